"""Part of almoneda; see the README for what each module holds."""
