"""Column normalisers (text, numbers, identifiers). All stay JVM-side."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

def _decomposed(compat: bool) -> tuple[str, str]:
    """Letters that Unicode takes apart into one plain letter and marks, and those plain letters; with ``compat`` also single characters that
    stand for another one (ª, ², full-width forms). From the characters' own decompositions."""
    letters, plain = [], []
    for n in [*range(0xA0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000), *(range(0x2070, 0x214F) if compat else ()), *(range(0xFF01, 0xFF5F) if compat else ())]:
        rest = "".join(c for c in unicodedata.normalize("NFKD" if compat else "NFD", chr(n)) if not unicodedata.combining(c))
        if rest != chr(n) and len(rest) == 1:
            letters.append(chr(n))
            plain.append(rest)
    return "".join(letters), "".join(plain)


ACCENTED, PLAIN = _decomposed(False)
COMPAT, COMPAT_PLAIN = _decomposed(True)
#: Ligatures and the letters they stand for.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬆ": "st", "ĳ": "ij", "Ĳ": "IJ", "…": "...", "№": "No", "™": "TM"}

#: The form of a usable CIF once normalised.
CIF_FORM = r"^([A-Z][0-9]{8}|[0-9]{8}[A-Z])\z"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """Trimmed of any Unicode white space; a blank text is null."""
    return F.nullif(F.regexp_replace(col(c), r"(?U)^\s+|\s+\z", ""), F.lit(""))


def number(c) -> Column:
    """Double of a numeric text; NaN and infinities count as no number."""
    v = clean_text(c).try_cast("double")
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), None).otherwise(v)


def money(c) -> Column:
    """Amount with two decimals of a numeric text, exact; NaN, infinities and other texts count as none."""
    return clean_text(c).try_cast("decimal(20,2)")


def integer(c) -> Column:
    """Integer of a numeric text, decimals cut off."""
    t = clean_text(c)
    return F.coalesce(t.try_cast("bigint"), number(c).try_cast("bigint")).try_cast("int")


def boolean(c) -> Column:
    """The words for yes and no."""
    t = F.lower(clean_text(c))
    return F.when(t.isin("true", "1", "si", "sí", "yes"), True).when(t.isin("false", "0", "no"), False)


def plausible_date(c, as_of: Column) -> Column:
    """A date between 2000-01-01 and as_of + 730 days, else null. Only the first ten characters count."""
    d = F.try_to_date(F.substring(clean_text(c), 1, 10), "yyyy-MM-dd")
    return F.when((d >= F.lit("2000-01-01").cast("date")) & (d <= F.date_add(as_of, 730)), d)


def cif(c) -> Column:
    """Identifier without white space, dots, slashes and dashes, in upper case; null gives ''."""
    return F.upper(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?U)[\s./\-]", ""))


def usable_cif(c) -> Column:
    return cif(c).rlike(CIF_FORM)


def file_number(c) -> Column:
    """File number without white space, slashes, dots and dashes, in upper case; null gives ''."""
    return F.upper(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?U)[\s/.\-]", ""))


def unaccented(c) -> Column:
    """Letters without their accents, composed or decomposed."""
    return F.regexp_replace(F.translate(col(c), ACCENTED, PLAIN), r"\p{Mn}+", "")


def fold(c) -> Column:
    """Lower case without accents."""
    return unaccented(F.lower(col(c)))


def plain_word(word: str) -> str:
    """``fold`` of a text on the driver."""
    return "".join(c for c in unicodedata.normalize("NFD", word.lower()) if not unicodedata.combining(c))


def fold_compat(c) -> Column:
    """Lower case without accents, compatibility characters as what they stand for (ª as a, ﬁ as fi, full-width letters as plain ones)."""
    t = F.lower(col(c))
    for k, v in LIGATURES.items():
        t = F.replace(t, F.lit(k), F.lit(v.lower()))
    return F.lower(F.regexp_replace(F.translate(t, COMPAT, COMPAT_PLAIN), r"\p{Mn}+", ""))


def fold_upper(c) -> Column:
    return unaccented(F.upper(col(c)))


def codes_text(c) -> Column:
    """' ' and the codes joined by ' ', as a prefix-searchable text; null gives ' '."""
    return F.concat(F.lit(" "), F.array_join(F.coalesce(col(c), F.array().cast("array<string>")), " "))


def code_prefix(c) -> Column:
    """What stands before a check digit's dash."""
    return F.substring_index(F.trim(col(c)), "-", 1)


def digits(c) -> Column:
    """Digits of the first word."""
    return F.regexp_replace(F.substring_index(F.trim(col(c)), " ", 1), "[^0-9]", "")


def looks_like_cif(c) -> Column:
    return cif(c).rlike(r"^[A-Z0-9]{8,10}\z") & cif(c).rlike("[0-9]")


def like_escaped(text: str) -> str:
    """A text whose wild cards stand for themselves in LIKE with a backslash as the escape."""
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def days_left(end, today: Column) -> Column:
    return F.datediff(F.to_date(col(end)), today)


def validity(end, today: Column, near: int = 180) -> Column:
    """How long something is still valid: 'vencida', 'ambar' within ``near`` days, 'verde'; null for no date."""
    d = days_left(end, today)
    return F.when(d < 0, "vencida").when(d < near, "ambar").when(d.isNotNull(), "verde")


def relative_days(d: Column) -> Column:
    """How a number of days is said."""
    return F.when(d == 0, "hoy").when(d == 1, "mañana").when(d > 1, F.concat(F.lit("en "), d, F.lit(" días"))).when(d == -1, "ayer").when(d < -1, F.concat(F.lit("hace "), -d, F.lit(" días")))


def first_year(*dates) -> Column:
    """The year, as text, of the first of these texts that begins with four digits; 's/f' if none does."""
    return F.coalesce(*[F.when(F.substring(col(d).cast("string"), 1, 4).rlike(r"^[0-9]{4}\z"), F.substring(col(d).cast("string"), 1, 4)) for d in dates], F.lit("s/f"))


def slug(c) -> Column:
    """Folded, with a dash for every run of other characters, none at the ends."""
    return F.regexp_replace(F.regexp_replace(fold_compat(c), "[^a-z0-9]+", "-"), r"^-|-\z", "")


def spanish_amount(c) -> Column:
    """1.234,50 € of an amount; a dash for none."""
    return F.coalesce(F.concat(F.translate(F.format_number(col(c).cast("decimal(30,2)"), 2), ",.", ".,"), F.lit(" €")), F.lit("—"))


def spanish_date(c) -> Column:
    return F.coalesce(F.date_format(col(c), "dd/MM/yyyy"), F.lit("—"))


def decimal_comma(c) -> Column:
    """Amount of a text with a decimal comma or point; blank gives none."""
    return F.replace(clean_text(c), F.lit(","), F.lit(".")).try_cast("decimal(20,2)")
