"""Almoneda: public-tender analytics as declarative PySpark plans."""
