"""Dates and times in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "d MMMM yyyy", "MMMM d, yyyy")
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def publication_date(col: Column) -> Column:
    """A date in one of FORMATS, or the ISO date a longer text starts with."""
    t = F.trim(F.coalesce(col, F.lit("")))
    iso = F.try_to_date(F.nullif(F.regexp_extract(t, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit("")), "yyyy-MM-dd")
    return F.coalesce(iso, *[F.try_to_date(F.when(t != "", t), f) for f in FORMATS])


def month_days(col: Column) -> Column:
    """All 'Month d' mentions of a text, as written."""
    return F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(r"\b((?:" + "|".join(MONTHS) + r") [0-9]{1,2})\b"), F.lit(1))


def time_scope(label: Column) -> Column:
    """year, period, season or unspecified, by how a label is written."""
    t = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    return F.when(t.rlike(r"^(19|20)\d{2}$"), "year").when(t.rlike(r"^(19|20)\d{2}\s*[-–/]\s*(19|20)?\d{2}$") | (t == "multi-year"), "period").when(t.rlike(r"spring|summer|autumn|fall|winter|season"), "season").otherwise("unspecified")
