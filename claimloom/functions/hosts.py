"""Host names: spelling and site."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host_of(col: Column) -> Column:
    """Lower-case host without scheme, user, port, path and final dots; null for blank values."""
    h = F.lower(F.trim(col))
    h = F.regexp_replace(h, r"^[a-z][a-z0-9+.-]*://", "")
    h = F.regexp_replace(h, r"[/?#].*$", "")
    h = F.regexp_replace(h, r"^.*@", "")
    h = F.regexp_replace(h, r":\d*$", "")
    h = F.regexp_replace(h, r"\.+$", "")
    return F.nullif(h, F.lit(""))


def site_of(col: Column) -> Column:
    """The last two labels of a host; the host itself where it has one label; null for blank values."""
    return F.substring_index(host_of(col), ".", -2)
