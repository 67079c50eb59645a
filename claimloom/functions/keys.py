"""Identity keys of sources and relationships."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_doi(col: Column) -> Column:
    """Lower case, without resolver prefix, outer slashes and spaces; '' for null."""
    d = F.lower(F.trim(F.coalesce(col, F.lit(""))))
    d = F.regexp_replace(d, r"^(https?://)?(dx\.)?doi\.org/", "")
    d = F.regexp_replace(d, r"^doi:\s*", "")
    return F.regexp_replace(d, r"^/+|/+$", "")


def url_host(col: Column) -> Column:
    h = F.lower(F.regexp_extract(F.coalesce(col, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return F.regexp_replace(h, r"^www\.", "")


def url_path(col: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(F.coalesce(col, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), r"/+$", "")


def canonical_key(doi: Column, url: Column) -> Column:
    """doi:<doi> where there is one, else url:<host><path> in lower case without the query."""
    d = normalize_doi(doi)
    return F.when(d != "", F.concat(F.lit("doi:"), d)).otherwise(F.concat(F.lit("url:"), url_host(url), F.lower(url_path(url))))


#: DOIs that name no article (fixed values).
JUNK_DOI = r"(^10\.99999/|/xxxx$|/0000$|^pending$|^-$|^n/a$|^none$)"


def junk_doi(col: Column) -> Column:
    return normalize_doi(col).rlike(JUNK_DOI)


def pair_key(mode: Column, a: Column, b: Column, symmetric: Column) -> Column:
    """mode|a|b, the ends sorted where the relation is symmetric."""
    return F.when(symmetric, F.concat_ws("|", mode, F.least(a, b), F.greatest(a, b))).otherwise(F.concat_ws("|", mode, a, b))


def search_pair_key(a: Column, b: Column) -> Column:
    return F.concat_ws("|", F.least(a, b), F.greatest(a, b))


def ordered_keys(a: Column, b: Column) -> Column:
    """Both orders of a pair, once where the ends are equal."""
    return F.array_distinct(F.array(F.concat_ws("|", a, b), F.concat_ws("|", b, a)))
