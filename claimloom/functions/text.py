"""Text expressions of the curation pipeline, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STOPWORDS = ("the", "and", "for", "from", "with", "under", "near", "over")


def normalize_ws(col: Column) -> Column:
    """White space (Unicode) collapsed to single spaces and trimmed."""
    return F.trim(F.regexp_replace(col, r"(?U)\s+", " "))


def text_hash(col: Column) -> Column:
    """SHA-256 of the collapsed text; '' for blank or null text."""
    t = normalize_ws(F.coalesce(col, F.lit("")))
    return F.when(t == "", F.lit("")).otherwise(F.sha2(t, 256))


def fallback_key(url: Column, title: Column) -> Column:
    """Content key of a record without text."""
    return F.sha2(F.concat(F.coalesce(url, F.lit("")), F.lit("|"), F.coalesce(title, F.lit(""))), 256)


def document_id(key: Column) -> Column:
    return F.concat(F.lit("doc-"), F.substring(key, 1, 16))


def tokens(col: Column) -> Column:
    """Distinct lower-case ASCII word tokens, in order of first use."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1)))


def title_tokens(col: Column) -> Column:
    return F.array_except(F.filter(tokens(col), lambda t: F.length(t) > 2), F.array(*[F.lit(s) for s in STOPWORDS]))


def overlap_share(part: Column, whole: Column) -> Column:
    """Share of the tokens of `whole` that `part` has; null without tokens."""
    return F.try_divide(F.size(F.array_intersect(part, whole)).cast("double"), F.size(whole).cast("double"))


def sentences(col: Column) -> Column:
    """Sentences: split after . ! ? before white space, blanks dropped."""
    marked = F.regexp_replace(F.coalesce(col, F.lit("")), r"([.!?])\s+", "$1\u0001")
    return F.filter(F.transform(F.split(marked, "\u0001"), lambda s: F.trim(s)), lambda s: s != "")


def excerpt(text: Column, needle: Column, margin: int = 120, fallback: int = 240) -> Column:
    """Up to margin characters on both sides of the first case-insensitive occurrence, else the start."""
    at = F.instr(F.lower(text), F.lower(needle))
    start = F.greatest(at - margin, F.lit(1))
    return F.when((at > 0) & (F.length(needle) > 0), F.substring(text, start, at - start + F.length(needle) + margin)).otherwise(F.substring(text, 1, fallback))


def truncate(col: Column, limit: int = 240) -> Column:
    """Collapsed text, cut with '...' to at most limit characters."""
    t = normalize_ws(F.coalesce(col, F.lit("")))
    return F.when(F.length(t) <= limit, t).otherwise(F.concat(F.rtrim(F.substring(t, 1, limit - 3)), F.lit("...")))


def slug(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def span_key(col: Column) -> Column:
    return F.lower(normalize_ws(F.coalesce(col, F.lit(""))))


def drop_repeated_words(col: Column) -> Column:
    """A word equal (letter case aside) to the word before it goes."""
    words = F.split(normalize_ws(F.coalesce(col, F.lit(""))), " ")
    kept = F.filter(words, lambda w, i: (i == 0) | (F.lower(w) != F.lower(F.get(words, i - 1))))
    return F.array_join(kept, " ")


def document_type(content_type: Column, url: Column) -> Column:
    ct, path = F.lower(F.coalesce(content_type, F.lit(""))), F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"[?#].*$", ""))
    return (
        F.when(ct.contains("pdf"), "pdf").when(ct.contains("json"), "json").when(ct.contains("csv"), "csv").when(ct.contains("html"), "html")
        .when(path.endswith(".pdf"), "pdf").when(path.endswith(".json"), "json").when(path.endswith(".csv"), "csv").when(path.rlike(r"(\.html?|/[^./]*)$"), "html").otherwise("other")
    )


def evidence_label(col: Column) -> Column:
    t = F.lower(F.trim(F.coalesce(col, F.lit(""))))
    reference = t.rlike(r"^https?://|doi\.org|^\[?\d+[.\])] .*(19|20)\d\d")
    return F.when(reference, "reference").when(t.rlike(r"^table \d"), "table").when(t.rlike(r"^(figure|fig\.) ?\d"), "figure").when(t.startswith("abstract"), "abstract").when(t.rlike(r"^chapter \d"), "chapter").otherwise("claim")


def table_like(col: Column) -> Column:
    """At least six tokens of which most are numbers, or many capitalised ones and a few numbers."""
    parts = F.filter(F.split(normalize_ws(F.coalesce(col, F.lit(""))), " "), lambda p: p != "")
    numbers = F.size(F.filter(parts, lambda p: p.rlike(r"^[0-9.,%]+$")))
    capitals = F.size(F.filter(parts, lambda p: p.rlike(r"^[A-Z]")))
    return (F.size(parts) >= 6) & (((numbers >= 5) & (numbers * 2 >= F.size(parts))) | ((capitals >= 4) & (numbers >= 2)))


def title_case(col: Column) -> Column:
    """Words parted by spaces and underscores, each with a capital and else small."""
    words = F.filter(F.split(F.coalesce(col, F.lit("")), r"[\s_]+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.length(w))))), " ")


def safe_filename(col: Column) -> Column:
    """A name without the characters that file systems keep for themselves."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(col, F.lit("")), r"[\\/:*?\"<>|]+", " "), r"\s+", " "))
