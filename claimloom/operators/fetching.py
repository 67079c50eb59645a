"""Fetch stages over injected payloads: one fetch a URL, salvage, captures, repair of missing full texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.keys import junk_doi, normalize_doi
from claimloom.functions.predicates import looks_like_html, low_value


def urls_once(queue: DataFrame, url: str = "source_url") -> DataFrame:
    """The distinct URLs of a queue with their first position: each is fetched once, whatever rows ask for it."""
    return queue.where(F.coalesce(url, F.lit("")) != "").groupBy(F.col(url).alias("url")).agg(F.min("ord").alias("first_ord"), F.count("*").alias("rows"))


def fetched(urls: DataFrame, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """url, text, content_type, error: what the injected adapter returned; a URL it says nothing of is an error row."""
    got = fetch(urls)
    return urls.join(got, "url", "left").select(*urls.columns, "text", "content_type", F.coalesce("error", F.when(F.col("text").isNull(), F.lit("not_found"))).alias("error"))


def salvaged(pages: DataFrame) -> DataFrame:
    """document_type (a page that says PDF and begins like HTML is HTML) and ok (no error, no challenge page, not too short)."""
    says_pdf = F.lower(F.coalesce("content_type", F.lit(""))).contains("pdf") | F.lower("url").rlike(r"\.pdf(?:$|[?#])")
    kind = F.when(says_pdf & looks_like_html(F.col("text")), "html").when(says_pdf, "pdf").otherwise("html")
    return pages.withColumn("document_type", kind).withColumn("ok", F.col("error").isNull() & ~low_value(F.col("text")))


def captures(queue: DataFrame, pages: DataFrame, run: str) -> DataFrame:
    """One capture a row and parameter of the queue: full text where its URL came out well, else metadata only.

    queue: ord, source_url, parameters (map parameter -> query), access_status; pages: salvaged(). Rows that are metadata only are not fetched for.
    """
    wanted = queue.select("ord", "source_url", "access_status", F.explode_outer("parameters").alias("parameter_id", "query"))
    j = wanted.join(pages.select(F.col("url").alias("source_url"), "text", "document_type", "ok"), "source_url", "left")
    full = F.coalesce(F.col("ok"), F.lit(False)) & (F.coalesce("access_status", F.lit("")) != "metadata_only")
    return j.select(
        "ord", F.lit(run).alias("run_id"), "source_url", "parameter_id", F.coalesce("query", F.lit("")).alias("query"),
        F.when(full, "open_full_text").otherwise("metadata_only").alias("access_status"), F.when(full, F.col("text")).otherwise("").alias("raw_text"),
        F.when(full, F.col("document_type")).otherwise("other").alias("document_type"), F.when(full, "parsed").otherwise("captured").alias("status"),
    )


def metadata_capture(row: DataFrame) -> DataFrame:
    """A capture without text: the columns of a full one, its texts empty."""
    return row.withColumns({"access_status": F.lit("metadata_only"), "raw_text": F.lit(""), "snippet": F.lit(""), "document_type": F.lit("other"), "parser_used": F.lit("metadata-only"), "status": F.lit("captured")})


def fetch_summary(caps: DataFrame) -> DataFrame:
    return caps.agg(F.count("*").alias("captures"), F.count_distinct("source_url").alias("sources"), F.count_if(F.col("status") == "parsed").alias("parsed"), F.count_distinct(F.when(F.col("access_status") == "metadata_only", F.col("source_url"))).alias("metadata_only_sources"))


def reference_url(label: Column, base: str = "https://en.wikipedia.org/wiki/") -> Column:
    """The page of a label in an encyclopedia: words joined by underscores, the rest percent-encoded."""
    return F.concat(F.lit(base), F.replace(F.url_encode(F.replace(F.trim(label), F.lit(" "), F.lit("_"))), F.lit("+"), F.lit("%20")))


def with_errors(results: dict[str, Callable[[], DataFrame]]) -> tuple[DataFrame | None, dict[str, str]]:
    """(the union of the providers' rows with `provider`, the errors of those that failed): one provider's failure does not stop the others."""
    rows, errors = None, {}
    for name, search in results.items():
        try:
            df = search().withColumn("provider", F.lit(name))
        except Exception as e:  # noqa: BLE001 an injected adapter may fail in any way
            errors[name] = str(e)
            continue
        rows = df if rows is None else rows.unionByName(df, allowMissingColumns=True)
    return rows, errors


def fixture_fetch(urls: DataFrame, fixture: DataFrame) -> DataFrame:
    """url, status, text: the stored page, else a not_found record. fixture: url, text (one row a URL)."""
    return urls.select("url").join(fixture.select("url", "text"), "url", "left").select("url", F.when(F.col("text").isNotNull(), "ok").otherwise("not_found").alias("status"), F.coalesce("text", F.lit("")).alias("text"))


def repair_outcome(doi: Column, open_url: Column, text: Column) -> Column:
    """What repairing a document without full text comes to, in this order."""
    d = normalize_doi(doi)
    return F.when(d == "", "no_doi").when(junk_doi(doi), "junk_doi").when(open_url.isNull(), "no_oa_full_text").when(F.coalesce(text, F.lit("")) == "", "fetch_failed").otherwise("full_text")


def repaired(docs: DataFrame, open_copies: DataFrame, texts: DataFrame) -> DataFrame:
    """Documents that are metadata only, repaired where an open copy and its text are there; the others with the reason. docs: doc_id, doi, is_metadata_only, text; open_copies: doi, url; texts: url, text."""
    d = docs.where("is_metadata_only").withColumn("_d", normalize_doi(F.col("doi")))
    o = open_copies.select(normalize_doi(F.col("doi")).alias("_d"), F.col("url").alias("oa_url")).where("_d <> ''").groupBy("_d").agg(F.min("oa_url").alias("oa_url"))
    j = d.join(o, "_d", "left").join(texts.select(F.col("url").alias("oa_url"), F.col("text").alias("oa_text")), "oa_url", "left")
    out = repair_outcome(F.col("doi"), F.col("oa_url"), F.col("oa_text"))
    return j.select("doc_id", out.alias("outcome"), F.when(out == "full_text", F.col("oa_text")).alias("new_text"), (out == "full_text").alias("backfilled"))
