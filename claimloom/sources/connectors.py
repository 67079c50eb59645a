"""Responses of bibliographic services as ledger rows: one declarative projection a provider.

Each takes a table with a `payload` column of JSON responses (replayed from a cache; fetching is an
injected adapter) and gives provider, title, source_url, doi and access_status of every result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, META = "open_full_text", "metadata_only"


def _first(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols])


def _open(flag: Column) -> Column:
    return F.when(F.coalesce(flag, F.lit(False)), OPEN).otherwise(META)


#: provider -> (schema of a response, column of its results)
SHAPES = {
    "openalex": ("results array<struct<id:string,display_name:string,doi:string,open_access:struct<is_oa:boolean,oa_url:string>,primary_location:struct<pdf_url:string,landing_page_url:string>>>", "results"),
    "crossref": ("message struct<items:array<struct<DOI:string,title:array<string>,URL:string>>>", "message.items"),
    "google_books": ("items array<struct<id:string,volumeInfo:struct<title:string,infoLink:string>,accessInfo:struct<publicDomain:boolean,viewability:string>>>", "items"),
    "open_library": ("docs array<struct<key:string,title:string,ia:array<string>>>", "docs"),
    "europe_pmc": ("resultList struct<result:array<struct<id:string,title:string,doi:string,fullTextUrlList:struct<fullTextUrl:array<struct<availability:string,url:string>>>>>>", "resultList.result"),
    "doaj": ("results array<struct<bibjson:struct<title:string,identifier:array<struct<type:string,id:string>>,link:array<struct<type:string,url:string>>>>>", "results"),
    "internet_archive": ("response struct<docs:array<struct<identifier:string,title:string>>>", "response.docs"),
    "doab": ("items array<struct<handle:string,metadata:array<struct<key:string,value:string>>>>", "items"),
    "wikipedia": ("query struct<search:array<struct<title:string,snippet:string>>>", "query.search"),
}


def results(provider: str, responses: DataFrame) -> DataFrame:
    schema, path = SHAPES[provider]
    extra = [c for c in responses.columns if c != "payload"]
    r = responses.select(*extra, F.from_json("payload", schema).alias("p")).select(*extra, F.posexplode(F.col(f"p.{path}")).alias("position", "r"))
    c = F.col
    no = F.lit(None).cast("string")
    if provider == "openalex":
        oa = c("r.open_access.oa_url")
        title, url, doi = c("r.display_name"), _first(oa, c("r.primary_location.pdf_url"), c("r.primary_location.landing_page_url"), c("r.doi"), c("r.id")), c("r.doi")
        access = _open(c("r.open_access.is_oa") | (F.coalesce(c("r.primary_location.pdf_url"), F.lit("")) != ""))
    elif provider == "crossref":
        title, url, doi, access = F.get("r.title", F.lit(0)), _first(c("r.URL")), c("r.DOI"), F.lit(META)
    elif provider == "google_books":
        title, url, doi = c("r.volumeInfo.title"), _first(c("r.volumeInfo.infoLink"), c("r.id")), no
        access = _open(c("r.accessInfo.publicDomain") | (c("r.accessInfo.viewability") == "ALL_PAGES"))
    elif provider == "open_library":
        ia = F.get("r.ia", F.lit(0))
        title, url, doi, access = c("r.title"), F.coalesce(F.concat(F.lit("ia:"), ia), c("r.key")), no, _open(ia.isNotNull())
    elif provider == "europe_pmc":
        free = F.get(F.filter("r.fullTextUrlList.fullTextUrl", lambda u: F.lower(u["availability"]).isin("open access", "free")), F.lit(0))
        title, url, doi, access = c("r.title"), _first(free["url"], c("r.doi"), c("r.id")), c("r.doi"), _open(free.isNotNull())
    elif provider == "doaj":
        last = lambda arr, kind, field: F.try_element_at(F.transform(F.filter(arr, lambda x: x["type"] == kind), lambda x: x[field]), F.lit(-1))
        doi = last(c("r.bibjson.identifier"), "doi", "id")
        link = last(c("r.bibjson.link"), "fulltext", "url")
        title, url, access = c("r.bibjson.title"), _first(link, doi), _open(link.isNotNull())
    elif provider == "internet_archive":
        r = r.where(F.coalesce(c("r.identifier"), F.lit("")) != "")
        title, url, doi, access = c("r.title"), F.concat(F.lit("ia:"), c("r.identifier")), no, F.lit(OPEN)
    elif provider == "doab":
        value = lambda key: F.try_element_at(F.transform(F.filter("r.metadata", lambda x: x["key"] == key), lambda x: x["value"]), F.lit(-1))  # noqa: E731 the last wins
        title, doi, access = value("dc.title"), value("oapen.identifier.doi"), F.lit(OPEN)
        url = _first(value("dc.identifier.uri"), c("r.handle"))
    elif provider == "wikipedia":
        title, url, doi, access = c("r.title"), F.concat(F.lit("wiki:"), F.replace(c("r.title"), F.lit(" "), F.lit("_"))), no, F.lit(OPEN)
    return r.select(*extra, F.lit(provider).alias("provider"), "position", title.alias("title"), url.alias("source_url"), doi.alias("doi"), access.alias("access_status"))


def fixture_search(queries: DataFrame, fixtures: DataFrame, k: int = 10) -> DataFrame:
    """Fixtures (url, title, snippet, tags) that share words with a query, the k with most shared words.

    An inverted join on words; no query meets a fixture it shares nothing with. Fixtures are a fixed table of test pages (some hundreds
    of rows), not a corpus.
    """
    from pyspark.sql import Window

    words = lambda col: F.array_distinct(F.regexp_extract_all(F.lower(col), F.lit("([a-z0-9]+)"), F.lit(1)))
    q = queries.select("query_id", F.explode(words(F.col("query"))).alias("w"))
    f = fixtures.select("url", F.explode(F.array_distinct(F.concat(words(F.concat_ws(" ", "title", "snippet")), F.coalesce(F.transform("tags", lambda t: F.lower(t)), F.array().cast("array<string>"))))).alias("w"))
    n = q.join(f, "w").groupBy("query_id", "url").agg(F.count("*").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "url")
    return n.withColumn("position", F.row_number().over(w)).where(F.col("position") <= k)


def resolve_open_copies(docs: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """oa_url and resolver of each doi: the first service's answer, else the second's (both: doi, url)."""
    a, b = first.groupBy("doi").agg(F.min("url").alias("_a")), second.groupBy("doi").agg(F.min("url").alias("_b"))
    j = docs.join(a, "doi", "left").join(b, "doi", "left")
    return j.withColumn("oa_url", F.coalesce("_a", "_b")).withColumn("oa_resolver", F.when(F.col("_a").isNotNull(), "first").when(F.col("_b").isNotNull(), "second")).drop("_a", "_b")
