"""Queries of sources, sinks, places, evaluation helpers and the streaming extension."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from claimloom.functions import geo, values
from claimloom.functions import text as X
from claimloom.functions.keys import ordered_keys, search_pair_key
from claimloom.operators import claims as C
from claimloom.operators import ledger as L
from claimloom.operators.planning import provider_routes
from claimloom.session import shared_folder
from claimloom.sources import connectors, sinks
from claimloom.sources.tables import table
from claimloom.streaming import ledger_stream

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# ---------------------------------------------------------------- connectors
def _payload(spark, d):
    """Documents as cached responses of a bibliographic service, one a run."""
    doc = table(spark, d, "documents").select("doc_id", "run_id", "title", "doi", "canonical_url", "access_status")
    item = F.struct(F.concat(F.lit("W"), F.col("doc_id").cast("string")).alias("id"), F.col("title").alias("display_name"), "doi", F.struct((F.col("access_status") == "open_full_text").alias("is_oa"), F.when(F.col("access_status") == "open_full_text", F.col("canonical_url")).alias("oa_url")).alias("open_access"))
    return doc.groupBy("run_id").agg(F.to_json(F.struct(F.array_sort(F.collect_list(item)).alias("results"))).alias("payload"))


@query("""select 'W' || doc_id as id, run_id, title, coalesce(case when access_status = 'open_full_text' then nullif(trim(canonical_url), '') end, nullif(trim(doi), ''), 'W' || doc_id) source_url, doi,
case when coalesce(access_status = 'open_full_text', false) then 'open_full_text' else 'metadata_only' end access_status from documents""")
def connector_openalex(spark, d):
    r = connectors.results("openalex", _payload(spark, d))
    ids = _payload(spark, d).select("run_id", F.posexplode(F.from_json("payload", "results array<struct<id:string>>").getField("results")).alias("position", "i")).select("run_id", "position", F.col("i.id").alias("id"))
    return r.join(ids, ["run_id", "position"]).select("id", "run_id", "title", "source_url", "doi", "access_status")


@query("""with q as (select parameter_id query_id, unnest(list_distinct(regexp_extract_all(lower(label), '([a-z0-9]+)', 1))) w from parameter_manifest),
f as (select source_url url, unnest(list_distinct(regexp_extract_all(lower(coalesce(source_title, '')), '([a-z0-9]+)', 1))) w from (select source_url, min(source_title) source_title from source_documents group by 1)),
n as (select query_id, url, count(*) score from q join f using (w) group by 1, 2)
select query_id, url, score, cast(rn as int) as position from (select *, row_number() over (partition by query_id order by score desc, url) rn from n) where rn <= 10""")
def fixture_search(spark, d):
    fixtures = table(spark, d, "source_documents").groupBy(F.col("source_url").alias("url")).agg(F.min("source_title").alias("title")).withColumn("snippet", F.lit("")).withColumn("tags", F.array().cast("array<string>"))
    return connectors.fixture_search(table(spark, d, "parameter_manifest").select(F.col("parameter_id").alias("query_id"), F.col("label").alias("query")), fixtures)


@query("""with a as (select doi, min(canonical_url) url from documents where doi <> '' and access_status = 'open_full_text' and canonical_url is not null group by 1), b as (select doi, min(canonical_url) url from documents where doi <> '' and access_status = 'metadata_only' and canonical_url is not null group by 1)
select doc_id, coalesce(a.url, b.url) oa_url, case when a.url is not null then 'first' when b.url is not null then 'second' end oa_resolver from documents left join a using (doi) left join b using (doi)""")
def oa_resolve(spark, d):
    doc = table(spark, d, "documents")
    have = doc.where("doi <> '' and canonical_url is not null")
    pick = lambda k: have.where(F.col("access_status") == k).select("doi", F.col("canonical_url").alias("url"))
    return connectors.resolve_open_copies(doc.select("doc_id", "doi"), pick("open_full_text"), pick("metadata_only")).select("doc_id", "oa_url", "oa_resolver")


@query("""with t as (select tier_id, unnest(case when priority <= 2 then ['openalex', 'crossref'] when priority <= 5 then ['google_books'] else ['wikipedia'] end) provider from source_tiers)
select p.parameter_id, t.tier_id tier, t.provider from parameter_manifest p cross join t""")
def tier_routing(spark, d):
    t = provider_routes(table(spark, d, "source_tiers").select(F.col("tier_id").alias("tier"), "priority"), [(2, ("openalex", "crossref")), (5, ("google_books",))], ("wikipedia",))
    return table(spark, d, "parameter_manifest").select("parameter_id").join(F.broadcast(t), how="cross")


# ---------------------------------------------------------------- places
MENTION_SQL = r"\b([A-Z][a-z]+(?: [A-Z][a-z]+){0,2}) (?:district|valley|plain|station|county|Farm)\b"
GAZ_SQL = "gaz as (select lower(trim(location_name)) name, min(location_geo_id) geo_id from (select distinct location_name, location_geo_id from normalized_claims where location_name is not null and location_geo_id is not null) group by 1 having count(distinct location_geo_id) = 1)"


@query(f"with m as (select ord, unnest(list_distinct(regexp_extract_all(coalesce(claim_text, ''), '{MENTION_SQL}', 1))) as name from normalized_claims) select ord, name from m")
def place_mentions(spark, d):
    return geo.mentions(table(spark, d, "normalized_claims"), "ord", "claim_text")


@query(f"with m as (select ord, unnest(list_distinct(regexp_extract_all(coalesce(claim_text, ''), '{MENTION_SQL}', 1))) as name from normalized_claims), {GAZ_SQL} select m.ord, m.name, gaz.geo_id, case when gaz.geo_id is not null then 'gazetteer' else 'missing' end geo_source from m left join gaz on lower(trim(m.name)) = gaz.name")
def place_lookup(spark, d):
    n = table(spark, d, "normalized_claims")
    return geo.locate(geo.mentions(n, "ord", "claim_text"), n.select(F.col("location_name").alias("name"), F.col("location_geo_id").alias("geo_id")))


# ---------------------------------------------------------------- text and values
@query("select ord, regexp_replace(lower(trim(coalesce(entity_name, ''))), '[^a-z0-9]+', '-', 'g') entity, case when length(coalesce(raw_value_text, '')) > 0 and instr(lower(coalesce(claim_text, '')), lower(raw_value_text)) > 0 then true else false end faithful from normalized_claims")
def evidence_faithfulness(spark, d):
    n = table(spark, d, "normalized_claims")
    hit = (F.length(F.coalesce("raw_value_text", F.lit(""))) > 0) & (F.instr(F.lower(F.coalesce("claim_text", F.lit(""))), F.lower("raw_value_text")) > 0)
    return n.select("ord", F.regexp_replace(F.lower(F.trim(F.coalesce("entity_name", F.lit("")))), "[^a-z0-9]+", "-").alias("entity"), F.coalesce(hit, F.lit(False)).alias("faithful"))


@query("""select ord, case when len(regexp_extract_all(t, '[^ ]+')) >= 6 and ((len(list_filter(string_split(t, ' '), lambda p: regexp_matches(p, '^[0-9.,%]+$'))) >= 5 and len(list_filter(string_split(t, ' '), lambda p: regexp_matches(p, '^[0-9.,%]+$'))) * 2 >= len(regexp_extract_all(t, '[^ ]+')))
 or (len(list_filter(string_split(t, ' '), lambda p: regexp_matches(p, '^[A-Z]'))) >= 4 and len(list_filter(string_split(t, ' '), lambda p: regexp_matches(p, '^[0-9.,%]+$'))) >= 2)) then true else false end table_like
from (select ord, trim(regexp_replace(coalesce(evidence_text, ''), '[\\s\\x{A0}\\x{2009}\\x{202F}]+', ' ', 'g')) t from normalized_claims)""")
def table_like_evidence(spark, d):
    return table(spark, d, "normalized_claims").select("ord", X.table_like(F.col("evidence_text")).alias("table_like"))


@query("select ord, least(entity_name, cultivar) || '|' || greatest(entity_name, cultivar) pair, case when entity_name = cultivar then 1 else 2 end orders from normalized_claims where entity_name is not null and cultivar is not null")
def pair_keys(spark, d):
    n = table(spark, d, "normalized_claims").where("entity_name is not null and cultivar is not null")
    return n.select("ord", search_pair_key(F.col("entity_name"), F.col("cultivar")).alias("pair"), F.size(ordered_keys(F.col("entity_name"), F.col("cultivar"))).alias("orders"))


@query("select ord, case when normalized_numeric_value is null or numeric_value is null then false else abs(normalized_numeric_value - numeric_value) <= 0.05 * greatest(abs(numeric_value), 1e-9) end same from normalized_claims")
def numeric_matches(spark, d):
    none = F.lit(None).cast("double")
    return table(spark, d, "normalized_claims").select("ord", values.numeric_match(F.col("numeric_value"), F.col("normalized_numeric_value"), none, none).alias("same"))


@query("""select ord, qualifier, case lower(trim(coalesce(qualifier, ''))) when 'about' then 'approximate' when 'at least' then 'lower_bound' when 'up to' then 'upper_bound' when 'qualitative' then 'qualitative' else 'exact' end observation from normalized_claims""")
def qualifier_map(spark, d):
    kinds = {"about": "approximate", "at least": "lower_bound", "up to": "upper_bound", "qualitative": "qualitative"}
    return table(spark, d, "normalized_claims").select("ord", "qualifier", values.observation_type(F.col("qualifier"), kinds, "exact").alias("observation"))


@query("select run_id, document_type, count(*) n, count(distinct source_url) sources from normalized_claims group by grouping sets ((run_id), (document_type), ())")
def claim_cube(spark, d):
    n = table(spark, d, "normalized_claims")
    return n.groupingSets([["run_id"], ["document_type"], []], "run_id", "document_type").agg(F.count("*").alias("n"), F.count_distinct("source_url").alias("sources"))


@query("select doc_id, capture, previous_doc from (select doc_id, row_number() over (partition by source_domain order by doc_id) capture, coalesce(lag(doc_id) over (partition by source_domain order by doc_id), -1) previous_doc from documents where source_domain is not null)")
def capture_sequence(spark, d):
    """Position and predecessor of each document within its domain."""
    s = L.sequence(table(spark, d, "documents").where("source_domain is not null").select("doc_id", "source_domain"), "source_domain", "doc_id")
    return s.select("doc_id", F.col("position").cast("bigint").alias("capture"), F.coalesce("previous", F.lit(-1)).alias("previous_doc"))


# ---------------------------------------------------------------- sinks
@query("select claim_id, ord, status from (select *, row_number() over (partition by claim_id order by ord desc) rn from normalized_claims) where rn = 1")
def upsert_claims(spark, d):
    n = table(spark, d, "normalized_claims").select("claim_id", "ord", "status", "confidence")
    return sinks.upserted(n.where("confidence = 'high'").drop("confidence"), n.where("confidence is null or confidence <> 'high'").drop("confidence"), ["claim_id"], "ord")


@query("""select parameter_id, '<!-- generated -->' || chr(10) || '# ' || coalesce(min(attribute), '') || chr(10) || chr(10) || string_agg(distinct '- ' || text_value, chr(10) order by '- ' || text_value) note from normalized_claims where text_value is not null group by 1""")
def parameter_notes(spark, d):
    return sinks.notes(table(spark, d, "normalized_claims").where("text_value is not null"), ["parameter_id"], "attribute", "text_value")


# ---------------------------------------------------------------- streaming extension
def _streamed(spark, d, name: str, plan, mode: str = "append"):
    """Runs a stream to the end of the data, into a table of the shared folder (its checkpoint beside it), and reads that table."""
    schema = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts", "value").schema
    s = spark.readStream.schema(schema).option("pathGlobFilter", "events*").option("recursiveFileLookup", "true").parquet(d)
    place = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    out = plan(s)
    if mode == "append":
        q = out.writeStream.format("parquet").option("path", f"{place}/table").option("checkpointLocation", f"{place}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    else:  # the whole result of every trigger replaces the table
        q = out.writeStream.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{place}/table")).option("checkpointLocation", f"{place}/checkpoint").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{place}/table")


@query("select user_id, event_type, count(*) > 0 seen from events group by 1, 2")
def events_dedupe_stream(spark, d):
    """Each (user, type) once, as a stream run to the end of the data; the watermark is that of the table's length of time."""
    days = table(spark, d, "events").agg((F.max(F.col("ts").cast("timestamp").cast("long")) - F.min(F.col("ts").cast("timestamp").cast("long"))) / 86400 + 1).first()[0] or 1
    plan = lambda s: ledger_stream.first_of_key(s.withColumn("at", F.col("ts").cast("timestamp")), ["user_id", "event_type"], late=f"{int(days) + 1} days").select("user_id", "event_type", F.lit(True).alias("seen"))
    return _streamed(spark, d, "events_dedupe_stream", plan)


@query("select epoch_us(time_bucket(interval 1 day, cast(ts as timestamp))) window_start, event_type, count(*) n, max(value) best from events group by 1, 2")
def events_window_stream(spark, d):
    """Counts by window and type; the last window stands in the table too, since every trigger writes the state as it is."""
    plan = lambda s: ledger_stream.windowed_counts(s.select(F.col("ts").cast("timestamp").alias("at"), "event_type", F.col("value").alias("score")), ["event_type"], width="1 day")
    return _streamed(spark, d, "events_window_stream", plan, "complete").withColumn("window_start", F.unix_micros("window_start"))


@query("select claim_id, ord from (select claim_id, ord, row_number() over (partition by claim_id order by ord) rn from normalized_claims) where rn = 1")
def claim_first(spark, d):
    n = table(spark, d, "normalized_claims").select("claim_id", (-F.col("ord")).alias("v"))
    return C.latest(n, ["claim_id"], ["v"]).select("claim_id", (-F.col("v")).alias("ord"))
