"""Queries of relational export, reports and vault notes, with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.operators import corpus as D
from claimloom.operators import fetching as H
from claimloom.plans.reference_queries import CLAIM_SQL, claims
from claimloom.sources import sinks
from claimloom.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


@query("select durable_claim_id, nullif(promotion_decision, '') promotion_decision, nullif(confidence, '') confidence, nullif(provenance_json, '') provenance_json from durable_claims")
def durable_relational(spark, d):
    return sinks.durable_rows(table(spark, d, "durable_claims")).select("durable_claim_id", "promotion_decision", "confidence", "provenance_json")


@query("""select 'INSERT INTO durable (durable_claim_id, run_id, confidence) VALUES (' || concat_ws(', ', coalesce('''' || replace(durable_claim_id, '''', '''''') || '''', 'NULL'), coalesce('''' || replace(run_id, '''', '''''') || '''', 'NULL'), coalesce('''' || replace(confidence, '''', '''''') || '''', 'NULL')) || ') ON CONFLICT (durable_claim_id) DO UPDATE SET run_id = EXCLUDED.run_id, confidence = EXCLUDED.confidence;' statement from durable_claims""")
def export_statements(spark, d):
    return sinks.upsert_statements(table(spark, d, "durable_claims").select("durable_claim_id", "run_id", "confidence"), "durable", ["durable_claim_id"])


NUM_SQL = "regexp_replace(printf('%.4f', {c}), '\\.?0+$', '')"


@query(f"""select ord, trim(concat_ws(' ', case when value_type = 'range' and range_min is not null and range_max is not null then {NUM_SQL.format(c='range_min')} || '–' || {NUM_SQL.format(c='range_max')} when numeric_value is not null then {NUM_SQL.format(c='numeric_value')} else coalesce(text_value, '') end, coalesce(unit, '')), ' ') shown from normalized_claims""")
def value_displays(spark, d):
    n = table(spark, d, "normalized_claims")
    return n.select("ord", sinks.value_display(*[F.col(c) for c in ("value_type", "numeric_value", "range_min", "range_max", "text_value", "unit")]).alias("shown"))


SLUG_SQL = "regexp_replace(lower(coalesce({c}, 'unknown')), '[^a-z0-9]+', '-', 'g')"


@query(f"""with {CLAIM_SQL}, c as (select distinct entity_name e, parameter_id p, source_url s, coalesce(raw_value_text, '') x from cl),
l as (select 'claims/' || {SLUG_SQL.format(c='e')} || '--' || {SLUG_SQL.format(c='p')} || '.md' path, concat_ws(': ', e, p) t, '- ' || x l, e k, p k2 from c union select 'hubs/' || {SLUG_SQL.format(c='e')} || '.md', coalesce(e, 'unknown'), '- [[' || {SLUG_SQL.format(c='e')} || '--' || {SLUG_SQL.format(c='p')} || ']]', e, '' from c union select 'sources/' || sha1(s) || '.md', s, '- [[' || {SLUG_SQL.format(c='e')} || '--' || {SLUG_SQL.format(c='p')} || ']]', s, '' from c where s is not null)
select path, '<!-- generated -->' || chr(10) || '# ' || t || chr(10) || chr(10) || string_agg(l, chr(10) order by l) note from l group by path, t, k, k2
union all select 'index.md', '<!-- generated -->' || chr(10) || '# Index' || chr(10) || chr(10) || string_agg('- ' || path, chr(10) order by '- ' || path) from (select path from l where path like 'hubs/%' group by path, k)""")
def vault(spark, d):
    """Notes of claims, hubs, sources and the index."""
    c = claims(spark, d).select("entity_name", "parameter_id", "source_url", "source_title", F.coalesce("raw_value_text", F.lit("")).alias("display"))
    return sinks.vault_notes(c)


@query("""with k as (select count(*) documents, count(*) filter (coalesce(is_metadata_only, false)) m, count(*) filter (coalesce(backfilled, false)) b from documents)
select '# Corpus' || chr(10) || chr(10) || case when round(cast(m as double) / documents, 3) < 0.15 then '- [x] ' else '- [ ] ' end || 'metadata' markdown from k""")
def gate_report(spark, d):
    return sinks.gates_markdown(D.qa_metrics(table(spark, d, "documents")), ["gate_metadata"], "Corpus")


@query("""with r as (select '| ' || parameter_id || ' | ' || count(*) || ' |' r from normalized_claims where parameter_id is not null group by parameter_id) select '# Claims' || chr(10) || chr(10) || '| parameter_id | n |' || chr(10) || '|---|---|' || chr(10) || string_agg(r, chr(10) order by r) markdown from r""")
def scorecard_report(spark, d):
    n = table(spark, d, "normalized_claims").where("parameter_id is not null").groupBy("parameter_id").agg(F.count("*").alias("n"))
    return sinks.scorecard_markdown(n, "Claims")


@query("""with c as (select run_id, count(*) n from normalized_claims group by 1), q as (select run_id, count(*) hits, count(distinct document_id) docs from query_hits group by 1)
select 'claims' stage, 'n' metric, cast(sum(n) as double) total from c union all select 'hits', 'hits', cast(sum(hits) as double) from q union all select 'hits', 'docs', cast(sum(docs) as double) from q""")
def handoff_totals(spark, d):
    c = table(spark, d, "normalized_claims").groupBy("run_id").agg(F.count("*").alias("n"))
    q = table(spark, d, "query_hits").groupBy("run_id").agg(F.count("*").alias("hits"), F.count_distinct("document_id").alias("docs"))
    return sinks.run_totals({"claims": c, "hits": q})


@query("""select 'one' provider, count(*) n from documents union all select 'two', count(*) from source_documents""")
def provider_union(spark, d):
    """The union of providers' rows; a failing provider stops no other."""

    def broken():
        raise RuntimeError("no answer")

    rows, errors = H.with_errors({"one": lambda: table(spark, d, "documents").select(F.col("canonical_url").alias("url")), "bad": broken, "two": lambda: table(spark, d, "source_documents").select(F.col("source_url").alias("url"))})
    assert errors == {"bad": "no answer"}
    return rows.groupBy("provider").agg(F.count("*").alias("n"))


@query("""select tier, cast(sum(planned) as bigint) planned, cast(sum(found) as bigint) found from (select coalesce(nullif(trim(source_tier_id, ' '), ''), 'unspecified') tier, count(distinct query) planned, count(*) found from query_hits group by 1) group by 1""")
def exploration_tiers(spark, d):
    """Planned queries and hits of each tier."""
    q = table(spark, d, "query_hits").withColumn("tier", F.coalesce(F.nullif(F.trim("source_tier_id"), F.lit("")), F.lit("unspecified")))
    return q.groupBy("tier").agg(F.count_distinct("query").alias("planned"), F.count("*").alias("found"))


@query("""with p as (select parameter_id, count(*) filter (source_tier_id = 'peer_reviewed_science') peer, count(*) n from normalized_claims group by 1) select m.parameter_id, case when p.n is null then 'no_claims' when p.peer = 0 then 'practice_only' when p.peer = p.n then 'science_only' else 'mixed' end status from parameter_manifest m left join p using (parameter_id)""")
def science_status(spark, d):
    """Whether a parameter's claims come from science, practice, both or nowhere."""
    n = table(spark, d, "normalized_claims").groupBy("parameter_id").agg(F.count_if(F.col("source_tier_id") == "peer_reviewed_science").alias("peer"), F.count("*").alias("n"))
    j = table(spark, d, "parameter_manifest").select("parameter_id").join(n, "parameter_id", "left")
    return j.select("parameter_id", F.when(F.col("n").isNull(), "no_claims").when(F.col("peer") == 0, "practice_only").when(F.col("peer") == F.col("n"), "science_only").otherwise("mixed").alias("status"))


@query("select coalesce(d.run_id, n.run_id) run_id, count(*) n from (select run_id, claim_id from normalized_claims) n full join (select run_id, source_claim_id from durable_claims) d on n.claim_id = d.source_claim_id group by 1")
def claims_across_runs(spark, d):
    """Claims of all runs with the run that promoted them."""
    n = table(spark, d, "normalized_claims").select("claim_id", F.col("run_id").alias("nr"))
    p = table(spark, d, "durable_claims").select("source_claim_id", F.col("run_id").alias("dr"))
    return n.join(p, F.col("claim_id") == F.col("source_claim_id"), "full").groupBy(F.coalesce("dr", "nr").alias("run_id")).agg(F.count("*").alias("n"))


@query("select distinct tier from (select coalesce(source_tier_id, '') tier from documents union select coalesce(source_tier_id, '') from query_hits union select tier_id from source_tiers)")
def tier_keys(spark, d):
    a = table(spark, d, "documents").select(F.coalesce("source_tier_id", F.lit("")).alias("tier"))
    b = table(spark, d, "query_hits").select(F.coalesce("source_tier_id", F.lit("")).alias("tier"))
    return a.unionByName(b).unionByName(table(spark, d, "source_tiers").select(F.col("tier_id").alias("tier"))).distinct()


@query("select tier_id, case when priority <= 2 then 'evidence' when priority <= 5 then 'reference' else 'discovery' end band from source_tiers")
def tier_bands(spark, d):
    p = F.col("priority")
    return table(spark, d, "source_tiers").select("tier_id", F.when(p <= 2, "evidence").when(p <= 5, "reference").otherwise("discovery").alias("band"))


@query("select source_domain, bool_or(status = 'accepted') has_accepted, max(case when source_title is not null then source_title end) last_label from normalized_claims where source_domain is not null group by 1")
def tier_has_claims(spark, d):
    n = table(spark, d, "normalized_claims").where("source_domain is not null")
    return n.groupBy("source_domain").agg(F.bool_or(F.col("status") == "accepted").alias("has_accepted"), F.max("source_title").alias("last_label"))


@query("select durable_claim_id, sha256(coalesce(provenance_json, '')) h, octet_length(encode(coalesce(provenance_json, ''))) bytes from durable_claims")
def content_hashes(spark, d):
    """Hash and size of stored bytes."""
    p = F.coalesce("provenance_json", F.lit(""))
    return table(spark, d, "durable_claims").select("durable_claim_id", F.sha2(p, 256).alias("h"), F.octet_length(F.encode(p, "UTF-8")).cast("bigint").alias("bytes"))
