"""Further queries: lookups, summaries, dates, relation reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.functions import dates
from claimloom.functions import text as X
from claimloom.operators import claims as C
from claimloom.operators import relations as R
from claimloom.plans.reference_queries import LEDGER_SQL, REL_SQL, ledger, nodes, relations
from claimloom.plans.reference_queries import QUERIES as BASE
from claimloom.plans.reference_queries import SQL as BASE_SQL
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


# ---------------------------------------------------------------- lookups
@query(f"""with {LEDGER_SQL}, q as (select canonical_key, list(distinct parameter_id) ids from led where parameter_id is not null group by 1), e as (select canonical_key, unnest(ids) parameter_id from q),
f as (select canonical_key, parameter_id, first(query order by ord) query from led group by 1, 2)
select e.canonical_key, e.parameter_id, coalesce(f.query, '') query from e left join f using (canonical_key, parameter_id)""")
def queue_ledger_join(spark, d):
    """Each queued key with its parameters and the first query that found it."""
    led = ledger(spark, d)
    q = led.where("parameter_id is not null").groupBy("canonical_key").agg(F.collect_set("parameter_id").alias("ids")).select("canonical_key", F.explode_outer("ids").alias("parameter_id"))
    first = led.groupBy("canonical_key", "parameter_id").agg(F.min_by("query", "ord").alias("query"))
    return q.join(first, ["canonical_key", "parameter_id"], "left").select("canonical_key", "parameter_id", F.coalesce("query", F.lit("")).alias("query"))


@query("""select n.ord, coalesce(m.parameter_id, 'unmapped.' || coalesce(n.attribute_subtype, '')) parameter from (select ord, attribute, attribute_subtype from normalized_claims) n
left join (select normalized_attribute, normalized_attribute_subtype, max(parameter_id) parameter_id from parameter_manifest where family <> 'soil' group by 1, 2) m on n.attribute = m.normalized_attribute and n.attribute_subtype = m.normalized_attribute_subtype""")
def subtype_lookup(spark, d):
    m = table(spark, d, "parameter_manifest").where("family <> 'soil'").groupBy(F.col("normalized_attribute").alias("attribute"), F.col("normalized_attribute_subtype").alias("attribute_subtype")).agg(F.max("parameter_id").alias("p"))
    n = table(spark, d, "normalized_claims").select("ord", "attribute", "attribute_subtype")
    return n.join(F.broadcast(m), ["attribute", "attribute_subtype"], "left").select("ord", F.coalesce("p", F.concat(F.lit("unmapped."), F.coalesce("attribute_subtype", F.lit("")))).alias("parameter"))


@query("select d.doc_id, coalesce(t.priority, (select max(priority) + 1 from source_tiers)) rank from documents d left join source_tiers t on d.source_tier_id = t.tier_id")
def tier_rank_lookup(spark, d):
    t = table(spark, d, "source_tiers").select(F.col("tier_id").alias("source_tier_id"), "priority")
    last = t.agg((F.max("priority") + 1).alias("last"))
    return table(spark, d, "documents").select("doc_id", "source_tier_id").join(F.broadcast(t), "source_tier_id", "left").join(F.broadcast(last), how="cross").select("doc_id", F.coalesce("priority", "last").alias("rank"))


@query("""with u as (select canonical_url, min(doc_id) doc_id, count(*) n from documents where canonical_url is not null group by 1)
select d.doc_id, u.doc_id fetched_as, u.n from documents d join u using (canonical_url)""")
def fetch_once_per_url(spark, d):
    """Every URL is worked on once; the result goes back to all its rows."""
    doc = table(spark, d, "documents").where("canonical_url is not null").select("doc_id", "canonical_url")
    once = doc.groupBy("canonical_url").agg(F.min("doc_id").alias("fetched_as"), F.count("*").alias("n"))
    return doc.join(once, "canonical_url").select("doc_id", "fetched_as", "n")


# ---------------------------------------------------------------- summaries
@query("select promotion_decision, count(*) n, count(distinct source_claim_id) claims, count(distinct run_id) runs, max(case lower(trim(confidence)) when 'high' then 3 when 'medium' then 2 when 'low' then 1 else 0 end) best_confidence from durable_claims group by 1")
def promotion_summary(spark, d):
    c = F.lower(F.trim("confidence"))
    rank = F.when(c == "high", 3).when(c == "medium", 2).when(c == "low", 1).otherwise(0)
    return table(spark, d, "durable_claims").groupBy("promotion_decision").agg(F.count("*").alias("n"), F.count_distinct("source_claim_id").alias("claims"), F.count_distinct("run_id").alias("runs"), F.max(rank).alias("best_confidence"))


@query("select parameter_id, count(*) claims, count(*) filter (normalized_numeric_value is not null) converted, count(*) filter (unit is null) without_unit, count(distinct unit) units from normalized_claims where value_type = 'numeric' group by 1")
def unit_report(spark, d):
    n = table(spark, d, "normalized_claims").where("value_type = 'numeric'")
    return n.groupBy("parameter_id").agg(F.count("*").alias("claims"), F.count_if(F.col("normalized_numeric_value").isNotNull()).alias("converted"), F.count_if(F.col("unit").isNull()).alias("without_unit"), F.count_distinct("unit").alias("units"))


@query("select count(*) parameters, count(*) filter (n > 0) with_claims, count(*) filter (n >= 100) with_many, count(*) filter (coalesce(n, 0) = 0) missing from (select p.parameter_id, count(c.claim_id) n from parameter_manifest p left join normalized_claims c using (parameter_id) group by 1)")
def coverage_rollup(spark, d):
    n = table(spark, d, "normalized_claims").groupBy("parameter_id").agg(F.count("claim_id").alias("n"))
    j = table(spark, d, "parameter_manifest").select("parameter_id").join(n, "parameter_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return j.agg(F.count("*").alias("parameters"), F.count_if(F.col("n") > 0).alias("with_claims"), F.count_if(F.col("n") >= 100).alias("with_many"), F.count_if(F.col("n") == 0).alias("missing"))


@query("select parameter_id, list_aggregate(list_sort(list(distinct raw_value_text))[1:4], 'string_agg', '; ') samples from normalized_claims where raw_value_text is not null group by 1")
def calibration_samples(spark, d):
    n = table(spark, d, "normalized_claims").where("raw_value_text is not null")
    return C.first_values(n, ["parameter_id"], "raw_value_text", 4).select("parameter_id", F.array_join("_s", "; ").alias("samples"))


@query("""with b as (select parameter_id, case common_unit when 'celsius' then 50.0 when '%' then 40.0 when 'days' then 160.0 when 'kg/ha' then 220.0 when 'fraction' then 1.0 end bound from parameter_manifest)
select ord, coalesce(greatest(abs(numeric_value), abs(range_min), abs(range_max)) > b.bound, false) outlier from normalized_claims left join b using (parameter_id)""")
def outlier_flags(spark, d):
    u = F.col("common_unit")
    bound = F.when(u == "celsius", 50.0).when(u == "%", 40.0).when(u == "days", 160.0).when(u == "kg/ha", 220.0).when(u == "fraction", 1.0)
    return C.flag_outliers(table(spark, d, "normalized_claims"), table(spark, d, "parameter_manifest").select("parameter_id", bound.alias("bound"))).select("ord", "outlier")


# ---------------------------------------------------------------- dates and excerpts
@query("""select ord, case when regexp_matches(t, '^(19|20)\\d{2}$') then 'year' when regexp_matches(t, '^(19|20)\\d{2}\\s*[-–/]\\s*(19|20)?\\d{2}$') or t = 'multi-year' then 'period' when regexp_matches(t, 'spring|summer|autumn|fall|winter|season') then 'season' else 'unspecified' end scope from (select ord, lower(trim(coalesce(time_label, ''))) t from normalized_claims)""")
def time_scopes(spark, d):
    return table(spark, d, "normalized_claims").select("ord", dates.time_scope(F.col("time_label")).alias("scope"))


@query("""select doc_id, coalesce(strftime(try_cast(nullif(regexp_extract(trim(coalesce(publication_date_hint, '')), '^(\\d{4}-\\d{2}-\\d{2})', 1), '') as date), '%Y-%m-%d'), '') published, cast(len(regexp_extract_all(coalesce(text, ''), '\\b((?:January|February|March|April|May|June|July|August|September|October|November|December) [0-9]{1,2})\\b', 1)) as int) month_days from documents""")
def document_dates(spark, d):
    doc = table(spark, d, "documents")
    return doc.select("doc_id", F.coalesce(F.date_format(dates.publication_date(F.col("publication_date_hint")), "yyyy-MM-dd"), F.lit("")).alias("published"), F.size(dates.month_days(F.col("text"))).alias("month_days"))


@query("""select ord, case when length(coalesce(raw_value_text, '')) > 0 and instr(lower(claim_text), lower(raw_value_text)) > 0 then substr(claim_text, greatest(instr(lower(claim_text), lower(raw_value_text)) - 30, 1), instr(lower(claim_text), lower(raw_value_text)) - greatest(instr(lower(claim_text), lower(raw_value_text)) - 30, 1) + length(raw_value_text) + 30) else substr(claim_text, 1, 60) end excerpt from normalized_claims where claim_text is not null""")
def evidence_excerpts(spark, d):
    n = table(spark, d, "normalized_claims").where("claim_text is not null")
    return n.select("ord", X.excerpt(F.col("claim_text"), F.coalesce("raw_value_text", F.lit("")), 30, 60).alias("excerpt"))


# ---------------------------------------------------------------- relations
_RESOLVE = BASE_SQL["resolve_relations"]


@query(f"with res as ({_RESOLVE}) select resolution, effect, count(*) pairs, cast(grouping(resolution) * 2 + grouping(effect) as int) \"level\" from res group by rollup (resolution, effect)")
def relation_coverage(spark, d):
    return R.coverage_report(BASE["resolve_relations"](spark, d)).withColumn("level", F.col("level").cast("int"))


@query(f"""with res as ({_RESOLVE}), g as (select *, case resolution when 'direct' then 2 when 'inferred' then 1 else 0 end grade from res)
select least(subject, object) a, greatest(subject, object) b, first(subject <= object order by grade desc, subject <= object desc) forward, first(resolution order by grade desc, subject <= object desc) resolution, first(effect order by grade desc, subject <= object desc) effect, max(grade) grade from g group by 1, 2""")
def relation_best_direction(spark, d):
    return R.best_direction(BASE["resolve_relations"](spark, d), {"direct": 2, "inferred": 1, "none": 0})


@query("""select a.n_name subject, b.n_name object, a.n_regionkey host_group, p.factor, p.effect from nation a join nation b on a.n_regionkey = b.n_regionkey and a.n_name < b.n_name
join (select r_regionkey host_group, 'shared ' || r_name factor, 'avoid' effect from region) p on p.host_group = a.n_regionkey""")
def host_overlay(spark, d):
    n = nodes(spark, d)
    hosts = n.select("node", F.col("group").alias("host_group"))
    caveats = table(spark, d, "region").select(F.col("r_regionkey").alias("host_group"), F.concat(F.lit("shared "), "r_name").alias("factor"), F.lit("avoid").alias("effect"))
    return R.host_overlay(R.unordered_pairs(n).where("subject < object"), hosts, caveats)


@query(f"""with {REL_SQL}, cells as (select subject, object, mode, first(effect order by ord, effect) effect from rel where tier = '3-MEDIUM' group by 1, 2, 3), gold as (select subject, object, mode, first(effect order by ord desc, effect) effect from rel group by 1, 2, 3)
select count(*) gold, count(*) filter (cells.effect is not null) found, count(*) filter (cells.effect = gold.effect) agree from gold left join cells using (subject, object, mode)""")
def relation_eval(spark, d):
    rel = relations(spark, d)
    cells = rel.where("tier = '3-MEDIUM'").groupBy("subject", "object", "mode").agg(F.min_by("effect", F.struct("ord", "effect")).alias("effect"))
    gold = rel.groupBy("subject", "object", "mode").agg(F.min_by("effect", F.struct((-F.col("ord")).alias("o"), "effect")).alias("effect"))
    return R.matrix_scores(gold, cells)
