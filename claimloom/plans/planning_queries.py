"""Queries of planning, scoring and text predicates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from claimloom.functions import predicates as P
from claimloom.functions import scoring as S
from claimloom.functions import text as X
from claimloom.operators import planning as L
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


# ---------------------------------------------------------------- planning
PARAM_SQL = "par as (select *, row_number() over (order by parameter_id) pos from parameter_manifest)"


def _parameters(spark, d):
    return table(spark, d, "parameter_manifest").withColumn("pos", F.row_number().over(Window.orderBy("parameter_id"))).withColumn("applies_to", F.array().cast("array<string>"))


@query(f"with {PARAM_SQL} select parameter_id, pos from par where family in ('planting', 'yield', 'water') order by pos limit 5")
def plan_parameters(spark, d):
    return L.select_parameters(_parameters(spark, d), families=["planting", "yield", "water"], crop_group="cereal", limit=5).select("parameter_id", F.col("pos").cast("bigint").alias("pos"))


@query("select tier_id, priority, pos from (select tier_id, priority, case tier_id when 'textbook_reference' then 0 when 'peer_reviewed_science' then 1 end pos from source_tiers) where pos is not null")
def plan_tiers(spark, d):
    t = L.in_given_order(table(spark, d, "source_tiers"), "tier_id", ["textbook_reference", "peer_reviewed_science"])
    return t.select("tier_id", "priority", F.when(F.col("tier_id") == "textbook_reference", 0).otherwise(1).alias("pos"))


@query(f"""with {PARAM_SQL}, x as (select p.parameter_id, t.tier_id tier, g pattern_pos, p.pos, t.priority, case g when 0 then p.label || ' field trial ' || t.label when 1 then t.label || ' ' || p.label || ' guide guide' end q from par p cross join source_tiers t cross join range(0, 2) r(g))
select parameter_id, tier, cast(pattern_pos as int) pattern_pos, regexp_replace(q, ' guide guide$', ' guide') query, cast(row_number() over (order by pos, pattern_pos, priority) as int) plan_pos from x""")
def plan_queries(spark, d):
    return L.plan(_parameters(spark, d), ["{label} field trial {tier}", "{tier} {label} guide guide"], table(spark, d, "source_tiers"))


@query("""with seeds as (select source_url, source_tier_id tier, min(case document_type when 'pdf' then 'id' when 'html' then 'family' else 'any' end) kind from normalized_claims where source_url is not null group by 1, 2),
q as (select parameter_id || '@' || t.tier_id query_id, parameter_id, family, t.tier_id tier from parameter_manifest cross join source_tiers t),
j as (select q.query_id, s.source_url, min(case when kind = 'id' and q.parameter_id = 'yield.grain_yield' then 0 when kind = 'family' and q.family = 'planting' then 1 when kind = 'any' then 2 end) seed_rank from q join seeds s using (tier) group by 1, 2)
select query_id, source_url, seed_rank, cast(rn as int) as position from (select *, row_number() over (partition by query_id order by seed_rank, source_url) rn from j where seed_rank is not null) where rn <= 3""")
def plan_seeds(spark, d):
    none = F.array().cast("array<string>")
    kind = F.when(F.col("document_type") == "pdf", "id").when(F.col("document_type") == "html", "family").otherwise("any")
    s = table(spark, d, "normalized_claims").where("source_url is not null").groupBy("source_url", F.col("source_tier_id").alias("tier")).agg(F.min(kind).alias("kind"))
    seeds = s.select("source_url", "tier", F.when(F.col("kind") == "id", F.array(F.lit("yield.grain_yield"))).otherwise(none).alias("parameter_ids"), F.when(F.col("kind") == "family", F.array(F.lit("planting"))).otherwise(none).alias("families"))
    t = table(spark, d, "source_tiers").select(F.col("tier_id").alias("tier"))
    q = table(spark, d, "parameter_manifest").select("parameter_id", "family").join(F.broadcast(t), how="cross").withColumn("query_id", F.concat("parameter_id", F.lit("@"), "tier"))
    return L.seeds_for(q, seeds).select("query_id", "source_url", "seed_rank", "position")


@query("select source_url, parameter_id from (select source_url, unnest([parameter_id, parameter_id || '.old']) parameter_id from (select distinct source_url, parameter_id from normalized_claims where source_url is not null)) where parameter_id not in (select parameter_id from parameter_manifest)")
def seed_unknown_references(spark, d):
    n = table(spark, d, "normalized_claims").where("source_url is not null").select("source_url", "parameter_id").distinct()
    seeds = n.select("source_url", F.array("parameter_id", F.concat("parameter_id", F.lit(".old"))).alias("parameter_ids"))
    return L.unknown_references(seeds, table(spark, d, "parameter_manifest")).where("parameter_id is not null")


# ---------------------------------------------------------------- scoring
@query("""select doc_id, cast(greatest(0, least(100, 45 + case when coalesce(document_type = 'pdf', false) then 3 else 0 end + case when coalesce(is_metadata_only, false) then -10 else 0 end + case when contains(lower(coalesce(title, '')), 'yield') then 4 else 0 end + case when coalesce(source_tier_id = 'peer_reviewed_science', false) then 12 else 0 end + case when coalesce(length(text) < 200, false) then -8 else 0 end)) as int) score,
 case when coalesce(is_metadata_only, false) then 'metadata' when coalesce(length(text) < 200, false) then 'short' else '' end reason from documents""")
def source_score(spark, d):
    rules = {
        "pdf": (F.col("document_type") == "pdf", 3), "metadata": (F.col("is_metadata_only"), -10), "topic": (F.lower(F.coalesce("title", F.lit(""))).contains("yield"), 4),
        "tier": (F.col("source_tier_id") == "peer_reviewed_science", 12), "short": (F.length("text") < 200, -8),
    }
    return table(spark, d, "documents").select("doc_id", S.total(rules, 45, 0, 100).alias("score"), S.first_reason([("metadata", F.col("is_metadata_only")), ("short", F.length("text") < 200)]).alias("reason"))


@query("""select ord, cast(case when regexp_matches(t, '[0-9]') then 5 else 0 end + case when contains(lower(t), 'yield') then 3 else 0 end + case when t like '%|%' then -8 else 0 end as int) score,
 concat_ws(',', case when t like '%|%' then 'layout' end, case when contains(lower(t), 'yield') then 'topic' end, case when regexp_matches(t, '[0-9]') then 'number' end) parts from (select ord, coalesce(evidence_text, '') t from normalized_claims)""")
def sentence_quality(spark, d):
    t = F.coalesce("evidence_text", F.lit(""))
    rules = {"number": (t.rlike("[0-9]"), 5), "topic": (F.lower(t).contains("yield"), 3), "layout": (t.contains("|"), -8)}
    names = S.reasons({k: rules[k][0] for k in ("layout", "topic", "number")})
    return table(spark, d, "normalized_claims").select("ord", S.total(rules).alias("score"), F.array_join(names, ",").alias("parts"))


# ---------------------------------------------------------------- predicates
@query(r"""select ord, length(t) < 200 or (length(t) < 1500 and regexp_matches(lower(t), 'checking your browser|enable javascript|captcha|recaptcha|just a moment|access denied|403 forbidden|cloudflare|request unsuccessful|are you a robot|verifying you are human')) low_value, regexp_matches(lower(t), '[0-9](?:\.[0-9]+)? ?(?:%|°c|°f|celsius|fahrenheit|mm|cm|m|kg|t|g|lb|ha|ac|days|weeks)(?:$|[^a-z])') specific from (select ord, trim(coalesce(evidence_text, ''), ' ') t from normalized_claims)""")
def evidence_predicates(spark, d):
    e = F.col("evidence_text")
    return table(spark, d, "normalized_claims").select("ord", P.low_value(e).alias("low_value"), P.specific_evidence(e).alias("specific"))


@query(r"""with l as (select doc_id, unnest(string_split(text, chr(10))) line from documents where text is not null), t as (select doc_id, trim(line, ' ') t from l)
select doc_id, count(*) n_lines, count(*) filter (regexp_matches(t, '^https?://') or regexp_matches(lower(t), 'doi\.org/|\bdoi: ?10\.') or regexp_matches(t, '^\[?[0-9]+[.\])] .*(19|20)[0-9]{2}') or regexp_matches(t, '^[A-Z][a-z]+,? [A-Z]\..*\(?(19|20)[0-9]{2}')) reference_lines,
 count(*) filter (t = '' or regexp_matches(t, '^[-–—_=.· ]{3,}$') or regexp_matches(t, '^[-–—\[( ]*[0-9]{1,4}[-–—\]) ]*$') or regexp_matches(lower(t), '^page [0-9]+( of [0-9]+)?$|^(vol\.|volume|issue) [0-9]|all rights reserved|^©')) noise_lines from t group by 1""")
def line_kinds(spark, d):
    lines = table(spark, d, "documents").where("text is not null").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(P.reference_entry(F.col("line"))).alias("reference_lines"), F.count_if(P.page_noise(F.col("line"))).alias("noise_lines"))


@query("""select ord, d like '%quarofield.example' or d like '%sanosoil.example' trusted, case when s = '' then '.html' else s end suffix
from (select ord, lower(coalesce(source_domain, '')) d, lower(regexp_extract(regexp_replace(coalesce(source_url, ''), '[?#].*$', ''), '/[^/]*(\\.[A-Za-z0-9]{1,5})$', 1)) s from source_documents)""".replace("\\\\", "\\"))
def source_predicates(spark, d):
    return table(spark, d, "source_documents").select("ord", P.trusted_domain(F.col("source_domain"), ["quarofield.example", "sanosoil.example"]).alias("trusted"), P.url_suffix(F.col("source_url")).alias("suffix"))


@query()
def body_without_references(spark, d):
    """Words of each text before and after its back matter is taken out (lookahead over lines: no SQL twin)."""
    t = L.without_back_matter(F.col("text"))
    words = lambda c: F.size(F.filter(F.split(X.normalize_ws(c), " "), lambda w: w != ""))
    return table(spark, d, "documents").where("text is not null").select("doc_id", words(F.col("text")).alias("words"), words(t).alias("body_words"))
