"""Queries of the claim path, evaluation, places and signals, with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.functions import geo as G
from claimloom.functions import quality as Q
from claimloom.functions import text as T
from claimloom.functions import values
from claimloom.operators import corpus as D
from claimloom.operators import evaluate as E
from claimloom.operators import extraction as X
from claimloom.plans.reference_queries import CLAIM_SQL, claims
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


# ------------------------------------------------------------ extractions
@query("""select ord, case when lower(trim(value_type)) in ('numeric', 'range', 'text') then lower(trim(value_type)) else 'text' end value_type,
 case when lower(trim(coalesce(qualifier, ''))) in ('optimal', 'risk', 'recommended', 'descriptive') then lower(trim(qualifier)) else 'descriptive' end qualifier,
 case when lower(trim(coalesce(confidence, ''))) in ('high', 'medium', 'low') then lower(trim(confidence)) else 'low' end confidence, left(coalesce(claim_text, ''), 40) claim_text
 from normalized_claims where parameter_id in (select parameter_id from parameter_manifest) and trim(coalesce(evidence_text, ''), ' ') <> ''""")
def extraction_coercion(spark, d):
    n = table(spark, d, "normalized_claims")
    return X.coerced(n, table(spark, d, "parameter_manifest"), summary_chars=40).select("ord", "value_type", "qualifier", "confidence", "claim_text")


@query("""select ord, case when try_cast(trim(time_label) as int) between 1950 and 2030 then try_cast(trim(time_label) as int) end y from normalized_claims where regexp_matches(coalesce(trim(time_label), ''), '^[0-9]*$')""")
def bounded_numbers(spark, d):
    n = table(spark, d, "normalized_claims").where(F.coalesce(F.trim("time_label"), F.lit("")).rlike(r"^[0-9]*$"))
    return n.select("ord", X.whole_number(F.col("time_label"), 1950, 2030).alias("y"))


@query("select parameter_id, evidence_text, min(ord) ord from normalized_claims where parameter_id is not null and evidence_text is not null group by 1, 2")
def extraction_dedupe(spark, d):
    n = table(spark, d, "normalized_claims").where("parameter_id is not null and evidence_text is not null").select("parameter_id", "evidence_text", "ord")
    return X.first_per(n.withColumn("o", F.col("ord")), ["parameter_id", "evidence_text"], "o").select("parameter_id", "evidence_text", "ord")


UNITS = ("kg/ha", "t/ha", "cm", "mm", "percent", "days")
_N, _U = r"[0-9][0-9,]*(?:\.[0-9]+)?", "|".join(UNITS)


@query(f"""with t as (select ord, lower(coalesce(claim_text, '')) x from normalized_claims),
m as (select ord, x, regexp_extract(x, '({_N})\\s*(?:to|-)\\s*({_N})\\s*({_U})\\b', ['a', 'b', 'u']) r, regexp_extract(x, '({_N})\\s*({_U})\\b', ['a', 'u']) s from t)
select ord, case when r.u <> '' then 'range' else 'numeric' end value_type, case when r.u <> '' then cast(replace(r.a, ',', '') as double) end range_min, case when r.u <> '' then cast(replace(r.b, ',', '') as double) end range_max,
 case when r.u = '' then cast(replace(s.a, ',', '') as double) end numeric_value, case when r.u <> '' then r.u else s.u end unit from m where r.u <> '' or s.u <> ''""")
def generic_measurements(spark, d):
    m = table(spark, d, "normalized_claims").select("ord", X.measurement(F.col("claim_text"), UNITS).alias("m")).where("m is not null")
    return m.select("ord", "m.value_type", "m.range_min", "m.range_max", "m.numeric_value", "m.unit")


@query(f"""with n as (select ord, parameter_id, lower(coalesce(claim_text, '')) x from normalized_claims),
m as (select ord, case parameter_id when 'yield.grain_yield' then regexp_extract(x, '({_N})\\s*(t/ha|kg/ha)\\b', ['a', 'u']) when 'management.seeding_depth' then regexp_extract(x, '({_N})\\s*(cm|mm)\\b', ['a', 'u']) end s from n)
select ord, cast(replace(s.a, ',', '') as double) v, s.u unit from m where s.u <> ''""")
def dispatched_values(spark, d):
    units = {"yield.grain_yield": ("t/ha", "kg/ha"), "management.seeding_depth": ("cm", "mm")}
    m = table(spark, d, "normalized_claims").select("ord", X.dispatched(F.col("claim_text"), F.col("parameter_id"), units).alias("m"))
    return m.where("m.value_type = 'numeric'").select("ord", F.col("m.numeric_value").alias("v"), F.col("m.unit").alias("unit")).unionByName(
        m.where("m.value_type = 'range'").select("ord", F.col("m.range_max").alias("v"), F.col("m.unit").alias("unit")))


@query("""with p as (select ord, entity_name, claim_text, list_filter(string_split_regex(claim_text, '(?i)\\bwhile\\b|;'), lambda s: contains(lower(s), lower(entity_name))) f from normalized_claims where claim_text is not null and entity_name is not null)
select ord, coalesce(f[1], claim_text) segment from p""")
def subject_segments(spark, d):
    n = table(spark, d, "normalized_claims").where("claim_text is not null and entity_name is not null")
    return n.select("ord", X.segment_of(F.col("claim_text"), F.col("entity_name")).alias("segment"))


CAPTURES_SQL = "cap as (select source_url, min(source_title) source_title, min(latest_run_id) run from source_documents group by 1)"


@query(f"""with {CLAIM_SQL}, {CAPTURES_SQL}, m as (select parameter_id, min(normalized_attribute) a, min(normalized_attribute_subtype) s from parameter_manifest group by 1),
e as (select cl.claim_id, coalesce(m.a, split_part(cl.parameter_id, '.', 1)) attribute, coalesce(m.s, case when contains(cl.parameter_id, '.') then substr(cl.parameter_id, instr(cl.parameter_id, '.') + 1) else cl.parameter_id end) attribute_subtype,
 trim(coalesce(cl.evidence_text, ''), ' ') ev, trim(coalesce(cl.claim_text, ''), ' ') ct, cap.source_title, cl.source_url from cl left join m on cl.parameter_id = m.parameter_id join cap on cl.source_url = cap.source_url)
select claim_id, attribute, attribute_subtype, source_title, case when ct = '' then ev else ct end claim_text, source_url url from e where ev <> '' and length(case when ct = '' then ev else ct end) >= 5""")
def claim_projection(spark, d):
    """Extractions as claims with their capture's title."""
    caps = table(spark, d, "source_documents").groupBy("source_url").agg(F.min("source_title").alias("source_title")).withColumn("final_url", F.lit(None).cast("string"))
    e = claims(spark, d).select("claim_id", "parameter_id", "claim_text", "evidence_text", "source_url")
    p = X.projected(e, caps, table(spark, d, "parameter_manifest"))
    return p.select("claim_id", "attribute", "attribute_subtype", "source_title", "claim_text", F.get("source_urls", F.lit(0)).alias("url"))


MERGE_KEY = ["entity_name", "parameter_id", "location_level", "time_label"]


@query(f"""with {CLAIM_SQL}, t as (select {', '.join(MERGE_KEY)}, claim_text, count(*) members, min(ord) ord, count(distinct source_url) sources from cl where not (value_type in ('numeric', 'range') and lo is not null) group by all)
select {', '.join(MERGE_KEY)}, claim_text, members, ord, sources from t""")
def merged_texts(spark, d):
    """Equal texts of an applicability key as one claim, with its sources."""
    m = merged_claims(spark, d).where("lo is null")
    return m.select(*MERGE_KEY, "claim_text", "members", "ord", F.size("source_urls").cast("bigint").alias("sources"))


@query()
def merged_claims(spark, d):
    """All claims merged by key, numbered; the order-dependent fold of intervals is tested against a plain loop."""
    c = claims(spark, d).select(*MERGE_KEY, "ord", "claim_text", "value_type", "lo", "hi", F.array(F.coalesce("source_url", F.lit(""))).alias("source_urls"))
    return X.merged(c, "run", MERGE_KEY)


@query(f"""with {CLAIM_SQL}, g as (select entity_name, parameter_id, min(ord) o from cl group by 1, 2) select entity_name, parameter_id, row_number() over (order by o) n from g""")
def first_seen_numbers(spark, d):
    from claimloom.operators.ledger import numbered

    g = claims(spark, d).groupBy("entity_name", "parameter_id").agg(F.min("ord").alias("o"))
    return numbered(g, ["o"], "n").select("entity_name", "parameter_id", F.col("n").cast("bigint").alias("n"))


@query("select parameter_id, case max(case lower(trim(confidence)) when 'high' then 3 when 'medium' then 2 when 'med' then 2 when 'low' then 1 else 0 end) when 3 then 'high' when 2 then 'medium' when 1 then 'low' else 'unknown' end confidence from durable_claims group by 1")
def best_confidence(spark, d):
    return X.best_confidence(table(spark, d, "durable_claims"), ["parameter_id"])


@query("select parameter_id, count(*) claims, count(distinct source_url) sources from normalized_claims group by 1")
def extraction_summary(spark, d):
    return table(spark, d, "normalized_claims").groupBy("parameter_id").agg(F.count("*").alias("claims"), F.count_distinct("source_url").alias("sources"))


@query("select doc_id, left(array_to_string(list_transform(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> ''), lambda x, i: '[b' || i || '] ' || x), chr(10)), 12000) text from documents where text is not null and len(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> '')) > 0")
def rendered_blocks(spark, d):
    t = table(spark, d, "documents").where("text is not null").select("doc_id", F.filter(F.split("text", "\n", -1), lambda x: F.trim(x) != "").alias("ls"))
    b = t.select("doc_id", F.posexplode("ls").alias("pos", "text")).select("doc_id", "pos", F.concat(F.lit("b"), F.col("pos") + 1).alias("anchor"), F.lit("paragraph").alias("kind"), "text")
    return X.rendered_blocks(b, "doc_id")


@query("select doc_id, left(coalesce(nullif(case when is_metadata_only then '' else text end, ''), coalesce(title, '')), 12000) text from documents")
def capture_input_text(spark, d):
    t = table(spark, d, "documents")
    return t.select("doc_id", X.input_text(F.when(F.col("is_metadata_only"), F.lit("")).otherwise(F.col("text")), F.array(F.coalesce("title", F.lit("")))).alias("text"))


@query("""select parameter_id, concat_ws(' | ', parameter_id, label, common_unit) line from parameter_manifest""")
def manifest_lines(spark, d):
    p = X.active_parameters(table(spark, d, "parameter_manifest")).withColumn("aliases", F.array().cast("array<string>"))
    return p.select("parameter_id", X.manifest_text(p).alias("line"))


STUB = {"yield": "yield.grain_yield", "temperature": "temperature.optimum_growth_temperature", "depth": "management.seeding_depth"}


@query("""with t as (select doc_id, lower(coalesce(text, '')) x from documents), p as (select doc_id, x, case when contains(x, 'yield') then 'yield.grain_yield' when contains(x, 'temperature') then 'temperature.optimum_growth_temperature' when contains(x, 'depth') then 'management.seeding_depth' end parameter_id,
 regexp_extract(x, '([0-9]+(?:\\.[0-9]+)?)\\s*(?:-|to|–)\\s*([0-9]+(?:\\.[0-9]+)?)\\s*(?:°\\s*c|degrees celsius|celsius)', ['a', 'b']) r from t)
select doc_id, parameter_id, try_cast(r.a as double) range_min, try_cast(r.b as double) range_max, case when contains(x, 'irrigat') then 'irrigat' when contains(x, 'till') then 'till' end as "method" from p where parameter_id is not null""")
def stub_extraction(spark, d):
    return X.stub_extraction(table(spark, d, "documents"), STUB, ("irrigat", "till"))


# ------------------------------------------------------------ evaluation
GOLD_SQL = """gold as (select d.durable_claim_id gold_id, n.source_url doc, d.parameter_id, split_part(d.parameter_id, '.', 1) as "domain", json_extract_string(d.value_json, '$.value_type') vt,
 try_cast(json_extract_string(d.value_json, '$.numeric_value') as double) v, try_cast(json_extract_string(d.value_json, '$.range_min') as double) lo, try_cast(json_extract_string(d.value_json, '$.range_max') as double) hi, json_extract_string(d.value_json, '$.text_value') tv, json_extract_string(d.value_json, '$.unit') u
 from durable_claims d join cl n on d.source_claim_id = n.claim_id)"""
PRED_SQL = "pred as (select source_url doc, parameter_id, ord, numeric_value v, range_min lo, range_max hi, unit u, claim_text, evidence_text from cl)"
HIT_SQL = """coalesce(case when coalesce(g.vt, 'numeric') = 'numeric' then g.v is not null and (coalesce(abs(p.v - g.v) <= 0.05 * greatest(abs(g.v), 1e-9), false) or coalesce(g.v >= p.lo and g.v <= p.hi, false))
 when g.vt = 'range' then g.lo is not null and g.hi is not null and (coalesce(greatest(g.lo, p.lo) <= least(g.hi, p.hi) and p.lo is not null and p.hi is not null, false) or coalesce(p.v >= g.lo and p.v <= g.hi, false))
 else lower(trim(coalesce(g.tv, ''), ' ')) = '' or contains(lower(concat_ws(' ', p.claim_text, p.evidence_text)), lower(trim(g.tv, ' '))) end, false)"""


def _gold(spark, d):
    c = claims(spark, d).select(F.col("claim_id").alias("source_claim_id"), F.col("source_url").alias("doc"))
    j = lambda p: F.get_json_object("value_json", p)
    g = table(spark, d, "durable_claims").join(c, "source_claim_id")
    return g.select(
        F.col("durable_claim_id").alias("gold_id"), "doc", "parameter_id", F.substring_index("parameter_id", ".", 1).alias("domain"), j("$.value_type").alias("value_type"), j("$.numeric_value").try_cast("double").alias("value"),
        j("$.range_min").try_cast("double").alias("low"), j("$.range_max").try_cast("double").alias("high"), j("$.text_value").alias("text"), j("$.unit").alias("unit"), F.lit(None).cast("string").alias("marker"),
    )


def _predictions(spark, d):
    return claims(spark, d).select(F.col("source_url").alias("doc"), "parameter_id", "ord", F.col("numeric_value").alias("value"), F.col("range_min").alias("low"), F.col("range_max").alias("high"), "unit", "claim_text", "evidence_text")


@query(f"""with {CLAIM_SQL}, {GOLD_SQL}, {PRED_SQL}, j as (select g.gold_id, g."domain", p.ord, p.doc is not null m, p.doc is not null and {HIT_SQL} h,
 (regexp_replace(lower(trim(coalesce(g.u, ''), ' ')), '\\s+', '', 'g') = '' or regexp_replace(lower(trim(coalesce(p.u, ''), ' ')), '\\s+', '', 'g') = regexp_replace(lower(trim(coalesce(g.u, ''), ' ')), '\\s+', '', 'g')) uo,
 coalesce(p.evidence_text, '') <> '' and (g.v is null or len(list_filter(regexp_extract_all(lower(coalesce(p.evidence_text, '')), '(-?[0-9]+(?:\\.[0-9]+)?)', 1), lambda x: abs(try_cast(x as double) - g.v) <= greatest(abs(g.v) * 0.05, 1e-9))) > 0) fo
 from gold g left join pred p on g.doc = p.doc and g.parameter_id = p.parameter_id),
o as (select gold_id, "domain", bool_or(h) h, bool_or(m) m, coalesce(arg_min(uo, ord) filter (h), false) uo, coalesce(arg_min(fo, ord) filter (h), false) fo from j group by 1, 2),
s as (select "domain", grouping("domain") overall, count(*) gold, count(*) filter (h) hits, count(*) filter (m) mapped, count(*) filter (h and uo) units, count(*) filter (h and fo) fa from o group by rollup ("domain"))
select "domain", cast(overall as tinyint) overall, gold, case when gold = 0 then 0.0 else round(hits / gold, 4) end recall, case when gold = 0 then 0.0 else round(mapped / gold, 4) end parameter_mapping_accuracy, case when hits = 0 then 0.0 else round(units / hits, 4) end unit_correctness, case when hits = 0 then 0.0 else round(fa / hits, 4) end evidence_faithfulness from s""")
def eval_extraction_full(spark, d):
    """Recall, mapping, unit correctness and faithfulness, per domain and over all."""
    return E.extraction_report(_gold(spark, d), _predictions(spark, d))


@query(f"""with {CLAIM_SQL}, {GOLD_SQL}, {PRED_SQL}, o as (select p.ord, bool_or({HIT_SQL}) h from pred p join gold g on g.doc = p.doc and g.parameter_id = p.parameter_id group by 1)
select count(*) adjudicable, count(*) filter (h) correct, case when count(*) = 0 then 0.0 else round(count(*) filter (h) / count(*), 4) end "precision" from o""")
def eval_extraction_precision(spark, d):
    return E.extraction_precision(_gold(spark, d), _predictions(spark, d))


HOSTS_SQL = "regexp_replace(regexp_extract(lower(coalesce({c}, '')), '^[a-z]+://([^/]*)', 1), '^www\\.', '')"


@query(f"""with g as (select ord gold_id, document_type as "domain", lower(trim(source_url, ' ')) url, {HOSTS_SQL.format(c='source_url')} host from source_documents),
l as (select lower(trim(canonical_url, ' ')) url, {HOSTS_SQL.format(c='canonical_url')} host, cast(doc_id as int) rank, not is_metadata_only selected from documents),
lu as (select url v, min(rank) rank, bool_or(selected) selected from l where coalesce(url, '') <> '' group by 1), lh as (select host v, min(rank) rank, bool_or(selected) selected from l where coalesce(host, '') <> '' group by 1),
h as (select gold_id, min(rank) rank, bool_or(selected) selected from (select gold_id, rank, selected from g join lu on g.url = lu.v where g.url <> '' union all select gold_id, rank, selected from g join lh on g.host = lh.v where g.host <> '') group by 1),
s as (select "domain", grouping("domain") overall, count(*) gold, count(rank) found, count(*) filter (selected) chosen, round(avg(rank), 2) mean_rank from g left join h using (gold_id) group by rollup ("domain"))
select "domain", cast(overall as tinyint) overall, gold, case when gold = 0 then 0.0 else round(found / gold, 4) end source_recall, case when gold = 0 then 0.0 else round(chosen / gold, 4) end selection_recall, mean_rank from s""")
def eval_retrieval_full(spark, d):
    """Source recall, selection recall and mean rank of pages looked for in the documents, per kind and over all."""
    host = lambda c: F.regexp_replace(F.regexp_extract(F.lower(F.coalesce(c, F.lit(""))), r"^[a-z]+://([^/]*)", 1), r"^www\.", "")
    g = table(spark, d, "source_documents").select(F.col("ord").alias("gold_id"), F.col("document_type").alias("domain"), F.lit("").alias("doi"), F.col("source_url").alias("url"), host(F.col("source_url")).alias("host"))
    led = table(spark, d, "documents").select(F.lit("").alias("canonical_key"), F.lit("").alias("doi"), F.col("canonical_url").alias("url"), host(F.col("canonical_url")).alias("host"), F.col("doc_id").cast("int").alias("discovery_rank"), (~F.col("is_metadata_only")).alias("selected"))
    return E.retrieval_scores(g, led)


@query("select ord from query_hits q where exists (select 1 from documents d where d.document_id = q.document_id and d.doi is not null)")
def selected_keys(spark, d):
    """Hits whose document is among the selected keys."""
    keys = table(spark, d, "documents").where("doi is not null").select("document_id")
    return table(spark, d, "query_hits").join(keys, "document_id", "left_semi").select("ord")


# ------------------------------------------------------------ places
GAZ_SQL = "gaz as (select location_level as level, lower(trim(location_name, ' ')) n, min(location_geo_id) id from normalized_claims where location_name is not null and location_geo_id is not null group by 1, 2)"


@query(f"""with {GAZ_SQL} select c.ord, c.level, c.name, coalesce(gaz.id, case when c.level = 'global' then 'global' else '' end) geo_id, case when gaz.id is not null then 'gazetteer' when c.level = 'global' then 'not_applicable' else 'missing_gazetteer_record' end geocode_source,
 case when gaz.id is not null then 'approximate' else 'none' end geocode_confidence, 'EPSG:4326' coordinate_system from (select ord, coalesce(location_level, 'global') as level, coalesce(location_name, 'global') as name from normalized_claims) c left join gaz on c.level = gaz.level and lower(trim(c.name, ' ')) = gaz.n""")
def enriched_scopes(spark, d):
    n = table(spark, d, "normalized_claims")
    gaz = n.where("location_name is not null").select(F.col("location_level").alias("level"), F.col("location_name").alias("name"), F.col("location_geo_id").alias("geo_id"))
    return G.enrich(n.select("ord", F.coalesce("location_level", F.lit("global")).alias("level"), F.coalesce("location_name", F.lit("global")).alias("name")), gaz)


PLACES_SQL = "al as (select lower(trim(location_name, ' ')) alias, min(location_name) as name, min(location_level) as level from (select distinct location_level, location_name from normalized_claims where location_level = 'region' and location_name is not null) group by 1)"
RUNS_SQL = """w as (select {k}, list_transform(regexp_extract_all(coalesce({t}, ''), '([\\p{{L}}\\p{{N}}][\\p{{L}}\\p{{N}}.''-]*)', 1), lambda x: regexp_replace(x, '[.''-]+$', '')) ws from {f}),
r as (select {k}, i p, lower(array_to_string(ws[i:i + n - 1], ' ')) alias from (select {k}, ws, unnest(range(1, len(ws) + 1)) i from w), (values (1), (2), (3), (4)) v(n) where i + n - 1 <= len(ws))"""


def _aliases(spark, d):
    n = table(spark, d, "normalized_claims").where("location_level = 'region' and location_name is not null")
    places = n.select(F.col("location_name").alias("name"), F.lit(None).cast("string").alias("abbreviation"), F.col("location_level").alias("level")).distinct()
    return G.alias_dim(places)


@query(f"""with {PLACES_SQL}, {RUNS_SQL.format(k='ord', t='claim_text', f='normalized_claims')}, h as (select r.ord, al.name, al.level, al.alias, row_number() over (partition by r.ord order by length(al.alias) desc, r.p) rn from r join al using (alias))
select ord, name, level, alias from h where rn = 1""")
def detected_regions(spark, d):
    """The region with the longest name in each claim."""
    return G.detect(table(spark, d, "normalized_claims").select("ord", "claim_text"), ["ord"], "claim_text", _aliases(spark, d))


@query(f"""with {PLACES_SQL}, f as (select ord * 10 + 0 k, source_title t from source_documents union all select ord * 10 + 1, source_url from source_documents union all select ord * 10 + 2, source_domain from source_documents),
{RUNS_SQL.format(k='k', t='t', f='f')}, h as (select k, name, level, row_number() over (partition by k order by length(alias) desc, p) rn from r join al using (alias)),
b as (select k // 10 ord, arg_min(k % 10, k) pos, arg_min(name, k) as name, arg_min(level, k) as level from h where rn = 1 group by 1)
select s.ord, coalesce(['source_title', 'source_url', 'source_domain'][b.pos + 1], 'default_global') field, coalesce(b.name, 'global') as name, coalesce(b.level, 'global') as level,
 case when coalesce(b.level, 'global') = 'global' then 'none' when b.pos in (0, 1) then 'medium' else 'low' end confidence from source_documents s left join b using (ord)""")
def source_scopes(spark, d):
    """Where a source is from: title, then address, then domain; how sure that is."""
    s = G.first_scope(table(spark, d, "source_documents").select("ord", "source_title", "source_url", "source_domain"), "ord", ["source_title", "source_url", "source_domain"], _aliases(spark, d))
    return s.withColumn("confidence", G.confidence_of(F.col("field"), F.col("level")))


@query("""select ord, case when location_level is not null then 1 else 0 end + case when location_level is not null and document_type = 'pdf' then 1 else 0 end n from normalized_claims""")
def geo_evidence(spark, d):
    """How many of a claim's two inferred places are smaller than the world."""
    n = table(spark, d, "normalized_claims")
    one = lambda ok: F.struct(F.lit("x").alias("field"), F.when(ok, F.col("location_level")).otherwise("global").alias("level"), F.coalesce("location_name", F.lit("global")).alias("name"))
    here = F.col("location_level").isNotNull()
    return n.select("ord", F.size(G.evidence(one(here), one(here & F.coalesce(F.col("document_type") == "pdf", F.lit(False))))).alias("n"))


@query("""select ord, contains(lower(coalesce(claim_text, '')), lower('valley')) evidenced, contains(lower(coalesce(source_title, '')), 'valley') and not contains(lower(coalesce(source_title, '')), 'valley state university') titled from normalized_claims""")
def region_context(spark, d):
    n = table(spark, d, "normalized_claims")
    return n.select("ord", G.region_evidenced(F.col("claim_text"), F.lit("valley")).alias("evidenced"), G.title_names_region(F.col("source_title"), F.lit("valley")).alias("titled"))


# ------------------------------------------------------------ signals
TOPICS = {"yield": ("yield", "harvest"), "water": ("water", "irrigation", "rain"), "soil": ("soil", "clay", "sand")}


@query("""with t as (select ord, list_filter([case when regexp_matches(x, 'yield|harvest') then 'yield' end, case when regexp_matches(x, 'water|irrigation|rain') then 'water' end, case when regexp_matches(x, 'soil|clay|sand') then 'soil' end], lambda v: v is not null) f from (select ord, lower(coalesce(claim_text, '')) x from normalized_claims))
select ord, case when len(f) = 0 then 'conditions' else array_to_string(f, ',') end topics from t""")
def topic_inference(spark, d):
    return table(spark, d, "normalized_claims").select("ord", F.array_join(Q.topics(F.col("claim_text"), TOPICS, "conditions"), ",").alias("topics"))


@query("""with x as (select ord, claim_text t, len(regexp_extract_all(coalesce(claim_text, ''), '(\\S+)', 1)) w, len(regexp_extract_all(coalesce(claim_text, ''), '([0-9]+(?:[.,][0-9]+)*)', 1)) n, len(regexp_extract_all(coalesce(claim_text, ''), '\\b([A-Z]{3,})\\b', 1)) c, len(regexp_extract_all(coalesce(claim_text, ''), '(?i)\\b([0-9]+(?:st|nd|rd|th))\\b', 1)) o,
 trim(regexp_replace(lower(coalesce(source_title, '')), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' ') nt, trim(regexp_replace(lower(coalesce(claim_text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' ') nc from normalized_claims)
select ord, regexp_matches(coalesce(t, ''), '(?i)(?:cookies|subscribe)') or (regexp_matches(coalesce(t, ''), '[•▪●]|^\\s*[-*]\\s') and n >= 4) or o >= 2 or (c >= 5 and w < 35) layout, (nt <> '' and nc <> '' and contains(nt, nc)) or (w < 6 and not regexp_matches(coalesce(t, ''), '[.!?]\\s*$')) header,
 w between 6 and 45 and not regexp_matches(coalesce(t, ''), '(?i)\\b(?:table of contents|(?:table|figure|fig\\.|page)\\s*[0-9]+)') and not regexp_matches(coalesce(t, ''), '(?i)(?:cookies)') and (regexp_matches(coalesce(t, ''), '(?i)(?:yield|water)') or n > 0) admissible from x""")
def claim_signals(spark, d):
    """Leftovers of layout and headings, and sentences that may become claims."""
    t = F.col("claim_text")
    n = table(spark, d, "normalized_claims")
    return n.select("ord", Q.layout_artifact(t, ("cookies", "subscribe")).alias("layout"), Q.header_artifact(t, F.col("source_title")).alias("header"), Q.admissible(t, F.lit(9), ("cookies",), ("yield", "water")).alias("admissible"))


@query("""select doc_id, coalesce(cast(floor(quality_score * 10) as int), 0) >= 5 and (regexp_matches(lower(coalesce(source_domain, '')), 'soil|agro') or regexp_matches(lower(concat_ws(chr(10), title, source_domain)), 'yield') or (regexp_matches(lower(concat_ws(chr(10), title, text)), 'wheat|rye') and cast(floor(quality_score * 10) as int) >= 9)) relevant from documents where not isnan(coalesce(quality_score, 0.0))""")
def capture_relevance(spark, d):
    """Captures worth reading: by preferred source, by term, or strong ones that name the subject."""
    n = table(spark, d, "documents").where("not isnan(coalesce(quality_score, 0.0D))")
    score = F.floor(F.col("quality_score") * 10).cast("int")
    signal = Q.has_any_in([F.col("title"), F.col("text")], ("wheat", "rye"))
    return n.select("doc_id", Q.relevant_capture(score, Q.has_any(F.col("source_domain"), ("soil", "agro")), Q.has_any_in([F.col("title"), F.col("source_domain")], ("yield",)), signal).alias("relevant"))


@query(f"""select ord, (lower(trim(coalesce(time_label, ''), ' ')) not in ('', 'unspecified', 'any', 'all')) or coalesce(try_cast(regexp_extract(coalesce(claim_text, ''), '\\b((?:19|20)[0-9][0-9])\\b', 1) as int) between 2017 and 2026, false) or coalesce(regexp_matches(claim_text, '(?i){Q.CALENDAR}'), false) seasonal,
 regexp_matches(lower(concat_ws(chr(10), claim_text, source_title, location_name)), 'valley') or coalesce(lower(location_level) in ('state', 'county', 'region', 'trial_site'), false) regional from normalized_claims""")
def season_and_region(spark, d):
    n = table(spark, d, "normalized_claims")
    return n.select("ord", Q.seasonal(F.col("time_label"), F.col("claim_text"), (2017, 2026)).alias("seasonal"), Q.regional(F.col("location_level"), [F.col("claim_text"), F.col("source_title"), F.col("location_name")], "valley").alias("regional"))


@query("""select ord, case when regexp_matches(x, 'best|optimum|optimal') then 'optimal' when regexp_matches(x, 'risk|damage') then 'risk' when regexp_matches(x, 'advice|recommend') then 'recommended' else 'descriptive' end q,
 case when regexp_matches(x, 'temperature') and regexp_matches(x, 'germination|soil') then 'soil_temperature' when regexp_matches(x, 'temperature') then 'temperature' when regexp_matches(x, 'yield|harvest') then 'yield' else 'other' end attribute from (select ord, lower(coalesce(claim_text, '')) x from normalized_claims)""")
def statement_kinds(spark, d):
    """Kind of a statement and its attribute, by ordered rules."""
    t = F.col("claim_text")
    rules = [(("temperature",), ("germination", "soil"), ("soil_temperature", "minimum")), (("temperature",), (), ("temperature", "optimum")), (("yield", "harvest"), (), ("yield", "mean"))]
    words = {"optimal": ("best", "optimum", "optimal"), "risk": ("risk", "damage"), "recommended": ("advice", "recommend")}
    return table(spark, d, "normalized_claims").select("ord", Q.qualifier(t, words).alias("q"), Q.first_rule(t, rules, ("other", "other"))["attribute"].alias("attribute"))


# ------------------------------------------------------------ reviews
@query(f"""with {CLAIM_SQL}, r as (select source_claim_id claim_id, promotion_decision decision from durable_claims) select r.claim_id, r.decision, coalesce(nullif(trim(cl.source_tier_id, ' '), ''), 'unspecified') tier, left(cl.evidence_text, 240) excerpt from r left join cl using (claim_id)""")
def review_rows(spark, d):
    """Reviews with their claim's tier and excerpt; a claim that is gone has no tier."""
    r = table(spark, d, "durable_claims").select(F.col("source_claim_id").alias("claim_id"), F.col("promotion_decision").alias("decision"))
    c = claims(spark, d).select("claim_id", "source_tier_id", "evidence_text")
    return r.join(c, "claim_id", "left").select("claim_id", "decision", F.coalesce(F.nullif(F.trim("source_tier_id"), F.lit("")), F.lit("unspecified")).alias("tier"), F.substring("evidence_text", 1, 240).alias("excerpt"))


@query("""with n as (select regexp_replace(lower(trim(promotion_decision, ' ')), '[ -]+', '_', 'g') d from durable_claims) select count(*) reviewed, count(*) filter (d in ('canonical_candidate', 'merge_candidate')) durable, count(*) filter (d = 'needs_review') manual, count(*) filter (d = 'reject') rejected, count(*) filter (d = 'seasonal_observation') seasonal from n""")
def review_summary(spark, d):
    n = table(spark, d, "durable_claims").select(F.regexp_replace(F.lower(F.trim("promotion_decision")), r"[ -]+", "_").alias("d"))
    return n.agg(F.count("*").alias("reviewed"), F.count_if(F.col("d").isin("canonical_candidate", "merge_candidate")).alias("durable"), F.count_if(F.col("d") == "needs_review").alias("manual"), F.count_if(F.col("d") == "reject").alias("rejected"), F.count_if(F.col("d") == "seasonal_observation").alias("seasonal"))


# ------------------------------------------------------------ names, values, gates, pages
@query("""select ord, array_to_string(list_transform(list_filter(string_split_regex(coalesce(entity_name, ''), '[\\s_]+'), lambda w: w <> ''), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') title, trim(regexp_replace(regexp_replace(coalesce(source_title, ''), '[\\\\/:*?"<>|]+', ' ', 'g'), '\\s+', ' ', 'g'), ' ') file_name from normalized_claims""")
def display_names(spark, d):
    return table(spark, d, "normalized_claims").select("ord", T.title_case(F.col("entity_name")).alias("title"), T.safe_filename(F.col("source_title")).alias("file_name"))


_T = "(-?[0-9]+(?:\\.[0-9]+)?) ?(?:°|degrees |deg )?([CF]|Celsius|Fahrenheit|celsius|fahrenheit)\\b"


@query(f"""with t as (select ord, regexp_extract_all(coalesce(claim_text, ''), '{_T}', 1) n, regexp_extract_all(coalesce(claim_text, ''), '{_T}', 2) u from normalized_claims)
select ord, i as position, case when lower(left(u[i], 1)) = 'f' then round((cast(n[i] as double) - 32.0) * 5.0 / 9.0, 2) else cast(n[i] as double) end celsius from (select ord, n, u, cast(unnest(range(1, len(n) + 1)) as int) i from t)""")
def text_temperatures(spark, d):
    """Temperatures in claims, all in Celsius."""
    n = table(spark, d, "normalized_claims").select("ord", F.posexplode(values.all_temperatures(F.col("claim_text"))).alias("p", "celsius"))
    return n.select("ord", (F.col("p") + 1).alias("position"), "celsius")


@query("select ord, case lower(trim(coalesce(qualifier, ''), ' ')) when 'risk' then 'risk' when 'recommended' then 'recommendation' when 'threshold' then 'threshold' else 'condition' end observation from normalized_claims")
def observation_types(spark, d):
    return table(spark, d, "normalized_claims").select("ord", values.observation_type(F.col("qualifier")).alias("observation"))


@query("""select round(avg(case when coalesce(document_type, '') = 'other' then 1 else 0 end), 3) background_share, count(*) filter (contains(coalesce(text, ''), ' | ')) documents_with_tables,
 round(avg(case when coalesce(document_type, '') = 'other' then 1 else 0 end), 3) < 0.15 gate_background, count(*) filter (contains(coalesce(text, ''), ' | ')) > 0 gate_tables, round(cast(count(*) filter (coalesce(is_metadata_only, false)) as double) / count(*), 3) < 0.15 gate_metadata from documents""")
def corpus_gates(spark, d):
    """The gates of a corpus."""
    g = D.qa_gates(table(spark, d, "documents"), F.coalesce("document_type", F.lit("")) == "other", F.contains(F.coalesce("text", F.lit("")), F.lit(" | ")))
    return g.select("background_share", "documents_with_tables", "gate_background", "gate_tables", "gate_metadata")


@query()
def page_sections(spark, d):
    """Blocks of pages with section, level, anchor, caption and date (texts wrapped in markup as stand-in pages; parsed with an HTML parser, no SQL twin)."""
    body = F.regexp_replace(F.regexp_replace("text", "[<>&]", " "), "\n", "</p><p>")
    html = F.concat(F.lit("<html><head><meta name='date' content='2020-01-02'></head><h1 id='top'>"), F.coalesce("title", F.lit("")), F.lit("</h1><p>"), body, F.lit("</p></html>"))
    return D.page_sections(table(spark, d, "documents").where("text is not null").select("doc_id", html.alias("html")))
