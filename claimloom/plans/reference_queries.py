"""Queries of the reference's own operators, each with its DuckDB twin.

The project's tables stand for the pipeline's stages: query_hits with documents are the discovery
ledger and the captures, normalized_claims the claims, source_documents the sources, durable_claims
the promoted claims. Relationship operators run over nations and line items as stand-in data.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from claimloom.functions import keys as K
from claimloom.functions import text as X
from claimloom.functions import values as V
from claimloom.functions.hosts import host_of
from claimloom.operators import claims as C
from claimloom.operators import corpus as D
from claimloom.operators import coverage as G
from claimloom.operators import evaluate as E
from claimloom.operators import ledger as L
from claimloom.operators import relations as R
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


# ---------------------------------------------------------------- adapters
DOI_SQL = "regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce({c}, ''))), '^(https?://)?(dx\\.)?doi\\.org/', ''), '^doi:\\s*', ''), '^/+|/+$', '', 'g')"
HOST_SQL = "regexp_replace(lower(regexp_extract(coalesce({c}, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '')"
PATH_SQL = "regexp_replace(regexp_extract(coalesce({c}, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '')"
KEY_SQL = f"case when {DOI_SQL.format(c='doi')} <> '' then 'doi:' || {DOI_SQL.format(c='doi')} else 'url:' || {HOST_SQL.format(c='canonical_url')} || lower({PATH_SQL.format(c='canonical_url')}) end"
LEDGER_SQL = f"""led as (
  select h.ord, h.run_id, coalesce(h.query, '') query, h.parameter_id, coalesce(h.discovery_method, '') provider, cast(floor(coalesce(d.quality_score, 0) * 15) as int) score,
    d.canonical_url source_url, d.doi, coalesce(d.source_domain, '') source_domain, coalesce(d.access_status, '') access_status, coalesce(d.document_type, '') document_type, coalesce(h.source_tier_id, '') tier, {KEY_SQL} canonical_key
  from query_hits h join documents d using (document_id))"""
STAMP_SQL = """st as (select *, case when provider in ('backfill', 'citation') and score < 4 then 'relevance_gate'
   when row_number() over (partition by canonical_key order by score desc, ord) > 1 then 'duplicate' else '' end discovery_drop_reason from led)"""
TRUST_SQL = "trust as (select tier_id tier, trust from source_tiers)"
CAND_SQL = """acc as (select st.*, coalesce(trust.trust, 0.0) trust, case access_status when 'open_full_text' then 2 when 'metadata_only' then 1 else 0 end access_rank from st left join trust using (tier)),
cand as (select canonical_key, arg_min(source_url, ord) source_url, arg_min(source_domain, ord) source_domain, first(doi order by ord) doi, arg_min(document_type, ord) document_type,
  first(tier order by trust desc, ord) tier, max(trust) trust, max(score) score, first(access_status order by access_rank desc, ord) access_status, max(access_rank) access_rank,
  list_sort(list(distinct parameter_id)) parameter_ids, count(*) ledger_rows, bool_and(discovery_drop_reason = 'relevance_gate') all_gated, min(ord) first_ord from acc group by 1)"""
GATED = ("backfill", "citation")


def ledger(spark, d):
    h = table(spark, d, "query_hits").select("ord", "run_id", F.coalesce("query", F.lit("")).alias("query"), "parameter_id", F.coalesce("discovery_method", F.lit("")).alias("provider"), F.coalesce("source_tier_id", F.lit("")).alias("tier"), "document_id")
    docs = table(spark, d, "documents").select("document_id", F.floor(F.coalesce("quality_score", F.lit(0.0)) * 15).cast("int").alias("score"), F.col("canonical_url").alias("source_url"), "doi", *[F.coalesce(c, F.lit("")).alias(c) for c in ("source_domain", "access_status", "document_type")], K.canonical_key(F.col("doi"), F.col("canonical_url")).alias("canonical_key"))
    return h.join(docs, "document_id")


def stamped(spark, d):
    return L.stamp_drops(ledger(spark, d), GATED)


def cands(spark, d):
    return L.candidates(stamped(spark, d), table(spark, d, "source_tiers").select(F.col("tier_id").alias("tier"), "trust"))


# ---------------------------------------------------------------- ledger
@query(f"with {LEDGER_SQL} select ord, row_number() over (partition by query, provider order by ord) discovery_rank from led")
def ledger_provider_rank(spark, d):
    return L.provider_rank(ledger(spark, d)).select("ord", "discovery_rank")


@query(f"with {LEDGER_SQL}, {STAMP_SQL} select ord, canonical_key, discovery_drop_reason from st")
def ledger_drop_stamp(spark, d):
    return stamped(spark, d).select("ord", "canonical_key", "discovery_drop_reason")


@query(f"with {LEDGER_SQL}, {STAMP_SQL} select provider, discovery_drop_reason, count(*) n, count(distinct canonical_key) keys from st group by 1, 2")
def ledger_summary(spark, d):
    return stamped(spark, d).groupBy("provider", "discovery_drop_reason").agg(F.count("*").alias("n"), F.count_distinct("canonical_key").alias("keys"))


@query(f"with {LEDGER_SQL} select ord, substr(sha1('run-1'), 1, 6) || '-led-' || lpad(cast(row_number() over (order by ord) as varchar), 6, '0') ledger_id from led")
def ledger_ids(spark, d):
    return L.with_ids(ledger(spark, d), "run-1").select("ord", "ledger_id")


@query(f"with {LEDGER_SQL}, {STAMP_SQL}, {TRUST_SQL}, {CAND_SQL} select canonical_key, source_url, source_domain, doi, document_type, tier, round(trust, 6) trust, score, access_status, list_aggregate(parameter_ids, 'string_agg', ',') parameter_ids, ledger_rows, all_gated, first_ord from cand")
def candidate_aggregate(spark, d):
    return cands(spark, d).select("canonical_key", "source_url", "source_domain", "doi", "document_type", "tier", F.round("trust", 6).alias("trust"), "score", "access_status", F.array_join("parameter_ids", ",").alias("parameter_ids"), "ledger_rows", "all_gated", "first_ord")


JUNK_SQL = "regexp_matches({d}, '(^10\\.99999/|/xxxx$|/0000$|^pending$|^-$|^n/a$|^none$)')"


@query(f"""with {LEDGER_SQL}, {STAMP_SQL}, {TRUST_SQL}, {CAND_SQL}, n as (select *, {DOI_SQL.format(c='doi')} nd from cand)
select canonical_key, case when all_gated then 'relevance_gated' when nd <> '' and {JUNK_SQL.format(d='nd')} then 'junk_doi' when nd <> '' and document_type not in ('article', 'html', 'pdf') then 'non_article_type' else '' end reason from n""")
def candidate_prefilter(spark, d):
    return cands(spark, d).select("canonical_key", L.prefilter_reason().alias("reason"))


@query(f"with {LEDGER_SQL}, {STAMP_SQL}, {TRUST_SQL}, {CAND_SQL} select canonical_key, round(trust, 6) trust, access_rank, score, first_ord from cand order by trust desc, access_rank desc, score desc, first_ord limit 50")
def fetch_rank_topk(spark, d):
    return L.fetch_rank(cands(spark, d), 50).select("canonical_key", F.round("trust", 6).alias("trust"), "access_rank", "score", "first_ord")


@query()
def fetch_quota_select(spark, d):
    """Greedy quota selection, one fold a run (sequential: no SQL twin; tested against a plain loop)."""
    led = ledger(spark, d)
    trust = table(spark, d, "source_tiers").select(F.col("tier_id").alias("tier"), "trust")
    per_run = led.withColumn("canonical_key", F.concat_ws("\x1f", "run_id", "canonical_key"))
    c = L.candidates(L.stamp_drops(per_run, GATED), trust)
    return L.quota_select(c.withColumn("run_id", F.substring_index("canonical_key", "\x1f", 1)))


@query(f"""with {LEDGER_SQL}, s as (select source_url, min(parameter_id) pid, count(*) n from led where score >= 12 group by 1),
seeds as (select source_url || '#seed' source_url, pid parameter_id from s where n >= 2 union all select source_url, pid from s where n = 1),
fresh as (select * from seeds where source_url not in (select source_url from led where source_url is not null))
select source_url, parameter_id, provider, score from led union all select source_url, parameter_id, 'seed', 15 from fresh""")
def seed_union(spark, d):
    led = ledger(spark, d)
    s = led.where("score >= 12").groupBy("source_url").agg(F.min("parameter_id").alias("pid"), F.count("*").alias("n"))
    seeds = s.select(F.when(F.col("n") >= 2, F.concat("source_url", F.lit("#seed"))).otherwise(F.col("source_url")).alias("source_url"), F.array("pid").alias("parameter_ids")).where("source_url is not null")
    return L.seed_union(led, seeds)


# ---------------------------------------------------------------- keys and text
@query(f"select doc_id, {KEY_SQL} canonical_key, {DOI_SQL.format(c='doi')} doi_norm, {JUNK_SQL.format(d=DOI_SQL.format(c='doi'))} junk from documents")
def source_keys(spark, d):
    doc = table(spark, d, "documents")
    return doc.select("doc_id", K.canonical_key(F.col("doi"), F.col("canonical_url")).alias("canonical_key"), K.normalize_doi(F.col("doi")).alias("doi_norm"), K.junk_doi(F.col("doi")).alias("junk"))


WS_SQL = "trim(regexp_replace(coalesce({c}, ''), '[\\s\\x0B\\x{{85}}\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}\\x{{1680}}]+', ' ', 'g'))"
HASH_SQL = f"case when {WS_SQL.format(c='text')} = '' then '' else sha256({WS_SQL.format(c='text')}) end"


@query(f"select doc_id, {HASH_SQL} sha from documents")
def doc_text_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", X.text_hash(F.col("text")).alias("sha"))


CORPUS_SQL = f"""k as (select *, {HASH_SQL} sha from documents),
c as (select *, 'doc-' || substr(case when sha <> '' then sha else sha256(coalesce(canonical_url, '') || '|' || coalesce(title, '')) end, 1, 16) corpus_id from k)"""


@query(f"with {CORPUS_SQL} select corpus_id, min(doc_id) doc_id, arg_min(coalesce(source_domain, ''), doc_id) source_domain, count(*) captures from c group by 1")
def doc_dedupe(spark, d):
    doc = table(spark, d, "documents").withColumn("source_url", F.col("canonical_url")).withColumn("source_domain", F.coalesce("source_domain", F.lit("")))
    return D.unique_documents(D.content_keys(doc)).select("corpus_id", "doc_id", "source_domain", "captures")


@query(f"with {CORPUS_SQL} select distinct c.corpus_id, h.capture_id, h.parameter_id from c join query_hits h using (document_id)")
def doc_hits_bridge(spark, d):
    doc = D.content_keys(table(spark, d, "documents").withColumn("source_url", F.col("canonical_url"))).select("document_id", "corpus_id")
    return table(spark, d, "query_hits").select("document_id", "capture_id", "parameter_id").join(doc, "document_id").select("corpus_id", "capture_id", "parameter_id").distinct()


@query("with h as (select run_id, sha256(doc_id || '|' || coalesce(text_hash, '') || '|' || coalesce(content_hash, '')) h from documents) select run_id, count(*) documents, sha256(concat_ws(',', " + ", ".join(f"sum(cast(('0x' || substr(h, {1 + 8 * k}, 8)) as bigint))" for k in range(8)) + ")) fingerprint from h group by 1")
def corpus_fingerprint(spark, d):
    return D.fingerprint(table(spark, d, "documents"), "doc_id", ["text_hash", "content_hash"])


@query(f"""with k as (select *, {HASH_SQL} sha, length({WS_SQL.format(c='text')}) len from documents),
a as (select count(*) documents, count(*) filter (sha <> '') text_documents, count(distinct case when sha <> '' then sha end) distinct_texts, count(*) filter (coalesce(is_metadata_only, false)) metadata_only, count(*) filter (coalesce(backfilled, false)) backfilled, count(*) filter (len < 200) short_texts from k)
select *, round(1 - cast(distinct_texts as double) / text_documents, 3) duplicate_ratio, round(cast(metadata_only as double) / documents, 3) metadata_share,
 round(1 - cast(distinct_texts as double) / text_documents, 3) < 0.10 gate_duplicates, round(cast(metadata_only as double) / documents, 3) < 0.15 gate_metadata from a""")
def corpus_qa_metrics(spark, d):
    return D.qa_metrics(table(spark, d, "documents"))


@query("select source_domain, count(*) n, min(doc_id) first_doc from documents where source_domain is not null group by 1 order by n desc, first_doc limit 15")
def corpus_top_domains(spark, d):
    g = table(spark, d, "documents").where("source_domain is not null").groupBy("source_domain").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))
    return g.orderBy(F.col("n").desc(), "first_doc").limit(15)


@query("select parameter_id from parameter_manifest where parameter_id not in (select parameter_id from query_hits where discovery_method = 'citation' and source_tier_id is null and parameter_id is not null)")
def missing_parameters(spark, d):
    seen = table(spark, d, "query_hits").where("discovery_method = 'citation' and source_tier_id is null").select("parameter_id")
    return table(spark, d, "parameter_manifest").select("parameter_id").join(seen, "parameter_id", "left_anti")


@query("""with l as (select doc_id, string_split(text, chr(10)) ls from documents where text is not null),
p as (select doc_id, unnest(range(0, len(ls))) pos, ls from l)
select doc_id, cast(pos as int) as position, cast(coalesce(list_sum(list_transform(ls[1:pos], lambda x: length(x) + 1)), 0) as int) char_offset, ls[pos + 1] paragraph from p where length(trim(ls[pos + 1], ' ')) >= 40""")
def doc_paragraphs(spark, d):
    return D.paragraphs(table(spark, d, "documents").where("text is not null"))


TOK_SQL = "list_distinct(regexp_extract_all(lower(coalesce({c}, '')), '([a-z0-9]+)', 1))"


@query(f"select doc_id, cast(len({TOK_SQL.format(c='title')}) as int) title_tokens, cast(len(list_intersect({TOK_SQL.format(c='title')}, {TOK_SQL.format(c='text')})) as int) shared from documents")
def doc_tokens_overlap(spark, d):
    t, b = X.tokens(F.col("title")), X.tokens(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(t).alias("title_tokens"), F.size(F.array_intersect(t, b)).alias("shared"))


@query("""with s as (select doc_id, unnest(string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \\t\\n\\r\\f\\x0B]+', '\\1' || chr(1), 'g'), chr(1))) s from documents)
select doc_id, count(*) sentences, max(length(trim(s, ' '))) longest from s where trim(s, ' ') <> '' group by 1""")
def doc_sentences(spark, d):
    s = table(spark, d, "documents").select("doc_id", F.explode(X.sentences(F.col("text"))).alias("s"))
    return s.groupBy("doc_id").agg(F.count("*").alias("sentences"), F.max(F.length("s")).alias("longest"))


@query("""with s as (select doc_id, unnest(list_distinct(list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \\t\\n\\r\\f\\x0B]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x, ' ')), lambda x: x <> ''))) s from documents),
c as (select doc_id, s, len(regexp_extract_all(s, '[0-9]+')) * 2 + case when contains(lower(s), 'yield') then 3 else 0 end + case when length(s) < 40 then -4 else 0 end score from s),
r as (select *, row_number() over (partition by doc_id order by score desc, s) rn from c where score >= 4)
select doc_id, cast(rn as int) as position, cast(score as int) score, s sentence from r where rn <= 8""")
def sentence_top8(spark, d):
    s = table(spark, d, "documents").select("doc_id", F.explode(F.array_distinct(X.sentences(F.col("text")))).alias("sentence"))
    score = F.size(F.regexp_extract_all("sentence", F.lit("([0-9]+)"), F.lit(1))) * 2 + F.when(F.lower("sentence").contains("yield"), 3).otherwise(0) + F.when(F.length("sentence") < 40, -4).otherwise(0)
    s = s.withColumn("score", score.cast("int")).where("score >= 4")
    w = Window.partitionBy("doc_id").orderBy(F.col("score").desc(), "sentence")
    return s.withColumn("position", F.row_number().over(w)).where("position <= 8").select("doc_id", "position", "score", "sentence")


@query(f"""with n as (select doc_id, {WS_SQL.format(c='text')} t from documents)
select doc_id, case when length(t) <= 240 then t else rtrim(substr(t, 1, 237), ' ') || '...' end excerpt from n""")
def doc_truncate(spark, d):
    return table(spark, d, "documents").select("doc_id", X.truncate(F.col("text")).alias("excerpt"))


@query("""select doc_id, regexp_replace(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') slug,
 case when contains(lower(coalesce(content_type, '')), 'pdf') then 'pdf' when contains(lower(coalesce(content_type, '')), 'json') then 'json' when contains(lower(coalesce(content_type, '')), 'csv') then 'csv' when contains(lower(coalesce(content_type, '')), 'html') then 'html'
  when u like '%.pdf' then 'pdf' when u like '%.json' then 'json' when u like '%.csv' then 'csv' when regexp_matches(u, '(\\.html?|/[^./]*)$') then 'html' else 'other' end kind
from (select *, lower(regexp_replace(coalesce(canonical_url, ''), '[?#].*$', '')) u from documents)""")
def doc_slug_and_type(spark, d):
    return table(spark, d, "documents").select("doc_id", X.slug(F.col("title")).alias("slug"), X.document_type(F.col("content_type"), F.col("canonical_url")).alias("kind"))


@query("""select ord, case when regexp_matches(t, '^https?://|doi\\.org|^\\[?[0-9]+[.\\])] .*(19|20)[0-9][0-9]') then 'reference' when regexp_matches(t, '^table [0-9]') then 'table' when regexp_matches(t, '^(figure|fig\\.) ?[0-9]') then 'figure' when t like 'abstract%' then 'abstract' when regexp_matches(t, '^chapter [0-9]') then 'chapter' else 'claim' end label
from (select ord, lower(trim(coalesce(evidence_text, ''), ' ')) t from normalized_claims)""")
def evidence_labels(spark, d):
    return table(spark, d, "normalized_claims").select("ord", X.evidence_label(F.col("evidence_text")).alias("label"))


# ---------------------------------------------------------------- values
@query("""select ord, case when unit = 'fahrenheit' then round((numeric_value - 32.0) * 5.0 / 9.0, 2) end celsius, try_cast(nullif(regexp_extract(coalesce(raw_value_text, ''), '([0-9]+(?:\\.[0-9]+)?) ?(?:to|-|–) ?([0-9]+(?:\\.[0-9]+)?)', 1), '') as double) lo,
 try_cast(nullif(regexp_extract(coalesce(raw_value_text, ''), '([0-9]+(?:\\.[0-9]+)?) ?(?:to|-|–) ?([0-9]+(?:\\.[0-9]+)?)', 2), '') as double) hi, cast(len(regexp_extract_all(coalesce(claim_text, ''), '([0-9]+(?:\\.[0-9]+)?) ?(?:°C|celsius|deg C|degrees Celsius)', 1)) as int) temperatures
 from normalized_claims""")
def value_extract(spark, d):
    n = table(spark, d, "normalized_claims")
    return n.select("ord", F.when(F.col("unit") == "fahrenheit", V.fahrenheit_to_celsius(F.col("numeric_value"))).alias("celsius"), V.measurement_range(F.col("raw_value_text"), 1).alias("lo"), V.measurement_range(F.col("raw_value_text"), 2).alias("hi"), F.size(V.temperatures(F.col("claim_text"))).alias("temperatures"))


@query("select ord, coalesce(try_cast(nullif(regexp_extract(coalesce(source_title, ''), '((?:19|20)[0-9]{2})', 1), '') as int), -1) title_year, cast(coalesce(source_publication_year, year(source_publication_date), -1) as int) publication_year from source_documents")
def publication_years(spark, d):
    return table(spark, d, "source_documents").select("ord", F.coalesce(V.year_in(F.col("source_title")), F.lit(-1)).alias("title_year"), F.coalesce("source_publication_year", F.year("source_publication_date"), F.lit(-1)).cast("int").alias("publication_year"))


SIG_SQL = """case when value_type = 'numeric' and numeric_value is not null then 'n|' || printf('%.4f', numeric_value) || '|' || coalesce(unit, '')
 when value_type = 'range' and range_min is not null and range_max is not null then 'r|' || printf('%.4f', range_min) || '|' || printf('%.4f', range_max) || '|' || coalesce(unit, '') else 't|' || lower(trim(coalesce(text_value, ''))) end"""


def _signed(spark, d):
    n = table(spark, d, "normalized_claims")
    return n.withColumn("sig", V.value_signature(*[F.col(c) for c in ("value_type", "numeric_value", "range_min", "range_max", "text_value", "unit")]))


# ---------------------------------------------------------------- claims
CLAIM_SQL = """cl as (select *, coalesce(range_min, numeric_value) lo, coalesce(range_max, numeric_value) hi from (select *, row_number() over (partition by claim_id order by inserted_at desc, ord desc) rn from normalized_claims) where rn = 1)"""


def claims(spark, d):
    n = C.latest(table(spark, d, "normalized_claims"), ["claim_id"], ["inserted_at", "ord"])
    return n.withColumn("lo", V.interval_low(F.col("numeric_value"), F.col("range_min"))).withColumn("hi", V.interval_high(F.col("numeric_value"), F.col("range_max")))


@query(f"with {CLAIM_SQL} select claim_id, ord, run_id, parameter_id, source_domain, lo, hi from cl")
def claim_latest(spark, d):
    return claims(spark, d).select("claim_id", "ord", "run_id", "parameter_id", "source_domain", "lo", "hi")


KEY4 = ["parameter_id", "location_name", "attribute_subtype", "management_system"]
CONFLICT_SQL = ", ".join(C.CONFLICT_KEY)


@query(f"with {CLAIM_SQL} select {CONFLICT_SQL}, count(*) members, count(distinct source_domain) sources, max(lo) max_lo, min(hi) min_hi, count(distinct source_domain) > 1 and max(lo) > min(hi) + 0.5 conflict from cl where lo is not null group by {CONFLICT_SQL}")
def claim_conflict_groups(spark, d):
    """Conflicts by the whole applicability key."""
    return C.conflict_groups(claims(spark, d).where("lo is not null"))


@query(f"""with {CLAIM_SQL}, g as (select parameter_id, location_name, attribute_subtype, management_system, count(distinct source_domain) > 1 and max(lo) > min(hi) + 0.5 conflict from cl where lo is not null group by 1, 2, 3, 4)
select cl.claim_id, g.conflict from cl join g on cl.parameter_id is not distinct from g.parameter_id and cl.location_name is not distinct from g.location_name and cl.attribute_subtype is not distinct from g.attribute_subtype and cl.management_system is not distinct from g.management_system where cl.lo is not null""")
def claim_conflict_flags(spark, d):
    c = claims(spark, d).where("lo is not null")
    g = C.conflict_groups(c, KEY4).select(*[F.col(k).alias(f"g_{k}") for k in KEY4], "conflict")
    on = F.lit(True)
    for k in KEY4:
        on = on & F.col(k).eqNullSafe(F.col(f"g_{k}"))
    return c.join(g, on).select("claim_id", "conflict")


@query()
def claim_merge_intervals(spark, d):
    """Greedy interval merge (order-dependent fold: no SQL twin; tested against a plain loop)."""
    return C.merge_intervals(claims(spark, d).where("lo is not null"), ["parameter_id", "location_name"])


@query(f"with {CLAIM_SQL} select parameter_id, location_name, text_value, min(ord) first_ord, count(*) members, count(distinct source_url) sources from cl where value_type = 'text' group by 1, 2, 3")
def claim_merge_text_dedupe(spark, d):
    t = claims(spark, d).where("value_type = 'text'")
    return t.groupBy("parameter_id", "location_name", "text_value").agg(F.min("ord").alias("first_ord"), F.count("*").alias("members"), F.count_distinct("source_url").alias("sources"))


@query(f"select ord, {SIG_SQL} signature from normalized_claims")
def value_signatures(spark, d):
    return _signed(spark, d).select("ord", F.col("sig").alias("signature"))


@query(f"""with s as (select *, {SIG_SQL} sig from normalized_claims)
select parameter_id, attribute_subtype, sig, cast(count(distinct claim_id) as int) members, cast(count(distinct source_domain) as int) domains, case when coalesce(max(cast(conflict_status = 'potential' as int)), 0) = 1 then 'review_conflict' when count(distinct source_domain) > 1 then 'merge_sources' else 'keep_single' end action
from s group by 1, 2, 3""")
def cluster_actions(spark, d):
    return C.clusters(_signed(spark, d), ["parameter_id", "attribute_subtype", "sig"]).select("parameter_id", "attribute_subtype", "sig", "members", F.size("domains").alias("domains"), "action")


@query("""with n as (select source_domain, parameter_id, count(*) n, min(ord) first from normalized_claims where parameter_id is not null group by 1, 2)
select source_domain, parameter_id, n, cast(rn as int) as position from (select *, row_number() over (partition by source_domain order by n desc, first) rn from n) where rn <= 5""")
def scorecard_top_parameters(spark, d):
    return C.top_values(table(spark, d, "normalized_claims"), ["source_domain"], "parameter_id")


@query("select source_domain, document_type, count(*) claims, count(distinct claim_id) distinct_claims, count(*) filter (confidence = 'high') high, count(*) filter (conflict_status = 'potential') conflicts, count(distinct parameter_id) parameters from normalized_claims group by 1, 2")
def source_scorecards(spark, d):
    return table(spark, d, "normalized_claims").groupBy("source_domain", "document_type").agg(F.count("*").alias("claims"), F.count_distinct("claim_id").alias("distinct_claims"), F.count_if(F.col("confidence") == "high").alias("high"), F.count_if(F.col("conflict_status") == "potential").alias("conflicts"), F.count_distinct("parameter_id").alias("parameters"))


@query(f"""with {CLAIM_SQL}, u as (select parameter_id, unit, count(*) n from cl where unit is not null group by 1, 2),
m as (select parameter_id, first(unit order by n desc, unit) unit from u group by 1)
select cl.parameter_id, count(*) claims, min(lo) least, max(hi) greatest, any_value(m.unit) unit from cl left join m on cl.parameter_id is not distinct from m.parameter_id group by 1""")
def value_summary(spark, d):
    return C.value_summary(claims(spark, d), ["parameter_id"]).drop("samples")


@query("select d.durable_claim_id, n.parameter_id, n.source_domain from durable_claims d join (select distinct claim_id, parameter_id, source_domain from normalized_claims) n on d.source_claim_id = n.claim_id")
def promote_join(spark, d):
    n = table(spark, d, "normalized_claims").select(F.col("claim_id").alias("source_claim_id"), "parameter_id", "source_domain").distinct()
    return table(spark, d, "durable_claims").select("durable_claim_id", "source_claim_id").join(n, "source_claim_id").drop("source_claim_id")


@query("select durable_claim_id, run_id, cast(row_number() over (partition by run_id order by source_claim_id, durable_claim_id) as int) number from durable_claims")
def durable_numbering(spark, d):
    """Numbers within a run, whatever share of the rows it has."""
    c = table(spark, d, "durable_claims").select("durable_claim_id", "run_id", F.struct("source_claim_id", "durable_claim_id").alias("place"))
    return L.sequence(c, "run_id", "place").select("durable_claim_id", "run_id", F.col("position").cast("int").alias("number"))


@query("""select n.claim_id, count(*) spans from (select distinct claim_id, lower(trim(regexp_replace(coalesce(evidence_text, ''), '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'))) k from normalized_claims) n
join (select distinct lower(trim(regexp_replace(coalesce(claim_text, ''), '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'))) k from durable_claims) s using (k) where k <> '' group by 1""")
def span_conflicts(spark, d):
    key = lambda c: F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " ")))
    n = table(spark, d, "normalized_claims").select("claim_id", key(F.col("evidence_text")).alias("k")).distinct()
    s = table(spark, d, "durable_claims").select(key(F.col("claim_text")).alias("k")).distinct()
    return n.join(s, "k").where("k <> ''").groupBy("claim_id").agg(F.count("*").alias("spans"))


# ---------------------------------------------------------------- coverage
TIERED_SQL = "t as (select parameter_id, coalesce(nullif(trim(source_tier_id), ''), 'unclassified') tier from normalized_claims)"


def _tiered(spark, d, name="normalized_claims"):
    t = table(spark, d, name)
    return t.select("parameter_id", F.coalesce(F.nullif(F.trim("source_tier_id"), F.lit("")), F.lit("unclassified")).alias("tier"))


@query(f"with {TIERED_SQL} select parameter_id, tier, count(*) n, cast(grouping(parameter_id) * 2 + grouping(tier) as int) \"level\", 'normalized' stage from t group by grouping sets ((parameter_id), (tier), (parameter_id, tier))")
def coverage_grouping_sets(spark, d):
    return G.counts(_tiered(spark, d), "normalized").withColumn("level", F.col("level").cast("int"))


@query(f"with {TIERED_SQL}, n as (select parameter_id, tier, count(*) n from t group by 1, 2) select p.parameter_id, s.tier_id tier, coalesce(n.n, 0) n from parameter_manifest p cross join source_tiers s left join n on n.parameter_id = p.parameter_id and n.tier = s.tier_id")
def tier_pivot(spark, d):
    return G.parameter_tier_matrix(table(spark, d, "parameter_manifest"), table(spark, d, "source_tiers").select(F.col("tier_id").alias("tier")), _tiered(spark, d))


@query("select parameter_id, case when parameter_id in (select parameter_id from durable_claims where promotion_decision = 'canonical_candidate' and parameter_id is not null) then 'promoted' when parameter_id in (select parameter_id from normalized_claims where parameter_id is not null) then 'normalized' when parameter_id in (select parameter_id from query_hits where parameter_id is not null) then 'queried' else 'missing' end status from parameter_manifest")
def coverage_status(spark, d):
    p = table(spark, d, "durable_claims").where("promotion_decision = 'canonical_candidate'")
    return G.status(table(spark, d, "parameter_manifest"), table(spark, d, "normalized_claims"), p, table(spark, d, "query_hits"))


@query("select coalesce(nullif(trim(source_tier_id), ''), 'unclassified') tier, count(*) hits, count(distinct document_id) documents, count(distinct parameter_id) parameters, epoch_us(min(hit_at)) first_hit_us from query_hits group by 1")
def tier_summary(spark, d):
    t = table(spark, d, "query_hits").withColumn("tier", F.coalesce(F.nullif(F.trim("source_tier_id"), F.lit("")), F.lit("unclassified")))
    return t.groupBy("tier").agg(F.count("*").alias("hits"), F.count_distinct("document_id").alias("documents"), F.count_distinct("parameter_id").alias("parameters"), F.unix_micros(F.min("hit_at")).alias("first_hit_us"))


# ---------------------------------------------------------------- relationships (stand-in data)
def nodes(spark, d):
    return table(spark, d, "nation").select(F.col("n_name").alias("node"), F.col("n_regionkey").alias("group"))


REL_SQL = """rel as (select l.l_orderkey * 10 + l.l_linenumber ord, 'rotation' mode, cn.n_name subject, sn.n_name object, o.o_orderpriority tier,
 case when l_returnflag = 'A' and l_linestatus = 'F' then 'beneficial' when l_returnflag = 'R' then 'avoid' when l_linenumber % 3 = 0 then 'conditional' when l_linenumber % 3 = 1 then 'neutral' else 'unknown' end effect
 from lineitem l join orders o on l_orderkey = o_orderkey join customer c on o_custkey = c_custkey join supplier s on l_suppkey = s_suppkey join nation cn on c_nationkey = cn.n_nationkey join nation sn on s_nationkey = sn.n_nationkey)"""


def relations(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    n = table(spark, d, "nation")
    c = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("subject"))
    s = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("object"))
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    third = F.col("l_linenumber") % 3
    effect = F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), "beneficial").when(F.col("l_returnflag") == "R", "avoid").when(third == 0, "conditional").when(third == 1, "neutral").otherwise("unknown")
    return j.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.lit("rotation").alias("mode"), "subject", "object", F.col("o_orderpriority").alias("tier"), effect.alias("effect"))


@query("select a.n_name subject, b.n_name object from nation a, nation b where a.n_name <> b.n_name")
def pairs_ordered(spark, d):
    return R.ordered_pairs(nodes(spark, d))


@query("select a.n_name subject, b.n_name object from nation a, nation b where a.n_name <= b.n_name")
def pairs_unordered(spark, d):
    return R.unordered_pairs(nodes(spark, d))


@query("select a.n_name subject, b.n_name object, a.n_regionkey \"group\" from nation a join nation b on a.n_regionkey = b.n_regionkey where a.n_name < b.n_name")
def pairs_in_group(spark, d):
    n = nodes(spark, d)
    return n.select(F.col("node").alias("subject"), "group").join(n.select(F.col("node").alias("object"), "group"), "group").where("subject < object").select("subject", "object", "group")


@query("select p.parameter_id, t.tier_id tier, cast(p.rn as int) pattern, p.label || ' ' || case p.rn when 1 then 'trial' else 'guide' end || ' ' || t.label query from (select parameter_id, label, unnest([1, 2]) rn from parameter_manifest) p cross join source_tiers t")
def plan_product(spark, d):
    p = table(spark, d, "parameter_manifest").select("parameter_id", "label", F.posexplode(F.array(F.lit("trial"), F.lit("guide"))).alias("pos", "word"))
    t = table(spark, d, "source_tiers").select(F.col("tier_id").alias("tier"), F.col("label").alias("tier_label"))
    return p.join(F.broadcast(t), how="cross").select("parameter_id", "tier", (F.col("pos") + 1).alias("pattern"), F.concat_ws(" ", "label", "word", "tier_label").alias("query"))


@query(f"with {REL_SQL} select ord, least(subject, object) subject, greatest(subject, object) object, mode || '|' || least(subject, object) || '|' || greatest(subject, object) key from rel")
def symmetric_normalize(spark, d):
    return R.symmetric_ends(relations(spark, d), ("rotation",)).select("ord", "subject", "object", "key")


@query(f"""with {REL_SQL}, r as (select subject || '>' || object as key, ord, effect, cast(left(tier, 1) as int) rank, case effect when 'beneficial' then 'positive' when 'avoid' then 'negative' when 'conditional' then 'conditional' when 'neutral' then 'neutral' else 'ignore' end pol from rel),
n as (select key, rank, pol, effect, count(*) n, min(ord) first from r group by 1, 2, 3, 4),
m as (select *, min(rank) filter (pol <> 'ignore') over (partition by key) dec from n),
g as (select key, cast(sum(n) as bigint) claims, min(dec) dec, first(effect order by n desc, first, effect) filter (pol <> 'ignore' and rank = dec) any_e, first(effect order by n desc, first, effect) filter (pol in ('positive', 'negative') and rank = dec) dec_e,
 coalesce(bool_or(pol = 'positive' and rank = dec), false) pos, coalesce(bool_or(pol = 'negative' and rank = dec), false) neg, coalesce(bool_or(pol = 'conditional' and rank = dec), false) cond, coalesce(bool_or(pol = 'positive' and rank > dec), false) lp, coalesce(bool_or(pol = 'negative' and rank > dec), false) ln from m group by 1)
select key, claims, dec deciding_rank, case when dec is null then 'unknown' when pos and neg then dec_e when (pos or neg) and cond then 'conditional' when pos or neg then dec_e else any_e end effect, (pos and neg) or ((pos or neg) and cond) ambiguous, (pos and not neg and ln) or (neg and not pos and lp) superseded from g""")
def tiered_effect(spark, d):
    c = relations(spark, d).select(F.concat("subject", F.lit(">"), "object").alias("key"), "tier", "effect", "ord")
    # the ranks come from the dimension that names the tiers, not from the joined rows
    tiers = table(spark, d, "orders").select(F.col("o_orderpriority").alias("tier")).distinct()
    return R.tiered_effect(c, tiers.select("tier", F.substring("tier", 1, 1).cast("int").alias("rank")))


@query(f"with {REL_SQL} select subject || '>' || object as key, effect, count(*) n from rel group by 1, 2")
def effect_histogram(spark, d):
    return relations(spark, d).groupBy(F.concat("subject", F.lit(">"), "object").alias("key"), "effect").agg(F.count("*").alias("n"))


@query(f"""with {REL_SQL}, direct as (select subject, object, first(effect order by ord, effect) effect from rel join nation a on a.n_name = subject join nation b on b.n_name = object where effect = 'beneficial' and a.n_regionkey = b.n_regionkey group by 1, 2),
ge as (select a.n_regionkey sg, b.n_regionkey og, first(effect order by ord, effect) effect from rel join nation a on a.n_name = subject join nation b on b.n_name = object where a.n_regionkey < b.n_regionkey group by 1, 2),
q as (select a.n_name subject, b.n_name object, a.n_regionkey sg, b.n_regionkey og from nation a, nation b where a.n_name <> b.n_name)
select q.subject, q.object, case when d.effect is not null then 'direct' when ge.effect is not null then 'inferred' else 'none' end resolution, coalesce(d.effect, ge.effect, 'unknown') effect from q left join direct d using (subject, object) left join ge on ge.sg = q.sg and ge.og = q.og""")
def resolve_relations(spark, d):
    rel, n = relations(spark, d), nodes(spark, d)
    member = n.select("node", F.lit(0).alias("base_pos"), "group")
    g = rel.join(n.select(F.col("node").alias("subject"), F.col("group").alias("subject_group")), "subject").join(n.select(F.col("node").alias("object"), F.col("group").alias("object_group")), "object")
    direct = g.where("effect = 'beneficial' and subject_group = object_group").groupBy("subject", "object").agg(F.min_by("effect", F.struct("ord", "effect")).alias("effect"))
    edges = g.where("subject_group < object_group").groupBy("subject_group", "object_group").agg(F.min_by("effect", F.struct("ord", "effect")).alias("effect")).withColumn("base_pos", F.lit(0)).withColumn("pos", F.lit(0))
    return R.resolve(R.ordered_pairs(n), direct, member, edges)


@query(f"""with {REL_SQL}, e as (select * from rel where tier = '1-URGENT' and effect = 'conditional'), n as (select subject, object, count(*) n from e group by 1, 2), s as (select distinct subject, object from rel where tier = '2-HIGH' and effect = 'avoid')
select m.mode, a.n_name subject, b.n_name object, case when m.mode = 'rotation' then coalesce(n.n, 0) else 0 end claims, case when m.mode = 'rotation' and n.n is not null then 'evidence' when s.subject is not null then 'searched_no_evidence' else 'not_searched' end status
from nation a, nation b, (select unnest(['rotation', 'intercrop']) as mode) m left join n on n.subject = a.n_name and n.object = b.n_name left join s on s.subject = a.n_name and s.object = b.n_name where a.n_name <> b.n_name""")
def matrix_populate(spark, d):
    rel = relations(spark, d)
    modes = spark.createDataFrame([("rotation",), ("intercrop",)], "mode string")
    return R.matrix(R.ordered_pairs(nodes(spark, d)), modes, rel.where("tier = '1-URGENT' and effect = 'conditional'"), rel.where("tier = '2-HIGH' and effect = 'avoid'"))


@query("select alias, first(crop_id order by pos) node_id from (select crop_id, row_number() over (order by crop_id) pos, lower(trim(unnest(list_concat([crop_id, label], coalesce(aliases, []))))) alias from crops) group by 1")
def alias_index(spark, d):
    c = table(spark, d, "crops").select(F.col("crop_id").alias("node_id"), "label", "aliases", F.lit(True).alias("is_crop"), F.row_number().over(Window.orderBy("crop_id")).alias("pos"))
    return R.alias_index(c)


# ---------------------------------------------------------------- evaluation
@query("""with g as (select ord gold_id, source_url doc, parameter_id, numeric_value gold_value, source_domain as domain from (select *, row_number() over (partition by claim_id order by ord) rn from normalized_claims) where rn = 1 and value_type = 'numeric' and numeric_value is not null and confidence = 'high'),
p as (select source_url doc, parameter_id, normalized_numeric_value v, range_min lo, range_max hi from normalized_claims),
h as (select g.gold_id, any_value(g.domain) as domain, bool_or(coalesce(abs(v - gold_value) <= 0.05 * greatest(abs(gold_value), 1e-9), false) or coalesce(gold_value >= lo and gold_value <= hi, false)) hit from g left join p on g.doc = p.doc and g.parameter_id = p.parameter_id group by 1)
select domain, count(*) gold, count(*) filter (hit) recalled, cast(grouping(domain) as int) total, round(cast(count(*) filter (hit) as double) / count(*), 4) recall from h group by rollup (domain)""")
def eval_extraction(spark, d):
    n = table(spark, d, "normalized_claims")
    once = n.groupBy("claim_id").agg(F.min_by(F.struct("ord", "source_url", "parameter_id", "numeric_value", "source_domain", "value_type", "confidence"), "ord").alias("r")).select("r.*")
    gold = once.where("value_type = 'numeric' and numeric_value is not null and confidence = 'high'").select(F.col("ord").alias("gold_id"), F.col("source_url").alias("doc"), "parameter_id", F.col("numeric_value").alias("gold_value"), F.col("source_domain").alias("domain"))
    pred = n.select(F.col("source_url").alias("doc"), "parameter_id", F.col("normalized_numeric_value").alias("value"), F.col("range_min").alias("lo"), F.col("range_max").alias("hi"))
    return E.extraction_scores(gold, pred).withColumn("total", F.col("total").cast("int"))


@query(f"""with {LEDGER_SQL}, r as (select *, row_number() over (partition by query, provider order by ord) rank from led), g as (select ord gold_id, source_url, source_domain from source_documents),
u as (select g.gold_id, r.rank from g join r on g.source_url = r.source_url where coalesce(g.source_url, '') <> '' union all select g.gold_id, x.rank from g join (select source_domain, min(rank) rank from r where source_domain <> '' group by 1) x on g.source_domain = x.source_domain where coalesce(g.source_domain, '') <> '')
select g.gold_id, coalesce(min(u.rank), -1) best_rank from g left join u using (gold_id) group by 1""")
def eval_retrieval(spark, d):
    led = L.provider_rank(ledger(spark, d)).withColumnRenamed("discovery_rank", "rank").withColumn("rank", F.col("rank").cast("bigint"))
    gold = table(spark, d, "source_documents").select(F.col("ord").alias("gold_id"), F.lit("").alias("doi"), "source_url", "source_domain")
    return E.retrieval_hits(gold, led).withColumn("best_rank", F.coalesce("best_rank", F.lit(-1)).cast("bigint"))


# ---------------------------------------------------------------- relational projection
@query("""select claim_id, parameter_id, json_extract_string(to_json(struct_pack(level := location_level, name := location_name, geo_id := location_geo_id)), '$.name') location, status, epoch_us(inserted_at) inserted_us
from (select *, row_number() over (partition by claim_id order by inserted_at desc, ord desc) rn from normalized_claims) where rn = 1""")
def relational_claims(spark, d):
    c = C.latest(table(spark, d, "normalized_claims"), ["claim_id"], ["inserted_at", "ord"])
    scope = F.to_json(F.struct(F.col("location_level").alias("level"), F.col("location_name").alias("name"), F.col("location_geo_id").alias("geo_id")))
    return c.select("claim_id", "parameter_id", F.get_json_object(scope, "$.name").alias("location"), "status", F.unix_micros("inserted_at").alias("inserted_us"))


@query("""select source_url, arg_max(coalesce(source_title, ''), ord) source_title, count(*) claims, string_agg(distinct parameter_id, ',' order by parameter_id) parameters
from normalized_claims where source_url is not null group by 1""")
def source_notes(spark, d):
    n = table(spark, d, "normalized_claims").where("source_url is not null")
    return n.groupBy("source_url").agg(F.max_by(F.coalesce("source_title", F.lit("")), "ord").alias("source_title"), F.count("*").alias("claims"), F.array_join(F.array_sort(F.collect_set("parameter_id")), ",").alias("parameters"))


# ---------------------------------------------------------------- pages
@query()
def page_blocks(spark, d):
    """Blocks of pages (texts wrapped in markup as stand-in pages); parsed with an HTML parser, no SQL twin."""
    p = table(spark, d, "documents").where("text is not null").select("doc_id", F.concat(F.lit("<html><nav>menu</nav><h1>"), F.coalesce("title", F.lit("")), F.lit("</h1><p>"), F.regexp_replace(F.regexp_replace("text", "[<>&]", " "), "\n", "</p><p>"), F.lit("</p><script>x</script></html>")).alias("html"))
    return D.page_blocks(p)
