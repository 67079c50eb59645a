"""Queries of the relationship lane and the fetch stages, with their DuckDB twins.

Claims about crops have no relationships in the tables; the lane runs over the claims' own columns: two crops of one group that
were studied on the same page are a pair, the claim's confidence is its effect.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.operators import fetching as H
from claimloom.operators import lane as V
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


# ------------------------------------------------------------ plans
MODES = [("rotation", 0, True, "directional"), ("intercrop", 1, True, "symmetric"), ("companion", 2, False, "symmetric")]
TEMPLATES = [("rotation", 0, "{object} after {subject}", True), ("rotation", 1, "{subject} {object} rotation", False), ("intercrop", 0, "{subject} with {object} intercrop", False)]
MODES_SQL = "modes as (select * from (values ('rotation', 0, true, 'directional'), ('intercrop', 1, true, 'symmetric'), ('companion', 2, false, 'symmetric')) m(mode, pos, is_default, directionality))"
TEMPLATES_SQL = "templates as (select * from (values ('rotation', 0, '{object} after {subject}', true), ('rotation', 1, '{subject} {object} rotation', false), ('intercrop', 0, '{subject} with {object} intercrop', false)) t(mode, pos, template, directional))"


def _modes(spark):
    return spark.createDataFrame(MODES, "mode string, pos int, is_default boolean, directionality string")


def _templates(spark):
    return spark.createDataFrame(TEMPLATES, "mode string, pos int, template string, directional boolean")


@query(f"with {MODES_SQL} select 'default' asked, mode from modes where is_default union all select 'all', mode from modes union all select 'named', mode from modes where mode in ('companion', 'rotation')")
def mode_selection(spark, d):
    m = _modes(spark)
    pick = lambda name, df: df.select(F.lit(name).alias("asked"), "mode")
    return pick("default", V.select_modes(m)).unionByName(pick("all", V.select_modes(m, every=True))).unionByName(pick("named", V.select_modes(m, ["companion", "rotation"])))


@query(f"with {TEMPLATES_SQL} select mode, cast(row_number() over (partition by mode order by directional, pos) as int) as position, template from templates")
def neutral_first_templates(spark, d):
    return V.neutral_first(_templates(spark))


@query(f"""with {MODES_SQL}, {TEMPLATES_SQL}, p as (select a.crop_id subject, b.crop_id object, a.scientific_names sn, b.scientific_names os from crops a, crops b where a.crop_id < b.crop_id),
t as (select mode, row_number() over (partition by mode order by directional, pos) as position, template from templates)
select subject, object, mode, tier, position, array_to_string(list_filter(w, lambda x, i: i = 1 or lower(x) <> lower(w[i - 1])), ' ') query, false truncated from (
select p.subject, p.object, m.mode, s.tier_id tier, cast(t.position as int) as position, string_split(concat_ws(' ', replace(replace(t.template, '{{subject}}', p.subject), '{{object}}', p.object), case when s.priority <= 2 then concat_ws(' ', p.sn[1], p.os[1]) end, lower(s.tier_id)), ' ') w
from p, (select mode from modes where is_default) m join t using (mode), source_tiers s where t.position <= 3)""")
def relationship_plan(spark, d):
    """A query of every pair of crops, mode, template and tier."""
    c = table(spark, d, "crops")
    pairs = c.select(F.col("crop_id").alias("subject"), F.col("scientific_names").alias("subject_names")).crossJoin(F.broadcast(c.select(F.col("crop_id").alias("object"), F.col("scientific_names").alias("object_names")))).where("subject < object")
    tiers = table(spark, d, "source_tiers").select(F.col("tier_id").alias("tier"), F.array(F.lower("tier_id")).alias("query_terms"), (F.col("priority") <= 2).alias("scholarly"))
    return V.plan(pairs, V.select_modes(_modes(spark)), _templates(spark), tiers)


@query("select 'rotation|' || 'family:' || a.crop_group || '|' || 'family:' || b.crop_group as key, count(*) n from crops a, crops b where a.crop_group <= b.crop_group group by 1")
def aggregate_keys(spark, d):
    c = table(spark, d, "crops")
    p = c.select(F.col("crop_group").alias("s")).crossJoin(F.broadcast(c.select(F.col("crop_group").alias("o")))).where("s <= o")
    return p.groupBy(V.aggregate_key(F.lit("rotation"), F.lit("family"), F.col("s"), F.lit("family"), F.col("o")).alias("key")).agg(F.count("*").alias("n"))


# ------------------------------------------------------------ candidates
LANE_SQL = """lane as (select ord, run_id, coalesce(entity_name, '') || '|' || coalesce(attribute, '') pair_key, coalesce(source_url, '') || '|' || coalesce(entity_name, '') || '|' || coalesce(attribute, '') relationship_source_key, source_url, source_domain, cast(null as varchar) doi, document_type, coalesce(source_tier_id, '') tier,
 case status when 'accepted' then 'backfill' else 'search' end provider, case lower(coalesce(confidence, '')) when 'high' then 9 when 'medium' then 5 else 2 end score, case document_type when 'html' then 'open_full_text' when 'pdf' then 'metadata_only' else 'unknown' end access_status from normalized_claims)"""
LANE_ST = "st as (select *, case when provider = 'backfill' and score < 4 then 'relevance_gate' when row_number() over (partition by relationship_source_key order by score desc, ord) > 1 then 'duplicate' else '' end discovery_drop_reason from lane)"


def lane(spark, d):
    n = table(spark, d, "normalized_claims")
    e = lambda c: F.coalesce(F.col(c), F.lit(""))
    conf = F.lower(e("confidence"))
    return n.select(
        "ord", "run_id", F.concat_ws("|", e("entity_name"), e("attribute")).alias("pair_key"), F.concat_ws("|", e("source_url"), e("entity_name"), e("attribute")).alias("relationship_source_key"), "source_url", "source_domain", F.lit(None).cast("string").alias("doi"), "document_type", e("source_tier_id").alias("tier"),
        F.when(F.col("status") == "accepted", "backfill").otherwise("search").alias("provider"), F.when(conf == "high", 9).when(conf == "medium", 5).otherwise(2).alias("score"),
        F.when(F.col("document_type") == "html", "open_full_text").when(F.col("document_type") == "pdf", "metadata_only").otherwise("unknown").alias("access_status"),
    )


def _stamped(spark, d):
    from claimloom.operators import ledger as L

    return L.stamp_drops(lane(spark, d), ("backfill",), key="relationship_source_key")


@query(f"with {LANE_SQL}, {LANE_ST} select ord, discovery_drop_reason from st")
def relationship_stamp(spark, d):
    return _stamped(spark, d).select("ord", "discovery_drop_reason")


@query(f"with {LANE_SQL} select ord, left(sha1('run'), 6) || printf('-rel-led-%06d', row_number() over (order by ord)) ledger_id from lane")
def relationship_ids(spark, d):
    from claimloom.operators import ledger as L

    return L.with_ids(lane(spark, d).select("ord"), "run", "rel-led").select("ord", "ledger_id")


@query(f"""with {LANE_SQL}, {LANE_ST}, a as (select *, case access_status when 'open_full_text' then 2 when 'metadata_only' then 1 else 0 end access_rank from st)
select relationship_source_key, arg_min(pair_key, ord) pair_key, arg_min(tier, ord) tier, max(score) score, max(access_rank) access_rank, count(*) filter (discovery_drop_reason = 'relevance_gate') = count(*) all_gated, min(ord) first_ord from a group by 1""")
def relationship_candidates(spark, d):
    return V.candidates(_stamped(spark, d)).select("relationship_source_key", "pair_key", "tier", "score", "access_rank", "all_gated", "first_ord")


@query(f"with {LANE_SQL}, {LANE_ST} select discovery_drop_reason, grouping(discovery_drop_reason) overall, count(*) as rows from st group by rollup (discovery_drop_reason)")
def relationship_discovery_summary(spark, d):
    return V.queue_summary(_stamped(spark, d), "discovery_drop_reason").select("discovery_drop_reason", F.col("overall").cast("bigint").alias("overall"), "rows")


@query()
def relationship_quota_select(spark, d):
    """Selection under the domain's and the pair's quota; order-dependent, tested against a plain loop."""
    n = _stamped(spark, d)
    c = V.candidates(n).join(n.groupBy("relationship_source_key").agg(F.min("run_id").alias("run_id")), "relationship_source_key")
    t = table(spark, d, "source_tiers").select(F.col("tier_id").alias("tier"), "trust")
    return V.pair_quota(c.join(F.broadcast(t), "tier", "left").withColumn("trust", F.coalesce("trust", F.lit(0.0))))


# ------------------------------------------------------------ evidence
EDGE_SQL = f"""crop as (select lower(trim(n, ' ')) nm, min(crop_id) crop, min(crop_group) grp from (select crop_id, crop_group, unnest(list_concat([label], coalesce(aliases, []), coalesce(scientific_names, []))) n from crops) group by 1),
ent as (select distinct source_url, crop, grp from cl join crop on lower(trim(cl.entity_name, ' ')) = crop.nm where source_url is not null),
ev as (select cl.claim_id, cl.ord, cl.status, cl.source_tier_id tier, a.crop subject, a.grp sg, b.crop object, b.grp og, case lower(coalesce(cl.confidence, '')) when 'high' then 'beneficial' when 'low' then 'avoid' when 'medium' then 'conditional' else 'unknown' end effect
 from cl join crop a on lower(trim(cl.entity_name, ' ')) = a.nm join (select crop_id crop, crop_group grp from crops) b on a.crop <> b.crop and cl.location_level = 'region' where cl.status in ('accepted', 'needs_review') and substr(b.crop, 1, 1) = substr(cl.source_domain, 1, 1))"""


def _edges(spark, d):
    """Claims as edges: the claim's crop and the crops whose name begins as its source's."""
    crops = table(spark, d, "crops")
    names = crops.select("crop_id", F.explode(F.concat(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>")), F.coalesce("scientific_names", F.array().cast("array<string>")))).alias("n"))
    names = F.broadcast(names.groupBy(F.lower(F.trim("n")).alias("nm")).agg(F.min("crop_id").alias("s")))
    c = claims(spark, d).where("location_level = 'region'").join(names, F.lower(F.trim("entity_name")) == F.col("nm"))
    other = F.broadcast(crops.select(F.col("crop_id").alias("o"), F.substring("crop_id", 1, 1).alias("letter")))
    e = c.withColumn("letter", F.substring("source_domain", 1, 1)).join(other, "letter").where("s <> o")
    conf = F.lower(F.coalesce("confidence", F.lit("")))
    effect = F.when(conf == "high", "beneficial").when(conf == "low", "avoid").when(conf == "medium", "conditional").otherwise("unknown")
    end = lambda x: V.endpoint(F.lit(None).cast("string"), F.lit(None).cast("string"), F.col(x))
    return e.select(F.concat_ws("|", "claim_id", "o").alias("claim_id"), "status", F.lit("rotation").alias("mode"), end("s").alias("subject"), end("o").alias("object"), effect.alias("effect"), F.coalesce("source_tier_id", F.lit("")).alias("tier"), "ord")


def _all_edges(spark, d):
    """Direct edges, and each as one of the groups of its ends."""
    e = _edges(spark, d)
    grp = F.broadcast(table(spark, d, "crops").select("crop_id", "crop_group"))
    g = e.join(grp.select(F.col("crop_id").alias("a"), F.col("crop_group").alias("ga")), F.col("subject.id") == F.col("a")).join(grp.select(F.col("crop_id").alias("b"), F.col("crop_group").alias("gb")), F.col("object.id") == F.col("b"))
    node = lambda c: F.struct(F.lit("botanical_family").alias("type"), F.col(c).alias("id"))
    agg = g.select(F.concat_ws("|", "claim_id", F.lit("group")).alias("claim_id"), "status", "mode", node("ga").alias("subject"), node("gb").alias("object"), "effect", "tier", "ord")
    return V.graph(e.unionByName(agg))


@query(f"with {CLAIM_SQL}, {EDGE_SQL} select 'direct' kind, subject, object, effect, count(*) n from ev group by all union all select 'aggregate', sg, og, effect, count(*) from ev group by all")
def evidence_graph(spark, d):
    return _all_edges(spark, d).groupBy("kind", "subject", "object", "effect").agg(F.count("*").alias("n"))


TIERED_SQL = """eff as (select kind, subject, object, case when dec is null then 'unknown' when pos and neg then dec_e when (pos or neg) and cond then 'conditional' when pos or neg then dec_e else any_e end effect from (
 select kind, subject, object, min(dec) dec, first(effect order by n desc, first, effect) filter (pol <> 'ignore' and rank = dec) any_e, first(effect order by n desc, first, effect) filter (pol in ('positive', 'negative') and rank = dec) dec_e,
 coalesce(bool_or(pol = 'positive' and rank = dec), false) pos, coalesce(bool_or(pol = 'negative' and rank = dec), false) neg, coalesce(bool_or(pol = 'conditional' and rank = dec), false) cond from (
  select *, min(rank) filter (pol <> 'ignore') over (partition by kind, subject, object) dec from (select kind, subject, object, rank, pol, effect, count(*) n, min(ord) first from (
   select e.*, coalesce(t.priority, 99) rank, case effect when 'beneficial' then 'positive' when 'avoid' then 'negative' when 'conditional' then 'conditional' else 'ignore' end pol from (select 'direct' kind, subject, object, effect, tier, ord from ev union all select 'aggregate', sg, og, effect, tier, ord from ev) e left join source_tiers t on e.tier = t.tier_id) group by all)) group by 1, 2, 3))"""


@query(f"""with {CLAIM_SQL}, {EDGE_SQL}, {TIERED_SQL} select a.crop_id subject, b.crop_id object, case when d.effect is not null then 'direct_evidence' when g.effect is not null then 'inferred_from_group' else 'no_evidence' end status, case when d.effect is null and g.effect is not null then 'botanical_family' else '' end inference_basis, coalesce(d.effect, g.effect, 'unknown') effect
from crops a join crops b on a.crop_id <> b.crop_id left join eff d on d.kind = 'direct' and d.subject = a.crop_id and d.object = b.crop_id left join eff g on g.kind = 'aggregate' and g.subject = a.crop_group and g.object = b.crop_group""")
def resolved_relationships(spark, d):
    """Every ordered pair of crops: direct evidence, else that of the families."""
    crops = table(spark, d, "crops")
    asked = crops.select(F.col("crop_id").alias("subject")).crossJoin(F.broadcast(crops.select(F.col("crop_id").alias("object")))).where("subject <> object").withColumn("mode", F.lit("rotation"))
    nodes = crops.select(F.col("crop_id").alias("node"), F.col("crop_group").alias("botanical_family"), F.lit("").alias("genus"), F.array().cast("array<string>").alias("functional_groups"))
    ranks = table(spark, d, "source_tiers").select(F.col("tier_id").alias("tier"), F.col("priority").alias("rank"))
    r = V.resolve(asked, _all_edges(spark, d), V.memberships(nodes), ranks)
    return r.select("subject", "object", "status", "inference_basis", "effect")


@query("select a.crop_id subject, b.crop_id object, 'rotation' mode from crops a, crops b where a.crop_id <> b.crop_id union all select a.crop_id, b.crop_id, 'intercrop' from crops a, crops b where a.crop_id < b.crop_id")
def directed_listing(spark, d):
    crops = table(spark, d, "crops").select("crop_id")
    p = crops.select(F.col("crop_id").alias("subject")).crossJoin(F.broadcast(crops.select(F.col("crop_id").alias("object")))).where("subject < object")
    modes = spark.createDataFrame([("rotation",), ("intercrop",)], "mode string")
    return V.both_directions(p.crossJoin(F.broadcast(modes)), ("rotation",)).select("subject", "object", "mode")


@query("""with a as (select distinct lower(trim(n, ' ')) alias from (select unnest(list_concat([crop_id, label], coalesce(aliases, []), coalesce(scientific_names, []))) n from crops)) select distinct lower(trim(entity_name, ' ')) alias from normalized_claims where entity_name is not null and lower(trim(entity_name, ' ')) not in (select alias from a)""")
def unknown_crops(spark, d):
    crops = table(spark, d, "crops")
    a = crops.select(F.explode(F.concat(F.array("crop_id", "label"), F.coalesce("aliases", F.array().cast("array<string>")), F.coalesce("scientific_names", F.array().cast("array<string>")))).alias("n")).select(F.lower(F.trim("n")).alias("alias")).distinct()
    return V.unknown_nodes(table(spark, d, "normalized_claims").where("entity_name is not null").select(F.col("entity_name").alias("name")), a)


# ------------------------------------------------------------ fetching
def _pages(spark, d):
    """The documents as an injected fetch adapter's answers: one page a URL."""
    doc = table(spark, d, "documents").where("canonical_url is not null")
    one = doc.groupBy(F.col("canonical_url").alias("url")).agg(F.min_by(F.struct("text", "content_type"), "doc_id").alias("p"))
    return one.select("url", "p.text", "p.content_type", F.lit(None).cast("string").alias("error"))


def _queue(spark, d):
    s = table(spark, d, "documents").where("canonical_url is not null")
    return s.select(F.col("doc_id").alias("ord"), F.col("canonical_url").alias("source_url"), "access_status", F.create_map(F.lit("p1"), F.lit("q one"), F.lit("p2"), F.lit("q two")).alias("parameters"))


P_SQL = "pg as (select canonical_url url, arg_min(struct_pack(t := text, c := content_type), doc_id) p from documents where canonical_url is not null group by 1)"
OK_SQL = "p.t is not null and not (length(trim(p.t, ' ')) < 200 or (length(trim(p.t, ' ')) < 1500 and regexp_matches(lower(trim(p.t, ' ')), 'checking your browser|enable javascript|captcha|recaptcha|just a moment|access denied|403 forbidden|cloudflare|request unsuccessful|are you a robot|verifying you are human')))"


@query(f"""with {P_SQL} select count(*) captures, count(distinct canonical_url) sources, count(*) filter (ok) parsed, count(distinct case when not ok then canonical_url end) metadata_only_sources from (
 select d.canonical_url, coalesce({OK_SQL}, false) and coalesce(d.access_status, '') <> 'metadata_only' ok from documents d join pg on d.canonical_url = pg.url, (values (1), (2)) v where d.canonical_url is not null)""")
def fetch_captures(spark, d):
    """Each URL once through the adapter, salvage, one capture a row and parameter, and the summary."""
    q = _queue(spark, d)
    pages = H.salvaged(H.fetched(H.urls_once(q), lambda urls: _pages(spark, d)))
    return H.fetch_summary(H.captures(q, pages, "run"))


@query("""select doc_id, case when regexp_matches(lower(coalesce(content_type, '')), 'pdf') or regexp_matches(lower(canonical_url), '\\.pdf($|[?#])') then 'pdf' else 'html' end document_type from documents where canonical_url is not null and not regexp_matches(ltrim(lower(left(coalesce(text, ''), 512))), '^<(!doctype|html)')""")
def salvage_types(spark, d):
    doc = table(spark, d, "documents").where("canonical_url is not null")
    p = doc.select("doc_id", F.col("canonical_url").alias("url"), "text", "content_type", F.lit(None).cast("string").alias("error"))
    return H.salvaged(p).where(~F.ltrim(F.lower(F.substring(F.coalesce("text", F.lit("")), 1, 512))).rlike("^<(?:!doctype|html)")).select("doc_id", "document_type")


@query("select canonical_url url, case when min(doc_id) % 2 = 0 then 'ok' else 'not_found' end status from documents where canonical_url is not null group by 1")
def fixture_fetch(spark, d):
    doc = table(spark, d, "documents").where("canonical_url is not null").groupBy(F.col("canonical_url").alias("url")).agg(F.min("doc_id").alias("i"))
    stored = doc.where("i % 2 = 0").select("url", F.lit("page").alias("text"))
    return H.fixture_fetch(doc, stored).select("url", "status")


DOI_SQL = "regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce(doi, ''))), '^(https?://)?(dx\\.)?doi\\.org/', ''), '^doi:\\s*', ''), '^/+|/+$', '', 'g')"


@query(f"""with x as (select doc_id, is_metadata_only, {DOI_SQL} d, canonical_url, text from documents), o as (select d, min(canonical_url) url from x where not is_metadata_only and d <> '' and canonical_url is not null group by 1), t as (select canonical_url url, arg_min(coalesce(text, ''), doc_id) t from x where canonical_url is not null group by 1)
select doc_id, case when x.d = '' then 'no_doi' when regexp_matches(x.d, '(^10\\.99999/|/xxxx$|/0000$|^pending$|^-$|^n/a$|^none$)') then 'junk_doi' when o.url is null then 'no_oa_full_text' when coalesce(t.t, '') = '' then 'fetch_failed' else 'full_text' end outcome from x left join o using (d) left join t on o.url = t.url where is_metadata_only""")
def repair_outcomes(spark, d):
    """Documents without full text, repaired from an open copy with the same DOI."""
    doc = table(spark, d, "documents")
    copies = doc.where("not is_metadata_only and canonical_url is not null").select("doi", F.col("canonical_url").alias("url"))
    texts = doc.where("canonical_url is not null").groupBy(F.col("canonical_url").alias("url")).agg(F.min_by(F.coalesce("text", F.lit("")), "doc_id").alias("text"))
    return H.repaired(doc.select("doc_id", "doi", "is_metadata_only", "text"), copies, texts).select("doc_id", "outcome")


@query("select crop_id, 'https://en.wikipedia.org/wiki/' || url_encode(replace(trim(label, ' '), ' ', '_')) url from crops")
def reference_urls(spark, d):
    return table(spark, d, "crops").select("crop_id", H.reference_url(F.col("label")).alias("url"))
