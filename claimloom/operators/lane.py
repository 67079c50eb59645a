"""The relationship lane: plans over pairs, candidates, stamps, quotas, evidence graphs and their resolution."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.operators import ledger as L
from claimloom.operators import relations as R

BASES = ("botanical_family", "genus", "functional_group")
EVIDENCE = ("accepted", "needs_review")


# ------------------------------------------------------------ plans
def select_modes(modes: DataFrame, ids: list[str] | None = None, every: bool = False) -> DataFrame:
    """The modes asked for, in the order asked; all; or those marked as defaults. modes: mode, pos, is_default, directionality."""
    if ids:
        order = F.array_position(F.array(*[F.lit(i) for i in ids]), F.col("mode"))
        return modes.withColumn("pos", order.cast("int")).where("pos > 0")
    return modes if every else modes.where("is_default")


def pair_mode(modes: DataFrame, asked: str = "auto") -> str:
    """ordered or unordered: what is asked, else unordered where every mode is symmetric."""
    if asked not in ("auto", "ordered", "unordered"):
        raise ValueError("pair_mode must be auto, ordered or unordered")
    if asked != "auto":
        return asked
    return "unordered" if modes.agg(F.bool_and(F.col("directionality") == "symmetric")).first()[0] else "ordered"


def neutral_first(templates: DataFrame) -> DataFrame:
    """Templates of a mode in order, those without a direction before the others: mode, position (from 1), template. templates: mode, pos, template, directional."""
    from pyspark.sql import Window

    w = Window.partitionBy("mode").orderBy("directional", "pos")  # a vocabulary's templates: a few rows a mode
    return templates.select("mode", F.row_number().over(w).alias("position"), "template")


def rendered(template: Column, subject: Column, obj: Column, region: Column | None = None) -> Column:
    out = F.replace(F.replace(template, F.lit("{subject}"), subject), F.lit("{object}"), obj)
    return F.replace(out, F.lit("{region}"), region) if region is not None else out


def scientific_names(subject_names: Column, object_names: Column, same: Column) -> Column:
    """The first scientific name of each end, not twice for a pair of one with itself."""
    return F.array_compact(F.array(F.get(subject_names, F.lit(0)), F.when(~same, F.get(object_names, F.lit(0)))))


def query_text(*parts: Column) -> Column:
    """Parts as one query; a word said twice in a row stands once."""
    words = F.split(F.trim(F.regexp_replace(F.concat_ws(" ", *parts), r"\s+", " ")), " ")
    kept = F.filter(words, lambda w, i: (i == 0) | (F.lower(w) != F.lower(F.coalesce(F.get(words, i - 1), F.lit("")))))
    return F.array_join(kept, " ")


def plan(pairs: DataFrame, modes: DataFrame, templates: DataFrame, tiers: DataFrame, queries_per_pair: int = 3, terms_per_tier: int = 3, max_pairs: int | None = None, region: str = "global") -> DataFrame:
    """A query of every pair, mode, template and tier: subject, object, mode, tier, position, query, truncated.

    pairs: subject, object, subject_names, object_names; templates: mode, pos, template, directional; tiers: tier, query_terms, scholarly. All
    are fixed dimensions; their product is the plan. With max_pairs the first pairs in order of (subject, object) are planned, and truncated says that there were more.
    """
    if queries_per_pair < 1 or (max_pairs is not None and max_pairs < 1):
        raise ValueError("queries_per_pair and max_pairs must be at least 1")
    more = F.lit(False)
    if max_pairs is not None:
        more = F.lit(pairs.count() > max_pairs)
        pairs = pairs.orderBy("subject", "object").limit(max_pairs)
    few = neutral_first(templates).where(F.col("position") <= queries_per_pair)
    cells = pairs.crossJoin(F.broadcast(modes.select("mode").distinct())).join(F.broadcast(few), "mode").crossJoin(F.broadcast(tiers))
    sci = F.when(F.col("scholarly"), F.array_join(scientific_names(F.col("subject_names"), F.col("object_names"), F.col("subject") == F.col("object")), " "))
    place = F.lit(region) if region.lower() != "global" else F.lit(None).cast("string")
    query = query_text(rendered(F.col("template"), F.col("subject"), F.col("object")), sci, place, F.array_join(F.slice("query_terms", 1, terms_per_tier), " "))
    return cells.select("subject", "object", "mode", "tier", "position", query.alias("query"), more.alias("truncated"))


# ------------------------------------------------------------ candidates and quotas
def candidates(ledger: DataFrame) -> DataFrame:
    """One row a source and pair (relationship_source_key): first values, best score; the best access brings its URL; gated if all rows are. The tier stays that of the first row."""
    access = F.when(F.col("access_status") == "open_full_text", 2).when(F.col("access_status") == "metadata_only", 1).otherwise(0)
    late = -F.col("ord")
    first = [F.min_by(c, "ord").alias(c) for c in ("pair_key", "source_domain", "doi", "document_type", "tier")]
    g = ledger.withColumn("_access", access).groupBy("relationship_source_key")
    return g.agg(
        *first, F.max("score").alias("score"), F.max("_access").alias("access_rank"), F.max_by("access_status", F.struct("_access", late)).alias("access_status"),
        F.max_by("source_url", F.struct("_access", late)).alias("source_url"), F.bool_and(F.col("discovery_drop_reason") == "relevance_gate").alias("all_gated"), F.min("ord").alias("first_ord"),
    )


def pair_quota(cands: DataFrame, target: int = 4, domain_cap: int = 3, trusted: tuple[str, ...] = (), trusted_cap: int = 50, group: str = "run_id") -> DataFrame:
    """Greedy selection of one run: by trust, access and score; the domain's cap first, then the pair's target. Only selected rows use up quota. A run's candidates are bounded by its plan."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["trust", "access_rank", "score", "first_ord"], ascending=[False, False, False, True], kind="stable")
        domains: dict = {}
        pairs: dict = {}
        why = []
        for domain, pair in zip(pdf["source_domain"].fillna(""), pdf["pair_key"]):
            cap = trusted_cap if any(domain.endswith(t) for t in trusted) else domain_cap
            reason = "domain_cap" if domains.get(domain, 0) >= cap else "pair_mode_saturated" if pairs.get(pair, 0) >= target else ""
            if not reason:
                domains[domain] = domains.get(domain, 0) + 1
                pairs[pair] = pairs.get(pair, 0) + 1
            why.append(reason)
        return pdf.assign(fetch_selected=[not w for w in why], fetch_skip_reason=why)[[group, "relationship_source_key", "fetch_selected", "fetch_skip_reason"]]

    return cands.groupBy(group).applyInPandas(fold, f"`{group}` string, relationship_source_key string, fetch_selected boolean, fetch_skip_reason string")


def queue_summary(queue: DataFrame, reason: str = "fetch_skip_reason") -> DataFrame:
    """Rows by skip reason ('' is selected), with totals."""
    return queue.rollup(reason).agg(F.count("*").alias("rows"), F.grouping(reason).alias("overall"))


def stamp(ledger: DataFrame) -> DataFrame:
    return L.stamp_drops(ledger, key="relationship_source_key")


# ------------------------------------------------------------ evidence graph
def endpoint(kind: Column, node: Column, crop: Column) -> Column:
    """(type, id) of a claim's end: its node, else its crop, else null."""
    pair = lambda a, b: F.struct(a.alias("type"), b.alias("id"))
    return F.when((F.coalesce(kind, F.lit("")) != "") & (F.coalesce(node, F.lit("")) != ""), pair(kind, node)).when(F.coalesce(crop, F.lit("")) != "", pair(F.lit("crop"), crop))


def graph(claims: DataFrame, statuses: tuple[str, ...] = EVIDENCE, bases: tuple[str, ...] = BASES) -> DataFrame:
    """Edges kind (direct, aggregate, host), mode, subject, object, ord, effect, tier of evidence-bearing claims; an id counts once (the first), claims without an end are left out.

    claims: claim_id, status, mode, subject (type, id), object (type, id), effect, tier, ord.
    """
    c = claims.where(F.col("status").isin(*statuses) & F.col("subject").isNotNull() & F.col("object").isNotNull())
    named = c.where("claim_id is not null").groupBy("claim_id").agg(F.min_by(F.struct(*[x for x in c.columns if x != "claim_id"]), "ord").alias("_r")).select("claim_id", "_r.*")
    c = named.unionByName(c.where("claim_id is null"))
    s, o = F.col("subject.type"), F.col("object.type")
    kind = F.when(s == "host_group", "host").when((s == "crop") & (o == "crop"), "direct").when(s.isin(*bases) & o.isin(*bases), "aggregate")
    return c.select(kind.alias("kind"), "mode", F.col("subject.id").alias("subject"), F.col("object.id").alias("object"), "effect", "tier", "ord").where("kind is not null")


def memberships(nodes: DataFrame) -> DataFrame:
    """node, base_pos, group_pos, group: family, then genus, then functional groups in order. nodes: node, botanical_family, genus, functional_groups."""
    one = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.array(c)).otherwise(F.array().cast("array<string>"))
    lists = F.array(one("botanical_family"), one("genus"), F.coalesce("functional_groups", F.array().cast("array<string>")))
    return nodes.select("node", F.posexplode(lists).alias("base_pos", "_g")).select("node", "base_pos", F.posexplode("_g").alias("group_pos", "group"))


def resolve(asked: DataFrame, edges: DataFrame, members: DataFrame, ranks: DataFrame, symmetric: tuple[str, ...] = ()) -> DataFrame:
    """Of each asked (mode, subject, object): the tiered effect of its direct claims, else of the first pair of groups with claims (family, genus, functional groups in order).

    Ends of symmetric modes are sorted on both sides. Equi-joins throughout; the first group pair is a mergeable min_by.
    """
    def sort(df: DataFrame, a: str, b: str) -> DataFrame:
        swap = F.col("mode").isin(*symmetric) & (F.col(a) > F.col(b)) if symmetric else F.lit(False)
        return df.withColumn("_a", F.when(swap, F.col(b)).otherwise(F.col(a))).withColumn("_b", F.when(swap, F.col(a)).otherwise(F.col(b)))

    key = lambda kind: F.concat_ws("|", F.lit(kind), "mode", "_a", "_b")
    e = sort(edges.where("kind in ('direct', 'aggregate')"), "subject", "object")
    effects = R.tiered_effect(e.select(F.concat_ws("|", "kind", "mode", "_a", "_b").alias("key"), "tier", "effect", "ord"), ranks)
    q = sort(asked.select("mode", "subject", "object"), "subject", "object").withColumn("key", key("direct")).drop("_a", "_b")
    direct = q.join(effects.select("key", F.struct("effect", "ambiguous", "superseded", "deciding_rank").alias("d")), "key", "left").drop("key")
    m = members.select("node", "base_pos", "group_pos", "group")
    via = asked.select("mode", "subject", "object").join(m.select(F.col("node").alias("subject"), "base_pos", F.col("group_pos").alias("sp"), F.col("group").alias("sg")), "subject").join(m.select(F.col("node").alias("object"), "base_pos", F.col("group_pos").alias("op"), F.col("group").alias("og")), ["object", "base_pos"])
    via = sort(via, "sg", "og").withColumn("key", key("aggregate")).join(effects.select("key", F.struct("effect", "ambiguous", "superseded", "deciding_rank").alias("g")), "key")
    first = via.groupBy("mode", "subject", "object").agg(F.min_by("g", F.struct("base_pos", "sp", "op")).alias("g"), F.min("base_pos").alias("base_pos"))
    r = direct.join(first, ["mode", "subject", "object"], "left")
    best = F.coalesce("d", "g")
    status = F.when(F.col("d").isNotNull(), "direct_evidence").when(F.col("g").isNotNull(), "inferred_from_group").otherwise("no_evidence")
    basis = F.when(F.col("d").isNull() & F.col("g").isNotNull(), F.get(F.array(*[F.lit(b) for b in BASES]), F.col("base_pos"))).otherwise("")
    flags = F.array_compact(F.array(F.when(best["ambiguous"], "conflicting_evidence"), F.when(best["superseded"], "superseded_evidence")))
    return r.select("mode", "subject", "object", status.alias("status"), basis.alias("inference_basis"), F.coalesce(best["effect"], F.lit("unknown")).alias("effect"), F.array_join(F.coalesce(flags, F.array().cast("array<string>")), ",").alias("flags"))


def both_directions(pairs: DataFrame, directional: tuple[str, ...]) -> DataFrame:
    """(mode, subject, object) of every pair, and reversed for modes with a direction."""
    back = pairs.where(F.col("mode").isin(*directional)).select("mode", F.col("object").alias("subject"), F.col("subject").alias("object"))
    return pairs.select("mode", "subject", "object").unionByName(back).distinct()


def aggregate_key(mode: Column, subject_type: Column, subject: Column, object_type: Column, obj: Column) -> Column:
    return F.concat_ws("|", mode, F.concat_ws(":", subject_type, subject), F.concat_ws(":", object_type, obj))


def unknown_nodes(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """Names that are no alias of the catalog."""
    return names.select(F.lower(F.trim("name")).alias("alias")).distinct().join(aliases.select("alias"), "alias", "left_anti")
