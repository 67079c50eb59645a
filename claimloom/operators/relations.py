"""Pairwise relationships: keys, tier-weighted effects, edges, resolution, matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from claimloom.functions.keys import pair_key

#: effect -> class (fixed values).
POLARITY = {"beneficial": "positive", "compatible": "positive", "incompatible": "negative", "avoid": "negative", "conditional": "conditional", "neutral": "neutral", "unknown": "ignore"}


def ordered_pairs(nodes: DataFrame, self_pairs: bool = False) -> DataFrame:
    """All (subject, object) of a node catalog (a fixed dimension of at most a few hundred rows)."""
    s, o = nodes.select(F.col("node").alias("subject")), nodes.select(F.col("node").alias("object"))
    p = s.join(F.broadcast(o), how="cross")
    return p if self_pairs else p.where("subject <> object")


def unordered_pairs(nodes: DataFrame) -> DataFrame:
    return ordered_pairs(nodes, True).where("subject <= object")


def symmetric_ends(claims: DataFrame, symmetric_modes: tuple[str, ...]) -> DataFrame:
    """Ends of symmetric relations sorted, with the canonical key."""
    swap = F.col("mode").isin(*symmetric_modes) & (F.col("subject") > F.col("object"))
    s, o = F.when(swap, F.col("object")).otherwise(F.col("subject")), F.when(swap, F.col("subject")).otherwise(F.col("object"))
    return claims.select(*[c for c in claims.columns if c not in ("subject", "object")], s.alias("subject"), o.alias("object")).withColumn("key", pair_key(F.col("mode"), F.col("subject"), F.col("object"), F.col("mode").isin(*symmetric_modes)))


def tiered_effect(claims: DataFrame, ranks: DataFrame) -> DataFrame:
    """The effect of each key as its best tier with a usable effect sees it.

    claims: key, tier, effect, ord; ranks: tier, rank (lower is better; unknown tiers come last). The
    deciding tier is the best with an effect that isn't ignored. Within it: both signs -> the most
    frequent decisive effect, ambiguous; a sign and a condition -> conditional, ambiguous; else the most
    frequent (ties to the first, then by name). superseded: a worse tier says the opposite.
    """
    pol = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in POLARITY.items() for x in kv]), F.col("effect")), F.lit("ignore"))
    worst = F.lit(99)
    c = claims.join(F.broadcast(ranks), "tier", "left").withColumn("rank", F.coalesce("rank", worst)).withColumn("polarity", pol)
    n = c.groupBy("key", "rank", "polarity", "effect").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    usable = F.col("polarity") != "ignore"
    w = Window.partitionBy("key")
    n = n.withColumn("decider", F.min(F.when(usable, F.col("rank"))).over(w))
    at = usable & (F.col("rank") == F.col("decider"))
    decisive = F.col("polarity").isin("positive", "negative")
    order = F.struct((-F.col("n")).alias("n"), "first", "effect")
    g = n.groupBy("key").agg(
        F.min("decider").alias("decider"), F.sum("n").alias("claims"),
        F.min_by("effect", F.when(at, order)).alias("any_effect"),
        F.min_by("effect", F.when(at & decisive, order)).alias("decisive_effect"),
        F.max(at & (F.col("polarity") == "positive")).alias("pos"), F.max(at & (F.col("polarity") == "negative")).alias("neg"), F.max(at & (F.col("polarity") == "conditional")).alias("cond"),
        F.max(usable & (F.col("rank") > F.col("decider")) & (F.col("polarity") == "positive")).alias("low_pos"), F.max(usable & (F.col("rank") > F.col("decider")) & (F.col("polarity") == "negative")).alias("low_neg"),
    )
    both, some = F.col("pos") & F.col("neg"), F.col("pos") | F.col("neg")
    effect = F.when(F.col("decider").isNull(), "unknown").when(both, F.col("decisive_effect")).when(some & F.col("cond"), "conditional").when(some, F.col("decisive_effect")).otherwise(F.col("any_effect"))
    opposite = (F.col("pos") & ~F.col("neg") & F.coalesce("low_neg", F.lit(False))) | (F.col("neg") & ~F.col("pos") & F.coalesce("low_pos", F.lit(False)))
    return g.select("key", "claims", F.col("decider").alias("deciding_rank"), effect.alias("effect"), F.coalesce(both | (some & F.col("cond")), F.lit(False)).alias("ambiguous"), F.coalesce(opposite, F.lit(False)).alias("superseded"))


def resolve(queries: DataFrame, direct: DataFrame, membership: DataFrame, group_edges: DataFrame) -> DataFrame:
    """Effect of each queried (subject, object): the direct edge, else that of the first base of groups with an edge.

    membership: node, base_pos, group; group_edges: base_pos, subject_group, object_group, effect, pos.
    All equi-joins; the first match is a mergeable min_by.
    """
    d = direct.select("subject", "object", F.col("effect").alias("direct_effect"))
    s = membership.select(F.col("node").alias("subject"), "base_pos", F.col("group").alias("subject_group"))
    o = membership.select(F.col("node").alias("object"), "base_pos", F.col("group").alias("object_group"))
    via = queries.join(s, "subject").join(o, ["object", "base_pos"]).join(group_edges, ["base_pos", "subject_group", "object_group"])
    first = via.groupBy("subject", "object").agg(F.min_by("effect", F.struct("base_pos", "pos")).alias("inferred_effect"), F.min("base_pos").alias("base_pos"))
    r = queries.join(d, ["subject", "object"], "left").join(first, ["subject", "object"], "left")
    how = F.when(F.col("direct_effect").isNotNull(), "direct").when(F.col("inferred_effect").isNotNull(), "inferred").otherwise("none")
    return r.select("subject", "object", how.alias("resolution"), F.coalesce("direct_effect", "inferred_effect", F.lit("unknown")).alias("effect"))


def matrix(pairs: DataFrame, modes: DataFrame, claims: DataFrame, searched: DataFrame) -> DataFrame:
    """Long form: every pair and mode with its claims, or searched_no_evidence / not_searched."""
    cells = pairs.join(F.broadcast(modes), how="cross")
    n = claims.groupBy("mode", "subject", "object").agg(F.count("*").alias("n"))
    seen = searched.select("subject", "object").distinct().withColumn("_seen", F.lit(True))
    c = cells.join(n, ["mode", "subject", "object"], "left").join(seen, ["subject", "object"], "left")
    state = F.when(F.col("n").isNotNull(), "evidence").when(F.col("_seen"), "searched_no_evidence").otherwise("not_searched")
    return c.select("mode", "subject", "object", F.coalesce("n", F.lit(0)).alias("claims"), state.alias("status"))


def alias_index(catalog: DataFrame) -> DataFrame:
    """alias (lower case) -> node_id: ids, labels and aliases; crops win over groups, then the first listed."""
    names = catalog.select("node_id", "is_crop", "pos", F.explode(F.array_distinct(F.transform(F.concat(F.array("node_id", "label"), "aliases"), lambda x: F.lower(F.trim(x))))).alias("alias"))
    return names.groupBy("alias").agg(F.min_by("node_id", F.struct((~F.col("is_crop")).alias("a"), F.col("pos").alias("b"))).alias("node_id"))


def best_direction(resolved: DataFrame, grades: dict[str, int]) -> DataFrame:
    """Of each unordered pair the direction with the better grade; ties go forward (the sorted order)."""
    grade = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in grades.items() for x in kv]), F.col("resolution")), F.lit(0))
    forward = F.col("subject") <= F.col("object")
    r = resolved.withColumn("a", F.least("subject", "object")).withColumn("b", F.greatest("subject", "object")).withColumn("grade", grade).withColumn("forward", forward)
    best = F.max_by(F.struct("forward", "resolution", "effect", "grade"), F.struct("grade", F.col("forward").cast("int").alias("f")))
    return r.groupBy("a", "b").agg(best.alias("m")).select("a", "b", "m.forward", "m.resolution", "m.effect", "m.grade")


def host_overlay(pairs: DataFrame, hosts: DataFrame, caveats: DataFrame) -> DataFrame:
    """Caveats of the host groups both ends share: hosts (node, host_group), caveats (host_group, factor, effect)."""
    s = hosts.select(F.col("node").alias("subject"), "host_group")
    o = hosts.select(F.col("node").alias("object"), "host_group")
    return pairs.join(s, "subject").join(o, ["object", "host_group"]).join(caveats, "host_group").select("subject", "object", "host_group", "factor", "effect")


def coverage_report(resolved: DataFrame) -> DataFrame:
    """Pairs by resolution and effect, with totals (rollup)."""
    return resolved.rollup("resolution", "effect").agg(F.count("*").alias("pairs"), F.grouping_id().alias("level"))


def matrix_scores(gold: DataFrame, cells: DataFrame) -> DataFrame:
    """Gold (subject, object, mode, effect) against matrix cells: found and agreeing, one row."""
    j = gold.join(cells.select("subject", "object", "mode", F.col("effect").alias("_e")), ["subject", "object", "mode"], "left")
    return j.agg(F.count("*").alias("gold"), F.count_if(F.col("_e").isNotNull()).alias("found"), F.count_if(F.col("_e") == F.col("effect")).alias("agree"))
