"""Query planning: selections, products, query strings, seeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from claimloom.functions.text import drop_repeated_words


def select_parameters(parameters: DataFrame, ids: list[str] | None = None, families: list[str] | None = None, crop_group: str | None = None, limit: int | None = None) -> DataFrame:
    """Parameters by id, family and crop group (none given: all), the first `limit` in listed order (pos)."""
    p = parameters
    if ids:
        p = p.where(F.col("parameter_id").isin(*ids))
    if families:
        p = p.where(F.col("family").isin(*families))
    if crop_group:
        p = p.where(F.coalesce(F.size("applies_to") <= 0, F.lit(True)) | F.array_contains("applies_to", crop_group))
    return p.orderBy("pos").limit(limit) if limit else p


def in_given_order(dim: DataFrame, key: str, wanted: list[str]) -> DataFrame:
    """Rows of a small dimension in the order asked for; an unknown key raises when the plan runs."""
    order = dim.sparkSession.createDataFrame(list(enumerate(wanted)), "_pos int, _key string")
    j = order.join(dim, F.col("_key") == F.col(key), "left")
    checked = F.when(F.col(key).isNull(), F.raise_error(F.concat(F.lit(f"unknown {key}: "), F.col("_key")))).otherwise(F.col(key))
    return j.withColumn(key, checked).orderBy("_pos").drop("_pos", "_key")


def plan(parameters: DataFrame, patterns: list[str], tiers: DataFrame, extra: Column | None = None) -> DataFrame:
    """parameter x pattern x tier, in that order, with the query string; plan_pos numbers the rows.

    All three are fixed dimensions; patterns hold {label} and {tier}.
    """
    pats = F.posexplode(F.array(*[F.lit(p) for p in patterns])).alias("pattern_pos", "pattern")
    p = parameters.select("parameter_id", "label", "pos", pats).join(F.broadcast(tiers.select(F.col("tier_id").alias("tier"), F.col("label").alias("tier_label"), F.col("priority"))), how="cross")
    q = F.replace(F.replace("pattern", F.lit("{label}"), F.col("label")), F.lit("{tier}"), F.col("tier_label"))
    q = drop_repeated_words(F.concat_ws(" ", q, extra) if extra is not None else q)
    w = Window.orderBy("pos", "pattern_pos", "priority")  # a plan has some thousand rows
    return p.select("parameter_id", "tier", "pattern_pos", q.alias("query"), F.row_number().over(w).alias("plan_pos"))


def seeds_for(queries: DataFrame, seeds: DataFrame, k: int = 3) -> DataFrame:
    """The k best seeds of each query: by parameter id, then by family, then general; each URL once.

    queries (parameters x tiers) is a fixed dimension and is broadcast; the seed list may be long.
    """
    rank = F.when(F.array_contains("parameter_ids", F.col("parameter_id")), 0).when(F.array_contains("families", F.col("family")), 1).when((F.size("parameter_ids") <= 0) & (F.size("families") <= 0), 2)
    j = seeds.join(F.broadcast(queries), "tier").withColumn("seed_rank", rank).where("seed_rank is not null")
    j = j.groupBy("query_id", "source_url").agg(F.min("seed_rank").alias("seed_rank"))
    w = Window.partitionBy("query_id").orderBy("seed_rank", "source_url")
    return j.withColumn("position", F.row_number().over(w)).where(F.col("position") <= k)


def unknown_references(seeds: DataFrame, parameters: DataFrame) -> DataFrame:
    """(source_url, parameter_id) of seeds that name a parameter the manifest lacks."""
    return seeds.select("source_url", F.explode("parameter_ids").alias("parameter_id")).join(parameters.select("parameter_id").distinct(), "parameter_id", "left_anti").select("source_url", "parameter_id")


def without_back_matter(text: Column) -> Column:
    """The text without what stands between a 'References' line and the next 'Chapter' heading or the end; one linear pattern."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?ims)^[ \t]*(?:references|bibliography|literature cited)[ \t]*$.*?(?=^[ \t]*chapter |\z)", "")


def provider_routes(tiers: DataFrame, routes: list[tuple[int, tuple[str, ...]]], otherwise: tuple[str, ...]) -> DataFrame:
    """tier, provider: the providers of the first route whose greatest priority holds the tier's. tiers: tier, priority."""
    names = lambda some: F.array(*[F.lit(x) for x in some])
    out = F.when(F.lit(False), names(otherwise))
    for most, some in routes:
        out = out.when(F.col("priority") <= most, names(some))
    return tiers.select("tier", F.explode(out.otherwise(names(otherwise))).alias("provider"))
