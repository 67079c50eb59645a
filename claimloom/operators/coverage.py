"""Coverage of parameters and tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counts(rows: DataFrame, stage: str) -> DataFrame:
    """Counts by parameter, by tier and by both in one pass (grouping sets); null marks 'all'."""
    g = rows.groupingSets([["parameter_id"], ["tier"], ["parameter_id", "tier"]], "parameter_id", "tier")
    return g.agg(F.count("*").alias("n"), F.grouping_id().alias("level")).withColumn("stage", F.lit(stage))


def parameter_tier_matrix(parameters: DataFrame, tiers: DataFrame, rows: DataFrame) -> DataFrame:
    """Every parameter with every tier, zero where nothing was found; parameters x tiers are two fixed tables."""
    grid = parameters.select("parameter_id").distinct().join(F.broadcast(tiers.select("tier").distinct()), how="cross")
    n = rows.groupBy("parameter_id", "tier").agg(F.count("*").alias("n"))
    return grid.join(n, ["parameter_id", "tier"], "left").select("parameter_id", "tier", F.coalesce("n", F.lit(0)).alias("n"))


def status(parameters: DataFrame, normalized: DataFrame, promoted: DataFrame, queried: DataFrame) -> DataFrame:
    """promoted, normalized, queried or missing for each parameter."""
    flag = lambda df, name: df.select("parameter_id").distinct().withColumn(name, F.lit(True))
    s = parameters.select("parameter_id").join(flag(normalized, "_n"), "parameter_id", "left").join(flag(promoted, "_p"), "parameter_id", "left").join(flag(queried, "_q"), "parameter_id", "left")
    return s.select("parameter_id", F.when(F.col("_p"), "promoted").when(F.col("_n"), "normalized").when(F.col("_q"), "queried").otherwise("missing").alias("status"))
