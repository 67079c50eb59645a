"""Claims: conflicts, merges, clusters, scorecards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from claimloom.functions.values import SLACK

CONFLICT_KEY = ["entity_name", "attribute_subtype", "location_level", "location_name", "time_label", "cultivar", "management_system"]


def latest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row a key, the greatest in `order`: an upsert's last row. A mergeable aggregate over whole rows."""
    cols = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_r"))
    return picked.select(*key, *[F.col(f"_r.`{c}`").alias(c) for c in cols])


def conflict_groups(claims: DataFrame, key: list[str] = CONFLICT_KEY, source: str = "source_domain") -> DataFrame:
    """Per key: members, sources and whether some two intervals of lo..hi disagree.

    'Some pair disagrees' is max(lo) > min(hi) + slack: no self-join, one aggregate.
    """
    g = claims.groupBy(*key).agg(F.count("*").alias("members"), F.count_distinct(source).alias("sources"), F.max("lo").alias("max_lo"), F.min("hi").alias("min_hi"))
    return g.withColumn("conflict", (F.col("sources") > 1) & (F.col("max_lo") > F.col("min_hi") + SLACK))


def merge_intervals(claims: DataFrame, key: list[str]) -> DataFrame:
    """Greedy merge: in order of arrival each interval joins the first compatible one, which widens; else it opens its own.

    A fold over the group's sorted (ord, lo, hi), in the JVM. It is sequential by definition: an equal interval that comes later may join
    an earlier one that has widened since. A group is what was claimed of one entity, parameter, place and time; 24 bytes a claim are gathered.
    """
    rows = F.array_sort(F.collect_list(F.struct("ord", "lo", "hi")))
    empty = F.array().cast("array<struct<lo:double,hi:double,n:int>>")

    def step(acc: Column, v: Column) -> Column:
        fits = F.transform(acc, lambda x: F.greatest(x["lo"], v["lo"]) <= F.least(x["hi"], v["hi"]) + SLACK)
        at = F.array_position(fits, F.lit(True))
        opened = F.concat(acc, F.array(F.struct(v["lo"].alias("lo"), v["hi"].alias("hi"), F.lit(1).alias("n"))))
        widened = F.transform(acc, lambda x, i: F.when(i == at - 1, F.struct(F.least(x["lo"], v["lo"]).alias("lo"), F.greatest(x["hi"], v["hi"]).alias("hi"), (x["n"] + 1).alias("n"))).otherwise(x))
        return F.when(at > 0, widened).otherwise(opened)

    g = claims.groupBy(*key).agg(rows.alias("_rows"))
    merged = g.select(*key, F.posexplode(F.aggregate("_rows", empty, step)).alias("position", "m"))
    return merged.select(*key, "position", F.col("m.lo").alias("lo"), F.col("m.hi").alias("hi"), F.col("m.n").alias("members"))


def clusters(signed: DataFrame, key: list[str]) -> DataFrame:
    """Claims of one key and signature: sorted ids, distinct sources, what to do, numbered in key order."""
    g = signed.groupBy(*key).agg(F.array_sort(F.collect_set("claim_id")).alias("claim_ids"), F.array_sort(F.collect_set("source_domain")).alias("domains"), F.max(F.col("conflict_status") == "potential").alias("in_conflict"))
    action = F.when(F.col("in_conflict"), "review_conflict").when(F.size("domains") > 1, "merge_sources").otherwise("keep_single")
    return g.withColumn("action", action).withColumn("members", F.size("claim_ids"))


def top_values(df: DataFrame, key: list[str], value: str, k: int = 5, order: str = "ord") -> DataFrame:
    """The k most frequent values of each key, ties to the first seen."""
    n = df.where(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    w = Window.partitionBy(*key).orderBy(F.col("n").desc(), "_first")
    return n.withColumn("position", F.row_number().over(w)).where(F.col("position") <= k).drop("_first")


def first_values(df: DataFrame, key: list[str], value: str, k: int) -> DataFrame:
    """_s: the k smallest distinct values of each key, in order. Distinct first, then ranked within hash buckets, then within the key: no task sees more of a key than k values a bucket."""
    d = df.where(F.col(value).isNotNull()).select(*key, value).distinct().withColumn("_b", F.pmod(F.xxhash64(value), F.lit(256)))
    part = d.withColumn("_r", F.row_number().over(Window.partitionBy(*key, "_b").orderBy(value))).where(F.col("_r") <= k)
    return part.groupBy(*key).agg(F.slice(F.array_sort(F.collect_list(value)), 1, k).alias("_s"))


def value_summary(claims: DataFrame, key: list[str], k: int = 4) -> DataFrame:
    """Per key: least and greatest value, modal unit (ties to the smaller), count and the first k distinct values as text."""
    g = claims.groupBy(*key).agg(F.count("*").alias("claims"), F.min("lo").alias("least"), F.max("hi").alias("greatest"))
    for other in (first_values(claims, key, "raw_value_text", k), top_units(claims, key)):
        other = other.withColumnsRenamed({c: f"_{c}" for c in key})
        cond = F.lit(True)
        for c in key:
            cond &= F.col(c).eqNullSafe(F.col(f"_{c}"))
        g = g.join(other, cond, "left").drop(*[f"_{c}" for c in key])
    return g.select(*key, "claims", "least", "greatest", F.array_join(F.coalesce("_s", F.array().cast("array<string>")), "; ").alias("samples"), "unit")


def top_units(claims: DataFrame, key: list[str]) -> DataFrame:
    n = claims.where(F.col("unit").isNotNull()).groupBy(*key, "unit").agg(F.count("*").alias("_n"))
    return n.groupBy(*key).agg(F.min_by("unit", F.struct((-F.col("_n")).alias("a"), F.col("unit").alias("b"))).alias("unit"))


def flag_outliers(claims: DataFrame, bounds: DataFrame, key: str = "parameter_id") -> DataFrame:
    """outlier: some value of a claim is larger in size than its key's bound (bounds: key, bound; a fixed table). Flags only, drops nothing."""
    largest = F.greatest(F.abs("numeric_value"), F.abs("range_min"), F.abs("range_max"))
    j = claims.join(F.broadcast(bounds.select(F.col(key), F.col("bound").alias("_bound"))), key, "left")
    return j.withColumn("outlier", F.coalesce(largest > F.col("_bound"), F.lit(False))).drop("_bound")
