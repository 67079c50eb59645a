"""Capping records per dominant contributor with mergeable bounded heaps.

A contributor is (run, site, tier). Every map task folds its rows into one heap per contributor
that holds at most cap best (score, id) pairs; heaps are merged in a tree, first per contributor and
salt, then per contributor, so that what a task gathers is bounded by cap x salts pairs of a
contributor, whatever share of the rows it has. Full records are then semi- (or anti-) joined on
their unique id, which spreads a hot contributor over all tasks.

Defined results: null scores rank last, ties by the smaller id; null run_id is a run of its own; rows
without a site, and of a tier without a cap, are never capped; an unknown or blank tier is `unclassified`; a row delivered twice
(same id and contributor) takes one place; an empty table gives an empty table; clashing names of
extra columns do not matter, only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.hosts import site_of

SALTS = 16
CAPPED = "contributor is not null and cap is not null"  # all others stay and reach no heap
HEAP_SCHEMA = "contributor string, cap int, salt int, score double, doc_id bigint"


def spelled_tier(col):
    return F.lower(F.regexp_replace(F.coalesce(col, F.lit("")), r"[\s\-_]+", ""))


def cap_table(tiers: DataFrame) -> DataFrame:
    """tier spelling -> tier_id, domain_cap; a fixed table of a few rows."""
    by_id = tiers.select(spelled_tier(F.col("tier_id")).alias("_spell"), F.col("tier_id").alias("_tier"), F.col("domain_cap").alias("_cap"))
    by_label = tiers.select(spelled_tier(F.col("label")).alias("_spell"), F.col("tier_id").alias("_tier"), F.col("domain_cap").alias("_cap"))
    both = by_id.unionByName(by_label)
    return both.groupBy("_spell").agg(F.min("_tier").alias("_tier"), F.min("_cap").alias("_cap"))


def prepare_contributors(docs: DataFrame, tiers: DataFrame, other: str = "unclassified") -> DataFrame:
    """doc_id, pool (the run), contributor, cap, score; rows without a site have a null contributor, those of a tier without a cap a null cap."""
    caps = F.broadcast(cap_table(tiers))
    by_id = F.broadcast(tiers.groupBy(F.col("tier_id").alias("_id")).agg(F.min("domain_cap").alias("_idcap")))
    site = site_of(F.col("source_domain"))
    d = docs.withColumn("_s", spelled_tier(F.col("source_tier_id"))).join(caps, F.col("_s") == F.col("_spell"), "left")
    d = d.withColumn("_tier", F.coalesce("_tier", F.lit(other))).join(by_id, F.col("_tier") == F.col("_id"), "left")
    d = d.withColumn("cap", F.coalesce("_cap", "_idcap"))
    key = F.concat_ws("\x1f", F.coalesce("run_id", F.lit("\x00")), site, F.col("_tier"))
    return d.select("doc_id", F.coalesce("run_id", F.lit("\x00")).alias("pool"), F.when(site.isNotNull(), key).alias("contributor"), "cap", F.nanvl("quality_score", F.lit(None).cast("double")).alias("score"))


def with_share(contributors: DataFrame, share: float) -> DataFrame:
    """The cap of every contributor as a share of its pool's rows (at least one row), or its count cap where that is less.

    A heap's bound is then share x rows of the pool: meant for pools of bounded size, such as runs.
    """
    size = contributors.groupBy("pool").agg(F.count_distinct("doc_id").alias("_rows"))
    cap = F.greatest(F.lit(1), F.floor(F.col("_rows") * share)).cast("int")
    return contributors.join(size, "pool").withColumn("cap", F.least("cap", cap)).drop("_rows")


def _bounded_heaps(batches: Iterator[pa.RecordBatch], flush_rows: int = 400_000) -> Iterator[pa.RecordBatch]:
    """Keeps, of each contributor, the cap best pairs; the buffer is folded whenever it has doubled."""

    def fold(t: pa.Table) -> pa.Table:
        code = t.column("contributor").combine_chunks().dictionary_encode()
        code = code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code
        group = code.indices.to_numpy(zero_copy_only=False)
        score = np.nan_to_num(pc.fill_null(t.column("score"), float("-inf")).to_numpy(), nan=-np.inf)
        ids = t.column("doc_id").to_numpy()
        caps = t.column("cap").to_numpy()
        order = np.lexsort((ids, -score, group))
        g, i = group[order], ids[order]
        fresh = np.ones(len(g), bool)
        fresh[1:] = (g[1:] != g[:-1]) | (i[1:] != i[:-1])  # a pair delivered twice stands side by side
        order, g = order[fresh], g[fresh]
        first = np.ones(len(g), bool)
        first[1:] = g[1:] != g[:-1]
        start = np.maximum.accumulate(np.where(first, np.arange(len(g)), 0))
        return t.take(pa.array(order[np.arange(len(g)) - start < caps[order]]))

    held, rows, limit = [], 0, flush_rows
    for b in batches:
        if b.num_rows:
            held.append(b)
            rows += b.num_rows
        if rows >= limit:
            t = fold(pa.Table.from_batches(held))
            held, rows = t.to_batches(), t.num_rows
            limit = max(flush_rows, 2 * rows)
    if rows:
        yield from fold(pa.Table.from_batches(held)).to_batches(max_chunksize=100_000)


def kept_ids(contributors: DataFrame, salts: int = SALTS) -> DataFrame:
    """contributor, doc_id of the pairs left in the merged heaps."""
    salted = contributors.where(CAPPED).select("contributor", "cap", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"), "score", "doc_id")
    local = salted.mapInArrow(_bounded_heaps, HEAP_SCHEMA)  # map side
    half = local.repartition("contributor", "salt").mapInArrow(_bounded_heaps, HEAP_SCHEMA)
    whole = half.repartition("contributor").mapInArrow(_bounded_heaps, HEAP_SCHEMA)
    return whole.select("contributor", "doc_id")


def beyond_cap(contributors: DataFrame) -> DataFrame:
    """Rows with a contributor whose pair fell out of the heap; joined on the unique id."""
    kept = kept_ids(contributors).select(F.col("doc_id").alias("_kept")).distinct()
    return contributors.where(CAPPED).join(kept, F.col("doc_id") == F.col("_kept"), "left_anti").dropDuplicates(["doc_id"])
