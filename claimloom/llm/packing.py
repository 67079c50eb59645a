"""Filling fixed-capacity containers with whole documents at balanced attention cost.

The cost of a document of n tokens is linear x n + quadratic x n^2 / capacity. Documents are hashed
over shards of about SHARD_BINS containers each (their number follows the total of tokens, so a
task's work is bounded at any size); within a shard, by falling size, each goes to the container of
the lowest cost that still has room, a new one is opened only where none has. The number of containers
a shard starts with is the least it can do with. A document longer than a container is cut into full
containers and a remainder that is packed like a document.

Defined results: a document without tokens (null or empty text) is placed with size 0; repeated ids
are separate items; an empty table gives an empty table; ties go to the smaller id and the
container opened first, so the result depends on neither the number of tasks nor their order.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.session import checkpoint

CAPACITY, SHARD_BINS, LINEAR, QUADRATIC = 2048, 1024, 1.0, 1.0
SHARD_ROWS = 200_000


def pack(ids: np.ndarray, sizes: np.ndarray, capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC, pieces: np.ndarray | None = None) -> np.ndarray:
    """Container of each item (sizes at most capacity), numbered from 0; equal sizes in order of (id, piece)."""
    order = np.lexsort((pieces, ids, -sizes)) if pieces is not None else np.lexsort((ids, -sizes))
    total = int(sizes.sum())
    bins = max(1, math.ceil(total / capacity), int((sizes * 2 > capacity).sum()))
    room = np.full(bins, capacity, np.int64)
    cost = np.zeros(bins)
    out = np.zeros(len(ids), np.int64)
    for k in order:
        n = int(sizes[k])
        best = int(np.where(room >= n, cost, np.inf).argmin())
        if room[best] < n:  # none has room
            room, cost = np.append(room, capacity), np.append(cost, 0.0)
            best = len(room) - 1
        room[best] -= n
        cost[best] += linear * n + quadratic * n * n / capacity
        out[k] = best
    return out


def pack_documents(counts: DataFrame, capacity: int = CAPACITY, shard_bins: int = SHARD_BINS) -> DataFrame:
    """counts: doc_id, n_tokens -> doc_id, piece (from 0), first_token, n_tokens, shard, container (within all)."""
    counts = checkpoint(counts)  # two small columns; else the texts would be tokenised twice
    total, rows = counts.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.count("*")).first()
    shards = max(1, math.ceil(total / (capacity * shard_bins)), math.ceil(rows / SHARD_ROWS))
    full = (F.col("n_tokens") / capacity).cast("bigint")
    rest = F.col("n_tokens") % capacity
    pieces = full + F.when((rest > 0) | (F.col("n_tokens") == 0), 1).otherwise(0)
    items = counts.select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1)).alias("piece"))
    items = items.select("doc_id", F.col("piece").cast("int").alias("piece"), (F.col("piece") * capacity).alias("first_token"), F.least(F.lit(capacity).cast("bigint"), F.col("n_tokens") - F.col("piece") * capacity).alias("n_tokens"), F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)).cast("int").alias("shard"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece"], kind="stable")
        pdf["container"] = pack(pdf["doc_id"].to_numpy(), pdf["n_tokens"].to_numpy(), capacity, pieces=pdf["piece"].to_numpy()) * shards + pdf["shard"].to_numpy()
        return pdf

    return items.groupBy("shard").applyInPandas(run, "doc_id bigint, piece int, first_token bigint, n_tokens bigint, shard int, container bigint").drop("shard")
