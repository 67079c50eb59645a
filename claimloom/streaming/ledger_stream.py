"""Streaming extension: a discovery ledger that arrives continuously.

The batch pipeline has no stream of its own; these are the stamping and summary steps as Structured
Streaming plans, with watermarks that bound the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_ledger(spark: SparkSession, path: str, schema: str, max_files: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def first_of_key(stream: DataFrame, key: list[str], at: str = "at", late: str = "1 hour") -> DataFrame:
    """Each key once while the watermark holds it: state grows with the keys of `late`, not with history."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, keys: list[str], at: str = "at", width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Rows and best score by window and key; late rows beyond the watermark are dropped by definition."""
    g = stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), *keys)
    return g.agg(F.count("*").alias("n"), F.max("score").alias("best")).select(F.col("w.start").alias("window_start"), *keys, "n", "best")


def sessions(stream: DataFrame, key: str, at: str = "at", gap: str = "5 minutes", late: str = "30 minutes") -> DataFrame:
    g = stream.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("s"), key)
    return g.agg(F.count("*").alias("n")).select(F.col("s.start").alias("session_start"), key, "n")
