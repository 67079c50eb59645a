"""File sources: JSON objects, JSON lines, delimited gazetteers, gold sets, mixed claim files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return found is not None and len(found) > 0


def json_objects(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = False, key: str | None = "id", skip: tuple[str, ...] = ("summary.json",)) -> DataFrame:
    """One object a file. Lenient: broken files and files without `key` are dropped; strict: they raise.

    file_name orders the records (the position by name); summaries named in skip are left out.
    """
    reader = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST" if strict else "DROPMALFORMED")
    df = reader.json(path).withColumn("_file", F.col("_metadata.file_name"))
    df = df.where(~F.col("_file").isin(*skip)) if skip else df
    if key and not strict:
        df = df.where(F.col(key).isNotNull())
    return df.withColumnRenamed("_file", "file_name")


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str, missing_ok: bool = False) -> DataFrame:
    """Line-delimited JSON; a missing path raises, or with missing_ok gives an empty table."""
    if missing_ok and not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def gazetteer(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """A delimited place list with a header; names are trimmed."""
    df = spark.read.option("sep", sep).option("header", True).csv(path)
    return df.select(*[F.trim(F.col(f"`{c}`")).alias(c.strip().lower()) for c in df.columns])


def gold_set(spark: SparkSession, path: str, record: str, run_id: str | None = None) -> DataFrame:
    """records[] of gold files; a record inherits domain and run_id of its file; filtered by run where both are known."""
    df = spark.read.schema(f"domain string, run_id string, records array<struct<{record}>>").option("multiLine", True).json(path)
    r = df.select(F.col("domain").alias("_d"), F.col("run_id").alias("_r"), F.explode("records").alias("rec"))
    fields = r.schema["rec"].dataType.names
    out = r.select(*[F.coalesce(F.col(f"rec.{n}"), F.col("_d") if n == "domain" else F.col("_r")).alias(n) if n in ("domain", "run_id") else F.col(f"rec.{n}").alias(n) for n in fields], *([F.col("_d").alias("domain")] if "domain" not in fields else []), *([F.col("_r").alias("run_id")] if "run_id" not in fields else []))
    return out.where(F.col("run_id").isNull() | (F.col("run_id") == run_id)) if run_id else out


def mixed_claims(spark: SparkSession, path: str, claim: str) -> DataFrame:
    """Files that hold either one claim or {"claims": [...]}."""
    both = spark.read.schema(f"claims array<struct<{claim}>>, {claim}").option("multiLine", True).json(path)
    names = [n for n in both.columns if n != "claims"]
    many = both.where(F.col("claims").isNotNull()).select(F.explode("claims").alias("c")).select("c.*")
    single = both.where(F.col("claims").isNull()).select(*names)
    return many.unionByName(single)


def first_by_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key; rows without a key are all kept."""
    keyed = F.coalesce(F.col(key), F.lit("")) != ""
    w = Window.partitionBy(key).orderBy(order)
    first = df.where(keyed).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return first.unionByName(df.where(~keyed))
