"""Queries of problem 6: quantities in different units."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from claimloom.operators.harmonise_units import harmonise_units
from claimloom.sources.tables import table

COLUMNS = ("claim_id", "parameter_id", "entity_name", "value_type", "raw_value_text", "numeric_value", "unit", "claim_text", "normalized_numeric_value")


@F.pandas_udf(StringType())
def signature3(values: pd.Series) -> pd.Series:
    """C's %.2e, which rounds the exact binary value; the JVM's formatter rounds the shortest decimal (6.425 apart)."""
    return values.map(lambda v: "%.2e" % v if pd.notna(v) else None)


def _harmonised(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = table(spark, sf_dir, "normalized_claims").select(*COLUMNS).where(F.col("value_type") == "numeric")
    return harmonise_units(claims, table(spark, sf_dir, "parameter_manifest"), table(spark, sf_dir, "crops"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric claims whose stated unit differs in size from the common unit, with the common value."""
    h = _harmonised(spark, sf_dir).select("claim_id", "value_common", F.col("unit_source").isin("raw_value_text", "unit", "claim_text").alias("stated"), "unit_changes_size")
    # the filter stays above the aggregate, so that the long expressions are computed once a row
    one = h.groupBy("claim_id").agg(F.min(F.struct((~F.coalesce(F.col("stated") & F.col("unit_changes_size") & F.col("value_common").isNotNull(), F.lit(False))).alias("no"), "value_common")).alias("v"))
    return one.where(~F.col("v.no")).select("claim_id", signature3(F.col("v.value_common")).alias("value_sig3"))


def p6_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every numeric claim with its value in the parameter's common unit and where the unit was found."""
    h = _harmonised(spark, sf_dir)
    return h.groupBy("claim_id").agg(*[F.min(c).alias(c) for c in ("parameter_id", "number", "unit_name", "unit_source", "value_common", "log_residual", "unit_unique", "unit_by_identity")])


def p6_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each way in which a unit was found: the claims, those whose unit is unique, and those whose stated unit the identity contradicts."""
    v = p6_values(spark, sf_dir).where("number is not null")
    contradicted = ~F.col("unit_unique") & F.col("unit_source").isin("raw_value_text", "unit", "claim_text")
    return v.groupBy("unit_source").agg(F.count("*").alias("claims"), F.count_if("unit_unique").alias("unique_unit"), F.count_if(contradicted).alias("contradicted"), F.count_if(F.col("unit_by_identity") == F.col("unit_name")).alias("confirmed"))


QUERIES = {"p6_found": p6_found, "p6_values": p6_values, "p6_decisions": p6_decisions}
SQL: dict[str, str] = {}
