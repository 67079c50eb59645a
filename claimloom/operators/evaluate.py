"""Scorecards of extraction and retrieval against gold records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.values import TOLERANCE, numeric_match, range_match, safe_ratio, text_match


def extraction_hits(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """gold rows (gold_id, doc, parameter_id, gold_value, domain) with whether a prediction of the same document and parameter matches."""
    p = predicted.select("doc", "parameter_id", "value", "lo", "hi")
    j = gold.join(p, ["doc", "parameter_id"], "left").withColumn("_hit", F.coalesce(numeric_match(F.col("gold_value"), F.col("value"), F.col("lo"), F.col("hi")), F.lit(False)))
    return j.groupBy("gold_id").agg(F.max("_hit").alias("hit"), F.min("domain").alias("domain"))


def extraction_scores(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Recall by domain and over all (rollup)."""
    h = extraction_hits(gold, predicted)
    return h.rollup("domain").agg(F.count("*").alias("gold"), F.count_if("hit").alias("recalled"), F.grouping("domain").alias("total")).withColumn("recall", safe_ratio(F.col("recalled").cast("double"), F.col("gold").cast("double")))


def retrieval_hits(gold: DataFrame, ledger: DataFrame) -> DataFrame:
    """Best rank of each gold source found by DOI, URL or domain: three equi-joins in place of a disjunctive one."""
    parts = []
    for c in ("doi", "source_url", "source_domain"):
        g = gold.where(F.coalesce(F.col(c), F.lit("")) != "").select("gold_id", F.col(c).alias("k"))
        led = ledger.where(F.coalesce(F.col(c), F.lit("")) != "").groupBy(F.col(c).alias("k")).agg(F.min("rank").alias("rank"))
        parts.append(g.join(led, "k").select("gold_id", "rank"))
    found = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("gold_id").agg(F.min("rank").alias("best_rank"))
    return gold.select("gold_id").join(found, "gold_id", "left")


def unit_match(unit: Column, gold: Column) -> Column:
    """Equal units, letter case and spacing aside; no gold unit is always met."""
    norm = lambda c: F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), r"\s+", "")
    return (norm(gold) == "") | (norm(unit) == norm(gold))


def value_match(gold_type: Column, gold: dict[str, Column], said: dict[str, Column]) -> Column:
    """Whether a prediction meets a gold value, by the gold value's type (numeric by default)."""
    text = text_match(gold["text"], F.concat_ws(" ", said["claim_text"], said["evidence_text"]))
    return (
        F.when(F.coalesce(gold_type, F.lit("numeric")) == "numeric", gold["value"].isNotNull() & numeric_match(gold["value"], said["value"], said["low"], said["high"]))
        .when(gold_type == "range", gold["low"].isNotNull() & gold["high"].isNotNull() & range_match(gold["low"], gold["high"], said["value"], said["low"], said["high"]))
        .otherwise(text)
    )


def faithful(evidence: Column, gold_value: Column, marker: Column) -> Column:
    """Whether the cited text holds the marker, else the number (within the tolerance); no number is met by any text."""
    text = F.lower(F.coalesce(evidence, F.lit("")))
    numbers = F.transform(F.regexp_extract_all(text, F.lit(r"(-?\d+(?:\.\d+)?)"), F.lit(1)), lambda n: n.try_cast("double"))
    near = F.exists(numbers, lambda n: F.abs(n - gold_value) <= F.greatest(F.abs(gold_value) * TOLERANCE, F.lit(1e-9)))
    return (text != "") & F.when(F.coalesce(marker, F.lit("")) != "", F.contains(text, F.lower(marker))).when(gold_value.isNull(), F.lit(True)).otherwise(near)


def extraction_report(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """Per domain and over all (rollup): gold, recall, parameter mapping, unit correctness and faithfulness of the first hit, in shares.

    gold: gold_id, doc, parameter_id, domain, value_type, value, low, high, text, unit, marker; predictions: doc, parameter_id,
    ord, value, low, high, unit, claim_text, evidence_text. One equi-join on (doc, parameter_id); a gold row's hits are reduced by mergeable aggregates.
    """
    g = gold.select(*[F.col(c).alias(f"g_{c}") for c in gold.columns])
    p = predictions.withColumn("_hit", F.lit(True))
    j = g.join(p, (F.col("g_doc") == F.col("doc")) & (F.col("g_parameter_id") == F.col("parameter_id")), "left")
    hit = F.col("_hit").isNotNull() & value_match(F.col("g_value_type"), {k: F.col(f"g_{k}") for k in ("value", "low", "high", "text")}, {k: F.col(k) for k in ("value", "low", "high", "claim_text", "evidence_text")})
    j = j.withColumn("hit", F.coalesce(hit, F.lit(False)))
    first = F.min_by(F.struct(unit_match(F.col("unit"), F.col("g_unit")).alias("unit"), faithful(F.col("evidence_text"), F.col("g_value"), F.col("g_marker")).alias("faithful")), F.when(F.col("hit"), F.col("ord")))
    one = j.groupBy("g_gold_id", "g_domain").agg(F.max("hit").alias("hit"), F.max(F.col("_hit").isNotNull()).alias("mapped"), first.alias("f"))
    s = one.rollup("g_domain").agg(
        F.grouping("g_domain").alias("overall"), F.count("*").alias("gold"), F.count_if("hit").alias("hits"), F.count_if("mapped").alias("mapped"),
        F.count_if(F.col("hit") & F.col("f.unit")).alias("units"), F.count_if(F.col("hit") & F.col("f.faithful")).alias("faithful"),
    )
    return s.select(
        F.col("g_domain").alias("domain"), "overall", "gold", safe_ratio(F.col("hits"), F.col("gold")).alias("recall"), safe_ratio(F.col("mapped"), F.col("gold")).alias("parameter_mapping_accuracy"),
        safe_ratio(F.col("units"), F.col("hits")).alias("unit_correctness"), safe_ratio(F.col("faithful"), F.col("hits")).alias("evidence_faithfulness"),
    )


def extraction_precision(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """Of the predictions for a (doc, parameter_id) that has gold: how many meet some gold value."""
    g = gold.select(*[F.col(c).alias(f"g_{c}") for c in gold.columns])
    j = predictions.join(g, (F.col("g_doc") == F.col("doc")) & (F.col("g_parameter_id") == F.col("parameter_id")))
    hit = F.coalesce(value_match(F.col("g_value_type"), {k: F.col(f"g_{k}") for k in ("value", "low", "high", "text")}, {k: F.col(k) for k in ("value", "low", "high", "claim_text", "evidence_text")}), F.lit(False))
    one = j.groupBy("ord").agg(F.max(hit).alias("hit"))
    return one.agg(F.count("*").alias("adjudicable"), F.count_if("hit").alias("correct")).withColumn("precision", safe_ratio(F.col("correct"), F.col("adjudicable")))


def retrieval_scores(gold: DataFrame, ledger: DataFrame) -> DataFrame:
    """Per domain and over all (rollup): source recall, selection recall and mean best rank.

    gold: gold_id, domain, doi, url, host; ledger: canonical_key, doi, url, host, discovery_rank, selected. A row is found by DOI, URL or host: three
    equi-joins; a ledger row found twice counts once.
    """
    def by(col: str) -> DataFrame:
        g = gold.where((F.coalesce(col, F.lit("")) != "")).select("gold_id", F.lower(F.trim(col)).alias("_v"))
        le = ledger.where(F.coalesce(col, F.lit("")) != "").groupBy(F.lower(F.trim(col)).alias("_v")).agg(F.min("discovery_rank").alias("rank"), F.max("selected").alias("selected"))
        return g.join(le, "_v").select("gold_id", "rank", "selected")

    hits = by("doi").unionByName(by("url")).unionByName(by("host")).groupBy("gold_id").agg(F.min("rank").alias("rank"), F.max("selected").alias("selected"))
    j = gold.select("gold_id", "domain").join(hits, "gold_id", "left")
    s = j.rollup("domain").agg(F.grouping("domain").alias("overall"), F.count("*").alias("gold"), F.count("rank").alias("found"), F.count_if("selected").alias("chosen"), F.round(F.avg("rank"), 2).alias("mean_rank"))
    return s.select("domain", "overall", "gold", safe_ratio(F.col("found"), F.col("gold")).alias("source_recall"), safe_ratio(F.col("chosen"), F.col("gold")).alias("selection_recall"), "mean_rank")
