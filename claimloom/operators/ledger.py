"""Discovery ledger: ranks, stamps, candidates, queue selection.

A ledger row has ord (arrival position), canonical_key, provider, score and what is named below.
Ties resolve to the row that arrived first.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from claimloom.functions.keys import junk_doi, normalize_doi

GATED = ("internet_archive", "wikipedia", "duckduckgo_html")
ARTICLE_TYPES = ("article", "html", "pdf")


def provider_rank(ledger: DataFrame) -> DataFrame:
    """discovery_rank: 1-based arrival position within (query, provider)."""
    return ledger.withColumn("discovery_rank", F.row_number().over(Window.partitionBy("query", "provider").orderBy("ord")))


def stamp_drops(ledger: DataFrame, gated: tuple[str, ...] = GATED, least_score: int = 4, key: str = "canonical_key") -> DataFrame:
    """discovery_drop_reason: relevance_gate, else duplicate for all but a key's best row, else ''.

    The best row is a mergeable aggregate joined back on the row's own ord (unique), so that a key
    that holds many rows is spread over all tasks; rows without a key are no one's duplicates.
    """
    best = ledger.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by("ord", F.struct("score", (-F.col("ord")).alias("o"))).alias("ord")).select("ord", F.lit(True).alias("_best"))
    gate = F.col("provider").isin(*gated) & (F.col("score") < least_score)
    j = ledger.join(best, "ord", "left")
    reason = F.when(gate, "relevance_gate").when(F.col(key).isNotNull() & F.col("_best").isNull(), "duplicate").otherwise("")
    return j.select(*[j[c] for c in ledger.columns], reason.alias("discovery_drop_reason"))


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """name: 1, 2, ... in the given order. Numbered by range partitions, without one task seeing all rows.

    The partitioned rows are checkpointed: counting and numbering must see the same range bounds.
    """
    import itertools

    from claimloom.session import checkpoint

    parts = checkpoint(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = {r["_part"]: r["n"] for r in parts.groupBy("_part").agg(F.count("*").alias("n")).collect()}  # one row a partition
    ids = sorted(sizes)
    starts = dict(zip(ids, itertools.accumulate([0] + [sizes[p] for p in ids][:-1])))
    base = F.element_at(F.create_map(*[x for p, n in starts.items() for x in (F.lit(p), F.lit(n))]), F.col("_part")) if starts else F.lit(0)
    return parts.withColumn(name, F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + base).drop("_part")


def sequence(df: DataFrame, key: str, order: str) -> DataFrame:
    """Adds position (1, 2, ... of each key in the given order) and previous (the order value before, null for the first).

    Rows are ordered over (key, order) by ranges, so that a key with a third of the rows is spread over tasks: each range is numbered on
    its own, and what the ranges before it hold of its first key is added (one row a range and key at its ends).
    """
    from claimloom.session import checkpoint

    parts = checkpoint(df.repartitionByRange(key, order).withColumn("_part", F.spark_partition_id()))
    per = parts.groupBy("_part", key).agg(F.count("*").alias("_n"), F.max(order).alias("_last"))
    before = Window.partitionBy(key).orderBy("_part")  # the ranges a key is spread over
    per = per.select(F.col("_part").alias("_pp"), F.col(key).alias("_pk"), F.coalesce(F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"), F.lag("_last").over(before).alias("_carry"))
    w = Window.partitionBy("_part", key).orderBy(order)
    j = parts.withColumn("_i", F.row_number().over(w)).withColumn("_p", F.lag(order).over(w)).join(per, (F.col("_part") == F.col("_pp")) & F.col(key).eqNullSafe(F.col("_pk")))
    return j.select(*df.columns, (F.col("_i") + F.col("_base")).alias("position"), F.coalesce("_p", "_carry").alias("previous"))


def with_ids(ledger: DataFrame, run: str, infix: str = "led") -> DataFrame:
    """ledger_id: sequential over ord, prefixed by the run's hash."""
    return numbered(ledger, ["ord"], "_n").withColumn("ledger_id", F.concat(F.substring(F.sha1(F.lit(run)), 1, 6), F.format_string(f"-{infix}-%06d", "_n"))).drop("_n")


def candidates(stamped: DataFrame, tier_trust: DataFrame) -> DataFrame:
    """One row a canonical key: first url, doi and domain, most trusted tier, best score and access, distinct parameters.

    tier_trust (tier, trust) is a fixed table; the aggregate is one shuffle with map-side partials.
    """
    access = F.when(F.col("access_status") == "open_full_text", 2).when(F.col("access_status") == "metadata_only", 1).otherwise(0)
    s = stamped.join(F.broadcast(tier_trust.select(F.col("tier").alias("_tier"), F.col("trust"))), F.col("tier") == F.col("_tier"), "left")
    s = s.withColumn("trust", F.coalesce("trust", F.lit(0.0))).withColumn("_access", access)
    late = -F.col("ord")
    return s.groupBy("canonical_key").agg(
        F.min_by("source_url", "ord").alias("source_url"),
        F.min_by("source_domain", "ord").alias("source_domain"),
        F.min_by("doi", "ord").alias("doi"),
        F.min_by("document_type", "ord").alias("document_type"),
        F.max_by("tier", F.struct("trust", late)).alias("tier"),
        F.max("trust").alias("trust"),
        F.max("score").alias("score"),
        F.max_by("access_status", F.struct("_access", late)).alias("access_status"),
        F.max("_access").alias("access_rank"),
        F.array_sort(F.collect_set("parameter_id")).alias("parameter_ids"),
        F.count("*").alias("ledger_rows"),
        F.bool_and(F.col("discovery_drop_reason") == "relevance_gate").alias("all_gated"),
        F.min("ord").alias("first_ord"),
    )


def prefilter_reason(drop_gated: bool = True, article_types: tuple[str, ...] = ARTICLE_TYPES) -> Column:
    """Why a candidate isn't worth a fetch; '' where it is."""
    gate = F.col("all_gated") if drop_gated else F.lit(False)
    is_doi = normalize_doi(F.col("doi")) != ""
    return F.when(gate, "relevance_gated").when(is_doi & junk_doi(F.col("doi")), "junk_doi").when(is_doi & ~F.coalesce(F.col("document_type"), F.lit("")).isin(*article_types), "non_article_type").otherwise("")


def fetch_rank(cands: DataFrame, limit: int | None = None) -> DataFrame:
    """Candidates by trust, access and score, falling; the first `limit` with their position."""
    order = [F.col("trust").desc(), F.col("access_rank").desc(), F.col("score").desc(), F.col("first_ord")]
    ranked = cands.orderBy(*order)
    return ranked.limit(limit) if limit else ranked


def quota_select(cands: DataFrame, per_parameter: int = 4, domain_cap: int = 3, trusted: tuple[str, ...] = (), trusted_cap: int = 50, group: str = "run_id") -> DataFrame:
    """Greedy selection under quotas, one ordered fold a run: only selected rows use up quota.

    The domain cap comes first, then 'all of my parameters are saturated'. The fold is
    sequential by definition; runs are independent and spread over tasks, and a run's candidate list is
    bounded by the run's plan.
    """

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["trust", "access_rank", "score", "first_ord"], ascending=[False, False, False, True], kind="stable")
        domains: dict = {}
        params: dict = {}
        chosen, why = [], []
        for domain, ids in zip(pdf["source_domain"].fillna(""), pdf["parameter_ids"]):
            cap = trusted_cap if any(domain.endswith(t) for t in trusted) else domain_cap
            if domains.get(domain, 0) >= cap:
                chosen.append(False)
                why.append("domain_cap")
            elif len(ids) and all(params.get(p, 0) >= per_parameter for p in ids):
                chosen.append(False)
                why.append("saturated")
            else:
                domains[domain] = domains.get(domain, 0) + 1
                for p in ids:
                    params[p] = params.get(p, 0) + 1
                chosen.append(True)
                why.append("")
        return pdf.assign(fetch_selected=chosen, fetch_skip_reason=why)[[group, "canonical_key", "fetch_selected", "fetch_skip_reason"]]

    return cands.groupBy(group).applyInPandas(fold, f"`{group}` string, canonical_key string, fetch_selected boolean, fetch_skip_reason string")


def seed_union(ledger: DataFrame, seeds: DataFrame) -> DataFrame:
    """Seeds (source_url, parameter_ids) as ledger rows of score 15, one a parameter, where no searched row has their URL."""
    fresh = seeds.join(ledger.select("source_url").distinct(), "source_url", "left_anti")
    rows = fresh.select("source_url", F.explode("parameter_ids").alias("parameter_id")).withColumn("provider", F.lit("seed")).withColumn("score", F.lit(15))
    return ledger.select("source_url", "parameter_id", "provider", "score").unionByName(rows)
