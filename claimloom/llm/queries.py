"""Queries of the problems tagged llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.hosts import host_of
from claimloom.llm import oracles
from claimloom.llm.batch_index import BatchIndex
from claimloom.llm.best_record import best_records, claim_key
from claimloom.llm.contributor_cap import beyond_cap, prepare_contributors, with_share
from claimloom.llm.new_batches import duplicates, index_recall
from claimloom.llm.packing import pack_documents
from claimloom.llm.scan_noise import fit_repairer, repair_texts
from claimloom.llm.site_lines import clean_texts, frequent_runs, frequent_sequences, line_sequences, run_lines
from claimloom.llm.stuffed_pages import FLOORS, VOTES, judged_pages, stuffed_pages
from claimloom.llm.tokenizer import encode, spans, token_counts
from claimloom.llm.truncation import TERMINALITY, judged
from claimloom.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = dict(oracles.SQL)
P1_KEY = ["k_crop", "parameter_id", "attribute_subtype", "k_geo", "k_time", "k_value"]


def p1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving record of every claim, built bundle by bundle."""
    return best_records(claim_key(table(spark, sf_dir, "durable_claims"), table(spark, sf_dir, "crops")), P1_KEY)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best row of each group of two or more durable claims."""
    return p1_records(spark, sf_dir).where("has_copies").select("durable_claim_id")


def p1_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the groups of two or more rows: in how many a bundle is better than the best row's own."""
    r = p1_records(spark, sf_dir).where("has_copies")
    return r.select(F.explode(F.when(F.size("rebuilt") > 0, F.col("rebuilt")).otherwise(F.array(F.lit("none")))).alias("bundle")).groupBy("bundle").agg(F.count("*").alias("groups"))


def _contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "run_id", "source_domain", "source_tier_id", "quality_score")
    return prepare_contributors(docs, table(spark, sf_dir, "source_tiers"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents beyond their site's cap."""
    return beyond_cap(_contributors(spark, sf_dir)).select("doc_id")


def p2_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents beyond their site's cap or a hundredth of their run, whichever is less."""
    return beyond_cap(with_share(_contributors(spark, sf_dir), 0.01)).select("doc_id")


def p2_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that stay: those within the cap and those without a site."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source_domain", "quality_score")
    return docs.join(p2_found(spark, sf_dir), "doc_id", "left_anti")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of claim_text that are repeated over one site's claims."""
    return run_lines(frequent_runs(*_lines(spark, sf_dir))).select("claim_id", "line_no")


def _lines(spark: SparkSession, sf_dir: str):
    claims = table(spark, sf_dir, "normalized_claims").select("claim_id", "claim_text", "source_url")
    return line_sequences(claims, table(spark, sf_dir, "source_documents").select("source_url", "source_domain"))


def p7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """claim_text without the lines of the site."""
    claims = table(spark, sf_dir, "normalized_claims").select("claim_id", "claim_text")
    return clean_texts(claims, run_lines(frequent_runs(*_lines(spark, sf_dir))))


def p7_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each length: the frequent patterns, their occurrences, and the lines for which it is the longest pattern."""
    runs = frequent_runs(*_lines(spark, sf_dir))
    patterns = runs.groupBy("length").agg(F.count_distinct("site", "pattern").alias("patterns"), (F.count("*") / F.first("length")).cast("bigint").alias("occurrences"))
    longest = run_lines(runs).groupBy(F.col("longest").alias("length")).agg(F.count("*").alias("lines"))
    return patterns.join(longest, "length", "left").select("length", "patterns", "occurrences", F.coalesce("lines", F.lit(0)).alias("lines"))


QUERIES |= {"p1_found": p1_found, "p1_records": p1_records, "p1_rebuilt": p1_rebuilt, "p2_found": p2_found, "p2_kept": p2_kept, "p2_share": p2_share, "p7_found": p7_found, "p7_clean": p7_clean, "p7_levels": p7_levels}


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"))


def p9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document or piece of a document."""
    return pack_documents(token_counts(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES |= {"p8_ids": p8_ids, "p9_pack": p9_pack}


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of repeated keywords, tags, product entries or links."""
    return stuffed_pages(table(spark, sf_dir, "documents")).select("doc_id").distinct()


def p10_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the decision on every page rests on: the signals, the cuts of its language, the votes."""
    return judged_pages(table(spark, sf_dir, "documents"))


def p10_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each signal: the pages above its cut, of these the found ones, and the found pages that would be lost without its vote."""
    j = judged_pages(table(spark, sf_dir, "documents"))
    rows = j.select("found", "votes", F.explode(F.array(*[F.struct(F.lit(s).alias("signal"), (F.col(s) > F.col(f"cut_{s}")).alias("above")) for s in FLOORS])).alias("s"))
    rows = rows.select("found", "votes", "s.*").where("above")
    return rows.groupBy("signal").agg(F.count("*").alias("pages"), F.count_if("found").alias("found"), F.count_if(F.col("found") & (F.col("votes") == VOTES)).alias("lost_without"))


QUERIES |= {"p10_found": p10_found, "p10_features": p10_features, "p10_ablation": p10_ablation}


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_texts(table(spark, sf_dir, "normalized_claims").select("claim_id", "claim_text", "evidence_text"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields damaged by scanning."""
    return _scanned(spark, sf_dir).where("misread + parted + furniture > 0").select("claim_id", "field_name").distinct()


def p3_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repaired texts of the damaged fields."""
    return _scanned(spark, sf_dir).where("misread + parted + furniture > 0").groupBy("claim_id", "field_name").agg(F.min("repaired").alias("text"))


def p3_ranker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranker on held-out words: made misreadings with a right candidate, right and wrong choices, precision and recall; and the replacements it chose in the corpus."""
    _, fixes, held = fit_repairer(table(spark, sf_dir, "normalized_claims").select("claim_id", "claim_text", "evidence_text"))
    n = fixes.count() if fixes is not None else 0
    row = (held["cases"], held["right"], held["wrong"], round(held["right"] / max(1, held["right"] + held["wrong"]), 4), round(held["right"] / max(1, held["cases"]), 4), n)
    return spark.createDataFrame([row], "cases bigint, right bigint, wrong bigint, precision double, recall double, replacements bigint")


QUERIES |= {"p3_found": p3_found, "p3_repaired": p3_repaired, "p3_ranker": p3_ranker}


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals already held in an earlier batch, with the document first held."""
    return duplicates(table(spark, sf_dir, "documents").select("doc_id", "batch_no", "text", "content_hash", "canonical_url", "doi", "source_domain"))


def p4_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows where the last batch is added to a stored index that holds the others: its load reads none of their texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "batch_no", "text", "content_hash", "canonical_url", "doi", "source_domain")
    last = docs.agg(F.max("batch_no")).first()[0]
    index = BatchIndex(spark)
    index.add(docs.where(~F.coalesce(F.col("batch_no") == last, F.lit(False))))
    index.add(docs.where(F.col("batch_no") == last))
    return index.held_before()


QUERIES |= {"p4_found": p4_found, "p4_added": p4_added}


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "normalized_claims").select("claim_id", "source_domain", "evidence_text"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims whose evidence_text breaks off."""
    return _judged(spark, sf_dir).where("cut").select("claim_id")


def p5_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each source: claims with evidence, cut claims and their share."""
    host = F.coalesce(host_of(F.col("source_domain")), F.lit(""))
    return _judged(spark, sf_dir).groupBy(host.alias("source_domain")).agg(F.count("*").alias("claims"), F.sum(F.col("cut").cast("bigint")).alias("cut"), F.round(F.avg(F.col("cut").cast("double")), 6).alias("share"))


def p5_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each closing shape: the texts, those cut by terminality, by a longer copy, by the copy alone, and the least and greatest terminality."""
    low = F.col("terminality") < TERMINALITY
    return _judged(spark, sf_dir).groupBy("shape").agg(
        F.count("*").alias("texts"), F.count_if(low).alias("by_terminality"), F.count_if("by_copy").alias("by_copy"), F.count_if(F.col("by_copy") & ~low).alias("by_copy_alone"), F.round(F.min("terminality"), 4).alias("least"), F.round(F.max("terminality"), 4).alias("most")
    )


QUERIES |= {"p5_found": p5_found, "p5_rates": p5_rates, "p5_stages": p5_stages}


def p7_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent sequences of lines of each site (PrefixSpan), with their support."""
    s = frequent_sequences(*_lines(spark, sf_dir))
    return s.select("site", F.size("pattern").alias("length"), F.concat_ws(",", F.transform("pattern", lambda x: F.hex(x))).alias("pattern"), "support")


def p8_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of a text starts and which token is its first, for decoding parts."""
    return spans(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES |= {"p7_sequences": p7_sequences, "p8_spans": p8_spans}


def p4_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall of the near-copy index, measured on every hundredth document against exhaustive search."""
    return index_recall(table(spark, sf_dir, "documents").select("doc_id", "batch_no", "source_domain", "canonical_url", "text"))


QUERIES |= {"p4_recall": p4_recall}
