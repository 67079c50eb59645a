"""Keyword-stuffed pages and lists of links, tags and products.

1. Function words are learned: of each language (by the documents' label) the words that stand in the sentences of at least WORD_SHARE
   of its texts, and much more rarely in lines that are no sentences. One Arrow pass counts them over all documents.
2. A second pass takes, of the whole text of each document: the language by its function words, how many windows of
   WINDOW words hold 0, 1, 2, ... function words, and over the windows with almost none the share of repeated words, the top word's and the
   top two-word share, further the share of repeated lines, of link text and of separators.
3. All thresholds are calibrated per language over all documents: the median share of function words says how many a window of its
   sentences holds, and a window is empty of sentences when it has far fewer; each of the six signals has the QUANTILE of the
   language's pages that are no lists (junk share of at most ORDINARY; honest tables are among them) as its cut, and never less than its floor.
4. A page is found when most of its windows miss the function words and at least VOTES of the six signals lie above their cuts, or when
   many do and it is made of repeated words. An honest table shows one signal, separators.

Shares are smoothed by SMOOTH words, so that a page of a few words has low shares and is no case.

Defined results: null, empty and blank texts are never found; very long texts are read whole; languages with fewer than MIN_DOCS documents
have no function words of their own and take those of all languages, and the corpus-wide cuts; repeated rows give the same answer twice; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.session import checkpoint

WINDOW, MIN_DOCS, SMOOTH = 12, 30, 32
WORD_SHARE, OUTSIDE = 0.2, 0.3
EMPTY_FRACTION = 0.38  # of the language's usual number of function words in a window
JUNK_SHARE, STUFFED_SHARE, STUFFED_REPETITION = 0.5, 0.35, 0.5
QUANTILE, ORDINARY, VOTES = 0.99, 0.35, 2
#: The signals, and the least cut of each.
FLOORS = {"repetition": 0.25, "top_word": 0.12, "top_pair": 0.06, "repeated_lines": 0.1, "link_share": 0.15, "separators": 0.1}

WORD = regex.compile(r"[^\W_]+")
SENTENCE = regex.compile(r"[.!?…][\"'”’»)\]]*\s*$")
LINK = regex.compile(r"\[[^\]\n]*\]\([^)\n]*\)|https?://\S+|www\.\S+|#\w+")
SEPARATOR = regex.compile(r"[|/>#\[\]()–·•»]")
NAMES = ("n_words", "language", "function_share", "windows", *FLOORS)
FEATURES = "n_words int, language string, function_share double, windows array<int>, " + ", ".join(f"{s} double" for s in FLOORS)


def label(lang: str | None) -> str:
    """The language a document is said to have; '' for none."""
    code = (lang or "").strip().lower().replace("_", "-").partition("-")[0]
    return "" if code == "und" else code


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, texts (texts with the word in a sentence), inside, outside (occurrences in sentences and in other lines); word '' has the totals. Lines that are no sentences count under lang ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: Counter = Counter()
        inside: Counter = Counter()
        outside: Counter = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            keys = [*inside.keys() | texts.keys()]
            rows = [(g, w, texts[g, w], inside[g, w], 0) for g, w in keys] + [("", w, 0, 0, n) for w, n in outside.items()]
            for c in (texts, inside, outside):
                c.clear()
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.string(), pa.string(), *[pa.int64()] * 3])], names=["lang", "word", "texts", "inside", "outside"])

        for b in batches:
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                if not text or text.isspace():
                    continue
                g, here = label(lang), []
                for line in text.lower().split("\n"):
                    words = WORD.findall(line)
                    if SENTENCE.search(line):
                        here += words
                    else:
                        outside.update(words)
                        outside[""] += len(words)
                if g:
                    inside.update([(g, w) for w in here])
                    texts.update([(g, w) for w in set(here)])
                    inside[g, ""] += len(here)
                    texts[g, ""] += 1
            if len(inside) + len(outside) > 400_000:  # bounds the worker's memory
                yield from flush()
        yield from flush()

    counted = docs.select("text", "lang").mapInArrow(run, "lang string, word string, texts bigint, inside bigint, outside bigint")
    return counted.groupBy("lang", "word").agg(*[F.sum(c).alias(c) for c in ("texts", "inside", "outside")])


def function_words(docs: DataFrame) -> dict[str, frozenset[str]]:
    """language -> its function words; at most (different words of a text) / WORD_SHARE a language, and languages of MIN_DOCS documents only."""
    counts = checkpoint(word_counts(docs))
    totals = F.broadcast(counts.where("word = '' and lang <> ''").where(F.col("texts") >= MIN_DOCS).select("lang", F.col("texts").alias("all_texts"), F.col("inside").alias("all_inside")))
    all_outside = counts.where("word = '' and lang = ''").agg(F.sum("outside")).first()[0] or 0
    often = counts.where("word <> '' and lang <> ''").join(totals, "lang").where(F.col("texts") >= WORD_SHARE * F.col("all_texts"))
    outside = counts.where("word <> '' and lang = ''").select("word", F.col("outside").alias("out"))
    often = often.join(outside, "word", "left").where((F.coalesce("out", F.lit(0)) + 1) / F.lit(float(all_outside + 1)) <= OUTSIDE * F.col("inside") / F.col("all_inside"))
    found: dict[str, set] = {}
    for r in often.where(~F.col("word").rlike(r"^\d+$")).select("lang", "word").collect():
        found.setdefault(r["lang"], set()).add(r["word"])
    return {k: frozenset(v) for k, v in sorted(found.items())}


def features(text: str | None, lang: str | None, known: dict[str, frozenset[str]], every: frozenset[str]) -> tuple:
    """The features of one text, in the order of NAMES."""
    low = (text or "").lower()
    words = WORD.findall(low)
    n = len(words)
    if not n:
        return 0, "und", 0.0, [], *[0.0] * 6
    counts = Counter(words)
    hits = {k: sum(counts[w] for w in s if w in counts) for k, s in known.items()}
    best = max(hits, key=lambda k: (hits[k], k == label(lang)), default="und")
    language = best if hits.get(best, 0) * WINDOW >= n else label(lang) if label(lang) in known else "und"
    # a page in no language known is read with the function words it has most of
    own = known.get(language) or (known[best] if hits.get(best) else every)
    is_function = np.fromiter((w in own for w in words), bool, n)
    k = min(WINDOW, n)
    total = np.concatenate(([0], np.cumsum(is_function)))
    inside = total[k:] - total[:-k]  # function words in each window
    windows = np.bincount(inside, minlength=WINDOW + 1)[: WINDOW + 1]
    # words that lie in a window with at most one function word
    poor = np.concatenate(([0], np.cumsum(inside <= 1)))
    at = np.arange(n)
    covered = (poor[np.minimum(at, n - k) + 1] - poor[np.maximum(at - k + 1, 0)]) > 0
    junk = [w for w, c, f in zip(words, covered, is_function) if c and not f and not w.isdigit()]
    seen = Counter(junk)
    m = len(junk) + SMOOTH
    pairs = Counter(zip(junk, junk[1:]))
    lines = [x.strip() for x in low.split("\n") if x.strip()]
    link_chars = sum(len(x) for x in LINK.findall(text))
    return (
        n, language, float(is_function.mean()), windows.tolist(), (len(junk) - len(seen)) / m,
        max(seen.values(), default=0) / m, max(pairs.values(), default=0) / m,
        1.0 - len(set(lines)) / max(1, len(lines)), link_chars / len(text), len(SEPARATOR.findall(text)) / (n + SMOOTH),
    )


def page_features(docs: DataFrame) -> DataFrame:
    """doc_id and the features of each document (columns doc_id, text, lang are read)."""
    known = function_words(docs)
    shared = docs.sparkSession.sparkContext.broadcast((known, frozenset().union(*known.values())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, every = shared.value
        types = [pa.int32(), pa.string(), pa.float64(), pa.list_(pa.int32()), *[pa.float64()] * len(FLOORS)]
        for b in batches:
            rows = [features(t, g, words, every) for t, g in zip(b.column("text").to_pylist(), b.column("lang").to_pylist())]
            cols = list(zip(*rows)) if rows else [[] for _ in NAMES]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, types)]], names=["doc_id", *NAMES])

    return docs.select("doc_id", "text", "lang").mapInArrow(run, f"doc_id bigint, {FEATURES}")


def judged_pages(docs: DataFrame) -> DataFrame:
    """The features with junk_share, each signal's cut (cut_...), votes and found, for every document with words."""
    f = checkpoint(page_features(docs))  # a few numbers a document; else the texts would be read again
    f = f.where("n_words > 0")
    usual = f.groupBy("language").agg(F.percentile_approx("function_share", 0.5, 10000).alias("_median"), F.count("*").alias("_n"))
    usual = F.broadcast(usual.where(F.col("_n") >= MIN_DOCS).select("language", "_median"))  # at most one row a language
    overall = f.agg(F.percentile_approx("function_share", 0.5, 10000)).first()[0] or 0.0
    g = f.join(usual, "language", "left")
    few = F.floor(F.lit(EMPTY_FRACTION * WINDOW) * F.coalesce("_median", F.lit(overall)))
    poor = F.aggregate(F.slice("windows", F.lit(1), (few + 1).cast("int")), F.lit(0), lambda a, x: a + x)
    g = g.withColumn("junk_share", poor / F.aggregate("windows", F.lit(0), lambda a, x: a + x)).drop("_median")
    ordinary = g.where(F.col("junk_share") <= ORDINARY)
    cuts = [F.percentile_approx(s, QUANTILE, 10000).alias(f"_{s}") for s in FLOORS]
    by_language = F.broadcast(ordinary.groupBy("language").agg(*cuts, F.count("*").alias("_n")).where(F.col("_n") >= MIN_DOCS).drop("_n"))
    corpus = ordinary.agg(*cuts).first()
    g = g.join(by_language, "language", "left")
    votes = F.lit(0)
    for s, floor in FLOORS.items():
        g = g.withColumn(f"cut_{s}", F.greatest(F.coalesce(F.col(f"_{s}"), F.lit(corpus[f"_{s}"]).cast("double"), F.lit(0.0)), F.lit(floor))).drop(f"_{s}")
        votes = votes + (F.col(s) > F.col(f"cut_{s}")).cast("int")
    g = g.withColumn("votes", votes)
    listing = (F.col("junk_share") >= JUNK_SHARE) & (F.col("votes") >= VOTES)
    stuffed = (F.col("junk_share") >= STUFFED_SHARE) & (F.col("votes") >= VOTES) & (F.col("repetition") >= STUFFED_REPETITION)
    return g.withColumn("found", listing | stuffed)


def stuffed_pages(docs: DataFrame) -> DataFrame:
    """doc_id and what the decision rests on, of the pages found."""
    return judged_pages(docs).where("found").drop("windows")
