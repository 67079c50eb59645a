"""Repair of text from scanned pages: parted words, misread characters, page furniture.

1. One Arrow pass counts words and line keys of all texts (partial counts a task, summed by Spark).
2. Misread words: every word that is rare against another one is a suspect; candidates come from an
   inverted join on positional character q-grams with the vocabulary (words of at least MIN_SHARE of
   all words, hence at most 1 / MIN_SHARE of them). Each pair is aligned to one substitution. A substitution's support is the number of
   vocabulary words it turns into rare words, its chance the number it turns into other vocabulary words, its rate the share of the
   occurrences of vocabulary words with its letters that it turns. A gradient-boosted ranker chooses
   among a suspect's candidates. Its labels are made, not read off its features: substitutions, drawn by their support, are put into vocabulary words (the
   word itself is the right candidate, every other vocabulary word in reach a wrong one), and vocabulary words as they stand are right as they are (against neighbours that are not
   RATIO times as frequent, and against the same neighbours made more frequent). RANK_ROWS
   words are used, HELD_OUT of them for the measured precision and recall only.
3. Lines: one boosted classifier tells page furniture (running heads, page numbers) from text and the
   site's own lines, another tells whether two lines in sequence belong to one sentence; both are
   fitted on a bounded sample of texts (LINE_ROWS texts with several lines, and damage made from MADE_ROWS
   clean texts of one line, both by hash of the id).
4. A second Arrow pass repairs each text with the replacements, the line keys of the
   site's lines and the models. Replacements are a table; it is sent to the tasks in parts of at most FIX_PART words, with one further
   pass over the texts for each part beyond the first.

A word that stands only at the end of a text without a sentence end, and is a name or begins a longer vocabulary word, may have been cut off and is not taken for misread. Words
of one or two letters are never suspects: too little is left of them to tell what they were.

Defined results: null and blank texts are never damaged and stay as they are; rows delivered twice give
one result; an empty table gives an empty table; texts of any length are read whole.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.boost import BoostedTrees
from claimloom.session import checkpoint

MIN_SHARE, MIN_COUNT, RATIO = 2e-6, 20, 20
LINE_SHARE, LINE_TEMPLATE_SHARE, LINE_COUNT = 5e-5, 2e-3, 8
MIN_SUPPORT, PRECISION = 3, 0.995
RANK_ROWS, HELD_OUT, OPS_ROWS, LINE_ROWS, MADE_ROWS = 20_000, 0.2, 4_096, 4_000, 500
FIX_PART = 1_000_000
FIELDS = ("claim_text", "evidence_text")
WORD = regex.compile(r"\w+")
LETTERS = regex.compile(r"[^\p{L}]+")
MARKS, CLOSERS, CLOSED = ".!?…:;", "\"”’'»)]", "”»)]"  # a sentence ends in a mark, closers after it; some closers end one by themselves
HYPHENS = "-‐‑\u00ad¬"
END = regex.compile(r"(?!\.\.\.)[\"”’'»)\]]*[.!?:;]")
MORE = regex.compile(r"(?:\W*\b(?:read more|more|continued|cont)\W*|&\w{1,6})$", regex.I)  # a mark of a cut, not the text's own words
BULLET = regex.compile(r"^\s*(?:[-•*»|–—]|\d{1,2}[.)])\s+\p{L}")
HYPHEN = regex.compile(r"(\w+)[-‐‑­¬][ \t]*$")
PAGE = regex.compile(r"^\W*(?:page|p|pp|seite|pág|s)?\W*(?:\d{1,4}|[ivxlc]{1,6})(?:\s*(?:of|/|von|de|sur)\s*\d{1,4})?\W*$", regex.I)
LEFT_NUMBER = regex.compile(r"\s*\d{1,4}(?:\s{2,}|\s*[|—–]\s*)\p{L}")
RIGHT_NUMBER = regex.compile(r"(?:\s{2,}|\s[|—–]\s*)\d{1,4}\s*$")
UPPER, LOWER, DIGIT = regex.compile(r"\p{Lu}"), regex.compile(r"\p{Ll}"), regex.compile(r"\d")
ISSUE = regex.compile(r"\b(?:vol|no|nr|issue|heft|bd)\.?\s*\d", regex.I)
HEAD = regex.compile(r"\bet al\b|\bbulletin of\b|\breports?\b|\bproceedings\b|\bjournal\b|(?-i:^\p{Lu}\p{L}+\s*[|:]\s+\p{Lu}(?!.*,.*,))", regex.I)
HEAD_WORDS = regex.compile(r"\bet al\b|\bbulletin of\b|\breports?\b|\bproceedings\b|\bjournal\b", regex.I)
LINE_FEATURES, JOIN_FEATURES = 16, 12


def ends(s: str) -> bool:
    """Whether a text ends like a sentence."""
    return s.rstrip(CLOSERS)[-1:] in MARKS and s.rstrip(CLOSERS) != "" or s != "" and s[-1] in CLOSED


def hyphen(s: str):
    """The match of a word that a hyphen parts at the end of a line."""
    return HYPHEN.search(s) if s.rstrip(" \t")[-1:] in HYPHENS and s.strip() else None


def side_number(line: str) -> bool:
    """A page number at the left or right of a head."""
    return bool(LEFT_NUMBER.match(line)) or bool(RIGHT_NUMBER.search(line[-16:])) and bool(LOWER.search(line) or UPPER.search(line))


def line_key(line: str) -> str:
    return LETTERS.sub("", line.lower())


def line_template(line: str) -> str | None:
    """What is left of a line without capitalised words (after the first) and numbers."""
    words = WORD.findall(line)
    kept = [w.lower() for i, w in enumerate(words) if not w[0].isdigit() and (i == 0 or not w[0].isupper())]
    return " ".join(kept) if len(kept) >= 3 else None


def count_tokens(texts: DataFrame) -> DataFrame:
    """kind ('w' word, 'l' line key, 't' line template), token, n over all texts of FIELDS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw: Counter = Counter()  # tokens between white space; each distinct one is split into words once
        lines: Counter = Counter()
        templates: Counter = Counter()
        seen: dict[str, tuple[str, str | None]] = {}

        def of(line: str) -> tuple[str, str | None]:
            got = seen.get(line)
            if got is None:
                if len(seen) > 50_000:
                    seen.clear()
                got = seen[line] = (line_key(line), line_template(line))
            return got

        def flush() -> Iterator[pa.RecordBatch]:
            words: Counter = Counter()
            for token, n in raw.items():
                for w in WORD.findall(token):
                    words[w] += n
            raw.clear()
            for kind, c in (("w", words), ("l", lines), ("t", templates)):
                if c:
                    yield pa.RecordBatch.from_arrays([pa.array([kind] * len(c)), pa.array(list(c)), pa.array(list(c.values()), pa.int64())], names=["kind", "token", "n"])
                c.clear()

        for b in batches:
            for col in FIELDS:
                for text in b.column(col).to_pylist():
                    if not text:
                        continue
                    raw.update(text.split())
                    if "\n" in text:
                        own = [of(x) for x in text.split("\n") if x and not x.isspace()]
                        lines.update({k for k, _ in own if len(k) >= 12})
                        templates.update({t for _, t in own if t})
            if len(raw) + len(lines) + len(templates) > 400_000:  # bounds the worker's memory
                yield from flush()
        yield from flush()

    return texts.select(*FIELDS).mapInArrow(run, "kind string, token string, n bigint").groupBy("kind", "token").agg(F.sum("n").alias("n"))


def _grams(word, length, side: str):
    """(side, position, 2-gram) keys of a padded word as an array of strings, for words of a length."""
    half = F.ceil(length / 2).cast("int")
    padded = F.concat(F.lit("^"), word, F.lit("$"))
    if side == "s":
        return F.transform(F.sequence(F.lit(1), half), lambda i: F.concat(F.lit("s"), i, F.lit("_"), F.substring(padded, i, F.lit(2))))
    return F.transform(F.sequence(F.lit(0), half - 1), lambda i: F.concat(F.lit("e"), i, F.lit("_"), F.substring(padded, F.length(padded) - 1 - i, F.lit(2))))


def align(suspect: str, word: str) -> tuple[str, str, int]:
    """The one substitution (from, to) that turns word into suspect, and where it starts."""
    i, n = 0, min(len(suspect), len(word))
    while i < n and suspect[i] == word[i]:
        i += 1
    j = 0
    while j < n - i and suspect[-1 - j] == word[-1 - j]:
        j += 1
    return word[i : len(word) - j], suspect[i : len(suspect) - j], i


def misread_pairs(counts: DataFrame, total: int) -> DataFrame:
    """(suspect, word, n_suspect, n_word, shared, was, became) by a positional q-gram inverted join."""
    least = max(MIN_COUNT, int(MIN_SHARE * total))
    words = counts.where((F.col("kind") == "w") & (F.length("token") >= 3)).select("token", "n", F.length("token").alias("len"))
    vocabulary = words.where((F.col("n") >= least) & F.col("token").rlike(r"^\p{L}+$"))
    longest = vocabulary.agg(F.max("len")).first()[0] or 0
    words = words.where(F.col("len") <= longest + 1)  # no longer word has a candidate
    v = vocabulary.select(F.col("token").alias("word"), F.col("n").alias("n_word"), F.explode(F.transform(F.concat(_grams(F.col("token"), F.col("len"), "s"), _grams(F.col("token"), F.col("len"), "e")), lambda g: F.concat(F.col("len").cast("string"), g))).alias("key"))
    s = words.where(F.col("token").rlike(r"\p{L}")).select(F.col("token").alias("suspect"), F.col("n").alias("n_suspect"), "len", F.explode(F.array(F.col("len"), F.col("len") - 1)).alias("target"))
    s = s.where("target >= 3").select("suspect", "n_suspect", F.explode(F.transform(F.concat(_grams(F.col("suspect"), F.col("target"), "s"), _grams(F.col("suspect"), F.col("target"), "e")), lambda g: F.concat(F.col("target").cast("string"), g))).alias("key"))
    joined = s.join(v, "key").where((F.col("n_word") >= RATIO * F.col("n_suspect")) & (F.col("suspect") != F.col("word")))
    pairs = joined.groupBy("suspect", "word").agg(F.first("n_suspect").alias("n_suspect"), F.first("n_word").alias("n_word"), F.count("*").alias("shared"))
    need = F.length("word") + 1 - 4  # grams that one substitution of up to two characters leaves
    pairs = pairs.where(F.col("shared") >= F.greatest(F.lit(1), need))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = b.to_pydict()
            ops = [align(x, y) for x, y in zip(t["suspect"], t["word"])]
            keep = [k for k, (a, c, _) in enumerate(ops) if 0 < len(a) <= 2 and 0 < len(c) <= 2]
            out = {c: [t[c][k] for k in keep] for c in t} | {"was": [ops[k][0] for k in keep], "became": [ops[k][1] for k in keep], "at": [ops[k][2] for k in keep]}
            yield pa.RecordBatch.from_pydict(out, pa.schema([("suspect", pa.string()), ("word", pa.string()), ("n_suspect", pa.int64()), ("n_word", pa.int64()), ("shared", pa.int64()), ("was", pa.string()), ("became", pa.string()), ("at", pa.int32())]))

    return pairs.mapInArrow(run, "suspect string, word string, n_suspect bigint, n_word bigint, shared bigint, was string, became string, at int")


PAIR = ("n_word", "length", "shared", "support", "chance", "wider", "at", "digit", "first", "capital", "rivals", "support_share", "word_share", "excess", "expected", "n_suspect")


def _pair_features(t: dict[str, np.ndarray]) -> np.ndarray:
    n, size, support, chance = (np.asarray(t[c], float) for c in ("n_word", "length", "support", "chance"))
    return np.column_stack([
        np.log(n), size, np.asarray(t["shared"], float) / (size + 1), np.log1p(support), np.log1p(chance), np.log1p(support) - np.log1p(chance),
        np.asarray(t["wider"], float), np.asarray(t["at"], float) / size, np.asarray(t["digit"], float), np.asarray(t["first"], float), np.asarray(t["capital"], float), np.asarray(t["rivals"], float), np.asarray(t["support_share"], float), np.asarray(t["word_share"], float), np.log(np.asarray(t["excess"], float)), np.log(np.asarray(t["expected"], float)), np.log(np.asarray(t["n_suspect"], float)),
    ])


def _grams_shared(suspect: str, word: str) -> int:
    """Positional q-grams two aligned words share, as the inverted join counts them."""
    half = -(-len(word) // 2)
    a, b = f"^{suspect}$", f"^{word}$"
    return sum(a[i : i + 2] == b[i : i + 2] for i in range(half)) + sum(a[len(a) - 2 - i : len(a) - i] == b[len(b) - 2 - i : len(b) - i] for i in range(half))


def made_misreadings(vocabulary: dict[str, int], picked: list[str], ops: list[tuple[str, str, int, int, int, int]]) -> list[tuple[int, bool, dict]]:
    """(number of the case, label, features) of the candidates of made suspects, and of vocabulary words taken for suspects."""
    by_was: dict[str, list[int]] = {}
    by_became: dict[str, list[int]] = {}
    for k, (was, became, *_) in enumerate(ops):
        by_was.setdefault(was, []).append(k)
        by_became.setdefault(became, []).append(k)
    rng = np.random.default_rng(13)
    support = np.array([o[2] for o in ops], float)

    def pieces(word: str) -> Iterator[tuple[int, str]]:
        return ((i, word[i : i + n]) for n in (1, 2) for i in range(len(word) - n + 1))

    def candidates(suspect: str) -> dict[str, tuple[int, int]]:
        found = {}
        for i, piece in pieces(suspect):
            for k in by_became.get(piece, ()):
                word = suspect[:i] + ops[k][0] + suspect[i + len(piece) :]
                if word in vocabulary and word != suspect and align(suspect, word) == (ops[k][0], ops[k][1], i):
                    found[word] = (k, i)
        return found

    out, case = [], 0
    for word in picked:
        able = [(i, k) for i, piece in pieces(word) for k in by_was.get(piece, ())]
        suspects = [(word, None, vocabulary[word])]
        if able:
            weight = support[[k for _, k in able]]
            for j in rng.choice(len(able), min(3, len(able)), replace=False, p=weight / weight.sum()):
                i, k = able[j]
                suspect = word[:i] + ops[k][1] + word[i + len(ops[k][0]) :]
                if suspect not in vocabulary:
                    suspects.append((suspect, word, max(1, int(rng.poisson(vocabulary[word] * ops[k][4] / ops[k][5])))))
        for suspect, right, times in suspects:
            found = candidates(suspect)
            all_support, all_words = sum(ops[k][2] for k, _ in found.values()), sum(vocabulary[w] for w in found)
            for w, (k, i) in found.items():
                if right is None and vocabulary[w] >= RATIO * vocabulary[suspect]:
                    continue  # so much rarer than its neighbour, the word may be a misreading itself: no label
                was, became, sup, chance, turned, exposed = ops[k]
                own = times if right is None else 0  # a made misreading is none of those counted
                # a word that is right stays so however frequent its neighbour is
                for j, factor in enumerate((1, 10, 30, 100) if right is None else (1,)):
                    n = factor * vocabulary[w]
                    expected = n * (max(0, turned - own) + 0.5) / (max(0, exposed - vocabulary[w]) + 1.0)
                    values = (n, len(w), _grams_shared(suspect, w), sup, chance, len(became) - len(was), i, any(c.isdigit() for c in became), i == 0, w[0].isupper(), len(found), sup / all_support, vocabulary[w] / all_words, times / expected, expected, times)
                    out.append((4 * case + j, w == right, dict(zip(PAIR, values, strict=True))))
            case += 1
    return out


def fit_ranker(vocabulary: dict[str, int], picked: list[str], ops: list[tuple[str, str, int, int, int, int]]) -> tuple[BoostedTrees, dict]:
    """(the ranker; cases with a right candidate, right and wrong choices on held-out words, and the least p of a choice).

    The least p is the lowest at which the choices on words of their own reach PRECISION.
    """
    table = lambda some: _pair_features({c: np.array([f[c] for *_, f in some], float) for c in PAIR}).reshape(-1, len(PAIR) + 1)
    first, second = int(len(picked) * (1 - 2 * HELD_OUT)), int(len(picked) * (1 - HELD_OUT))
    train, tune, held = (made_misreadings(vocabulary, some, ops) for some in (picked[:first], picked[first:second], picked[second:]))
    model = BoostedTrees(rounds=120, depth=4, rate=0.15).fit(table(train), np.array([y for _, y, _ in train]))

    def best(some: list) -> np.ndarray:
        """(p, right) of each case's best candidate."""
        out: dict[int, tuple[float, bool]] = {}
        for (case, y, _), q in zip(some, model.predict(table(some))):
            out[case] = max(out.get(case, (0.0, False)), (float(q), bool(y)))
        return np.array(sorted(out.values(), reverse=True), float).reshape(-1, 2)

    b = best(tune)
    good = np.flatnonzero(np.cumsum(b[:, 1]) >= PRECISION * np.arange(1, len(b) + 1))
    least = max(0.5, float(b[good[-1], 0])) if len(good) else 0.5
    b = best(held)
    chosen = b[b[:, 0] >= least, 1]
    return model, {"cases": sum(y for _, y, _ in held), "right": int(chosen.sum()), "wrong": int(len(chosen) - chosen.sum()), "least": least}


def ranked(counts: DataFrame, total: int) -> tuple[DataFrame | None, dict[str, int]]:
    """((suspect, word, p) of each misread word and the word chosen for it, the ranker's counts on held-out words)."""
    least = max(MIN_COUNT, int(MIN_SHARE * total))
    pairs = checkpoint(misread_pairs(counts, total)).where(F.lower("was") != F.lower("became"))
    rare = F.col("n_suspect") < least
    words = counts.where((F.col("kind") == "w") & (F.col("n") >= least) & (F.length("token") >= 3) & F.col("token").rlike(r"^\p{L}+$")).select("token", "n")
    two = lambda t: F.transform(F.sequence(F.lit(1), F.length(t) - 1), lambda i: F.substring(t, i, F.lit(2)))
    exposed = words.select("n", F.explode(F.array_distinct(F.concat(F.split("token", ""), two(F.col("token"))))).alias("was")).groupBy("was").agg(F.sum("n").alias("exposed"))
    by_word = pairs.groupBy("was", "became", "word").agg(F.max(rare).alias("rare"), F.max(~rare).alias("common"), F.sum("n_suspect").alias("n"))
    ops = by_word.groupBy("was", "became").agg(F.count_if("rare").alias("support"), F.count_if("common").alias("chance"), F.sum("n").alias("n")).where(F.col("support") >= MIN_SUPPORT)
    ops = ops.join(exposed, "was").select("was", "became", "support", "chance", F.col("n").alias("turned"), "exposed")
    ops = checkpoint(ops)
    # the labelled sample: made from at most RANK_ROWS words by the OPS_ROWS most frequent substitutions; scoring knows all of them
    top = [tuple(r) for r in ops.orderBy(F.desc("support"), "was", "became").limit(OPS_ROWS).select("was", "became", "support", "chance", "turned", "exposed").collect()]
    vocabulary = {r[0]: r[1] for r in words.collect()}  # at most 1 / MIN_SHARE rows
    picked = [r[0] for r in words.orderBy(F.xxhash64("token"), "token").limit(RANK_ROWS).select("token").collect()]
    if not top or not picked:
        return None, {"cases": 0, "right": 0, "wrong": 0, "least": 1.0}
    model, held = fit_ranker(vocabulary, picked, top)
    shared = counts.sparkSession.sparkContext.broadcast(model)
    rivals = pairs.join(ops, ["was", "became"])
    many = rivals.groupBy("suspect").agg(F.count_distinct("word").alias("rivals"), F.sum("support").alias("all_support"), F.sum("n_word").alias("all_words"))
    # how often the word would be misread so at the rate of all other words
    expected = F.col("n_word") * (F.greatest(F.lit(0), F.col("turned") - F.col("n_suspect")) + 0.5) / (F.greatest(F.lit(0), F.col("exposed") - F.col("n_word")) + 1.0)
    scored = rivals.join(many, "suspect").select(
        "suspect", "word", F.col("n_word"), F.length("word").alias("length"), "shared", "support", "chance", (F.length("became") - F.length("was")).alias("wider"), "at",
        F.col("became").rlike(r"\d").alias("digit"), (F.col("at") == 0).alias("first"), F.col("word").rlike(r"^\p{Lu}").alias("capital"), "rivals", (F.col("support") / F.col("all_support")).alias("support_share"), (F.col("n_word") / F.col("all_words")).alias("word_share"), (F.col("n_suspect") / expected).alias("excess"), expected.alias("expected"), "n_suspect",
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = shared.value.predict(_pair_features({c: b.column(c).to_numpy(zero_copy_only=False) for c in PAIR}))
            yield pa.RecordBatch.from_arrays([b.column("suspect"), b.column("word"), b.column("n_word"), pa.array(p)], names=["suspect", "word", "n_word", "p"])

    chosen = scored.mapInArrow(score, "suspect string, word string, n_word bigint, p double").where(F.col("p") >= held["least"])
    return checkpoint(chosen.groupBy("suspect").agg(F.min_by("word", F.struct((-F.col("p")).alias("a"), (-F.col("n_word")).alias("b"), "word")).alias("word"), F.max("p").alias("p"))), held


class Lines:
    """Line statistics of the corpus: which lines are the site's own."""

    def __init__(self, keys: set[int], templates: set[str], vocabulary: set[str]):
        self.keys, self.templates, self.vocabulary = keys, templates, vocabulary
        self.seen: dict[str, bool] = {}

    def own(self, line: str) -> bool:
        """Whether the line is the site's own; remembered, since such lines come again and again."""
        known = self.seen.get(line)
        if known is None:
            if len(self.seen) > 50_000:
                self.seen.clear()
            known = self.seen[line] = self._own(line)
        return known

    def _own(self, line: str) -> bool:
        k = line_key(line)
        if len(k) >= 12 and k in self.keys:
            return True
        # a template stands for lines that name their site; running heads share templates too, but have a head's form
        return line_template(line) in self.templates and not (side_number(line) or ISSUE.search(line) or HEAD_WORDS.search(line))

    def ends_sentence(self, line: str) -> bool:
        """A line that ends a sentence and has no sign of a head or page number; such a line is text."""
        s = line.strip()
        return ends(s) and not (s.isupper() or s.endswith("…") or PAGE.match(s) or side_number(line) or ISSUE.search(s) or HEAD.search(s))

    def features(self, line: str, before: str | None, after: str | None, own: bool) -> list[float]:
        s = line.strip()
        n = max(1, len(s))
        upper = len(UPPER.findall(s))
        lower = len(LOWER.findall(s))
        words = s.split()
        capital = sum(w[0].isupper() for w in words) / max(1, len(words))
        opens = before is not None and not ends(before.rstrip())
        runs_on = after is not None and after.lstrip()[:1].islower()
        return [
            float(own), float(bool(PAGE.match(s))), float(side_number(line)), float(bool(ISSUE.search(s))), float(bool(HEAD.search(s))),
            upper / max(1, upper + lower), capital, float(ends(s)), float(bool(BULLET.match(line))), len(DIGIT.findall(s)) / n,
            min(n, 200) / 200, float(opens), float(runs_on), float(s[:1].islower()), float(before is None), float(s.endswith("…")),
        ]

    def joins(self, a: str, b: str, own_a: bool, own_b: bool) -> list[float]:
        h = hyphen(a)
        first = WORD.match(b.lstrip())
        whole = (h[1] + first[0]) if h and first else ""
        last = WORD.findall(a)[-1:] or [""]
        return [
            float(h is not None), float(whole.lower() in self.vocabulary), float(ends(a.rstrip())), float(b.lstrip()[:1].islower()), float(own_a), float(own_b),
            float(bool(BULLET.match(b))), float(bool(BULLET.match(a))), float(b.lstrip()[:1].isdigit()), float(last[0].lower() in self.vocabulary), len(last[0]), min(len(a), 200) / 200,
        ]


def _weak_furniture(f: list[float]) -> int | None:
    own, page, side, issue, head, caps, capital, terminal, bullet, digits, size, opens, runs_on, low, first, dots = f
    if own or bullet:
        return 0
    if page or side or issue:
        return 1
    if terminal and not dots and caps < 0.6:
        return 0
    if (opens and runs_on and (head or caps > 0.6)):
        return 1
    if head and (not terminal or dots):
        return 1
    return 0 if low or capital < 0.4 else None


def _weak_join(f: list[float]) -> int | None:
    hyphen, known, terminal, low, own_a, own_b, bullet_b, *_ = f
    if own_a or own_b or bullet_b:
        return 0
    if hyphen and (known or low):
        return 1
    if terminal:
        return 0
    return 1 if low else None


def _made_damage(text: str, k: int) -> Iterator[tuple[list[str], list[int], int]]:
    """Damage made from a clean one-line text: (lines, which are furniture, whether the text's lines join)."""
    letters = [m for m in WORD.finditer(text) if len(m[0]) >= 6 and m[0].isalpha() and m[0].islower()]
    page = ("- {} -", "{}", "Page {} of 300", "[{}]", "— {} —", "p. {}", "{} | ")[k % 7].format(3 + k % 290)
    if letters:
        m = letters[k % len(letters)]
        cut = m.start() + 3
        yield [text[:cut] + "-\u2010\u00ad"[k % 3], text[cut:]], [0, 0], 1
        yield [text[: m.start()].rstrip(), page, text[m.start() :]], [0, 1, 0], 1
    ends = [m.end() for m in regex.finditer(r"[.!?](?= \p{Lu})", text)]
    if ends:
        at = ends[k % len(ends)]
        yield [text[:at], text[at:].strip()], [0, 0], 0
    yield [text, page], [0, 1], 0


class Repairer:
    """Repairs texts batch by batch; the models see all lines of a batch at once."""

    def __init__(self, lines: Lines, words: dict[str, str], furniture: BoostedTrees, join: BoostedTrees):
        self.lines, self.words, self.furniture, self.join = lines, words, furniture, join
        self.tokens: dict[str, tuple[str, ...]] = {}  # misread words of a token between white space
        self.sorted = sorted(lines.vocabulary)

    def misread(self, text: str) -> set[str]:
        memo, words, out = self.tokens, self.words, set()
        for t in set(text.split()):
            got = memo.get(t)
            if got is None:
                if len(memo) > 300_000:
                    memo.clear()
                got = memo[t] = tuple(w for w in WORD.findall(t) if w in words)
            if got:
                out.update(got)
        return out - {self.cut_off(text)} if out else out

    def cut_off(self, text: str) -> str | None:
        """The last word of a text without a sentence end, if it stands nowhere else and is a name or begins a longer word."""
        text = MORE.sub("", text)
        words = WORD.findall(text)
        if not words:
            return None
        last = words[-1]
        after = text[text.rindex(last) + len(last) :].strip()
        if END.match(after) or words.count(last) > 1:
            return None
        low = last.lower()
        at = bisect.bisect_right(self.sorted, low)
        return last if last[0].isupper() or at < len(self.sorted) and self.sorted[at].startswith(low) else None

    def kept_lines(self, texts: list[str]) -> list[tuple[list[tuple[str, bool]], int]]:
        """Of each text its lines without furniture (line, is the site's own), and how many were furniture."""
        raws, owns, rows, at = [], [], [], []
        for t, text in enumerate(texts):
            raw = [x for x in text.split("\n") if x.strip()]
            own = [self.lines.own(x) for x in raw]
            raws.append(raw)
            owns.append(own)
            if len(raw) > 1:
                for i, x in enumerate(raw):
                    if not own[i] and not self.lines.ends_sentence(x):
                        rows.append(self.lines.features(x, raw[i - 1] if i else None, raw[i + 1] if i + 1 < len(raw) else None, False))
                        at.append((t, i))
        drop = {k for k, p in zip(at, self.furniture.predict(np.array(rows).reshape(-1, LINE_FEATURES))) if p >= 0.5}
        return [([(x, o) for i, (x, o) in enumerate(zip(raw, own)) if (t, i) not in drop], sum((t, i) in drop for i in range(len(raw)))) for t, (raw, own) in enumerate(zip(raws, owns))]

    def rejoin(self, kept: list[list[tuple[str, bool]]]) -> list[tuple[list[str], int]]:
        """Lines put together again where a word or sentence runs on; lines of the site in between part nothing."""
        rows, at = [], []
        for t, lines in enumerate(kept):
            last = None
            for i, (x, own) in enumerate(lines):
                if own:
                    continue
                if last is not None:
                    rows.append(self.lines.joins(last, x, False, False))
                    at.append((t, i))
                last = x
        join = {k for k, p in zip(at, self.join.predict(np.array(rows).reshape(-1, JOIN_FEATURES))) if p >= 0.5}
        result = []
        for t, lines in enumerate(kept):
            out: list[str] = []
            last, parted = -1, 0
            for i, (x, own) in enumerate(lines):
                if (t, i) in join:
                    parted += 1
                    out[last] = self._together(out[last], x)
                else:
                    out.append(x)
                    last = last if own else len(out) - 1
            result.append((out, parted))
        return result

    def _together(self, a: str, b: str) -> str:
        h, first, known = hyphen(a), WORD.match(b.lstrip()), self.lines.vocabulary
        if not h:
            return a.rstrip() + " " + b.lstrip()
        whole = (h[1] + (first[0] if first else "")).lower()
        compound = whole not in known and a.rstrip().endswith("-") and h[1].lower() in known and first is not None and first[0].lower() in known
        return a[: h.end(1)] + ("-" if compound else "") + b.lstrip()

    def repair(self, texts: list[str]) -> list[tuple[str, int, int, int]]:
        """(text, misread words, parted words or sentences, furniture lines) of each text."""
        several = [i for i, x in enumerate(texts) if "\n" in x]
        state = {}
        kept = self.kept_lines([texts[i] for i in several])
        for i, (lines, furniture), (out, parted) in zip(several, kept, self.rejoin([k for k, _ in kept])):
            state[i] = ("\n".join(out) if parted or furniture else texts[i], parted, furniture)
        result = []
        for i, text in enumerate(texts):
            text, parted, furniture = state.get(i, (text, 0, 0))
            text, misread = self.reword(text)
            result.append((text, misread, parted, furniture))
        return result

    def reword(self, text: str) -> tuple[str, int]:
        """The text with its misread words replaced, and how many different ones there were."""
        found = self.misread(text)
        if found:
            text = WORD.sub(lambda m: self.words[m[0]] if m[0] in found else m[0], text)
        return text, len(found)


def fit_repairer(claims: DataFrame) -> tuple[Repairer, DataFrame | None, dict[str, int]]:
    """(the repairer without replacements, the replacements, the ranker's counts on held-out words); claims: claim_id, claim_text, evidence_text."""
    counts = checkpoint(count_tokens(claims))
    totals = {r["kind"]: r["n"] for r in counts.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    words, lines, templates = (totals.get(k, 0) for k in "wlt")
    least = max(MIN_COUNT, int(MIN_SHARE * words))
    fixes, held = ranked(counts, words)
    frequent = lambda kind, share, total: {r[0] for r in counts.where((F.col("kind") == kind) & (F.col("n") >= max(LINE_COUNT, share * total))).select("token").collect()}  # noqa: E731 at most 1 / share rows
    known = counts.where((F.col("kind") == "w") & (F.col("n") >= least)).select(F.lower("token").alias("token")).distinct()
    known = known.join(fixes.select(F.lower("suspect").alias("token")), "token", "left_anti") if fixes is not None else known
    vocabulary = {r[0] for r in known.collect()}  # at most 1 / MIN_SHARE rows
    stats = Lines(frequent("l", LINE_SHARE, lines), frequent("t", LINE_TEMPLATE_SHARE, templates), vocabulary)
    # by hash a share of the rows is set aside first, so that what reaches the driver stays the same at any size
    share = min(1.0, 4.0 * LINE_ROWS / max(1, claims.count()))
    claims = claims.where(F.pmod(F.xxhash64("claim_id"), F.lit(2**62)) <= F.lit(int(2**62 * share)))
    several = F.concat_ws("\n\n", *[F.when(F.col(c).contains("\n"), F.col(c)) for c in FIELDS])
    sample = claims.select("claim_id", *FIELDS).where(F.col("claim_text").contains("\n") | F.col("evidence_text").contains("\n")).select(F.xxhash64("claim_id").alias("h"), several.alias("text")).orderBy("h", "text").limit(LINE_ROWS).collect()
    fx, fy, jx, jy = [], [], [], []
    for r in sample:
        for text in r["text"].split("\n\n"):
            raw = [x for x in text.split("\n") if x.strip()]
            own = [stats.own(x) for x in raw]
            for i, x in enumerate(raw):
                f = stats.features(x, raw[i - 1] if i else None, raw[i + 1] if i + 1 < len(raw) else None, own[i])
                if (y := _weak_furniture(f)) is not None and len(raw) > 1:
                    fx.append(f)
                    fy.append(y)
                if i and (y := _weak_join(f := stats.joins(raw[i - 1], x, own[i - 1], own[i]))) is not None:
                    jx.append(f)
                    jy.append(y)
    plain = claims.where(F.col("claim_text").rlike(r"^[^\n]{60,}$")).select(F.xxhash64("claim_id").alias("h"), F.col("claim_text").alias("text")).orderBy("h", "text").limit(MADE_ROWS).collect()
    for k, r in enumerate(plain):
        for raw, labels, joined in _made_damage(r["text"], k):
            for i, x in enumerate(raw):
                fx.append(stats.features(x, raw[i - 1] if i else None, raw[i + 1] if i + 1 < len(raw) else None, False))
                fy.append(labels[i])
            body = [x for x, y in zip(raw, labels) if not y]
            for i in range(1, len(body)):
                jx.append(stats.joins(body[i - 1], body[i], False, False))
                jy.append(joined)
    furniture = BoostedTrees(rounds=40).fit(np.array(fx).reshape(-1, LINE_FEATURES), np.array(fy))
    join = BoostedTrees(rounds=40).fit(np.array(jx).reshape(-1, JOIN_FEATURES), np.array(jy))
    return Repairer(stats, {}, furniture, join), fixes, held


REPAIRED = "claim_id string, field_name string, repaired string, misread int, parted int, furniture int"


def fix_parts(fixes: DataFrame | None) -> Iterator[dict[str, str]]:
    """The replacements in parts of about FIX_PART words, of which the driver holds one at a time; at least one part."""
    parts = 1 if fixes is None else max(1, -(-fixes.count() // FIX_PART))
    for k in range(parts):
        yield {} if fixes is None else {r[0]: r[1] for r in fixes.where(F.pmod(F.xxhash64("suspect"), F.lit(parts)) == k).select("suspect", "word").toLocalIterator()}


def repair_texts(claims: DataFrame) -> DataFrame:
    """claim_id, field_name, repaired, misread, parted, furniture of every field with text; once a claim."""
    model, fixes, _ = fit_repairer(claims.select("claim_id", *FIELDS))
    parts = fix_parts(fixes)
    model.words = next(parts)
    context = claims.sparkSession.sparkContext
    shared = context.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = shared.value
        for b in batches:
            ids = b.column("claim_id").to_pylist()
            rows: list[tuple] = []
            for col in FIELDS:
                some = [(i, text) for i, text in zip(ids, b.column(col).to_pylist()) if text and not text.isspace()]
                rows += [(i, col, *r) for (i, _), r in zip(some, repairer.repair([x for _, x in some]))]
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["claim_id", "field_name", "repaired", "misread", "parted", "furniture"])

    out = claims.select("claim_id", *FIELDS).mapInArrow(run, REPAIRED)
    for words in parts:
        more = context.broadcast(words)

        def again(batches: Iterator[pa.RecordBatch], more=more) -> Iterator[pa.RecordBatch]:
            repairer = Repairer(shared.value.lines, more.value, shared.value.furniture, shared.value.join)
            for b in batches:
                fixed = [repairer.reword(x) for x in b.column("repaired").to_pylist()]
                misread = pa.array([m + n for m, (_, n) in zip(b.column("misread").to_pylist(), fixed)], pa.int32())
                yield pa.RecordBatch.from_arrays([b.column("claim_id"), b.column("field_name"), pa.array([x for x, _ in fixed], pa.string()), misread, b.column("parted"), b.column("furniture")], names=b.schema.names)

        out = out.mapInArrow(again, REPAIRED)
    return out
