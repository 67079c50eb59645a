"""Texts cut off by field limits: which records, and how often each source cuts.

1. Near-copies: evidence texts become min-hash signatures of five-word shingles; BANDS bands of BAND_ROWS
   values find pairs of a similarity of 0.8 and more. In a band's bucket every text is compared with
   every longer one: by a join where the bucket has at most MANY rows, else in blocks of about BLOCK texts, each block with each,
   where only pairs that the closing word allows are aligned. Pairs are aligned; where a copy's alignment ends early, that is the
   longer text goes on after the last aligned word while the copy stops, and the place lies inside the longer
   text's word, sentence, row or caption, the copy is cut, whatever its closing shape.
2. Unmatched records are scored by the terminality of their closing word: of all its occurrences in the corpus, the share at which a
   sentence ends. Together with the closing shape (mark of a cut, sentence end, closed quote or bracket, table row, caption, bare word) it goes into
   boosted trees that tell whole texts from texts cut on purpose: CUT_ROWS texts of the corpus by hash, each as it stands
   and cut at a place of its own, some with a mark. PRIOR_ROWS made-up rows of each shape stand for what a small corpus cannot teach. Page furniture
   after the text is set aside first. A closing word can so move any shape over the threshold.

Defined results: null and blank texts are never found; a claim delivered twice counts once; ties between
longest texts go to the smaller id; very long texts are read whole; an empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.boost import BoostedTrees
from claimloom.llm.new_batches import _mix
from claimloom.llm.scan_noise import HEAD_WORDS, ISSUE, PAGE, side_number
from claimloom.session import checkpoint

SHINGLE, BANDS, BAND_ROWS, LIKE = 5, 9, 4, 0.8
MANY, BLOCK, BLOCK_CHARS = 256, 1_024, 2_000_000
CUT_MARK = regex.compile(r"(?:…|\.\.\.|\[\s*(?:…|\.\.\.)\s*\]|\(\s*(?:…|\.\.\.)\s*\)|\[?(?:more|read more|continued|cont\.)\]?\W*|&\w{1,6}|�|(?<=\w)-)$", regex.I)
CLOSED = regex.compile(r"[.!?][\"'”’»)\]]*$")
CAPTION = regex.compile(r"^\W*(?:table|tab\.|figure|fig\.?|chart|map|plate|box|photo|tabelle|abbildung|abb\.|tableau|tabla|figura)\s*\d+\s*[.:–-]", regex.I)
OPEN_PAIRS = (("“", "”"), ("«", "»"), ("(", ")"), ("[", "]"))
#: after these a sentence goes on even with a capital; after the others with a number
TITLE = regex.compile(r"(?<!\w)(?:dr|mr|mrs|ms|prof|cf|vs|viz|approx|e\.\s?g|i\.\s?e|z\.\s?b|bzw|vgl|et al)\.$", regex.I)
ABBREVIATION = regex.compile(r"(?<!\w)(?:\p{L}|(?:\p{L}\.)+\p{L}|ca|est|max|min|avg|no|nos|nr|figs?|tab|eq|vol|pp|eds?|ch|sect?|abb)\.$", regex.I)
WORDS = regex.compile(r"\S+")
TERMINALITY = 0.5


def body(text: str) -> str:
    """The text itself: page furniture after it is set aside."""
    lines = [x for x in text.rstrip().split("\n") if x.strip()]
    while len(lines) > 1:
        s = lines[-1].strip()
        if (PAGE.match(s) or side_number(lines[-1]) or ISSUE.search(s) or (HEAD_WORDS.search(s) and not s.endswith("."))) and not CUT_MARK.search(s) or (lines[-1].isupper() and len(lines[-1]) > 12 and not s.endswith(".")):
            lines.pop()
        else:
            break
    return "\n".join(lines).rstrip()


def body_end(text: str) -> str:
    """The last line of the text itself."""
    return body(text).rpartition("\n")[2]


def shape(text: str) -> str:
    """How a text ends: empty, table, caption, mark, closed, open (a sentence end within an unclosed quote or bracket), bracket, bare."""
    end = body_end(text)
    if not end:
        return "empty"
    if CUT_MARK.search(end):
        return "mark"
    cells = end.split("|")
    if len(cells) >= 3 and all(c.strip() for c in cells):
        return "table"
    if CAPTION.match(end):
        return "caption"
    if CLOSED.search(end):
        quote, close = OPEN_PAIRS[0]
        return "open" if text.lstrip().startswith(quote) and close not in text else "closed"
    if end[-1] in ")]”»":
        opened = dict((c, o) for o, c in OPEN_PAIRS)[end[-1]]
        return "bracket" if text.count(opened) >= text.count(end[-1]) and opened in text else "bare"
    return "bare"


#: Terminality of a closing shape where nothing is known of the corpus (fixed values).
SHAPES = {"empty": 1.0, "table": 0.9, "caption": 0.9, "closed": 0.95, "bracket": 0.85, "open": 0.3, "mark": 0.02, "bare": 0.2}
CUT_ROWS, PRIOR_ROWS = 4_000, 20
MARKS = ("…", "...", " […]", "-")


def closing_word(text: str) -> str:
    """The closing word of a text in lower case, bare of marks."""
    words = body(text).split()
    return bare_word(words[-1].lower()) if words else ""


def bare_word(token: str) -> str:
    """A word bare of marks; all numbers are one word."""
    w = token.strip(".,;:!?…\"'”“’‘»«()[]-")
    return "#" if w[:1].isdigit() and not any(c.isalpha() for c in w) else w


def made_cuts(text: str, k: int) -> Iterator[str]:
    """A text cut at three places that depend on k, in its second half, once with a mark, and a quoted text at a sentence end."""
    for j in range(3):
        at = len(text) // 2 + ((3 * k + j) * 2654435761 % 2**32) * (len(text) // 2) // 2**32
        cut = text[:at].rstrip()
        if cut:
            yield cut + MARKS[k % len(MARKS)] if j == 0 else cut
    if text.lstrip().startswith("“") and (ends := [m.end() for m in regex.finditer(r"[.!?](?=\s)", text)]):
        yield text[: ends[k % len(ends)]]


TYPES = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()))


def closing(claims: DataFrame) -> DataFrame:
    """Of each text claim_id, source_domain, text_id, n_chars, shape, word (the closing word, lower case), n_words and bands; and rows
    without claim_id that count each word: n_chars its occurrences, n_words those at which a sentence ends (partial counts of a task)."""
    rng = np.random.default_rng(5)
    mult = rng.integers(1, 2**63, BANDS * BAND_ROWS, dtype=np.uint64) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, int] = {}
        tokens: Counter = Counter()
        names = ["claim_id", "source_domain", "text_id", "n_chars", "shape", "word", "n_words", "bands"]

        def counted() -> pa.RecordBatch:
            uses: Counter = Counter()
            ends: Counter = Counter()
            for token, n in tokens.items():
                w = bare_word(token)
                uses[w] += n
                ends[w] += n if CLOSED.search(token) else 0
            tokens.clear()
            cols = {"word": pa.array(list(uses), pa.string()), "n_chars": pa.array(list(uses.values()), pa.int64()), "n_words": pa.array([ends[w] for w in uses], pa.int64())}
            return pa.RecordBatch.from_arrays([cols.get(c, pa.nulls(len(uses), t)) for c, t in zip(names, TYPES)], names=names)

        def hashed(w: str) -> int:
            h = memo.get(w)
            if h is None:
                if len(memo) > 300_000:
                    memo.clear()
                h = memo[w] = xxhash.xxh64_intdigest(w)
            return h

        for b in batches:
            texts = b.column("evidence_text").to_pylist()
            keep = [i for i, t in enumerate(texts) if t and not t.isspace()]
            if not keep:
                continue
            words = [texts[i].lower().split() for i in keep]
            for ws in words:
                tokens.update(ws)
            if len(tokens) > 400_000:  # bounds the worker's memory
                yield counted()
            flat = np.fromiter((hashed(w) for ws in words for w in ws), np.uint64, sum(map(len, words)))
            size = np.fromiter(map(len, words), np.int64, len(words))
            starts = np.cumsum(size) - size
            h, last = flat.copy(), np.repeat(starts + size - 1, size)
            at = np.arange(len(flat))
            for k in range(1, SHINGLE):
                inside = at + k <= last
                h = np.where(inside, _mix(h * np.uint64(0x9E3779B97F4A7C15) + flat[np.minimum(at + k, len(flat) - 1)]), h)
            whole = (at + SHINGLE - 1 <= last) | (at == np.repeat(starts, size))  # short texts have one shingle
            total = np.concatenate(([0], np.cumsum(whole)))
            h, first = h[whole], total[starts]
            bands = np.empty((len(words), BANDS), np.int64)
            for band in range(BANDS):
                acc = np.full(len(words), np.uint64(band + 1))
                for r in range(BAND_ROWS):
                    acc = _mix(acc * np.uint64(0xC2B2AE3D27D4EB4F) + np.minimum.reduceat(h * mult[band * BAND_ROWS + r], first))
                bands[:, band] = acc.view(np.int64)
            kinds = [shape(texts[i]) for i in keep]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("claim_id").take(pa.array(keep)), b.column("source_domain").take(pa.array(keep)), b.column("text_id").take(pa.array(keep)), pa.array([len(texts[i]) for i in keep], pa.int64()), pa.array(kinds), pa.array([closing_word(texts[i]) for i in keep]), pa.array(size),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)), pa.array(bands.ravel())),
                ],
                names=names,
            )
        yield counted()

    return claims.select("claim_id", "source_domain", "evidence_text", F.xxhash64("evidence_text").alias("text_id")).mapInArrow(run, "claim_id string, source_domain string, text_id bigint, n_chars bigint, shape string, word string, n_words bigint, bands array<bigint>")


def end_in(copy: str, longer: str) -> int | None:
    """Where in the longer text the copy's alignment ends (a position in characters); None where it doesn't end early.

    At least nine tenths of the copy's words but the last stand in order before that place, and the copy's last word is the one that ends
    there, or its beginning. Of several such places the one with most words in common counts, then the one nearest to the copy's own length.
    """
    a, b = copy.split(), list(WORDS.finditer(longer))
    if not a or len(a) > len(b) or len(copy) >= len(longer):
        return None
    last = a[-1].rstrip("…") or a[-1]
    n, slack = len(a), len(a) // 10
    ends = [j for j in range(max(1, n - slack), min(len(b), n + slack) + 1) if b[j - 1].group().startswith(last)]
    if not ends:
        return None
    y = [m.group() for m in b[: ends[-1]]]
    common = _prefix_common(a[:-1], y, [j - 1 for j in ends])
    best = max(range(len(ends)), key=lambda i: (common[i], -abs(ends[i] - n)))
    if common[best] < 0.9 * (n - 1):
        return None
    end = b[ends[best] - 1].start() + len(last)
    return end if longer[end:].strip() else None


def _prefix_common(x: list[str], y: list[str], stops: list[int]) -> list[int]:
    """Longest common subsequences of x with y[:stop] for each of the rising stops."""
    if x == y[: len(x)]:  # an exact copy up to its last word
        return [min(stop, len(x)) for stop in stops]
    place: dict[str, int] = {}
    for i, w in enumerate(x):
        place[w] = place.get(w, 0) | 1 << i
    full = (1 << len(x)) - 1
    row, done, out = full, 0, []
    for stop in stops:
        for w in y[done:stop]:
            u = row & place.get(w, 0)
            row = ((row + u) | (row - u)) & full
        done = stop
        out.append(len(x) - row.bit_count())
    return out


def same_matter(x: list[str], y: list[str]) -> bool:
    """Whether texts that are alike differ only in dropped or misspelt words: another name or number makes another row or sentence."""
    for op, a, b, c, d in SequenceMatcher(None, x, y, autojunk=False).get_opcodes():
        if op == "replace":
            u, v = "".join(x[a:b]), "".join(y[c:d])
            if [w for w in u if w.isdigit()] != [w for w in v if w.isdigit()] or SequenceMatcher(None, u, v, autojunk=False).ratio() < 0.75:
                return False
    return True


def breaks_off(copy: str, longer: str) -> bool:
    """Whether the copy ends inside a word, sentence, row or caption of the longer text."""
    copy, longer = body(copy), body(longer)
    at = end_in(copy, longer)
    if at is None:
        return False
    end, rest = longer[:at].rpartition("\n")[2], longer[at:]
    line = rest.partition("\n")[0]
    kind = shape(copy)
    if kind in ("mark", "empty"):
        return kind == "mark"
    whole, before = copy.split()[:-1], longer[:at].split()[:-1]
    if whole != before and kind in ("closed", "table", "caption", "bracket") and not same_matter(whole, before):
        return False
    glued, after = line[:1], line.lstrip()
    word_goes_on = bool(glued) and (glued.isalnum() or glued in "-'’" and line[1:2].isalnum())
    if kind == "table":
        return word_goes_on or any(c.isalnum() for c in line)
    if kind == "caption" and CAPTION.fullmatch(end):
        return bool(after)
    if CLOSED.search(end):
        if glued.isalnum() and not glued.isupper():
            return True  # a decimal point, or a point inside a word
        return after[:1].islower() or bool(TITLE.search(end)) or after[:1].isdigit() and bool(ABBREVIATION.search(end))
    if word_goes_on:
        return True
    # no sentence ends here: what stands after it on the line belongs to the same sentence, unless it is only a closing mark
    return any(c.isalnum() for c in line) and not regex.match(r"[.!?][\"'”’»)\]]*(?:\s|$)", line)


def copy_buckets(closings: DataFrame) -> DataFrame:
    """id, n_chars, band, n, chars: the different texts of each bucket that holds more than one, with the rows and characters of the bucket."""
    rows = closings.select(F.col("text_id").alias("id"), "n_chars", F.explode("bands").alias("band"))
    sizes = rows.groupBy("band").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high").select("band", "n", "chars")
    return checkpoint(rows.join(sizes.hint("merge"), "band").distinct())


def copy_pairs(shared: DataFrame) -> DataFrame:
    """(id, other): texts and the longer ones of their buckets of at most MANY rows."""
    few = shared.where(F.col("n") <= MANY).select("band", "id", "n_chars")
    other = few.select("band", F.col("id").alias("other"), F.col("n_chars").alias("m_chars"))
    return few.join(other.hint("merge"), "band").where("n_chars < m_chars").select("id", "other").distinct()


def cut_in_block(ids: np.ndarray, texts: list[str], block: np.ndarray, bands: np.ndarray, k: int) -> list[int]:
    """ids of the texts that break off where a longer one goes on: pairs of two blocks, or of the one block where all are of one, that share no band before band k.

    A text is aligned only with those longer ones in which, about its own length, a word begins with its closing word and more follows: without that end_in finds no end.
    """
    bodies = [body(t) for t in texts]
    words = [[m.group() for m in WORDS.finditer(t)] for t in bodies]
    size, chars = np.array([len(w) for w in words]), np.array([len(t) for t in bodies])
    vocab = sorted({w for ws in words for w in ws})
    rank = {w: i for i, w in enumerate(vocab)}
    flat = np.fromiter((rank[w] for ws in words for w in ws), np.int64, int(size.sum()))
    owner, starts = np.repeat(np.arange(len(texts)), size), np.cumsum(size) - size
    left = np.repeat(size, size) - (np.arange(len(flat)) - np.repeat(starts, size)) - 1  # words after it
    place = np.repeat(size, size) - left  # from 1
    raw, length = np.array([len(t) for t in texts]), np.array([len(w) for w in vocab])
    across = len(np.unique(block)) > 1
    out = []
    for i, text in enumerate(bodies):
        a = text.split()
        if not a:
            continue
        last = a[-1].rstrip("…") or a[-1]
        low = bisect_left(vocab, last)
        high = bisect_right(vocab, last, lo=low, key=lambda w: w[: len(last)])
        n, slack = len(a), len(a) // 10
        ends = (flat >= low) & (flat < high) & (place >= max(1, n - slack)) & (place <= n + slack)
        ends &= (left > 0) | (length[flat] > len(last))
        others = np.unique(owner[ends])
        others = others[(raw[others] > raw[i]) & (chars[others] > chars[i]) & (size[others] >= n)]
        if across:
            others = others[block[others] != block[i]]
        if k:
            others = others[~(bands[others, :k] == bands[i, :k]).any(axis=1)]
        if any(breaks_off(texts[i], texts[o]) for o in others):
            out.append(int(ids[i]))
    return out


def cut_in_hot(shared: DataFrame, texts: DataFrame, bands: DataFrame) -> DataFrame:
    """text_id of texts that break off where a longer one of a bucket of more than MANY rows goes on. texts: id, evidence_text; bands: id, bands; one row a text."""
    hot = shared.where(F.col("n") > MANY)
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("chars") / BLOCK_CHARS)).cast("int")
    full = hot.select("id", "band", blocks.alias("blocks")).join(bands.hint("merge"), "id").join(texts.hint("merge"), "id")  # the texts come before the rows are repeated for their blocks
    dealt = full.withColumn("block", F.pmod(F.xxhash64("id", "band"), "blocks").cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = dealt.select("id", "band", "bands", "evidence_text", "block", F.least("block", "x").alias("i"), F.greatest("block", "x").alias("j"))

    def run(t: pa.Table) -> pa.Table:
        b = t.combine_chunks()
        own = np.array(b.column("bands").to_pylist(), np.int64).reshape(-1, BANDS)
        block = b.column("block").to_numpy()
        across = b.column("i")[0].as_py() != b.column("j")[0].as_py()
        found: list[int] = []
        if len(own) > 1 and (not across or len(np.unique(block)) > 1):
            k = int(np.argmax(own[0] == b.column("band")[0].as_py()))
            found = cut_in_block(b.column("id").to_numpy(), b.column("evidence_text").to_pylist(), block, own, k)
        return pa.table({"text_id": pa.array(found, pa.int64())})

    return cells.groupBy("band", "i", "j").applyInArrow(run, "text_id bigint")


def cut_copies(claims: DataFrame, closings: DataFrame) -> DataFrame:
    """claim_id of texts that break off where a longer near-copy goes on. No side of these joins has a bound, so none is broadcast by an estimate."""
    shared = copy_buckets(closings)
    pairs = checkpoint(copy_pairs(shared))
    hot = shared.where(F.col("n") > MANY).select("id").distinct()
    needed = pairs.select(F.explode(F.array("id", "other")).alias("id")).union(hot).distinct()
    t = claims.select("evidence_text", F.xxhash64("evidence_text").alias("id")).join(needed.hint("merge"), "id", "left_semi").dropDuplicates(["id"])
    j = pairs.join(t.hint("merge"), "id").join(t.select(F.col("id").alias("other"), F.col("evidence_text").alias("longer")).hint("merge"), "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [breaks_off(x, y) for x, y in zip(b.column("evidence_text").to_pylist(), b.column("longer").to_pylist())]
            yield b.select(["text_id"]).filter(pa.array(ok, pa.bool_()))

    cut = j.select(F.col("id").alias("text_id"), "evidence_text", "longer").mapInArrow(run, "text_id bigint")
    bands = closings.select(F.col("text_id").alias("id"), "bands").join(hot.hint("merge"), "id", "left_semi").dropDuplicates(["id"])
    cut = cut.union(cut_in_hot(shared, t, bands)).distinct()
    return closings.join(cut.hint("merge"), "text_id", "left_semi").select("claim_id").distinct()


def _rows(kinds: list[str], uses: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Features of closings: the shape, the word's terminality (drawn to a half where it is rare), how frequent it is."""
    shapes = np.array([[k == x for x in SHAPES] for k in kinds], float).reshape(-1, len(SHAPES))
    return np.column_stack([shapes, (ends + 1.0) / (uses + 2.0), np.log1p(uses)])


def fit_terminality(claims: DataFrame, words: DataFrame, rows: int) -> BoostedTrees:
    """Trees that tell whether a text with a closing shape and word was cut. claims: evidence_text; words: word, uses, ends; rows: claims."""
    share = min(1.0, 4.0 * CUT_ROWS / max(1, rows))
    picked = claims.where(F.col("evidence_text").isNotNull() & (F.pmod(F.xxhash64("evidence_text"), F.lit(2**62)) <= F.lit(int(2**62 * share))))
    sample = picked.select("evidence_text").distinct().orderBy(F.xxhash64("evidence_text"), "evidence_text").limit(CUT_ROWS).collect()
    made = []
    for k, r in enumerate(sample):
        text = body(r[0])
        if text:
            made += [(shape(text), closing_word(text), 0), *((shape(c), closing_word(c), 1) for c in made_cuts(text, k) if shape(text) not in ("table", "caption"))]
    spark = claims.sparkSession
    known = {}
    if made:
        asked = spark.createDataFrame([(w,) for w in sorted({m[1] for m in made})], "word string")  # at most 3 x CUT_ROWS words
        known = {r["word"]: (r["uses"], r["ends"]) for r in words.join(F.broadcast(asked), "word").collect()}
    prior = [(k, "", int(i >= v * PRIOR_ROWS)) for k, v in SHAPES.items() for i in range(PRIOR_ROWS)]
    every = made + prior
    uses, ends = np.array([known.get(w, (0, 0)) for _, w, _ in every], float).reshape(-1, 2).T
    return BoostedTrees(rounds=40).fit(_rows([k for k, _, _ in every], uses, ends), np.array([y for *_, y in every]))


def judged(claims: DataFrame) -> DataFrame:
    """claim_id, source_domain, shape, terminality, by_copy, cut: one row a claim with text.

    terminality: the probability that a text with this closing shape and word is whole.
    """
    both = checkpoint(closing(claims))
    c = both.where("claim_id is not null")
    words = both.where("claim_id is null").groupBy("word").agg(F.sum("n_chars").alias("uses"), F.sum("n_words").alias("ends"))
    model = fit_terminality(claims, words, c.count())
    shared = claims.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _rows(b.column("shape").to_pylist(), b.column("uses").to_numpy(zero_copy_only=False), b.column("ends").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([b.column("shape"), b.column("word"), pa.array(1.0 - shared.value.predict(x))], names=["shape", "word", "terminality"])

    closings = c.select("shape", "word").distinct().join(words.hint("merge"), "word", "left").select("shape", "word", *[F.coalesce(x, F.lit(0)).cast("double").alias(x) for x in ("uses", "ends")])
    scored = c.join(closings.mapInArrow(score, "shape string, word string, terminality double").hint("merge"), ["shape", "word"])
    copies = cut_copies(claims, c).withColumn("by_copy", F.lit(True))
    s = scored.join(copies.hint("merge"), "claim_id", "left").withColumn("by_copy", F.coalesce("by_copy", F.lit(False)))
    s = s.withColumn("cut", F.col("by_copy") | (F.col("terminality") < TERMINALITY))
    return s.groupBy("claim_id").agg(F.min("source_domain").alias("source_domain"), F.min("shape").alias("shape"), F.min("terminality").alias("terminality"), F.max("by_copy").alias("by_copy"), F.max("cut").alias("cut"))
