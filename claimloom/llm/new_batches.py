"""Deduplicating new batches against all history: keys, tokens, signatures, index shards, verification, groups.

Exact links: equal text (white space aside), content hash, canonical URL, DOI. Near-copies: texts with
at least LIKE of the words in common and in order, lines of the site aside. Every text becomes a
min-hash signature of word pairs; ROUTES of its min-hash values route it to index shards (a shard
holds about SHARD_ROWS routed rows at any size of the corpus). A shard keeps a navigable small-world
graph per history segment (small_world): each arriving batch is searched in the graphs of its history and in its
own and becomes a new segment; segments are merged by a fixed schedule. What is kept between batches, and how a batch is added
without reading the texts of the history, is in batch_index. Candidates are verified exactly (longest common
subsequence of words). Links are closed by hash-to-min contraction.

Where a beam is full of near nodes, and in a graph whose recall is too low, all nodes with the query's own route value
are compared (an exact range scan in the shard). Up to FAMILY near nodes of a text become pairs, those of one group aside; a text with more is compared with
all texts of its route value in blocks (scanned), again those of its own group aside.

Hot keys: copies of one text are one row of the index; lines are the site's own where they stand in at least LINE_COUNT and
LINE_SITE_SHARE of the documents of one site, and in different texts (copies make no line a site's own). Word pairs that stand in more than COMMON of
all texts take no part in half of the routes; a route value that still holds more than SHARD_ROWS rows is split by the
text's next value, then by three further min-hash values, one after the other; what is still hot then holds texts that agree in all of
them, is dealt over salts that share its smallest documents, and its texts are compared in blocks.

Defined results: blank and null texts, hashes, URLs and DOIs link nothing; texts without a rare word
pair are routed by all their pairs; one-word texts by the word; repeated rows (same doc_id) are one
document; very long texts are read whole; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.hosts import site_of
from claimloom.llm.small_world import BEAM, DEGREE, EXACT, SIGNATURE, Graph, Segments, distances
from claimloom.session import checkpoint

LIKE, ROUTES, SHARD_ROWS, LIMIT, PIVOTS = 0.9, 8, 16_384, 22, 64
BUCKETS, COMMON = 1 << 16, 0.01
HALF_LIMIT, EXTRA, ALL_LIMIT, BAG, BLOCK, FAMILY = 11, 48, 31, 256, 4096, 64
LINE_SITE_SHARE, LINE_SHARE, LINE_COUNT, LINE_LETTERS, LINE_DIVERSE = 0.01, 2e-6, 8, 12, 0.5
BROADCAST_IDS = 500_000
ONE_TASK_LINKS = 1_000_000
HUB = 1_000_000  # rows of one key from which it is joined by broadcast
EMPTY_SHA = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
TRACKING = r"(?:utm_[a-z]+|fbclid|gclid|dclid|msclkid|mc_cid|mc_eid|igshid|yclid|_ga)"
WORD, WORD_OR_LINE = re.compile(r"\w+"), re.compile(r"\w+|\n")
CHUNK_CHARS = 1 << 25
#: what a line's key leaves out: ASCII that is no letter (line feeds part the lines), and usual signs
NO_ASCII = bytes(c for c in range(128) if not chr(c).isalpha() and c != 10)
WHITE = b" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"  # what str.split() parts ASCII text at
#: usual signs beyond ASCII as UTF-8: U+0080 to U+00BF, dashes, quotes, bullet, ellipsis, zero width space
SIGNS = re.compile(rb"\xc2[\x80-\xbf]|\xe2\x80[\x8b\x93\x94\x98\x99\x9c\x9d\xa2\xa6]")


class _Words(dict):
    """word -> 31-bit hash, filled as words come; bounded by MEMO_WORDS. A line feed is -1."""

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh32_intdigest(word) & 0x7FFFFFFF if word != "\n" else -1
        return h


_WORDS, MEMO_WORDS = _Words(), 1_000_000


def url_key(col: Column) -> Column:
    """Scheme, www., letter case of the host, closing slash, fragment and tracking parameters aside; null for front pages."""
    u = F.regexp_replace(F.trim(col), r"#.*$", "")
    u = F.regexp_replace(u, r"(?i)^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(u, r"^([^/?]*)", 1)), r"^www\.", ""), r"(?::\d*)?\.?$", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(u, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(rf"^{TRACKING}(=|$)")))
    q = F.array_join(kept, "&")
    return F.when((host != "") & ((path != "") | (q != "")), F.concat(F.lit("u:"), host, path, F.when(q != "", F.concat(F.lit("?"), q)).otherwise("")))


def doi_key(col: Column) -> Column:
    d = F.regexp_replace(F.lower(F.trim(col)), r"^(?:https?://)?(?:dx\.)?(?:www\.)?doi\.org/", "")
    d = F.regexp_replace(d, r"^(?:doi)?[\s:]*", "")
    d = F.regexp_replace(F.regexp_replace(d, r"\s+", ""), r"[.,;:)\]}>\"'/]+$", "")
    return F.when(d.rlike(r"^10\.\d{3,9}/.+") & ~d.startswith("10.99999/"), F.concat(F.lit("d:"), d))


def hash_key(col: Column) -> Column:
    h = F.lower(F.trim(col))
    return F.when((h != "") & (h != EMPTY_SHA) & h.rlike(r"^[0-9a-f]{16,}$"), F.concat(F.lit("c:"), h))


def split_join(rows: DataFrame, small: DataFrame, on: list[str], count: int) -> DataFrame:
    """rows (`count` of them) joined with small (one row a key, its number of rows in `n`): keys of more than HUB rows, of which there are at most |rows| / HUB, by broadcast."""
    if count <= HUB:  # no key can have more
        return rows.join(small, on).drop("n")
    hubs = F.broadcast(small.where(F.col("n") > HUB))
    return rows.join(hubs, on).unionByName(rows.join(hubs.select(*on), on, "left_anti").join(small.where(F.col("n") <= HUB), on)).drop("n")


def _word_hashes(words: list[str]) -> np.ndarray:
    if len(_WORDS) > MEMO_WORDS:
        _WORDS.clear()
    return np.fromiter(map(_WORDS.__getitem__, words), np.int32, len(words))


def long_enough(k: bytes) -> bool:
    """Whether UTF-8 text has LINE_LETTERS characters."""
    return len(k) >= LINE_LETTERS and (k.isascii() or len(k) >= 4 * LINE_LETTERS or len(k.decode("utf-8", "surrogatepass")) >= LINE_LETTERS)


def tokenise(docs: DataFrame) -> DataFrame:
    """doc_id, batch_no, site, t1, t2 (hash of the text without white space), words (int32 bytes), line_key, line_words of every text that isn't blank; docs: doc_id, batch_no, site (hash), text."""

    def some(rows: list[tuple]) -> pa.RecordBatch:
        tokens: list[str] = []
        keys: list[int] = []
        lines, t1, t2 = [], [], []
        for *_, text in rows:
            low = text.lower()
            tokens += WORD_OR_LINE.findall(low)
            tokens.append("\n")
            letters = low.encode("utf-8", "surrogatepass").translate(None, NO_ASCII)
            letters = (letters if letters.isascii() else SIGNS.sub(b"", letters)).split(b"\n")
            keys += [xxhash.xxh64_intdigest(k) - (1 << 63) if long_enough(k) else 0 for k in letters]
            lines.append(len(letters))
            t = xxhash.xxh3_128_intdigest(text.encode().translate(None, WHITE) if text.isascii() else "".join(text.replace("\u200b", "").split()))
            t1.append((t >> 64) - (1 << 63))
            t2.append((t & (1 << 64) - 1) - (1 << 63))
        arr, n = _word_hashes(tokens), np.array(lines, np.int64)
        feed = arr < 0
        words = arr[~feed]
        sizes = np.bincount((np.cumsum(feed) - feed)[~feed], minlength=len(keys)).astype(np.int32)
        owner = np.repeat(np.arange(len(rows)), n)
        count = np.bincount(owner, sizes, len(rows)).astype(np.int64)
        has, real = np.flatnonzero(count), sizes > 0
        per = np.bincount(owner[real], minlength=len(rows))[has]
        offset = pa.py_buffer(np.concatenate(([0], np.cumsum(4 * count[has]))).astype(np.int32))
        of_line = pa.array(np.concatenate(([0], np.cumsum(per))).astype(np.int32))
        column = lambda x, kind: pa.array([x[i] for i in has], kind)
        return pa.RecordBatch.from_arrays(
            [
                *[column([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.int64()))], column(t1, pa.int64()), column(t2, pa.int64()),
                pa.Array.from_buffers(pa.binary(), len(has), [None, offset, pa.py_buffer(words)]), pa.ListArray.from_arrays(of_line, pa.array(np.array(keys, np.int64)[real])), pa.ListArray.from_arrays(of_line, pa.array(sizes[real])),
            ],
            names=["doc_id", "batch_no", "site", "t1", "t2", "words", "line_key", "line_words"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, chars = [], 0
            for row in zip(*[b.column(c).to_pylist() for c in ("doc_id", "batch_no", "site", "text")]):
                if row[3] and not row[3].isspace():
                    held.append(row)
                    chars += len(row[3])
                    if chars > CHUNK_CHARS:  # bounds the worker's memory, and a column's bytes
                        yield some(held)
                        held, chars = [], 0
            if held:
                yield some(held)

    return docs.select("doc_id", "batch_no", "site", "text").mapInArrow(run, "doc_id bigint, batch_no int, site bigint, t1 bigint, t2 bigint, words binary, line_key array<bigint>, line_words array<int>")


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


def _content(batch: pa.RecordBatch, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(words of all texts without the site's lines, start of each text); a text of such lines alone keeps them."""
    col = batch.column("words")
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1] if pa.types.is_binary(col.type) else np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    words = np.frombuffer(col.buffers()[2], np.int32)[off[0] // 4 : off[-1] // 4] if off[-1] > off[0] else np.zeros(0, np.int32)
    starts = ((off - off[0]) // 4).astype(np.int64)
    if own is None or not len(own):
        return words, starts
    keys, sizes = batch.column("line_key").flatten().to_numpy(zero_copy_only=False), batch.column("line_words").flatten().to_numpy(zero_copy_only=False)
    drop = np.isin(keys, own)
    keep = ~np.repeat(drop, sizes)
    total = np.concatenate(([0], np.cumsum(keep)))
    left = total[starts[1:]] - total[starts[:-1]]
    for i in np.flatnonzero(left == 0):  # nothing else stands there
        keep[starts[i] : starts[i + 1]] = True
    total = np.concatenate(([0], np.cumsum(keep)))
    return words[keep], total[starts]


def _pairs(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word pair, start of each text's pairs); a text of one word has that word."""
    w = words.astype(np.uint64)
    h = _mix(w * np.uint64(0x9E3779B97F4A7C15) + np.append(w[1:], np.uint64(0)) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1))
    size = np.diff(starts)
    last = starts[1:][size > 1] - 1  # the last word starts no pair
    keep = np.ones(len(h), bool)
    keep[last] = False
    total = np.concatenate(([0], np.cumsum(keep)))
    return h[keep], total[starts]


def token_counts(tokens: DataFrame) -> DataFrame:
    """kind, site, key, n: texts with a word pair's bucket ('p'), texts of a site with a line ('l'), texts of a site ('s'), texts and word pairs ('n', 'w'). Counts of several loads add up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n, pairs = np.zeros(BUCKETS, np.int64), 0, 0
        lines: Counter = Counter()
        sites: Counter = Counter()

        def flush(final: bool) -> Iterator[pa.RecordBatch]:
            rows = [("l", s, k, c) for (s, k), c in lines.items()]
            lines.clear()
            if final:
                at = np.flatnonzero(seen)
                rows += [*(("p", 0, int(k), int(seen[k])) for k in at), *(("s", s, 0, c) for s, c in sites.items()), ("n", 0, 0, n), ("w", 0, 0, pairs)]
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *[pa.array(c, pa.int64()) for c in cols[1:]]], names=["kind", "site", "key", "n"])

        for b in batches:
            n += b.num_rows
            if not b.num_rows:
                continue
            h, starts = _pairs(*_content(b, None))
            # each bucket once a text
            owned = np.sort(np.repeat(np.arange(b.num_rows, dtype=np.uint32) << np.uint32(16), np.diff(starts)) | (h & np.uint64(BUCKETS - 1)).astype(np.uint32)) if b.num_rows < BUCKETS else np.unique(np.repeat(np.arange(b.num_rows), np.diff(starts)) * BUCKETS + (h & np.uint64(BUCKETS - 1)).astype(np.int64))
            owned = owned[np.append(True, owned[1:] != owned[:-1])]
            pairs += len(owned)
            seen += np.bincount((owned & (BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
            site = b.column("site").to_pylist()
            sites.update(site)
            for s, keys in zip(site, b.column("line_key").to_pylist()):
                lines.update({(s, k) for k in keys if k})
            if len(lines) > 400_000:  # bounds the worker's memory
                yield from flush(False)
        yield from flush(True)

    return tokens.mapInArrow(run, "kind string, site bigint, key bigint, n bigint").groupBy("kind", "site", "key").agg(F.sum("n").alias("n"))


def common_buckets(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """(buckets of common word pairs, keys of the site's lines, texts), both of bounded size."""
    return flags(checkpoint(token_counts(tokens)), tokens)


def flags(counts: DataFrame, tokens: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """As common_buckets, by counts; whether a line stands in different texts is told by `tokens`.

    A bucket is common where it stands in COMMON of the texts more than the average bucket does three times: the average
    grows with the length of the texts, and a bucket of chance meetings is none of a template.
    """
    total = {r["kind"]: r["n"] for r in counts.where("kind in ('n', 'w', 'l')").groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    texts, lines = total.get("n", 0), total.get("l", 0)
    least = max(8, COMMON * texts + 3.0 * total.get("w", 0) / BUCKETS)
    pairs = counts.where((F.col("kind") == "p") & (F.col("n") > least)).select("kind", "key")
    docs = counts.where("kind = 's'").select("site", F.col("n").alias("docs"))
    found = counts.where((F.col("kind") == "l") & (F.col("n") >= max(LINE_COUNT, LINE_SHARE * lines))).join(docs, "site").where(F.col("n") >= LINE_SITE_SHARE * F.col("docs"))
    both = pairs.unionByName(found.select(F.lit("l").alias("kind"), "key")).distinct().toPandas()  # at most BUCKETS + 1 / LINE_SHARE rows
    common, maybe = (both.loc[both["kind"] == k, "key"].to_numpy(np.int64) for k in "pl")
    return common, _diverse_lines(tokens, common, np.sort(maybe)), texts


def _diverse_lines(tokens: DataFrame, common: np.ndarray, maybe: np.ndarray) -> np.ndarray:
    """Of the lines that are frequent on a site those that stand in different texts: lines of much-copied texts are no site's own.

    A text is told by its two least rare word pairs, which most near-copies share; LINE_DIVERSE of the
    texts of a site with the line must differ in them.
    """
    if not len(maybe):
        return maybe
    flag = np.zeros(BUCKETS, bool)
    flag[common] = True
    shared = tokens.sparkSession.sparkContext.broadcast((flag, maybe))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flag_, maybe_ = shared.value
        for b in batches:
            keys = b.column("line_key")
            flat = keys.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(b.num_rows), np.diff(keys.offsets.to_numpy()))
            hit = np.isin(flat, maybe_)
            if not hit.any():
                continue
            h, starts = _pairs(*_content(b, None))
            rare = ~flag_[(h & np.uint64(BUCKETS - 1)).astype(np.int64)]
            h = np.where(rare, h, np.uint64(2**64 - 1))
            told = np.minimum.reduceat(h, starts[:-1]) ^ _mix(np.minimum.reduceat(np.where(rare, _mix(h), h), starts[:-1]))
            at = owner[hit]
            yield pa.RecordBatch.from_arrays([b.column("site").take(pa.array(at)), pa.array(flat[hit]), pa.array(told[at].view(np.int64))], names=["site", "key", "told"])

    seen = tokens.select("site", "words", "line_key", "line_words").mapInArrow(run, "site bigint, key bigint, told bigint").groupBy("site", "key", "told").agg(F.count("*").alias("n"))
    judged = seen.groupBy("site", "key").agg(F.count("*").alias("texts"), F.sum("n").alias("n")).where((F.col("n") >= LINE_COUNT) & (F.col("texts") >= LINE_DIVERSE * F.col("n")))
    return np.sort(judged.select("key").distinct().toPandas()["key"].to_numpy(np.int64))


def signatures(tokens: DataFrame, common: np.ndarray, own: np.ndarray) -> DataFrame:
    """doc_id, batch_no, signature (bytes), route, value, next_value: ROUTES rows a text."""
    return by_route(signature_rows(tokens, common, own))


def by_route(rows: DataFrame) -> DataFrame:
    pair = F.col("v")
    return rows.select("doc_id", "batch_no", "signature", *[c for c in rows.columns if c in ("old", "load")], F.posexplode(F.arrays_zip("values", "nexts")).alias("route", "v")).withColumns({"value": pair["values"], "next_value": pair["nexts"]}).drop("v")


def signature_rows(tokens: DataFrame, common: np.ndarray, own: np.ndarray) -> DataFrame:
    """doc_id, batch_no, signature (bytes), values, nexts (of each route): one row a text."""
    flag = np.zeros(BUCKETS, bool)
    flag[common] = True
    shared = tokens.sparkSession.sparkContext.broadcast((flag, own))
    rng = np.random.default_rng(11)
    mult = rng.integers(1, 2**63, SIGNATURE + EXTRA, dtype=np.uint64) | np.uint64(1)
    width = SIGNATURE + EXTRA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flag_, own_ = shared.value
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            h, starts = _pairs(*_content(b, own_))
            size = np.diff(starts)
            rare = ~flag_[(h & np.uint64(BUCKETS - 1)).astype(np.int64)]
            total = np.concatenate(([0], np.cumsum(rare)))
            left = total[starts[1:]] - total[starts[:-1]]
            rare |= np.repeat(left == 0, size)
            total = np.concatenate(([0], np.cumsum(rare)))
            hr, sr = h[rare], total[starts]
            sig = np.zeros((n, width), np.uint8)
            first, second = [], []
            for k in range(width):
                # one half of the signature over the rare pairs, the other and the further bytes over all
                hk, sk = (hr, sr) if k < SIGNATURE // 2 else (h, starts)
                v = hk * mult[k]
                low = np.minimum.reduceat(v, sk[:-1])
                sig[:, k] = (_mix(low) >> np.uint64(40)).astype(np.uint8)
                # half of the routes go over the rare pairs, half over all: the edits of a near-copy may fall among the few rare pairs
                if k < SIGNATURE and k % (SIGNATURE // 2) < ROUTES // 2:
                    v = np.where(v == np.repeat(low, np.diff(sk)), np.uint64(2**64 - 1), v)
                    first.append(low)
                    second.append(np.minimum.reduceat(v, sk[:-1]))
            code = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), n, [None, pa.py_buffer(sig)]).cast(pa.binary())
            starts_ = pa.array(np.arange(0, n * ROUTES + 1, ROUTES, dtype=np.int32))
            lists = [pa.ListArray.from_arrays(starts_, pa.array(_mix(np.stack(x, 1).ravel()).view(np.int64))) for x in (first, second)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("batch_no"), code, *lists], names=["doc_id", "batch_no", "signature", "values", "nexts"])

    return tokens.select("doc_id", "batch_no", "words", "line_key", "line_words").mapInArrow(run, "doc_id bigint, batch_no int, signature binary, values array<bigint>, nexts array<bigint>")


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether signatures (n, words) may be of near-copies.

    A near-copy with a tenth of the words exchanged has at least two thirds of its word pairs in common, while its rare pairs may all
    differ: of the 16 bytes over all pairs at most HALF_LIMIT may be unequal, of these and the EXTRA further ones at most ALL_LIMIT (a pair at
    the bound of two thirds is lost with a chance of 0.4 %). Signatures without further bytes are near within LIMIT as well.
    """
    half, nav = SIGNATURE // 16, SIGNATURE // 8
    if a.shape[-1] == nav:
        return (distances(a, b) <= LIMIT) | (distances(a[..., half:], b[..., half:]) <= HALF_LIMIT)
    unequal = distances(a[..., half:nav], b[..., half:nav])
    ok = unequal <= HALF_LIMIT
    at = np.flatnonzero(ok)
    b = np.broadcast_to(b, a.shape)
    ok[at] = unequal[at] + distances(a[at, nav:], b[at, nav:]) <= ALL_LIMIT
    return ok


def search_shard(history: Segments, ids: np.ndarray, batch: np.ndarray, codes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, further pairs, asked): near (id, id) of each batch with its history and itself; what crowded route values hold besides; (id, key)
    of texts with more than FAMILY near texts under a key. The batches are added to the history."""
    none = np.zeros((2, 0), np.int64)
    out, more, asked = [none], [none], [none]

    def pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.stack([np.minimum(a, b), np.maximum(a, b)])[:, a != b]

    for no in np.unique(batch):
        m = batch == no
        q, k, i = codes[m], keys[m], ids[m]
        graph = Graph(q, k, i).tuned(LIMIT, near)
        for g in [*(s[3] for s in history.graphs), graph]:
            lo, hi = g.span(k)
            at = np.flatnonzero(hi - lo > (g is graph))  # a search starts at nodes with the query's own route value
            if not len(at):
                continue
            full = np.full(len(at), True)
            if g.beam != EXACT:
                node, dist = g.search(q[at], k[at], g.beam)
                ok = (dist <= LIMIT) & (node >= 0)
                full = ok.sum(1) >= BEAM
                r, c = np.nonzero(ok)
                sure = near(g.codes[node[r, c]], q[at[r]])
                r, c = r[sure], c[sure]
                # the first node of a query's own key as well: it ties the copies of a much-copied text together
                entry = g.by_key[lo[at]]
                e = np.flatnonzero(near(g.codes[entry], q[at]))
                out.append(pairs(np.concatenate([g.ids[node[r, c]], g.ids[entry[e]]]), i[at[np.concatenate([r, e])]]))
            f = at[full]
            if len(f):  # as many near nodes as the narrowest beam holds: nearer ones may hide others
                r, n = g.of_key(q[f], k[f], near)
                crowd = np.bincount(r, minlength=len(f))
                few = crowd[r] <= FAMILY
                (more if g.beam != EXACT else out).append(pairs(g.ids[n[few]], i[f[r[few]]]))
                many = f[crowd > FAMILY]
                asked.append(np.stack([i[many], k[many]]))
                if g.beam == EXACT:
                    keep = np.flatnonzero(~few & (np.arange(len(r)) - np.searchsorted(r, r) < BEAM))
                    out.append(pairs(g.ids[n[keep]], i[f[r[keep]]]))
        history.add(graph, int(no), int(no), LIMIT, near)
    return tuple(np.unique(np.concatenate(x, 1), axis=1) for x in (out, more, asked))


#: Bytes of the signature by which a hot value of a route is split after the next value: min-hash values that are no route's own.
SPLIT_BYTES = tuple(tuple((SIGNATURE // 2) * (r >= ROUTES // 2) + ROUTES // 2 + 3 * (r % (ROUTES // 2)) + j for j in range(3)) for r in range(ROUTES))


def _hot_values(df: DataFrame) -> DataFrame:
    return df.groupBy("route", "value").agg(F.count("*").alias("n")).where(F.col("n") > SHARD_ROWS)


def hot_levels(routed: DataFrame) -> list[DataFrame]:
    """Of each level of splitting (next value, three bytes, salts) the hot (route, value, salts); stops at the first level without any.

    A level has at most ROUTES x texts / SHARD_ROWS rows.
    """
    levels, r = [], routed
    for k in range(5):
        hot = checkpoint(_hot_values(r).select("route", "value", F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("salts")))
        if hot.isEmpty():
            break
        levels.append(hot)
        if k < 4:
            r = r.join(F.broadcast(hot), ["route", "value"]).drop("salts").withColumn("value", _refined(k))
    return levels


def _refined(level: int) -> Column:
    """A hot route value together with the next of the text's values."""
    if not level:
        return F.xxhash64("value", "next_value")
    place = F.get(F.array(*[F.lit(x[level - 1] + 1) for x in SPLIT_BYTES]), F.col("route"))
    return F.xxhash64("value", F.lit(level), F.substring("signature", place, F.lit(1)))


def placed(routed: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """routed with its route value split where it is hot, and its salts (null, or their number)."""
    r = routed.withColumn("salts", F.lit(None).cast("int"))
    for k, hot in enumerate(levels):
        r = r.drop("salts").join(F.broadcast(hot), ["route", "value"], "left")
        if k < 4:
            r = r.withColumn("value", F.when(F.col("salts").isNotNull(), _refined(k)).otherwise(F.col("value"))).withColumn("salts", F.lit(None).cast("int"))
    return r


def _split_hot(routed: DataFrame, levels: list[DataFrame] | None = None) -> DataFrame:
    """routed with salt: route values of more than SHARD_ROWS rows are told apart by the text's next value, then by further min-hash values.

    Where one still holds more, it is dealt over salts, and its PIVOTS smallest documents go to every salt, so that the copies of a
    pivot meet it in each and closing the links joins them. What is not joined so is compared in blocks by scanned().
    """
    levels = hot_levels(routed) if levels is None else levels
    r = placed(routed, levels)
    if len(levels) < 5:
        return r.withColumn("salt", F.lit(0))
    ids = r.where("salts is not null").select("route", "value", "doc_id")
    pivots = ids.mapInArrow(_smallest, "route int, value bigint, doc_id bigint").repartition("route", "value").mapInArrow(_smallest, "route int, value bigint, doc_id bigint").withColumn("pivot", F.lit(True))
    r = r.join(F.broadcast(pivots), ["route", "value", "doc_id"], "left")
    own = F.array(F.pmod(F.xxhash64("doc_id"), F.coalesce("salts", F.lit(1))).cast("int"))
    return r.withColumn("salt", F.explode(F.when(F.col("pivot") & F.col("salts").isNotNull(), F.sequence(F.lit(0), F.col("salts") - 1)).otherwise(own)))


def _smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The PIVOTS smallest documents of each hot value, as a bounded heap a value."""
    held: pd.DataFrame | None = None
    for b in batches:
        t = b.to_pandas()
        held = t if held is None else pd.concat([held, t])
        held = held.sort_values(["route", "value", "doc_id"]).drop_duplicates().groupby(["route", "value"], sort=False).head(PIVOTS)
    if held is not None and len(held):
        yield pa.RecordBatch.from_pandas(held.astype({"route": "int32"}), preserve_index=False)


def shards_of(rows: int) -> int:
    return max(1, math.ceil(rows / SHARD_ROWS))


FOUND = "kind string, a bigint, b bigint, shard int, level int, first int, last int, beam int, ids binary, keys binary, codes binary, links binary"


def search_index(salted: DataFrame, shards: int, stored: DataFrame | None = None) -> DataFrame:
    """Rows of FOUND: 'c' candidate pairs, 'm' further pairs of crowded values, 'a' asked (text, key), 's' new segments.

    salted: doc_id, batch_no, signature, route, value, salt and `old` (a row of the history that is only to be indexed anew); stored: segments of the same shards.
    """
    r = salted.select("doc_id", "batch_no", "signature", "old", F.xxhash64("route", "value").alias("key"), F.pmod(F.xxhash64("value", "route", "salt"), F.lit(shards)).cast("int").alias("shard"))
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in FOUND.split(", ")])

    def part(n: int, **columns) -> pa.Table:
        return pa.table([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def run(rows: pa.Table, segments: pa.Table | None) -> pa.Table:
        if not rows.num_rows:
            return schema.empty_table()
        shard = rows.column("shard")[0].as_py()
        history = Segments([] if segments is None else [(x["level"], x["first"], x["last"], _graph(x)) for x in segments.to_pylist()])
        rows = rows.combine_chunks().sort_by([("batch_no", "ascending"), ("doc_id", "ascending")])
        codes = _codes(rows.column("signature"))
        ids, no, keys, old = (rows.column(c).to_numpy() for c in ("doc_id", "batch_no", "key", "old"))
        if old.any():
            history.add(Graph(codes[old], keys[old], ids[old]).tuned(LIMIT, near), int(no[old].min()), int(no[old].max()), LIMIT, near)
        new = ~old
        parts = []
        for kind, found in zip("cma", search_shard(history, ids[new], no[new], codes[new], keys[new])):
            parts.append(part(found.shape[1], kind=[kind] * found.shape[1], a=found[0], b=found[1]))
        for level, first, last, g in history.fresh:
            blob = {k: [np.ascontiguousarray(v).tobytes()] for k, v in (("ids", g.ids), ("keys", g.keys), ("codes", g.codes), ("links", g.links.astype(np.int32)))}
            parts.append(part(1, kind=["s"], shard=[shard], level=[level], first=[first], last=[last], beam=[g.beam], **blob))
        return pa.concat_tables(parts)

    if stored is None:
        return r.groupBy("shard").applyInArrow(lambda rows: run(rows, None), FOUND)
    return r.groupBy("shard").cogroup(stored.groupBy("shard")).applyInArrow(run, FOUND)


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """The signatures, all of one width, as 64-bit words (rows, words)."""
    a = column.combine_chunks()
    a = a.chunk(0) if isinstance(a, pa.ChunkedArray) else a
    a = a.cast(pa.large_binary())
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    return np.frombuffer(a.buffers()[2], np.uint8)[off[0] : off[-1]].view(np.uint64).reshape(len(a), -1)


def _graph(row: dict) -> Graph:
    ids = np.frombuffer(row["ids"], np.int64)
    return Graph(np.frombuffer(row["codes"], np.uint64).reshape(len(ids), -1), np.frombuffer(row["keys"], np.int64), ids, links=np.frombuffer(row["links"], np.int32).reshape(-1, DEGREE), beam=row["beam"])


def candidates(routed: DataFrame) -> DataFrame:
    """(a, b) pairs from the index shards; routed: one row per text and route."""
    found = search_index(_split_hot(routed).withColumn("old", F.lit(False)), shards_of(routed.count()))
    return found.where("kind in ('c', 'm')").select("a", "b").distinct()


def _bags(tokens: DataFrame, own: np.ndarray) -> DataFrame:
    """doc_id, bag: how often each of BAG word buckets occurs in the text as it stands and without the site's lines (uint16, two parts)."""
    shared = tokens.sparkSession.sparkContext.broadcast(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bags = np.zeros((b.num_rows, 2, BAG), np.int64)
            for part, drop in enumerate((None, shared.value)) if b.num_rows else ():
                words, starts = _content(b, drop)
                np.add.at(bags, (np.repeat(np.arange(b.num_rows), np.diff(starts)), part, words % BAG), 1)
            data = np.minimum(bags, 2**16 - 1).astype(np.uint16)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x.tobytes() for x in data], pa.binary())], names=["doc_id", "bag"])

    return tokens.select("doc_id", "words", "line_key", "line_words").mapInArrow(run, "doc_id bigint, bag binary")


def scan_block(sig: np.ndarray, bags: np.ndarray, group: np.ndarray, rows: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, other) of pairs of different groups whose signatures are near and that can have LIKE of the words in common."""
    out = [np.zeros((2, 0), np.int64)]
    size = bags.sum(2, dtype=np.int64)
    for i in rows:
        c = others[group[others] != group[i]]
        c = c[near(sig[c], sig[i])]
        if not len(c):
            continue
        able = np.zeros(len(c), bool)
        for part in range(2):  # the common words of two bags are at least the common subsequence of their texts
            most = np.maximum(size[c, part], size[i, part])
            fit = np.flatnonzero(np.minimum(size[c, part], size[i, part]) >= LIKE * most)
            able[fit] |= np.minimum(bags[c[fit], part], bags[i, part]).sum(1, dtype=np.int64) >= LIKE * most[fit]
        out.append(np.stack([np.full(able.sum(), i), c[able]]))
    return tuple(np.concatenate(out, 1))


def scanned(keyed: DataFrame, asked: DataFrame, group: DataFrame, tokens: DataFrame, own: np.ndarray) -> DataFrame:
    """(a, b): what the asked (a, key) texts may be near-copies of among all texts of their route value, those of their own group aside; keyed: doc_id, signature, key; group: doc_id, first.

    A value's texts are dealt over salts and every pair of salts is a block, so that no pair depends on a graph or on its salt.
    """
    keyed = keyed.join(asked.select("key").distinct(), "key", "left_semi")
    sizes = keyed.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("salts"))
    rows = keyed.join(sizes, "key").join(asked.select(F.col("a").alias("doc_id"), "key", F.lit(True).alias("ask")).distinct(), ["doc_id", "key"], "left")
    needed = rows.select("doc_id").distinct()
    bags = checkpoint(_bags(tokens.join(needed, "doc_id", "left_semi").dropDuplicates(["doc_id"]), own))
    rows = rows.join(group, "doc_id", "left").withColumn("first", F.coalesce("first", "doc_id")).join(bags, "doc_id")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), "salts").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    rows = rows.withColumn("low", F.least("salt", "other")).withColumn("high", F.greatest("salt", "other"))
    cells = max(1, math.ceil(keyed.count() / BLOCK))
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("key", "low", "high"), F.lit(cells)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [np.zeros((2, 0), np.int64)]
        for (_, low, high), g in pdf.groupby(["key", "low", "high"], sort=False):
            sig = np.frombuffer(b"".join(g["signature"]), np.uint64).reshape(len(g), -1)
            bags = np.frombuffer(b"".join(g["bag"]), np.uint16).reshape(-1, 2, BAG)
            ids, first, salt, ask = g["doc_id"].to_numpy(np.int64), g["first"].to_numpy(np.int64), g["salt"].to_numpy(), g["ask"].eq(True).to_numpy(bool)
            for one, two in {(low, high), (high, low)}:
                r, c = scan_block(sig, bags, first, np.flatnonzero((salt == one) & ask), np.flatnonzero(salt == two))
                found.append(np.stack([np.minimum(ids[r], ids[c]), np.maximum(ids[r], ids[c])]))
        a, b = np.unique(np.concatenate(found, 1), axis=1)
        return pd.DataFrame({"a": a, "b": b})

    return rows.select("cell", "key", "low", "high", "doc_id", "signature", "first", "salt", "ask", "bag").groupBy("cell").applyInPandas(run, "a bigint, b bigint").distinct()


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two word arrays."""
    n = min(len(a), len(b))
    if not n:
        return 0
    diff = np.flatnonzero(a[:n] != b[:n])
    head = int(diff[0]) if len(diff) else n
    diff = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = min(int(diff[0]) if len(diff) else n, n - head)
    x, y = a[head : len(a) - tail].tolist(), b[head : len(b) - tail].tolist()
    if not x or not y:
        return head + tail
    # bit-parallel: one bit a word of x
    place: dict[int, int] = {}
    for i, w in enumerate(x):
        place[w] = place.get(w, 0) | 1 << i
    full = (1 << len(x)) - 1
    row = full
    for w in y:
        u = row & place.get(w, 0)
        row = ((row + u) | (row - u)) & full
    return head + tail + len(x) - row.bit_count()


def verified(pairs: DataFrame, tokens: DataFrame, own: np.ndarray, like: float = LIKE) -> DataFrame:
    """The pairs whose texts have at least `like` of the words in common and in order."""
    shared = tokens.sparkSession.sparkContext.broadcast(own)
    needed = checkpoint(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    # ids of 8 bytes are broadcast while there are at most BROADCAST_IDS of them; beyond that both sides are shuffled
    needed = F.broadcast(needed) if needed.count() <= BROADCAST_IDS else needed
    t = tokens.join(needed, "doc_id", "left_semi").select("doc_id", "words", "line_key", "line_words")
    j = pairs.join(t.select(F.col("doc_id").alias("a"), *[F.col(c).alias(f"a_{c}") for c in ("words", "line_key", "line_words")]), "a")
    j = j.join(t.select(F.col("doc_id").alias("b"), *[F.col(c).alias(f"b_{c}") for c in ("words", "line_key", "line_words")]), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_ = shared.value

        def alike(x: np.ndarray, y: np.ndarray) -> bool:
            most = max(len(x), len(y))
            return min(len(x), len(y)) >= like * most and common_words(x, y) >= like * most

        for b in batches:
            if not b.num_rows:
                continue
            ok = np.zeros(b.num_rows, bool)
            # as they stand (a copy may have lost its line breaks), else without the site's lines
            for drop in (None, own_):
                side = [_content(pa.RecordBatch.from_arrays([b.column(f"{s}_{c}") for c in ("words", "line_key", "line_words")], names=["words", "line_key", "line_words"]), drop) for s in "ab"]
                (wa, sa), (wb, sb) = side
                for i in np.flatnonzero(~ok):
                    ok[i] = alike(wa[sa[i] : sa[i + 1]], wb[sb[i] : sb[i + 1]])
            yield b.select(["a", "b"]).filter(pa.array(ok))

    return j.select("a", "b", *[f"{s}_{c}" for s in "ab" for c in ("words", "line_key", "line_words")]).mapInArrow(run, "a bigint, b bigint")


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the smallest node of each one's component): roots are hung under smaller ones, then all pointers are followed."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        rx, ry = parent[x], parent[y]
        if (rx == ry).all():
            return nodes, nodes[parent]
        np.minimum.at(parent, np.maximum(rx, ry), np.minimum(rx, ry))
        while (parent != parent[parent]).any():
            parent = parent[parent]


def closed_groups(links: DataFrame) -> DataFrame:
    """(doc_id, first): the smallest document of each linked document's group.

    Up to ONE_TASK_LINKS links (16 bytes each) are closed in one task; more by hash-to-min with contraction until nothing changes.
    """
    edges = checkpoint(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    size = edges.count()
    if size <= ONE_TASK_LINKS:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(list(batches), pa.schema([("a", pa.int64()), ("b", pa.int64())]))
            nodes, first = roots(t.column("a").to_numpy(), t.column("b").to_numpy())
            other = nodes != first
            yield pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(first[other])], names=["doc_id", "first"])

        return checkpoint(edges.coalesce(1).mapInArrow(run, "doc_id bigint, first bigint"))
    while True:
        # large star: every neighbour above a node is tied to the least node around it; small star: the rest likewise
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
        large = split_join(both, least, ["a"], 2 * size).where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"), F.count("*").alias("n"))
        small = large.join(low, "b").select(F.col("m").alias("m"), "a", "b")
        nxt = small.select(F.col("m").alias("a"), "b").unionByName(small.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct()
        nxt = checkpoint(nxt)
        before, size = size, nxt.count()
        same = size == before and nxt.join(edges, ["a", "b"], "left_anti").isEmpty()
        edges = nxt
        if same:
            break
    return edges.select(F.col("b").alias("doc_id"), F.col("a").alias("first"))


def regrouped(pairs: DataFrame, group: DataFrame) -> DataFrame:
    """The pairs whose documents are not of one group yet."""
    g = pairs.join(group.select(F.col("doc_id").alias("a"), F.col("first").alias("ga")), "a", "left").join(group.select(F.col("doc_id").alias("b"), F.col("first").alias("gb")), "b", "left")
    return g.where(F.coalesce("ga", "a") != F.coalesce("gb", "b")).select("a", "b")


def found_links(found: DataFrame, keyed: DataFrame, tokens_of, own: np.ndarray) -> DataFrame:
    """(a, b): verified pairs of a search. found: rows of FOUND; keyed: doc_id, signature, key of all texts indexed; tokens_of(pairs): the tokens of the texts in the pairs."""
    first = found.where("kind = 'c'").select("a", "b").distinct()
    links = checkpoint(verified(first, tokens_of(first), own))
    rest = {r["kind"] for r in found.where("kind in ('m', 'a')").select("kind").distinct().collect()}
    if not rest:
        return links
    group = closed_groups(links)
    if "m" in rest:
        more = checkpoint(regrouped(found.where("kind = 'm'").select("a", "b").distinct().join(first, ["a", "b"], "left_anti"), group))
        if not more.isEmpty():
            links = links.unionByName(verified(more, tokens_of(more), own))
    if "a" in rest:
        asked = checkpoint(found.where("kind = 'a'").select("a", F.col("b").alias("key")).distinct())
        ids = keyed.join(asked.select("key").distinct(), "key", "left_semi").select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"))
        blocks = checkpoint(scanned(keyed, asked, group, tokens_of(ids), own))
        links = links.unionByName(verified(blocks, tokens_of(blocks), own))
    return links


def index_links(routed: DataFrame, tokens: DataFrame, own: np.ndarray) -> DataFrame:
    """(a, b): verified pairs of texts indexed and searched at once, nothing kept."""
    levels = hot_levels(routed)
    found = checkpoint(search_index(_split_hot(routed, levels).withColumn("old", F.lit(False)), shards_of(routed.count())))
    return found_links(asked_of_salts(found, routed, levels), keyed_rows(routed, levels), lambda pairs: tokens, own)


def keyed_rows(routed: DataFrame, levels: list[DataFrame]) -> DataFrame:
    return placed(routed, levels).select("doc_id", "signature", F.xxhash64("route", "value").alias("key"))


def asked_of_salts(found: DataFrame, routed: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """The texts of values dealt over salts met only those of their own salt: they are asked for as well."""
    if len(levels) < 5:
        return found
    more = placed(routed, levels).where("salts is not null").select(F.lit("a").alias("kind"), F.col("doc_id").alias("a"), F.xxhash64("route", "value").alias("b"))
    return found.select("kind", "a", "b").unionByName(more)


def prepared(docs: DataFrame) -> DataFrame:
    """Texts ready to be tokenised, each with the site its lines belong to."""
    no = F.coalesce("batch_no", F.lit(2**31 - 1)).cast("int").alias("batch_no")
    site = F.xxhash64(F.coalesce(site_of(F.col("source_domain")), site_of(F.col("canonical_url")))).alias("site")
    return tokenise(docs.select("doc_id", no, site, "text"))


def document_keys(docs: DataFrame) -> DataFrame:
    """doc_id, h, h2 (two hashes) of every hash, URL and DOI that links."""
    said = docs.select("doc_id", F.explode(F.array_distinct(F.array_compact(F.array(hash_key(F.col("content_hash")), url_key(F.col("canonical_url")), doi_key(F.col("doi")))))).alias("key"))
    return said.select("doc_id", F.xxhash64("key").alias("h"), F.hash("key").cast("bigint").alias("h2"))


def duplicates(docs: DataFrame) -> DataFrame:
    """(first_doc_id, doc_id) of arrivals whose group was first held in an earlier batch: all batches of docs, added to an index of their own."""
    from claimloom.llm.batch_index import BatchIndex

    index = BatchIndex(docs.sparkSession)
    index.add(docs)
    return index.held_before()


def index_recall(docs: DataFrame, every: int = 100, block: int = 2048) -> DataFrame:
    """queries, pairs, found, recall: near-copies of the documents whose id divides by `every`, found by exhaustive
    comparison of their texts with all rows, and how many of them the index's closed groups hold together.

    The queries' texts (one document in `every`) go to the tasks in blocks of `block`.
    """
    spark = docs.sparkSession
    tokens = checkpoint(prepared(docs))
    first = tokens.groupBy("t1", "t2").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    common, own, _ = common_buckets(tokens)
    routed = checkpoint(signatures(tokens, common, own).join(first, "doc_id", "left_semi"))
    groups = closed_groups(index_links(routed, tokens, own))
    rows = tokens.join(first, "doc_id", "left_semi").select("doc_id", "words", "line_key", "line_words")
    asked = rows.where(F.col("doc_id") % every == 0)
    n_blocks = max(1, math.ceil(asked.count() / block))
    exact = None
    for k in range(n_blocks):
        part = _exhaustive(rows, asked.where(F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)) == k).toArrow(), own)
        exact = part if exact is None else exact.unionByName(part)
    pairs = checkpoint(exact.distinct())
    g = groups.select("doc_id", "first")
    both = pairs.join(g.select(F.col("doc_id").alias("a"), F.col("first").alias("ga")), "a", "left").join(g.select(F.col("doc_id").alias("b"), F.col("first").alias("gb")), "b", "left")
    same = F.coalesce("ga", "a") == F.coalesce("gb", "b")
    n = spark.createDataFrame([(asked.count(),)], "queries bigint")
    return n.join(both.agg(F.count("*").alias("pairs"), F.count_if(same).alias("found")), how="cross").withColumn("recall", F.round(F.try_divide(F.col("found").cast("double"), F.col("pairs").cast("double")), 4))


def _exhaustive(rows: DataFrame, asked: pa.Table, own: np.ndarray) -> DataFrame:
    """(a, b): every pair of an asked and any text with LIKE of the words in common and in order."""
    columns = ["doc_id", "words", "line_key", "line_words"]
    shared = rows.sparkSession.sparkContext.broadcast((asked.select(columns).combine_chunks().to_pylist(), own))
    schema = pa.schema([("doc_id", pa.int64()), ("words", pa.binary()), ("line_key", pa.list_(pa.int64())), ("line_words", pa.list_(pa.int32()))])

    def sides(batch: pa.RecordBatch, own_: np.ndarray) -> list[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
        out = []
        for drop in (None, own_):
            words, starts = _content(batch, drop)
            bags = np.zeros((batch.num_rows, BAG), np.int32)
            np.add.at(bags, (np.repeat(np.arange(batch.num_rows), np.diff(starts)), words % BAG), 1)
            out.append((np.split(words, starts[1:-1]), np.diff(starts), bags))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, own_ = shared.value
        if not listed:
            return
        q = pa.RecordBatch.from_pylist(listed, schema=schema)
        qi, qs = q.column("doc_id").to_numpy(), sides(q, own_)
        for b in batches:
            if not b.num_rows:
                continue
            mine, ms, found = b.column("doc_id").to_numpy(), sides(b, own_), set()
            for (qw, qn, qb), (mw, mn, mb) in zip(qs, ms):
                for i in range(len(qi)):
                    most = np.maximum(mn, qn[i])
                    fit = np.flatnonzero((np.minimum(mn, qn[i]) >= LIKE * most) & (mine != qi[i]))
                    fit = fit[np.minimum(mb[fit], qb[i]).sum(1) >= LIKE * most[fit]]
                    found |= {(min(qi[i], mine[c]), max(qi[i], mine[c])) for c in fit if common_words(qw[i], mw[c]) >= LIKE * most[c]}
            x, y = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint")
