"""Encoding of a corpus with a public byte-level BPE vocabulary, without regular expressions.

Pre-tokenisation works on the UTF-8 bytes of a whole Arrow batch. Every byte gets a codepoint class
(letter, number, space, other white space, other, apostrophe; continuation bytes are the identity).
A class is a transition function over the run states, and composition of such functions is
associative: all classes but the continuation are constant functions, so the prefix scan by doubling
(F[i] := F[i] o F[i - step] where F[i] isn't constant yet) ends after two rounds. From the scanned
states and their neighbours the piece boundaries of the public pattern follow, contractions and
the last space of a run included. The slices stay offsets into the batch's buffer: they are
dictionary-encoded there, each distinct piece is merged once a worker (a cache bounded by
CACHE_PIECES entries), and ids are gathered by offset arithmetic.

Defined results: null and empty texts give an empty list; strings of special tokens are ordinary
text; a row delivered twice gives two rows; very long texts and pieces are encoded whole (pieces
longer than 64 bytes by a linked list and a heap, in n log n).
"""

from __future__ import annotations

import base64
import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CACHE_PIECES = 400_000
CONT, LETTER, NUMBER, SPACE, WHITE, OTHER, APOS = range(7)
_CLASS: np.ndarray | None = None
_STATE: dict = {}


def codepoint_classes() -> np.ndarray:
    """Class of every codepoint; letters and numbers by general category, white space by its Unicode property."""
    global _CLASS
    if _CLASS is None:
        import regex

        table = np.full(0x110000, OTHER, np.uint8)
        low, high = "".join(map(chr, range(0xD800))), "".join(map(chr, range(0xE000, 0x110000)))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\p{White_Space}+")):
            for text, base in ((low, 0), (high, 0xE000)):
                for m in regex.finditer(pattern, text):
                    table[base + m.start() : base + m.end()] = kind
        table[0x20] = SPACE
        table[0x27] = APOS
        _CLASS = table
    return _CLASS


def byte_classes(data: np.ndarray) -> np.ndarray:
    table = codepoint_classes()
    ascii_ = np.full(256, CONT, np.uint8)
    ascii_[:128] = table[:128]
    cls = ascii_[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        n = len(data)
        b0 = data[lead].astype(np.int32)
        at = lambda k: data[np.minimum(lead + k, n - 1)].astype(np.int32) & 0x3F
        two = ((b0 & 0x1F) << 6) | at(1)
        three = ((b0 & 0x0F) << 12) | (at(1) << 6) | at(2)
        four = ((b0 & 0x07) << 18) | (at(1) << 12) | (at(2) << 6) | at(3)
        cp = np.where(b0 < 0xE0, two, np.where(b0 < 0xF0, three, np.minimum(four, 0x10FFFF)))
        cls[lead] = table[cp]
    return cls


def scan(cls: np.ndarray) -> np.ndarray:
    """Prefix composition of the transition functions: identity (CONT) takes the state before it."""
    state, step = cls.copy(), 1
    open_ = np.flatnonzero(state == CONT)
    while len(open_):
        back = open_ - step
        state[open_[back >= 0]] = state[back[back >= 0]]
        open_ = open_[(state[open_] == CONT) & (back >= 0)]
        step = 1 if step > 2 else step + 1
    return state


def piece_starts(data: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Byte offsets at which pieces start; text_starts: offsets of the (non-empty) texts."""
    n = len(data)
    cls = byte_classes(data)
    state = scan(cls)
    lead = cls != CONT
    kind = state.copy()
    kind[kind == APOS] = OTHER
    white = (kind == SPACE) | (kind == WHITE)
    prev = np.empty_like(kind)
    prev[1:] = kind[:-1]
    prev[0] = 255
    first = np.zeros(n, bool)
    first[text_starts] = True
    prev[first] = 255
    prev_white = (prev == SPACE) | (prev == WHITE)
    # what is no white space starts at a change of kind, unless a space before it is its prefix
    start = lead & ~white & (prev != kind) & (prev != SPACE)
    start |= first
    # white space starts after anything else; the last of a run before other text stands alone
    start |= lead & white & ~prev_white
    ends = np.flatnonzero(lead & ~white & prev_white)  # first byte after a run of white space
    if len(ends):
        last = ends - 1
        while True:
            inside = cls[last] == CONT
            if not inside.any():
                break
            last[inside] -= 1
        start[last] = True
    # contractions at a piece start: ' before s t m d re ve ll
    apos = np.flatnonzero((cls == APOS) & start & (prev != SPACE))
    if len(apos):
        stop = np.append(text_starts[1:], n)
        limit = stop[np.searchsorted(text_starts, apos, side="right") - 1]
        get = lambda k: np.where(apos + k < limit, data[np.minimum(apos + k, n - 1)], 0)
        a, b = get(1), get(2)
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        start[apos[one | two] + 1] = False
        for hit, width in ((one, 2), (two & ~one, 3)):
            after = apos[hit] + width
            start[after[after < n]] = True
    return np.flatnonzero(start)


class Merger:
    """Rank merges of one vocabulary; the cache holds each distinct piece's ids."""

    def __init__(self, raw: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}
        self.cache: dict[bytes, tuple[int, ...]] = {}

    def __call__(self, piece: bytes) -> tuple[int, ...]:
        got = self.cache.get(piece)
        if got is None:
            one = self.ranks.get(piece)
            got = (one,) if one is not None else self._short(piece) if len(piece) <= 64 else self._long(piece)
            if len(self.cache) >= CACHE_PIECES:
                self.cache.clear()
            self.cache[piece] = got
        return got

    def _short(self, piece: bytes) -> tuple[int, ...]:
        get, parts = self.ranks.get, [piece[i : i + 1] for i in range(len(piece))]
        none = sys.maxsize
        pair = [get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
        while pair:
            best = min(pair)
            if best == none:
                break
            i = pair.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i < len(pair):
                pair[i] = get(parts[i] + parts[i + 1], none)
            if i:
                pair[i - 1] = get(parts[i - 1] + parts[i], none)
        return tuple(self.ranks[p] for p in parts)

    def _long(self, piece: bytes) -> tuple[int, ...]:
        get, n = self.ranks.get, len(piece)
        end, nxt, prv = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = nxt[i] if alive[i] else n
            if j >= n or not alive[i] or end[j] != stop:
                continue
            alive[j], end[i], nxt[i] = False, stop, nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                if (r := get(piece[i : end[nxt[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[nxt[i]]))
            if prv[i] >= 0 and (r := get(piece[prv[i] : stop])) is not None:
                heapq.heappush(heap, (r, prv[i], stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = nxt[i]
        return tuple(out)


def merger(raw: bytes) -> Merger:
    """The worker's merger of this vocabulary."""
    key = (len(raw), hash(raw))
    if _STATE.get("key") != key:
        _STATE.update(key=key, merger=Merger(raw))
    return _STATE["merger"]


def encode_array(texts: pa.Array, merge: Merger) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, id offsets by text, piece starts, first token of each piece) of a batch of texts."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())])
    n = len(texts)
    buffers = texts.buffers()
    off = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + n + 1].copy()
    if texts.null_count:  # a null may cover bytes
        texts = pa.array(texts.fill_null(""), pa.large_string())
        buffers = texts.buffers()
        off = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + n + 1].copy()
    base, end = off[0], off[-1]
    if end == base:
        zero = np.zeros(0, np.int64)
        return np.zeros(0, np.int32), np.zeros(n + 1, np.int64), zero, zero
    data = np.frombuffer(buffers[2], np.uint8)[base:end]
    off -= base
    starts = piece_starts(data, off[:-1][np.diff(off) > 0])
    bounds = np.append(starts, len(data)).astype(np.int64)
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
    which = pieces.indices.to_numpy(zero_copy_only=False)
    merged = [merge(p) for p in pieces.dictionary.to_pylist()]
    size = np.fromiter(map(len, merged), np.int64, len(merged))
    flat = np.fromiter((i for m in merged for i in m), np.int32, int(size.sum()))
    at = np.cumsum(size) - size
    count = size[which]
    tok = np.cumsum(count) - count  # first token of each piece
    total = int(count.sum())
    ids = flat[np.repeat(at[which] - tok, count) + np.arange(total)]
    ends = np.append(tok, total)
    return ids, ends[np.searchsorted(starts, off, side="left")], starts, tok


def _slices(batch: pa.RecordBatch, max_bytes: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with few bytes each, so that a worker's memory stays small; a long text is a part of its own."""
    col = batch.column(batch.schema.get_field_index("text")).cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids of every row. The vocabulary (0.8 MB, a fixed file) is broadcast to the workers."""
    raw = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = merger(raw.value)
        for whole in batches:
            for b in _slices(whole):
                ids, off, _, _ = encode_array(b.column("text"), merge)
                yield pa.RecordBatch.from_arrays([b.column("key"), pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids))], names=[key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens of every row, without the ids leaving the worker."""
    raw = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = merger(raw.value)
        for whole in batches:
            for b in _slices(whole):
                _, off, _, _ = encode_array(b.column("text"), merge)
                yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(np.diff(off))], names=[key, "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"`{key}` {kind}, n_tokens bigint")


def decode_table(raw: bytes) -> list[bytes]:
    """Bytes of each id, for decoding."""
    ranks = {int(b): base64.b64decode(a) for a, b in (line.split() for line in raw.splitlines() if line)}
    return [ranks.get(i, b"") for i in range(max(ranks) + 1)]


def decode(ids: list[int], table: list[bytes]) -> str:
    return b"".join(table[i] for i in ids).decode("utf-8", "replace")


def spans(docs: DataFrame, vocabulary: str = VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, piece_offsets (UTF-8 byte offset of each piece in its text), first_token (index of the piece's first id)."""
    raw = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = merger(raw.value)
        for whole in batches:
            for b in _slices(whole):
                t = b.column("text").fill_null("").cast(pa.large_string())
                _, off, starts, tok = encode_array(t, merge)
                length = np.fromiter((len(x.encode()) for x in t.to_pylist()), np.int64, len(t))
                begin = np.cumsum(length) - length
                cut = np.searchsorted(starts, np.append(begin, begin[-1:] + length[-1:]), side="left").astype(np.int32)
                owner = np.repeat(np.arange(len(t)), np.diff(cut))
                yield pa.RecordBatch.from_arrays(
                    [b.column("key"), pa.ListArray.from_arrays(pa.array(cut), pa.array((starts - begin[owner]).astype(np.int32))), pa.ListArray.from_arrays(pa.array(cut), pa.array((tok - off[owner]).astype(np.int32)))],
                    names=[key, "piece_offsets", "first_token"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"`{key}` {kind}, piece_offsets array<int>, first_token array<int>")
