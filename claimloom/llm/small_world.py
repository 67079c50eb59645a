"""Navigable small-world graphs over min-hash signatures, vectorised over many queries.

A signature is SIGNATURE bytes (one byte of each min-hash value) by which graphs are navigated, and further bytes that
only tell near nodes apart; the distance of two is the number of unequal bytes among the first SIGNATURE. A graph holds up to DEGREE links a node. Nodes are inserted in growing blocks: the
block is searched in the graph built so far (and within itself through shared entry keys), linked to
the nearest found, and linked back; a node whose entry key no other node has is linked by key order and at
random only. A search keeps a beam of the best nodes for every query at once and expands the best unexpanded
node of each query until no beam improves. A graph's beam is widened once, when it is made, until its recall
against exhaustive search is as wanted; a graph that misses it at the widest beam is read exactly, key by key.
"""

from __future__ import annotations

import numpy as np

SIGNATURE, DEGREE, BEAM = 32, 10, 4
FAR, EXACT = 255, 0
NODES, NONE = (1 << 24) - 1, 2**31 - 1
_LOW, _HIGH = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Unequal bytes of broadcast signatures, each SIGNATURE bytes as 64-bit words (..., SIGNATURE / 8)."""
    x = a ^ b
    x = (((x & _LOW) + _LOW) | x) & _HIGH  # the high bit of every byte that isn't zero
    return np.bitwise_count(x).sum(-1, dtype=np.uint8)


class Graph:
    """One segment's graph: signatures (n, SIGNATURE / 8 words), entry keys (n,), outer ids (n,)."""

    def __init__(self, codes: np.ndarray, keys: np.ndarray, ids: np.ndarray, seed: int = 7, links: np.ndarray | None = None, beam: int = BEAM):
        self.codes, self.keys, self.ids, self.beam = codes, keys, ids, beam
        self.way = np.ascontiguousarray(codes[:, : SIGNATURE // 8])
        n = len(ids)
        self.by_key = np.argsort(keys, kind="stable").astype(np.int32)
        self.sorted_keys = keys[self.by_key]
        # nodes in order of their key and a part of their signature: copies stand side by side in some of these orders
        self.own_keys = self.sorted_keys[np.append(True, self.sorted_keys[1:] != self.sorted_keys[:-1])] if n else self.sorted_keys
        self.orders = []
        for w in range(self.way.shape[1]):
            place = self._place(self.way, keys, w)
            order = np.argsort(place, kind="stable").astype(np.int32)
            self.orders.append((order, place[order]))
        if links is not None:  # a stored graph
            self.links, self.size = links, n
            return
        self.links = np.full((n, DEGREE), -1, np.int32)
        lo, hi = self.span(keys)
        self.shared = hi - lo > 1
        rng = np.random.default_rng(seed)
        done = min(n, 48)
        if done > 1:
            d = distances(self.way[:done, None], self.way[None, :done]).astype(np.int16)
            np.fill_diagonal(d, FAR)
            near = np.argsort(d, axis=1, kind="stable")[:, : min(DEGREE, done - 1)]
            self.links[:done, : near.shape[1]] = near
        self.size = done
        while self.size < n:
            self._insert(min(n, self.size * 2), rng)

    def _insert(self, stop: int, rng: np.random.Generator) -> None:
        new, half = np.arange(self.size, stop), DEGREE // 2
        found = np.full((len(new), 4), -1, np.int32)
        at = np.flatnonzero(self.shared[new])
        if len(at):
            found[at] = self.search(self.codes[new[at]], self.keys[new[at]], beam=4, rounds=4)[0]
        self.links[new[:, None], np.arange(4)] = found
        # a link to the neighbour in key order holds equal keys together, long random links keep the graph navigable
        rank = np.empty(len(self.keys), np.int32)
        rank[self.by_key] = np.arange(len(self.keys))
        beside = self.by_key[np.maximum(rank[new] - 1, 0)]
        self.links[new, 4] = np.where((beside != new) & (beside < stop), beside, -1)
        self.links[new, half] = rng.integers(0, self.size, len(new))
        # back links replace the farther half of the target's list, one writer a slot
        for k in range(2):
            t = found[:, k]
            ok = t >= 0
            self.links[t[ok], half + 1 + (new[ok] * 2 + k) % (DEGREE - half - 1)] = new[ok]
        self.size = stop

    def span(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the nodes with each query's key begin and end in key order."""
        return np.searchsorted(self.sorted_keys, keys, side="left"), np.searchsorted(self.sorted_keys, keys, side="right")

    def of_key(self, codes: np.ndarray, keys: np.ndarray, near, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all nodes with the query's own key for which near(codes of the nodes, codes of the queries) holds: the exact range scan."""
        lo, hi = self.span(keys)
        n, qs, ns = hi - lo, [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        ends = np.cumsum(n)
        start = 0
        while start < len(keys):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + block, side="right")))
            q = np.repeat(np.arange(start, stop), n[start:stop])
            node = self.by_key[np.arange(len(q)) - np.repeat(ends[start:stop] - n[start:stop] - (ends[start - 1] if start else 0), n[start:stop]) + np.repeat(lo[start:stop], n[start:stop])]
            ok = near(self.codes[node], codes[q])
            qs.append(q[ok])
            ns.append(node[ok])
            start = stop
        return np.concatenate(qs), np.concatenate(ns)

    def tuned(self, limit: int, near=None) -> Graph:
        """Sets the beam by the graph's own nodes that share their key; EXACT where even the widest beam misses the recall of near nodes."""
        at = np.flatnonzero(self.shared)
        if len(at):
            beam, recall = tuned_beam(self, self.codes[at], self.keys[at], limit, itself=True, nodes=at, near=near)
            self.beam = EXACT if recall < WANTED else beam
        return self

    def _place(self, way: np.ndarray, keys: np.ndarray, w: int) -> np.ndarray:
        rank = np.searchsorted(self.own_keys, keys).astype(np.uint64)
        return rank << np.uint64(40) | way[:, w].byteswap() >> np.uint64(24)

    def entries(self, way: np.ndarray, keys: np.ndarray, width: int) -> np.ndarray:
        """Nodes with the query's key: of each order up to width beside the query's own place (-1 where there is none)."""
        out = []
        for w, (order, place) in enumerate(self.orders):
            at = np.searchsorted(place, self._place(way, keys, w), side="left")[:, None] + np.arange(-(width // 2), width - width // 2)
            ok = (at >= 0) & (at < len(order))
            node = order[np.clip(at, 0, len(order) - 1)]
            out.append(np.where(ok & (node < self.size) & (self.keys[node] == keys[:, None]), node, -1))
        return np.concatenate(out, 1)

    def search(self, codes: np.ndarray, keys: np.ndarray, beam: int = BEAM, rounds: int = 24) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, distances), each (queries, beam) by rising distance; -1 fills.

        A query ends when its beam is expanded, or when its nearest node hasn't changed for beam / 4 rounds (at least one).
        """
        q, codes = len(codes), codes[:, : SIGNATURE // 8]
        if not self.size or not q:
            return np.full((q, beam), -1, np.int32), np.full((q, beam), FAR, np.uint8)
        start = self.entries(codes, keys, max(4, beam // 2))
        lost = np.flatnonzero((start < 0).all(1))
        if len(lost):  # nobody has the query's key: from a hub
            start[lost, 0] = self.size // 2
        # a beam place is one integer: distance, node, whether it was expanded
        state = self._merge(codes, start, np.full((q, beam), NONE, np.int32))
        live, idle, patience = np.arange(q), np.zeros(q, np.int16), max(1, beam // 4)
        for _ in range(rounds):
            now = state[live]
            waiting = np.where(now & 1, NONE, now)
            pick = waiting.argmin(1)
            best = waiting[np.arange(len(live)), pick]
            go = (best < NONE) & (idle[live] < patience)
            live, pick, best, now = live[go], pick[go], best[go], now[go]
            if not len(live):
                break
            now[np.arange(len(live)), pick] |= 1
            new = self._merge(codes[live], self.links[best >> 1 & NODES], now)
            idle[live] = np.where(new[:, 0] >> 25 < now[:, 0] >> 25, 0, idle[live] + 1)
            state[live] = new
        some = state < NONE
        return np.where(some, state >> 1 & NODES, -1).astype(np.int32), np.where(some, state >> 25, FAR).astype(np.uint8)

    def _merge(self, codes: np.ndarray, add: np.ndarray, state: np.ndarray) -> np.ndarray:
        """The best beam places of state and the nodes of add, each node once, expanded if it was."""
        beam = state.shape[1]
        d = distances(self.way[np.maximum(add, 0)], codes[:, None]).astype(np.int32)
        key = np.concatenate([state, np.where((add >= 0) & (add < self.size), d << 25 | add << 1, NONE)], 1)
        key.sort(axis=1)
        same = (key[:, 1:] >> 1 == key[:, :-1] >> 1) & (key[:, 1:] < NONE)
        rows = np.flatnonzero(same.any(1))
        if len(rows):
            k, s = key[rows], same[rows]
            for _ in range(5):  # a node may come from the beam and twice from links, or from several orders
                k[:, :-1] |= np.where(s, k[:, 1:] & 1, 0)
            k[:, 1:][s] = NONE
            k.sort(axis=1)
            key[rows] = k
        return key[:, :beam]

    def exhaustive(self, codes: np.ndarray, limit: int, block: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all nodes within a distance of limit."""
        qs, ns, codes = [], [], codes[:, : SIGNATURE // 8]
        for i in range(0, len(codes), block):
            q, n = np.nonzero(distances(codes[i : i + block, None], self.way[None]) <= limit)
            qs.append(q + i)
            ns.append(n)
        return (np.concatenate(qs), np.concatenate(ns)) if qs else (np.zeros(0, int), np.zeros(0, int))


WANTED = 0.97


def tuned_beam(graph: Graph, codes: np.ndarray, keys: np.ndarray, limit: int, wanted: float = WANTED, sample: int = 48, widest: int = 64, itself: bool = False, enough: int = 12, draws: int = 8, nodes: np.ndarray | None = None, near=None) -> tuple[int, float]:
    """The narrowest beam (doubled from BEAM) whose recall of all nodes within limit is as wanted, measured against exhaustive search.

    near(codes, codes): which nodes are wanted, of those with the query's own key (others are searched for under another key, in another
    shard); without it all nodes within the limit are.
    itself: the queries are the graph's own nodes (`nodes`; all in order by default), and none is its own neighbour. Samples are
    drawn until `enough` queries have a neighbour, at most `draws`; the recall is nan where none has. A beam that is full within
    the limit counts as whole: its query goes on by a scan of its key's nodes. At the widest beam the recall may stay below what is
    wanted; the caller then reads the graph exactly.
    """
    order = np.random.default_rng(3).permutation(len(codes))
    own = np.arange(len(codes)) if nodes is None else nodes
    pick, q, n = np.zeros(0, int), np.zeros(0, int), np.zeros(0, int)
    for k in range(draws):
        part = order[k * sample : (k + 1) * sample]
        if not len(part):
            break
        if near is not None:
            r, c = graph.of_key(codes[part], keys[part], near)
        else:
            r, c = graph.exhaustive(codes[part], limit)
        ok = own[part[r]] != c if itself else np.ones(len(r), bool)
        q, n = np.concatenate([q, r[ok] + len(pick)]), np.concatenate([n, c[ok]])
        pick = np.concatenate([pick, part])
        if len(np.unique(q)) >= enough:
            break
    if not len(q):
        return BEAM, float("nan")
    has, at = np.unique(q, return_inverse=True)
    wanted_n, asked = np.bincount(at), pick[has]
    beam = BEAM
    while True:
        node, d = graph.search(codes[asked], keys[asked], beam)
        within = (d <= limit) & (node >= 0)
        full = within.all(1)
        if near is not None:
            r, c = np.nonzero(node >= 0)
            within = np.zeros(node.shape, bool)
            within[r, c] = near(graph.codes[node[r, c]], codes[asked[r]]) & (graph.keys[node[r, c]] == keys[asked[r]])
        if itself:
            within &= node != own[asked][:, None]
        recall = float(np.where(full, 1.0, within.sum(1) / wanted_n).mean())
        if recall >= wanted or beam >= widest:
            return beam, recall
        beam *= 2


class Segments:
    """A shard's history: a graph per batch, merged when TIER graphs of one level have come together.

    Each is (level, first batch, last batch, graph); `fresh` are those that are not stored yet.
    """

    TIER = 4

    def __init__(self, stored: list[tuple[int, int, int, Graph]] = ()):
        # a stored graph that a later merge has taken in is no longer part of the history
        whole = [s for s in stored if not any(o[0] > s[0] and o[1] <= s[1] and s[2] <= o[2] for o in stored)]
        self.graphs: list[tuple[int, int, int, Graph]] = sorted(whole, key=lambda s: s[1])
        self.fresh: list[tuple[int, int, int, Graph]] = []

    def add(self, graph: Graph, first: int = 0, last: int = 0, limit: int | None = None, near=None) -> None:
        self.graphs.append((0, first, last, graph))
        self.fresh.append(self.graphs[-1])
        while len(self.graphs) >= self.TIER and len({s[0] for s in self.graphs[-self.TIER :]}) == 1:
            last_ones = self.graphs[-self.TIER :]
            merged = Graph(*[np.concatenate([getattr(s[3], a) for s in last_ones]) for a in ("codes", "keys", "ids")])
            if limit is not None:
                merged.tuned(limit, near)
            taken = {id(s) for s in last_ones}
            self.fresh = [s for s in self.fresh if id(s) not in taken]
            self.graphs[-self.TIER :] = [(last_ones[0][0] + 1, last_ones[0][1], last_ones[-1][2], merged)]
            self.fresh.append(self.graphs[-1])
