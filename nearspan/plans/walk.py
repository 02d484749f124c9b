"""Graph kernels that run inside one task: beam walks over a block of nodes, and the choice of edges."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from nearspan.plans.kernels import PAIR_BLOCK, Scorer, TopK, best_rows, offer_pairs, packed

SEEN_CELLS = 1 << 25
EXPAND = 4
REACH_ROWS = 1 << 15  # reached nodes whose vectors are gathered at a time


def pair_keys(metric: str, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Key of each row pair, from the definition; bit rows are packed words."""
    if metric == "hamming":
        return np.bitwise_count(x ^ y).sum(axis=1).astype(np.float64)
    i = np.arange(len(x))
    return Scorer(metric).rescore(x, y, i, i, None)


def chosen_keys(metric: str, x: np.ndarray, y: np.ndarray, xi: np.ndarray, yi: np.ndarray) -> np.ndarray:
    """Keys of chosen pairs; the rows of a bounded number of pairs are gathered at a time."""
    if metric != "hamming":
        return Scorer(metric).rescore(x, y, xi, yi, None)
    return np.concatenate([pair_keys(metric, x[xi[s:s + PAIR_BLOCK]], y[yi[s:s + PAIR_BLOCK]])
                           for s in range(0, max(len(xi), 1), PAIR_BLOCK)])


@dataclass
class Block:
    """Nodes in one place, ordered by id. ``inner`` (nodes, width) are positions of neighbours inside, -1 where there is
    none; ``outer`` lists the edges that leave: position, id and place of the other end."""

    metric: str
    ids: np.ndarray
    data: np.ndarray
    inner: np.ndarray
    outer: tuple[np.ndarray, np.ndarray, np.ndarray]
    last_reach: tuple[bytes, np.ndarray] | None = field(default=None, repr=False)

    @classmethod
    def of(cls, metric: str, ids: np.ndarray, data: np.ndarray, counts: np.ndarray, ends: np.ndarray,
           places: np.ndarray | None, here: int | None) -> "Block":
        """``counts`` neighbours per node, their ids ``ends`` and places one after the other; without ``here`` all are inside."""
        order = np.argsort(ids)
        data = packed(data) if metric == "hamming" else data
        at = np.repeat(np.argsort(order), counts)
        ids, data = ids[order], data[order]
        spot = np.minimum(np.searchsorted(ids, ends), max(len(ids) - 1, 0))
        inside = (ids[spot] == ends) if here is None else (places == here)
        column = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
        inner = np.full((len(ids), max(int(counts.max(initial=0)), 1)), -1, np.int32)
        inner[at[inside], column[inside]] = spot[inside]
        out = np.flatnonzero(~inside)
        out = out[np.argsort(at[out], kind="stable")]
        return cls(metric, ids, data, inner, (at[out], ends[out], np.empty(0, np.int32) if places is None else places[out]))

    def walk(self, queries: np.ndarray, slots: np.ndarray | None, starts: np.ndarray, ef: int, k: int | None = None):
        """Beams of ``ef`` nodes per query, or the ``k`` best of each: (query, position, key), ordered. ``slots``, ``starts`` pair
        queries with the nodes they begin at; without ``slots`` every query begins at all ``starts``, each given once. All queries
        move together; each opens its few closest unopened nodes until its beam has none. A beam with room for every node drops
        none, so it ends as all that can be reached from where it began."""
        queries = packed(queries) if self.metric == "hamming" else queries
        if ef >= len(self.ids):
            alike = [(np.sort(starts), np.arange(len(queries)))] if slots is None else self._alike(slots, starts)
            for begun, mine in alike:
                yield from self._open_all(queries, mine, begun, min(k or ef, ef))
            return
        step = max(1, SEEN_CELLS // max(len(self.ids), 1))
        for low in range(0, len(queries), step):
            some = queries[low:low + step]
            if slots is None:
                found = self._walk(some, None, starts, ef)
            else:
                mine = (slots >= low) & (slots < low + step)
                found = self._walk(some, slots[mine] - low, starts[mine], ef)
            if k is not None and k < ef:
                first = np.flatnonzero(np.r_[True, found[0][1:] != found[0][:-1]][:len(found[0])])
                few = np.arange(len(found[0])) - np.repeat(first, np.diff(np.r_[first, len(found[0])])) < k
                found = tuple(part[few] for part in found)
            yield found[0] + low, found[1], found[2]

    @staticmethod
    def _alike(slots: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Queries that begin at the same nodes, with these nodes."""
        order = np.lexsort((starts, slots))
        slots, starts = slots[order], starts[order]
        first = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]][:len(slots)])
        alike: dict[bytes, list[int]] = {}
        for low, high in zip(first, np.r_[first[1:], len(slots)]):
            alike.setdefault(starts[low:high].tobytes(), []).append(int(slots[low]))
        return [(np.frombuffer(begun, starts.dtype), np.array(mine)) for begun, mine in alike.items()]

    def _open_all(self, queries: np.ndarray, who: np.ndarray, starts: np.ndarray, k: int):
        """The ``k`` best of all nodes that the queries ``who``, which begin at the same nodes, can reach."""
        begun = starts.tobytes()
        if self.last_reach is None or self.last_reach[0] != begun:
            self.last_reach = begun, self.reach(starts)
        at = self.last_reach[1]
        step = max(1, SEEN_CELLS // max(8 * min(k, len(at)), 1))  # also bounds what a beam of all nodes returns
        for low in range(0, len(who) if len(at) else 0, step):
            some = who[low:low + step]
            sink = TopK(len(some), k)
            for s in range(0, len(at), REACH_ROWS):
                part = at[s:s + REACH_ROWS]
                for _ in offer_pairs(Scorer(self.metric), queries[some], np.arange(len(some)), self.data[part], part, sink):
                    pass
            slot, node, key = sink.rows()
            yield some[slot], node, key.astype(np.float64)

    def reach(self, starts: np.ndarray) -> np.ndarray:
        """Positions of all nodes that edges inside lead to from the given ones, which are among them."""
        reached = np.zeros(len(self.ids), bool)
        front = np.unique(starts)
        while len(front):
            reached[front] = True
            ends = self.inner[front]
            front = np.unique(ends[ends >= 0])
            front = front[~reached[front]]
        return np.flatnonzero(reached)

    def _best_starts(self, queries: np.ndarray, starts: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The first beams of queries that begin at the same nodes: their best starts, scored in blocks."""
        sink = TopK(len(queries), ef)
        for _ in offer_pairs(Scorer(self.metric), queries, np.arange(len(queries)), self.data[starts], starts, sink):
            pass
        slot, at, key = sink.rows()
        return slot, at, key.astype(np.float64)

    def _walk(self, queries: np.ndarray, slots: np.ndarray | None, starts: np.ndarray, ef: int):
        n = len(self.ids)
        seen = np.zeros(len(queries) * n, bool)
        slot, at, key, opened = (np.empty(0, k) for k in (np.int64, np.int64, np.float64, bool))
        fresh = np.empty(0, np.int64) if slots is None else np.unique(slots * n + starts)
        if slots is None:
            seen.reshape(len(queries), n)[:, starts] = True
            slot, at, key = self._best_starts(queries, starts, ef)
            opened = np.zeros(len(slot), bool)
        while len(fresh) or (len(slot) and not opened.any()):
            seen[fresh] = True
            s, p = np.divmod(fresh, n)
            near = chosen_keys(self.metric, queries, self.data, s, p)
            worst = np.full(len(queries), np.inf)  # of the beams that are full; what is farther can not get in
            last = np.flatnonzero(np.r_[slot[1:] != slot[:-1], True][:len(slot)])
            full = last[np.diff(np.r_[-1, last]) == ef]
            worst[slot[full]] = key[full]
            few = near <= worst[s]
            s, p, near = s[few], p[few], near[few]
            slot, at = np.r_[slot, s], np.r_[at, p]
            key, opened = np.r_[key, near], np.r_[opened, np.zeros(len(s), bool)]
            keep = best_rows(slot, self.ids[at], key, ef)
            slot, at, key, opened = slot[keep], at[keep], key[keep], opened[keep]
            shut = np.flatnonzero(~opened)
            first = np.flatnonzero(np.r_[True, slot[shut][1:] != slot[shut][:-1]][:len(shut)])
            turn = np.arange(len(shut)) - np.repeat(first, np.diff(np.r_[first, len(shut)]))
            go = shut[turn < EXPAND]
            opened[go] = True
            ends = self.inner[at[go]]
            code = (slot[go][:, None] * n + ends)[ends >= 0]
            code = np.sort(code[~seen[code]])
            fresh = code[np.r_[True, code[1:] != code[:-1]][:len(code)]]
        return slot, at, key

    def exits(self, slots: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Edges that leave the given nodes, as (query, id, place)."""
        node, ends, places = self.outer
        low, high = np.searchsorted(node, at), np.searchsorted(node, at, "right")
        size = high - low
        row = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.repeat(slots, size), ends[row], places[row]


def choose_edges(metric: str, node: np.ndarray, ends: np.ndarray, ids: np.ndarray, real: np.ndarray, degree: int,
                 spread: bool) -> np.ndarray:
    """(nodes, candidates) True for the edges kept: nearest first, a candidate that lies nearer to a kept one than to the node
    is left out, and what room remains goes to the nearest of those left out. ``ends`` is (nodes, candidates, width)."""
    b, m = real.shape
    to_node = pair_keys(metric, np.repeat(node, m, axis=0), ends.reshape(b * m, -1)).reshape(b, m)
    to_node[~real] = np.inf
    order = np.lexsort((ids, to_node), axis=1)
    row = np.arange(b)[:, None]
    near, sorted_ends = to_node[row, order], ends[row, order]
    kept, count = np.zeros((b, m), bool), np.zeros(b, np.int64)
    for j in range(m):
        free = np.isfinite(near[:, j]) & (count < degree)
        if spread and j:
            held = np.flatnonzero(free & kept[:, :j].any(axis=1))
            if len(held):
                i, c = np.nonzero(kept[held, :j])
                other = pair_keys(metric, sorted_ends[held[i], j], sorted_ends[held[i], c])
                hidden = np.zeros(len(held), bool)
                hidden[i[other < near[held[i], j]]] = True
                free[held[hidden]] = False
        kept[:, j] = free
        count += free
    for j in range(m):
        more = np.isfinite(near[:, j]) & ~kept[:, j] & (count < degree)
        kept[:, j] |= more
        count += more
    out = np.zeros((b, m), bool)
    out[row, order] = kept
    return out
