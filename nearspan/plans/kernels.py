"""NumPy helpers that run inside Spark tasks on one Arrow batch or one bounded cell.

Every score is a *key*: smaller is closer (inner products are negated). A block of keys may be computed
by matrix product, which rounds differently from the definition; such keys only preselect. Whatever can
still win within the rounding slack is scored again from its components, so results are exact, do not
depend on block borders, and equal vectors get equal keys. Ties fall to the smaller ``vec_id``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE_BLOCK = 2048
QUERY_BLOCK = 1024
CODE_ROWS = 32  # rows of codes whose words are compared at a time, so that they stay in the processor's cache
PAIR_BLOCK = 1 << 16
# Matrix products may run in single precision where squares neither overflow nor vanish.
SINGLE_RANGE = (1e-9, 1e15)
ROUNDOFF = {np.float32: 6e-8, np.float64: 1.2e-16}


def matrix(column: pa.Array) -> np.ndarray:
    """ARRAY<number> or BINARY Arrow column as a dense matrix (floats become float64).

    Null, ragged or non-finite vectors are an error: they would spoil the other rows of their block.
    ``prep.split_valid`` takes them out beforehand.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    lengths = pc.binary_length(column) if binary else pc.list_value_length(column)
    bounds = pc.min_max(lengths)
    width = bounds["max"].as_py() or 0
    if column.null_count or bounds["min"].as_py() != bounds["max"].as_py():
        raise ValueError("vectors of one table must not be null and must all have the same width")
    if binary:
        offset_type = np.int32 if pa.types.is_binary(column.type) else np.int64
        _, offsets, data = column.buffers()
        first = np.frombuffer(offsets, offset_type)[column.offset] if n else 0
        return np.frombuffer(data or b"", np.uint8)[first:first + n * width].reshape(n, width)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if not np.isfinite(flat).all():
        raise ValueError("vectors contain null, NaN or infinite values")
    return flat.reshape(n, width)


def list_column(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Dense matrix as an Arrow list column."""
    n, width = rows.shape
    offsets = pa.array(np.arange(0, (n + 1) * width, max(width, 1), dtype=np.int32)[: n + 1])
    return pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1), type=kind))


@dataclass(frozen=True)
class Scorer:
    """How keys are made. ``codebooks`` is (segments, codes, width) for ``adc``; ``step``/``low`` decode
    scalar-quantised bytes before a float metric."""

    metric: str  # l2 | ip | hamming | adc | adc_ip
    codebooks: np.ndarray | None = None
    step: np.ndarray | None = None
    low: np.ndarray | None = None

    def load_base(self, column: pa.Array) -> np.ndarray:
        rows = matrix(column)
        if self.step is not None:
            return rows * self.step + self.low
        return packed(rows) if self.metric == "hamming" else rows

    def load_query(self, column: pa.Array) -> np.ndarray:
        rows = matrix(column)
        return packed(rows) if self.metric == "hamming" else rows

    def block(self, q: "Rows", x: "Rows") -> tuple[np.ndarray, np.ndarray | int, np.ndarray | int]:
        """Keys of all pairs of two small blocks up to a constant per query, that constant, and how far
        a key may be off.

        Float metrics are one matrix product: for l2 the squared norm of x rides along as an extra
        column, and the squared norm of q is the constant.
        """
        if self.metric == "hamming":
            words = x.form("words", lambda: np.ascontiguousarray(x.data.T))
            keys = np.zeros((len(q.data), len(x.data)), np.min_scalar_type(64 * len(words)))
            gap, ones = np.empty((CODE_ROWS, len(x.data)), np.uint64), np.empty((CODE_ROWS, len(x.data)), np.uint8)
            for s in range(0, len(keys), CODE_ROWS):
                some = q.data[s:s + CODE_ROWS]
                for w, word in enumerate(words):
                    np.bitwise_xor(some[:, w, None], word, out=gap[:len(some)])
                    keys[s:s + CODE_ROWS] += np.bitwise_count(gap[:len(some)], out=ones[:len(some)])
            return keys, 0, 0
        if self.metric in ("adc", "adc_ip"):
            x = x.form("decoded", lambda: Rows(self._decoded(x.data)))
        reach = np.sqrt(q.squares) + np.sqrt(x.squares.max(initial=0.0))
        kind = np.float32 if SINGLE_RANGE[0] < reach.min() and reach.max() < SINGLE_RANGE[1] else np.float64
        slack = 2 * (q.data.shape[1] + 4) * ROUNDOFF[kind] * reach * reach
        if self.metric in ("ip", "adc_ip"):
            return -(q.plain(kind) @ x.plain(kind).T), 0, slack
        return q.doubled(kind) @ x.with_squares(kind).T, q.squares, slack

    def _tables(self, q: np.ndarray) -> np.ndarray:
        """(segments, queries, codes): part of the key that a code of a segment adds."""
        segments, codes, width = self.codebooks.shape
        out = np.empty((segments, len(q), codes))
        for s in range(segments):
            part = q[:, s * width:(s + 1) * width]
            if self.metric == "adc":
                gap = part[:, None, :] - self.codebooks[s][None]
                out[s] = (gap * gap).sum(axis=2)
            else:
                out[s] = -(part[:, None, :] * self.codebooks[s][None]).sum(axis=2)
        return out

    def _decoded(self, codes: np.ndarray) -> np.ndarray:
        """The vectors that codes stand for: the key of a code is, but for rounding, that of its vector."""
        codes = codes.astype(np.intp, copy=False)
        return np.concatenate([book[codes[:, s]] for s, book in enumerate(self.codebooks)], axis=1)

    def exact(self, q: "Rows", x: "Rows", qi: np.ndarray, xi: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Keys of chosen pairs of two blocks from the definition. For codes these are sums of table entries; the tables
        depend on the queries only, so a query block makes them once for all base blocks."""
        if self.metric not in ("adc", "adc_ip"):
            return self.rescore(q.data, x.data, qi, xi, keys)
        out = np.zeros(len(qi))
        if len(qi):
            for s, table in enumerate(q.form("tables", lambda: self._tables(q.data))):
                out += table[qi, x.data[xi, s].astype(np.intp)]
        return out

    def rescore(self, q: np.ndarray, x: np.ndarray, qi: np.ndarray, xi: np.ndarray,
                keys: np.ndarray) -> np.ndarray:
        """Keys of chosen pairs from the definition."""
        if self.metric == "hamming":
            return keys[qi, xi].astype(np.float64)
        out = np.empty(len(qi))
        for s in range(0, len(qi), PAIR_BLOCK):
            a, b = q[qi[s:s + PAIR_BLOCK]], x[xi[s:s + PAIR_BLOCK]]
            if self.metric == "ip":
                out[s:s + PAIR_BLOCK] = -(a * b).sum(axis=1)
            else:
                out[s:s + PAIR_BLOCK] = ((a - b) ** 2).sum(axis=1)
        return out


class Rows:
    """A block of vectors with the forms a matrix product wants, each made once."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self._forms: dict = {}

    def form(self, key, make) -> np.ndarray:
        if key not in self._forms:
            self._forms[key] = make()
        return self._forms[key]

    @property
    def squares(self) -> np.ndarray:
        return self.form("squares", lambda: np.einsum("ij,ij->i", self.data, self.data))

    def plain(self, kind) -> np.ndarray:
        return self.form(("plain", kind), lambda: self.data.astype(kind))

    def doubled(self, kind) -> np.ndarray:
        return self.form(("doubled", kind), lambda: np.column_stack(
            [-2.0 * self.data, np.ones(len(self.data))]).astype(kind))

    def with_squares(self, kind) -> np.ndarray:
        return self.form(("squared", kind), lambda: np.column_stack([self.data, self.squares]).astype(kind))


def packed(rows: np.ndarray) -> np.ndarray:
    """Bytes padded to whole 64-bit words."""
    pad = -rows.shape[1] % 8
    if pad:
        rows = np.pad(rows, ((0, 0), (0, pad)))
    return np.ascontiguousarray(rows).view(np.uint64)


class TopK:
    """The k best (key, vec_id) per query slot seen so far; ``limit`` is the worst key still useful."""

    overflowing = False
    counts = None

    def __init__(self, slots: int, k: int, limit: np.ndarray | None = None):
        self.k = k
        self.limit = np.full(slots, np.inf) if limit is None else np.array(limit, dtype=np.float64)
        self._seed = self.limit.copy()
        self._parts: list[tuple] = []
        self._waiting = 0
        self._room = max(4 * slots * k, PAIR_BLOCK)

    def offer(self, slots: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        if len(slots):
            self._parts.append((slots, ids, keys))
            self._waiting += len(slots)
            if self._waiting > self._room:
                self.settle()

    def settle(self) -> None:
        """Keep the k best of each slot and tighten the limits."""
        if not self._parts:
            return
        slots, ids, keys = (np.concatenate(p) for p in zip(*self._parts))
        keep = best_rows(slots, ids, keys, self.k)
        slots, ids, keys = slots[keep], ids[keep], keys[keep]
        self._parts, self._waiting = [(slots, ids, keys)], 0
        last = np.flatnonzero(np.r_[slots[1:] != slots[:-1], True])
        full = last[last - np.r_[-1, last[:-1]] == self.k]
        self.limit[slots[full]] = np.minimum(self._seed[slots[full]], keys[full])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.settle()
        if not self._parts:
            empty = np.empty(0, np.int64)
            return empty, empty, np.empty(0)
        return self._parts[0]

    @property
    def copies(self) -> int:
        return self.k


class Within:
    """All pairs whose key is strictly below the radius; ``counting`` keeps only counts per slot."""

    copies = 0

    def __init__(self, slots: int, radius: float, counting: bool = False):
        self.limit = np.full(slots, float(radius))
        self.radius = float(radius)
        self.counts = np.zeros(slots, np.int64) if counting else None
        self._parts: list[tuple] = []
        self._waiting = 0

    def offer(self, slots: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        inside = keys < self.radius
        if self.counts is not None:
            np.add.at(self.counts, slots[inside], 1)
        elif inside.any():
            self._parts.append((slots[inside], ids[inside], keys[inside]))
            self._waiting += len(self._parts[-1][0])

    @property
    def overflowing(self) -> bool:
        return self._waiting > 4 * PAIR_BLOCK

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hits gathered since the last call."""
        parts, self._parts, self._waiting = self._parts, [], 0
        if not parts:
            empty = np.empty(0, np.int64)
            return empty, empty, np.empty(0)
        return tuple(np.concatenate(p) for p in zip(*parts))


def best_rows(slots: np.ndarray, ids: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest distinct (key, id) of each slot, ordered by slot, key, id."""
    if len(slots) == 0:
        return np.empty(0, np.intp)
    order = np.lexsort((ids, keys, slots))
    s, i, d = slots[order], ids[order], keys[order]
    fresh = np.r_[True, (s[1:] != s[:-1]) | (d[1:] != d[:-1]) | (i[1:] != i[:-1])]
    order, s = order[fresh], s[fresh]
    start = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    rank = np.arange(len(s)) - np.repeat(start, np.diff(np.r_[start, len(s)]))
    return order[rank < k]


def _few_copies(x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Equal vectors tie for every query, so only the k smallest ids of each can reach a top-k."""
    raw = np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
    _, same = np.unique(raw, return_inverse=True)
    keep = best_rows(same.ravel(), ids, np.zeros(len(ids)), k)
    return x[keep], ids[keep]


def offer_pairs(scorer: Scorer, q: np.ndarray, slots: np.ndarray, x: np.ndarray, ids: np.ndarray,
                sink: TopK | Within) -> Iterator[None]:
    """Score every query of ``q`` against every row of ``x``, block by block, into ``sink``.

    Yields after each block, so that the caller can drain a sink that holds many hits.
    """
    asked = [(slots[s:s + QUERY_BLOCK], Rows(q[s:s + QUERY_BLOCK])) for s in range(0, len(q), QUERY_BLOCK)]
    k = sink.copies
    for xs in range(0, len(x), BASE_BLOCK):
        held, held_ids, reduced = Rows(x[xs:xs + BASE_BLOCK]), ids[xs:xs + BASE_BLOCK], False
        for sb, qb in asked:
            keys, shift, slack = scorer.block(qb, held)
            near = keys <= _column(sink.limit[sb] + slack - shift, keys)
            if sink.counts is not None:  # what rounding cannot move across the radius is counted as it is
                sure = keys < _column(sink.limit[sb] - slack - shift, keys, -np.inf)
                np.add.at(sink.counts, sb, np.count_nonzero(sure, axis=1))
                near &= ~sure
            tight = k and len(held_ids) > k and np.count_nonzero(near) > 4 * k * len(sb)
            if tight:
                near = _tighter(keys, near, slack, k)
                if not reduced and np.count_nonzero(near) > 4 * k * len(sb):
                    data, held_ids = _few_copies(held.data, held_ids, k)
                    held, reduced = Rows(data), True
                    keys, shift, slack = scorer.block(qb, held)
                    near = _tighter(keys, keys <= _column(sink.limit[sb] + slack - shift, keys), slack, k)
            qi, xi = np.divmod(_true(near), near.shape[1])  # faster than a 2-d nonzero
            found = scorer.exact(qb, held, qi, xi, keys)
            if tight and scorer.codebooks is not None:
                keep = found <= _kth_of_row(qi, found, len(sb), k)[qi]
                qi, xi, found = qi[keep], xi[keep], found[keep]
            sink.offer(sb[qi], held_ids[xi], found)
            yield


def _true(near: np.ndarray) -> np.ndarray:
    """Flat positions of what is true; where that is rare, eight cells are passed over at a time."""
    flat = np.ascontiguousarray(near).reshape(-1)
    if flat.size % 8:
        return np.flatnonzero(flat)
    some = np.flatnonzero(flat.view(np.uint64))
    at = np.flatnonzero(flat.reshape(-1, 8)[some])
    return some[at >> 3] * 8 + (at & 7)


def _column(limit: np.ndarray, keys: np.ndarray, to: float = np.inf) -> np.ndarray:
    """Limits in the precision of the keys, never rounded down below them (with ``to=-inf`` never up). Counts of bits that are at
    most a limit are at most its whole part."""
    if keys.dtype == np.float32:
        return np.nextafter(limit.astype(np.float32), np.float32(to))[:, None]
    if keys.dtype.kind == "u" and to > 0 and limit.min(initial=0) >= 0:
        return np.minimum(np.floor(limit), np.iinfo(keys.dtype).max).astype(keys.dtype)[:, None]
    return limit[:, None]


def _tighter(keys: np.ndarray, near: np.ndarray, slack, k: int) -> np.ndarray:
    """Also drop what is worse than the k-th key of this block alone."""
    if keys.shape[1] <= k:
        return near
    kth = np.partition(keys, k - 1, axis=1)[:, k - 1].astype(np.float64)
    return near & (keys <= _column(kth + 2 * slack, keys))


def _kth_of_row(row: np.ndarray, keys: np.ndarray, rows: int, k: int) -> np.ndarray:
    """The k-th key of each row, infinite where there are fewer."""
    order = np.lexsort((keys, row))
    low, high = np.searchsorted(row, np.arange(rows)), np.searchsorted(row, np.arange(rows), "right")
    out, some = np.full(rows, np.inf), high - low >= k
    out[some] = keys[order[low[some] + k - 1]]
    return out


def closest(scorer: Scorer, q: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Top-k rows of a small model ``x`` for each row of ``q``: (row, index, key), ordered."""
    sink = TopK(len(q), k)
    for _ in offer_pairs(scorer, q, np.arange(len(q)), x, np.arange(len(x)), sink):
        pass
    return sink.rows()


@dataclass
class Side:
    """Rows of one search side, sorted by group so that groups are slices."""

    ids: np.ndarray
    data: np.ndarray
    slots: np.ndarray
    groups: np.ndarray | None = None

    @classmethod
    def of(cls, ids, data, groups=None, slots=None) -> "Side":
        slots = np.arange(len(ids)) if slots is None else slots
        if groups is None or (len(groups) and (groups == groups[0]).all()):
            return cls(ids, data, slots, groups)  # nothing to sort, and no second copy of the vectors
        order = np.argsort(groups, kind="stable")
        return cls(ids[order], data[order], slots[order], groups[order])

    def slices(self) -> tuple[np.ndarray, np.ndarray]:
        values, start = np.unique(self.groups, return_index=True)
        return values, np.r_[start, len(self.groups)]


def match(scorer: Scorer, queries: Side, base: Side, sink: TopK | Within) -> Iterator[None]:
    """Score the pairs whose groups agree (all pairs when the sides have no groups)."""
    if queries.groups is None:
        yield from offer_pairs(scorer, queries.data, queries.slots, base.data, base.ids, sink)
        return
    qv, qe = queries.slices()
    bv, be = base.slices()
    _, qg, bg = np.intersect1d(qv, bv, assume_unique=True, return_indices=True)
    for i, j in zip(qg, bg):
        a, b = slice(qe[i], qe[i + 1]), slice(be[j], be[j + 1])
        yield from offer_pairs(scorer, queries.data[a], queries.slots[a], base.data[b], base.ids[b], sink)
