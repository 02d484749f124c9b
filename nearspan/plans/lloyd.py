"""Deterministic Lloyd iterations over a vector table.

One run trains any number of *segments* at once: a vector of width ``segments * width`` is cut into
equal parts and each part has its own ``k`` centres (one segment: coarse centres; several: product
quantiser codebooks). Bit codes use majority bits instead of means.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearspan.errors import ConfigError
from nearspan.plans.kernels import Rows, Scorer, best_rows, closest, matrix, packed
from nearspan.plans.sums import sum_by_slot

SEED_OVERSAMPLING = 4
ROW_BLOCK = 4096
SCORE_BLOCK = 1 << 22


def nearest_one(x: np.ndarray, centres: np.ndarray, metric: str = "l2") -> np.ndarray:
    """Index of the closest centre of each row; ties fall to the smaller index. At most SCORE_BLOCK scores are held."""
    scorer, held = Scorer(metric), Rows(centres)
    out = np.empty(len(x), np.int64)
    step = min(ROW_BLOCK, max(1, SCORE_BLOCK // max(len(centres), 1)))
    for s in range(0, len(x), step):
        rows = Rows(x[s:s + step])
        keys, _, slack = scorer.block(rows, held)
        best = keys.argmin(axis=1)
        if metric != "hamming":
            limit = keys.min(axis=1).astype(np.float64) + 2 * slack
            near = keys <= np.nextafter(limit.astype(keys.dtype), keys.dtype.type(np.inf))[:, None]
            unsure = np.flatnonzero(np.count_nonzero(near, axis=1) > 1)
            qi, ci = np.nonzero(near[unsure])
            exact = scorer.rescore(rows.data[unsure], centres, qi, ci, keys[unsure])
            keep = best_rows(qi, ci, exact, 1)
            best[unsure[qi[keep]]] = ci[keep]
        out[s:s + step] = best
    return out


def nearest_lists(x: np.ndarray, centres: np.ndarray, count: int, metric: str) -> np.ndarray:
    """Indices of the ``count`` closest centres of each row, best first."""
    _, index, _ = closest(Scorer(metric), x, centres, count)
    return index.reshape(len(x), -1)


def seeds(df: DataFrame, column: str, k: int) -> np.ndarray:
    """k starting vectors: the distinct vectors first in the order of md5(vec_id); copies only fill up what is missing.

    A top-k by hash needs no global sort or numbering of the table. Where copies crowd the first rows, the distinct
    vectors of the whole table are ordered instead, each by the first of its rows.
    """
    wanted, n = SEED_OVERSAMPLING * k, df.count()
    rows = _first_by_hash(df, column, wanted, n)
    if len(rows) < k:
        raise ConfigError(f"training needs at least {k} vectors, got {len(rows)}")
    _, first = np.unique(rows, axis=0, return_index=True)
    if len(first) < k and n > len(rows):
        order = F.struct(F.md5(F.col("vec_id").cast("string")).alias("h"), "vec_id")
        distinct = df.groupBy(column).agg(F.min(order).alias("first")).orderBy("first").limit(k)
        rows = np.concatenate([matrix(distinct.select(column).toArrow().column(0)), rows])
        _, first = np.unique(rows, axis=0, return_index=True)
    copies = np.setdiff1d(np.arange(len(rows)), first)
    return rows[np.r_[np.sort(first), copies][:k]]


def _first_by_hash(df: DataFrame, column: str, wanted: int, n: int) -> np.ndarray:
    """The ``wanted`` first vectors by md5(vec_id). A filter on the hash leaves about twice as many rows,
    so tasks do not each send their own ``wanted`` first rows."""
    digest = F.md5(F.col("vec_id").cast("string"))
    share = (2 * wanted + 64) / max(n, 1)
    some = df if share >= 1 else df.where(digest < f"{int(share * (1 << 128)):032x}")
    rows = matrix(some.orderBy(digest, "vec_id").limit(wanted).select(column).toArrow().column(0))
    if share < 1 and len(rows) < min(wanted, n):
        rows = matrix(df.orderBy(digest, "vec_id").limit(wanted).select(column).toArrow().column(0))
    return rows


def lloyd(df: DataFrame, column: str, *, k: int, rounds: int, segments: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Centres (segments, k, width) after ``rounds`` passes, and the sizes seen in the last pass.
    A centre that attracts no row stays where it was."""
    start = seeds(df, column, k)
    width = start.shape[1] // segments
    centres = start.reshape(k, segments, width).transpose(1, 0, 2).copy()
    n = np.zeros((segments, k), np.int64)
    for _ in range(rounds):
        held = df.sparkSession.sparkContext.broadcast(centres)

        def add(totals, batch):
            rows = matrix(batch.column(0))
            for s in range(segments):
                part = np.ascontiguousarray(rows[:, s * width:(s + 1) * width])
                totals.add_rows(nearest_one(part, held.value[s]) + s * k, part)

        sums = sum_by_slot(df.select(column), add, segments * k, width)
        n = sums.n.reshape(segments, k)
        total = sums.total.reshape(segments, k, width)
        filled = n > 0
        centres = centres.copy()
        centres[filled] = total[filled] / n[filled][:, None]
        held.unpersist()
    return centres, n


def majority(df: DataFrame, column: str, *, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit-code centres (k, bytes): a bit is set where more than half of the list has it set."""
    centres = seeds(df, column, k)
    n = np.zeros(k, np.int64)
    bits = centres.shape[1] * 8
    for _ in range(rounds):
        held = df.sparkSession.sparkContext.broadcast(centres)

        def add(totals, batch):
            rows = matrix(batch.column(0))
            lists = nearest_one(packed(rows), packed(held.value), "hamming")
            totals.add_rows(lists, np.unpackbits(rows, axis=1, bitorder="little").astype(np.float64))

        sums = sum_by_slot(df.select(column), add, k, bits)
        n, filled = sums.n, sums.n > 0
        centres = centres.copy()
        centres[filled] = np.packbits(
            2 * sums.total[filled] > n[filled][:, None], axis=1, bitorder="little"
        )
        held.unpersist()
    return centres, n

