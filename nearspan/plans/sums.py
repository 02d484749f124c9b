"""Vector sums by key: added up inside each task first, then once per key across tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from nearspan.plans.kernels import list_column, matrix
from nearspan.session import attach

SUMS = "slot int, n long, total array<double>"


class Totals:
    """Running counts and sums of ``slots`` vectors; its size is that of the model being trained."""

    def __init__(self, slots: int, width: int):
        self.n = np.zeros(slots, np.int64)
        self.total = np.zeros((slots, width))

    def add_rows(self, slots: np.ndarray, rows: np.ndarray) -> None:
        self.n += np.bincount(slots, minlength=len(self.n))
        for j in range(rows.shape[1]):
            self.total[:, j] += np.bincount(slots, weights=rows[:, j], minlength=len(self.n))

    def add_sums(self, slots: np.ndarray, n: np.ndarray, totals: np.ndarray) -> None:
        np.add.at(self.n, slots, n)
        np.add.at(self.total, slots, totals)

    def batch(self) -> pa.RecordBatch:
        some = np.flatnonzero(self.n)
        return pa.record_batch({
            "slot": pa.array(some, pa.int32()), "n": pa.array(self.n[some]),
            "total": list_column(self.total[some], pa.float64()),
        })


def sum_by_slot(df: DataFrame, add: Callable[[Totals, pa.RecordBatch], None], slots: int,
                width: int) -> Totals:
    """Run ``add`` on every Arrow batch of ``df`` and bring the sums to the driver.

    Each task returns at most ``slots`` rows; these are hashed by slot and added once more before the
    driver takes the ``slots`` final rows.
    """
    attach(df.sparkSession)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = Totals(slots, width)
        for batch in batches:
            if batch.num_rows:
                add(totals, batch)
        yield totals.batch()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = Totals(slots, width)
        for batch in batches:
            if batch.num_rows:
                totals.add_sums(batch.column(0).to_numpy(), batch.column(1).to_numpy(),
                                matrix(batch.column(2)))
        yield totals.batch()

    partial = df.mapInArrow(local, SUMS).repartition("slot")
    table = partial.mapInArrow(merged, SUMS).toArrow()
    out = Totals(slots, width)
    if table.num_rows:
        out.add_sums(table.column(0).to_numpy(), table.column(1).to_numpy(), matrix(table.column(2)))
    return out
