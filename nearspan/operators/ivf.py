"""Partitioned search: coarse centres, list assignment and probing (inverted lists)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearspan.errors import ConfigError, DimensionError
from nearspan.operators.exact import ranked
from nearspan.plans.kernels import Scorer, list_column, matrix, packed
from nearspan.plans.lloyd import lloyd, majority, nearest_lists, nearest_one
from nearspan.plans.search import Ask, Limits, check_k, match_tables
from nearspan.session import attach

DEFAULT_ROUNDS = 10


@dataclass(frozen=True)
class CoarseModel:
    """nlist centres. ``metric`` is l2, ip or hamming (then centres are rows of bytes)."""

    centres: np.ndarray
    metric: str = "l2"
    sizes: np.ndarray | None = None

    @property
    def nlist(self) -> int:
        return len(self.centres)

    @property
    def column(self) -> str:
        return "code" if self.metric == "hamming" else "embedding"

    def table(self, spark: SparkSession) -> DataFrame:
        """``(list_id, centroid)``; a bit centroid is BINARY."""
        if self.metric == "hamming":
            rows = [(i, bytearray(c.tobytes())) for i, c in enumerate(self.centres)]
            return spark.createDataFrame(rows, "list_id int, centroid binary")
        rows = [(i, c.tolist()) for i, c in enumerate(self.centres)]
        return spark.createDataFrame(rows, "list_id int, centroid array<double>")

    @classmethod
    def from_table(cls, table: DataFrame, metric: str = "l2") -> "CoarseModel":
        rows = table.orderBy("list_id").select("centroid").toArrow().column(0)
        return cls(matrix(rows), metric)


def train(df: DataFrame, nlist: int, *, rounds: int = DEFAULT_ROUNDS, metric: str = "l2") -> CoarseModel:
    """Coarse centres from the training table; it needs at least ``nlist`` rows."""
    attach(df.sparkSession)
    if nlist <= 0:
        raise ConfigError("nlist must be a positive integer")
    if metric == "hamming":
        centres, sizes = majority(df, "code", k=nlist, rounds=rounds)
        return CoarseModel(centres, metric, sizes)
    centres, sizes = lloyd(df, "embedding", k=nlist, rounds=rounds)
    return CoarseModel(centres[0], metric, sizes[0])


def _loaded(model: CoarseModel, rows: np.ndarray) -> np.ndarray:
    if rows.shape[1] != model.centres.shape[1]:
        raise DimensionError(f"vectors of width {rows.shape[1]}, model of width {model.centres.shape[1]}")
    return packed(rows) if model.metric == "hamming" else rows


def assign(df: DataFrame, model: CoarseModel) -> DataFrame:
    """Add ``list_id``, the closest centre (ties: smaller id). A map over the table, no shuffle."""
    attach(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("int")
    def list_of(v: pa.Array) -> pa.Array:
        m = held.value
        return pa.array(nearest_one(_loaded(m, matrix(v)), _loaded(m, m.centres), m.metric), pa.int32())

    return df.withColumn("list_id", list_of(F.col(model.column)))


def probe(queries: DataFrame, model: CoarseModel, nprobe: int, *, rank: str | None = None) -> DataFrame:
    """One row per query and probed list; ``rank`` names a column for the list's place (0 is the nearest)."""
    attach(queries.sparkSession)
    count = min(nprobe, model.nlist)
    held = queries.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<int>")
    def lists_of(v: pa.Array) -> pa.Array:
        m = held.value
        return list_column(nearest_lists(_loaded(m, matrix(v)), _loaded(m, m.centres), count, m.metric),
                           pa.int32())

    lists = lists_of(F.col(model.column))
    if rank:
        return queries.select("*", F.posexplode(lists).alias(rank, "list_id"))
    return queries.withColumn("list_id", F.explode(lists))


def nearest_places(model: CoarseModel, rows: np.ndarray, count: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, place, its lists) of the ``count`` closest lists of each row, gathered by ``places``, the place of every list."""
    lists = nearest_lists(_loaded(model, rows), _loaded(model, model.centres), min(count, model.nlist), model.metric)
    there = places[lists]
    order = np.argsort(there, axis=1, kind="stable")
    lists, there = np.take_along_axis(lists, order, 1), np.take_along_axis(there, order, 1)
    first = np.flatnonzero(np.c_[np.ones(len(there), bool), there[:, 1:] != there[:, :-1]].ravel())
    held = pa.ListArray.from_arrays(pa.array(np.r_[first, lists.size], pa.int32()), pa.array(lists.ravel(), pa.int32()))
    return first // lists.shape[1], there.ravel()[first], held


def search(assigned: DataFrame, queries: DataFrame, model: CoarseModel, k: int, *, nprobe: int = 10,
           scorer: Scorer | None = None, base_vector: Column | str | None = None,
           query_vector: Column | str | None = None, width: int | None = None,
           limits: Limits = Limits()) -> DataFrame:
    """Top-k among the rows of the ``nprobe`` lists closest to each query.

    The candidate step is an equi-match on ``list_id``; a list that holds a large share of all rows is
    cut into several cells (see ``plans.search``).
    """
    check_k(k)
    if nprobe <= 0:
        raise ConfigError("nprobe must be a positive integer")
    scorer = scorer or Scorer(model.metric)
    width = width or (model.centres.shape[1] * (1 if model.metric == "hamming" else 8))
    hits = match_tables(
        assigned, probe(queries, model, nprobe), Ask(scorer, k=k), group="list_id", width=width,
        base_vector=base_vector or model.column, query_vector=query_vector or model.column, limits=limits,
    )
    out = ranked(hits, scorer.metric)
    return out.withColumn("distance", F.col("distance").cast("int")) if model.metric == "hamming" else out


def list_sizes(assigned: DataFrame) -> DataFrame:
    """``(list_id, n)``."""
    return assigned.groupBy("list_id").agg(F.count(F.lit(1)).alias("n"))
