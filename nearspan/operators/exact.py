"""Exact search: nearest neighbours, radius joins and radius counts over float vectors or bit codes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearspan.errors import ConfigError, EmptyTableError
from nearspan.functions.vectors import normalize
from nearspan.plans.kernels import Scorer
from nearspan.plans.search import Ask, Limits, check_k, keyed, match_tables

FLOAT_METRICS = ("l2", "ip", "cosine")


def _prepare(base: DataFrame, queries: DataFrame, metric: str):
    """Cosine is an inner product of normalised vectors."""
    if metric not in FLOAT_METRICS:
        raise ConfigError(f"metric must be one of {', '.join(FLOAT_METRICS)}")
    if metric != "cosine":
        return base, queries, metric
    unit = normalize(F.col("embedding"))
    return base.withColumn("embedding", unit), queries.withColumn("embedding", unit), "ip"


def _strict(base: DataFrame, strict: bool) -> None:
    if strict and base.isEmpty():
        raise EmptyTableError("the base table is empty")


def knn(base: DataFrame, queries: DataFrame, k: int, *, metric: str = "l2", dims: int,
        strict: bool = False, limits: Limits = Limits()) -> DataFrame:
    """``(query_id, rank, vec_id, distance)``: the k best base rows of every query.

    ``l2`` is the squared distance, ascending; ``ip`` and ``cosine`` are scores, descending. Fewer than k
    base rows give fewer result rows.
    """
    check_k(k)
    _strict(base, strict)
    base, queries, metric = _prepare(base, queries, metric)
    hits = match_tables(base, queries, Ask(Scorer(metric), k=k), width=8 * dims, limits=limits)
    return ranked(hits, metric)


def ranked(hits: DataFrame, metric: str) -> DataFrame:
    return hits.select("query_id", "rank", "vec_id", keyed(metric).alias("distance"))


def _radius_key(radius: float, metric: str) -> float:
    if not isinstance(radius, (int, float)) or not math.isfinite(radius):
        raise ConfigError("radius must be a finite number")
    if metric == "l2" and radius < 0:
        raise ConfigError("an l2 radius must not be negative")
    return float(radius) if metric == "l2" else -float(radius)


def within(base: DataFrame, queries: DataFrame, radius: float, *, metric: str = "l2", dims: int,
           limits: Limits = Limits()) -> DataFrame:
    """``(query_id, vec_id, distance)`` with distance strictly below (l2) or score strictly above
    (ip, cosine) the radius. The row set is unordered and may be large; see :func:`radius_counts`."""
    base, queries, metric = _prepare(base, queries, metric)
    ask = Ask(Scorer(metric), radius=_radius_key(radius, metric))
    hits = match_tables(base, queries, ask, width=8 * dims, limits=limits)
    return hits.withColumn("distance", keyed(metric))


def radius_counts(base: DataFrame, queries: DataFrame, radius: float, *, metric: str = "l2", dims: int,
                  limits: Limits = Limits()) -> DataFrame:
    """``(query_id, n)``: hits per query, zero included, counted where the pairs are scored."""
    wanted = queries.select(F.col("query_id").cast("bigint").alias("query_id"))
    base, queries, metric = _prepare(base, queries, metric)
    ask = Ask(Scorer(metric), radius=_radius_key(radius, metric), counting=True)
    counts = match_tables(base, queries, ask, width=8 * dims, limits=limits)
    return wanted.join(counts, "query_id", "left").select("query_id", F.coalesce("n", F.lit(0)).alias("n"))


def hamming_knn(base: DataFrame, queries: DataFrame, k: int, *, dims: int, strict: bool = False,
                limits: Limits = Limits()) -> DataFrame:
    """k nearest bit codes; tables hold ``code BINARY`` of dims/8 bytes. Distances are integers."""
    check_k(k)
    _strict(base, strict)
    hits = match_tables(base, queries, Ask(Scorer("hamming"), k=k), base_vector="code",
                        query_vector="code", width=dims // 8, limits=limits)
    return ranked(hits, "hamming").withColumn("distance", F.col("distance").cast("int"))
