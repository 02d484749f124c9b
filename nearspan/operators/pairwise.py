"""Distances of given pairs: row by row, or one vector against a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearspan.errors import ConfigError, DimensionError
from nearspan.functions import distance as dist


def aligned(left: DataFrame, right: DataFrame, key: str, *metrics: str, strict: bool = False) -> DataFrame:
    """``(key, distance)`` of rows that share the key, or one column per metric if several are named: one equi-join.

    A key that only one side has stays, with null distances; with ``strict`` its row makes the query fail.
    """
    metrics = metrics or ("l2",)
    for m in metrics:
        _check(m)
    a = left.select(key, F.col("embedding").alias("_a"))
    b = right.select(key, F.col("embedding").alias("_b"))
    if strict:
        lone = F.col("_a").isNull() | F.col("_b").isNull()
        fail = F.when(lone, F.raise_error(F.lit("a row has no partner of the same key")))
    else:
        fail = F.lit(None)
    names = ["distance"] if len(metrics) == 1 else metrics
    return a.join(b, key, "full").select(key, *[
        F.coalesce(fail.cast("double"), dist.distance(m, F.col("_a"), F.col("_b"))).alias(n)
        for m, n in zip(metrics, names, strict=True)])


def one_to_many(one: DataFrame, many: DataFrame, key: str, metric: str = "l2") -> DataFrame:
    """``(key, distance)`` of every row of ``many`` to the single row of ``one``.

    The single vector becomes a constant of the projection: no join.
    """
    _check(metric)
    rows = one.select(F.col("embedding").cast("array<double>")).take(2)
    if len(rows) != 1:
        raise DimensionError("the single side needs one row, neither none nor several")
    vector = F.lit(rows[0][0])
    return many.select(key, dist.distance(metric, F.col("embedding"), vector).alias("distance"))


def _check(metric: str) -> None:
    if metric not in dist.METRICS:
        raise ConfigError(f"metric must be one of: {', '.join(dist.METRICS)}")
