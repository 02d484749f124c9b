"""Distance expressions over array columns (JVM side, no Python worker).

All sums run in double precision and in index order, so a result does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("l2", "ip", "cosine")


def _fold(products: Column) -> Column:
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def _dbl(x: Column) -> Column:
    return x.cast("double")


def squared_l2(a: Column, b: Column) -> Column:
    """Sum of squared differences (no square root)."""
    return _fold(F.zip_with(a, b, lambda x, y: (_dbl(x) - _dbl(y)) * (_dbl(x) - _dbl(y))))


def inner_product(a: Column, b: Column) -> Column:
    return _fold(F.zip_with(a, b, lambda x, y: _dbl(x) * _dbl(y)))


def norm(a: Column) -> Column:
    return F.sqrt(_fold(F.transform(a, lambda x: _dbl(x) * _dbl(x))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either side has zero norm."""
    denominator = norm(a) * norm(b)
    return F.when(denominator == 0.0, F.lit(0.0)).otherwise(inner_product(a, b) / denominator)


def hamming(a: Column, b: Column) -> Column:
    """Number of differing bits of two ``ARRAY<BIGINT>`` word columns."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")),
        F.lit(0), lambda total, x: total + x,
    )


def distance(metric: str, a: Column, b: Column) -> Column:
    return {"l2": squared_l2, "ip": inner_product, "cosine": cosine}[metric](a, b)
