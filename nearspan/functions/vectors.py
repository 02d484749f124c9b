"""Per-row vector expressions: checks, normalisation, scaling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nearspan.functions.distance import norm


def _not_finite(x: Column) -> Column:
    x = x.cast("double")
    return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))


def is_valid(v: Column, dims: int) -> Column:
    """True for a non-null vector of the wanted width whose components are all finite."""
    return F.coalesce(v.isNotNull() & (F.size(v) == dims) & ~F.exists(v, _not_finite), F.lit(False))


def non_finite_positions(v: Column) -> Column:
    """Positions (from 0) of null, NaN or infinite components."""
    return F.filter(
        F.transform(v, lambda x, i: F.when(_not_finite(x), i)), lambda i: i.isNotNull()
    )


def finite_norm(v: Column) -> Column:
    """Norm over the finite components only."""
    return norm(F.transform(v, lambda x: F.when(_not_finite(x), 0.0).otherwise(x.cast("double"))))


def normalize(v: Column) -> Column:
    """Divide by the L2 norm; a zero vector stays zero. The norm is bound once per row (inside the
    lambda of the components it would be computed for each of them)."""
    def divided(n: Column) -> Column:
        return F.transform(v, lambda x: F.when(n == 0.0, F.lit(0.0)).otherwise(x.cast("double") / n))

    return F.get(F.transform(F.array(norm(v)), divided), 0)


def scale(v: Column, factor: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double") * factor)


def slot_of(v: Column, pos: Column, start: int, width: int) -> Column:
    return F.slice(v, start + 1 + pos * width, width)
