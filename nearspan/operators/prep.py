"""Table preparation and data quality: validation, good/reject split, normalising, numbering, chunking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearspan.errors import ConfigError, InvalidVectorError
from nearspan.functions import bits, vectors
from nearspan.session import cut_lineage

ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its low 33 bits


def split_valid(df: DataFrame, dims: int, *, column: str = "embedding", strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows that hold a finite vector of the right width, and the other rows. ``strict`` raises instead."""
    ok = vectors.is_valid(F.col(column), dims)
    good, bad = df.where(ok), df.where(~ok)
    _refuse(bad, strict, f"rows without a finite vector of {dims} components")
    return good, bad


def split_valid_codes(df: DataFrame, dims: int, *, column: str = "code", strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """The same for bit codes: non-null and dims/8 bytes long."""
    _check_bits(dims)
    ok = F.coalesce(F.octet_length(column) == dims // 8, F.lit(False))
    good, bad = df.where(ok), df.where(~ok)
    _refuse(bad, strict, f"codes that are not {dims // 8} bytes long")
    return good, bad


def _refuse(bad: DataFrame, strict: bool, what: str) -> None:
    if strict and not bad.isEmpty():
        raise InvalidVectorError(f"the table has {what}")


def _check_bits(dims: int) -> None:
    if dims <= 0 or dims % 8:
        raise ConfigError("bit dimensions must be a positive multiple of 8")


def non_finite(df: DataFrame) -> DataFrame:
    """``(vec_id, component, value)`` of every null, NaN or infinite component."""
    positions = vectors.non_finite_positions(F.col("embedding"))
    return (df.select("vec_id", "embedding", F.explode(positions).alias("component"))
            .select("vec_id", "component", F.get("embedding", F.col("component")).alias("value")))


def zero_norm(df: DataFrame) -> DataFrame:
    """``vec_id`` of vectors whose finite components are all zero."""
    return df.where(vectors.finite_norm(F.col("embedding")) == 0.0).select("vec_id")


def validation_report(df: DataFrame, dims: int) -> DataFrame:
    """One row of counts. Zero norms are reported but do not make a table invalid."""
    v = F.col("embedding")
    bad = F.coalesce(F.size(vectors.non_finite_positions(v)), F.lit(0))
    wrong = F.coalesce(F.size(v) != dims, F.lit(True))
    return (
        df.select(bad.alias("bad"), wrong.alias("wrong"),
                  F.coalesce(vectors.finite_norm(v) == 0.0, F.lit(False)).alias("zero"))
        .agg(F.count(F.lit(1)).alias("vector_count"),
             F.coalesce(F.sum("bad"), F.lit(0)).alias("non_finite"),
             F.count_if(F.col("bad") > 0).alias("non_finite_vectors"),
             F.count_if("zero").alias("zero_norm_vectors"),
             F.count_if("wrong").alias("wrong_dims_vectors"))
        .withColumn("dims", F.lit(dims))
        .withColumn("valid", (F.col("non_finite") == 0) & (F.col("wrong_dims_vectors") == 0))
    )


def code_report(df: DataFrame, dims: int) -> DataFrame:
    """One row: count, wrong widths, bytes per code."""
    _check_bits(dims)
    wrong = F.coalesce(F.octet_length("code") != dims // 8, F.lit(True))
    return (df.agg(F.count(F.lit(1)).alias("vector_count"), F.count_if(wrong).alias("wrong_width"))
            .withColumn("dims", F.lit(dims)).withColumn("bytes_per_vector", F.lit(dims // 8))
            .withColumn("valid", F.col("wrong_width") == 0))


def normalize(df: DataFrame, column: str = "embedding") -> DataFrame:
    return df.withColumn(column, vectors.normalize(F.col(column)))


def binarize(df: DataFrame, dims: int, column: str = "embedding", out: str = "code") -> DataFrame:
    """Sign bits of a float vector as a packed code."""
    _check_bits(dims)
    return df.withColumn(out, bits.sign_code(F.col(column), dims))


def numbered(df: DataFrame, order: list[Column | str], *, start: int | Column = 0, out: str = "seq") -> DataFrame:
    """Add consecutive numbers in the given order without bringing the table into one task.

    The table is range-partitioned and sorted; row numbers inside each partition are shifted by the
    running total of the partition sizes (a table of one row per partition). The sorted table is written
    once, so that numbers do not change if a task is repeated.
    """
    mark = F.monotonically_increasing_id()
    ordered = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mark", mark))
    part = F.shiftright("_mark", ROW_BITS)
    sizes = ordered.groupBy(part.alias("_part")).count()
    before = F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    first = start if isinstance(start, Column) else F.lit(start)
    number = F.col("_before") + F.col("_mark").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + first
    return (ordered.withColumn("_part", part).join(F.broadcast(shifts), "_part")
            .withColumn(out, number.cast("bigint")).drop("_part", "_mark", "_before"))


def chunked(df: DataFrame, chunk_size: int, order: str = "vec_id") -> DataFrame:
    """Add ``chunk_id``: consecutive runs of ``chunk_size`` rows in ``order``; the last may be shorter."""
    if chunk_size <= 0:
        raise ConfigError("chunk_size must be a positive integer")
    return (numbered(df, [order], out="_seq")
            .withColumn("chunk_id", F.floor(F.col("_seq") / chunk_size).cast("bigint")).drop("_seq"))
