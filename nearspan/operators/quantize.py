"""Scalar and product quantisation: train, encode, decode, search on codes."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearspan.errors import ConfigError, DimensionError
from nearspan.operators import ivf
from nearspan.operators.exact import ranked
from nearspan.plans.kernels import Scorer, list_column, matrix
from nearspan.plans.lloyd import lloyd, nearest_one
from nearspan.plans.search import Ask, Limits, check_k, match_tables
from nearspan.session import attach

CODES = "array<smallint>"
# fixed values: names of the scalar types and their bits per component
SCALAR_BITS = {"SQ8": 8, "SQ6": 6, "SQ4": 4, "SQFP16": 16}


# ---- scalar quantisation -------------------------------------------------------------------------

@dataclass(frozen=True)
class ScalarModel:
    """Per-dimension range cut into ``levels`` steps; half-precision floats need no range."""

    low: np.ndarray
    step: np.ndarray
    levels: int

    @property
    def half(self) -> bool:
        return self.levels == 0

    def scorer(self, metric: str) -> Scorer:
        if self.half:
            return Scorer(metric)
        return Scorer(metric, step=self.step, low=self.low + 0.5 * self.step)

    def table(self, spark: SparkSession) -> DataFrame:
        """``(dim, low, step, levels)``."""
        rows = [(i, float(a), float(b), self.levels) for i, (a, b) in enumerate(zip(self.low, self.step))]
        return spark.createDataFrame(rows, "dim int, low double, step double, levels int")

    @classmethod
    def from_table(cls, table: DataFrame) -> "ScalarModel":
        rows = table.orderBy("dim").toArrow()
        return cls(rows.column("low").to_numpy(), rows.column("step").to_numpy(),
                   int(rows.column("levels")[0].as_py()))


def scalar_bits(sq_type: str) -> int:
    name = re.sub(r"[^A-Z0-9]", "", str(sq_type).upper())
    if name not in SCALAR_BITS:
        raise ConfigError(f"scalar type {sq_type!r} not supported; use one of {', '.join(SCALAR_BITS)}")
    return SCALAR_BITS[name]


def train_scalar(df: DataFrame, sq_type: str = "SQ8") -> ScalarModel:
    """Minimum and maximum of every dimension: one row of each per task, null or non-finite vectors are an error."""
    bits = scalar_bits(sq_type)
    attach(df.sparkSession)

    def ends(batches):
        low = high = None
        for b in batches:
            if b.num_rows:
                rows = matrix(b.column(0))
                if low is not None and rows.shape[1] != len(low):
                    raise ValueError("vectors of one table must all have the same width")
                low = rows.min(axis=0) if low is None else np.minimum(low, rows.min(axis=0))
                high = rows.max(axis=0) if high is None else np.maximum(high, rows.max(axis=0))
        if low is not None:
            yield pa.record_batch([pa.array(np.arange(len(low), dtype=np.int32)), pa.array(low), pa.array(high)],
                                  ["dim", "low", "high"])

    ranges = (df.select("embedding").mapInArrow(ends, "dim int, low double, high double").groupBy("dim")
              .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count(F.lit(1)).alias("n")).orderBy("dim").toArrow())
    if not ranges.num_rows:
        raise ConfigError("scalar ranges need at least one vector")
    if len(set(ranges.column("n").to_pylist())) > 1:
        raise DimensionError("vectors of one table must all have the same width")
    low, high = ranges.column("low").to_numpy(), ranges.column("high").to_numpy()
    if bits == 16:
        if max(abs(low).max(), abs(high).max()) > np.finfo(np.float16).max:
            raise ConfigError("values beyond the range of half-precision floats")
        return ScalarModel(low * 0, low * 0, 0)
    levels = (1 << bits) - 1
    return ScalarModel(low, (high - low) / levels, levels)


def encode_scalar(df: DataFrame, model: ScalarModel, out: str = "codes") -> DataFrame:
    """Add the code column; values outside the trained range go to its ends."""
    attach(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(CODES)
    def encode(v: pa.Array) -> pa.Array:
        m, rows = held.value, matrix(v)
        if m.half:
            return list_column(rows.astype(np.float16).view(np.int16), pa.int16())
        step = np.where(m.step == 0, 1.0, m.step)
        codes = np.clip(np.floor((rows - m.low) / step), 0, m.levels)
        return list_column(codes.astype(np.int16), pa.int16())

    return df.withColumn(out, encode(F.col("embedding")))


def decode_scalar(df: DataFrame, model: ScalarModel, codes: str = "codes", out: str = "decoded") -> DataFrame:
    """Add the middle of each component's step."""
    attach(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def decode(v: pa.Array) -> pa.Array:
        m, rows = held.value, matrix(v)
        if m.half:
            rows = rows.astype(np.int16).view(np.float16).astype(np.float64)
        else:
            rows = rows * m.step + (m.low + 0.5 * m.step)
        return list_column(rows, pa.float64())

    return df.withColumn(out, decode(F.col(codes)))


def _scalar_side(encoded: DataFrame, model: ScalarModel) -> tuple[DataFrame, str]:
    """Integer codes are decoded inside the scoring task; half floats before it."""
    if not model.half:
        return encoded, "codes"
    return decode_scalar(encoded, model), "decoded"


def search_scalar(encoded: DataFrame, queries: DataFrame, model: ScalarModel, k: int, *,
                  metric: str = "l2", limits: Limits = Limits()) -> DataFrame:
    """Top-k over all codes (no partitioning)."""
    check_k(k)
    base, column = _scalar_side(encoded, model)
    hits = match_tables(base, queries, Ask(model.scorer(metric), k=k), base_vector=column,
                        width=8 * len(model.low), limits=limits)
    return ranked(hits, metric)


def search_ivf_scalar(encoded: DataFrame, queries: DataFrame, coarse: ivf.CoarseModel, model: ScalarModel,
                      k: int, *, nprobe: int = 10, limits: Limits = Limits()) -> DataFrame:
    """Top-k over the codes of the probed lists."""
    base, column = _scalar_side(encoded, model)
    return ivf.search(base, queries, coarse, k, nprobe=nprobe, scorer=model.scorer(coarse.metric),
                      base_vector=column, limits=limits)


# ---- product quantisation ------------------------------------------------------------------------

@dataclass(frozen=True)
class ProductModel:
    """Codebooks (segments, codes, width)."""

    codebooks: np.ndarray

    @property
    def segments(self) -> int:
        return self.codebooks.shape[0]

    def scorer(self, metric: str) -> Scorer:
        return Scorer("adc_ip" if metric == "ip" else "adc", codebooks=self.codebooks)

    def table(self, spark: SparkSession) -> DataFrame:
        """``(segment, code, centroid)``."""
        rows = [(s, c, row.tolist()) for s, book in enumerate(self.codebooks) for c, row in enumerate(book)]
        return spark.createDataFrame(rows, "segment int, code int, centroid array<double>")

    @classmethod
    def from_table(cls, table: DataFrame) -> "ProductModel":
        rows = table.orderBy("segment", "code").toArrow()
        segments = int(rows.column("segment")[-1].as_py()) + 1
        flat = matrix(rows.column("centroid"))
        return cls(flat.reshape(segments, len(flat) // segments, flat.shape[1]))


def train_product(df: DataFrame, segments: int = 8, bits: int = 8, *, dims: int, column: str = "embedding",
                  rounds: int = ivf.DEFAULT_ROUNDS) -> ProductModel:
    """2**bits centres per segment; all segments are trained in the same passes over the table."""
    if dims % segments:
        raise DimensionError(f"{dims} components cannot be cut into {segments} segments of one width")
    codebooks, _ = lloyd(df, column, k=1 << bits, rounds=rounds, segments=segments)
    return ProductModel(codebooks)


def encode_product(df: DataFrame, model: ProductModel, column: str = "embedding", out: str = "codes") -> DataFrame:
    """Add the closest code of every segment."""
    attach(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(CODES)
    def encode(v: pa.Array) -> pa.Array:
        books, rows = held.value.codebooks, matrix(v)
        width = books.shape[2]
        codes = np.empty((len(rows), len(books)), np.int16)
        for s, book in enumerate(books):
            codes[:, s] = nearest_one(np.ascontiguousarray(rows[:, s * width:(s + 1) * width]), book)
        return list_column(codes, pa.int16())

    return df.withColumn(out, encode(F.col(column)))


def decode_product(df: DataFrame, model: ProductModel, codes: str = "codes", out: str = "decoded") -> DataFrame:
    """Add the concatenation of the chosen centres."""
    attach(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def decode(v: pa.Array) -> pa.Array:
        books, rows = held.value.codebooks, matrix(v).astype(np.intp)
        parts = [book[rows[:, s]] for s, book in enumerate(books)]
        return list_column(np.ascontiguousarray(np.concatenate(parts, axis=1)), pa.float64())

    return df.withColumn(out, decode(F.col(codes)))


def search_product(encoded: DataFrame, queries: DataFrame, model: ProductModel, k: int, *,
                   metric: str = "l2", limits: Limits = Limits()) -> DataFrame:
    """Asymmetric search: full queries against codes, by one lookup table per query and segment."""
    check_k(k)
    hits = match_tables(encoded, queries, Ask(model.scorer(metric), k=k), base_vector="codes",
                        width=8 * model.segments * model.codebooks.shape[2], limits=limits)
    return ranked(hits, metric)


def residual(df: DataFrame, coarse: ivf.CoarseModel, out: str = "residual") -> DataFrame:
    """Add embedding minus the centre of the row's list."""
    attach(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(coarse)

    @F.arrow_udf("array<double>")
    def minus_centre(v: pa.Array, lists: pa.Array) -> pa.Array:
        rows = matrix(v) - held.value.centres[lists.to_numpy(zero_copy_only=False)]
        return list_column(rows, pa.float64())

    return df.withColumn(out, minus_centre(F.col("embedding"), F.col("list_id")))


def train_ivf_product(df: DataFrame, coarse: ivf.CoarseModel, segments: int = 8, bits: int = 8, *,
                      dims: int, rounds: int = ivf.DEFAULT_ROUNDS) -> ProductModel:
    """Codebooks over residuals (l2), or over the vectors themselves (ip)."""
    assigned = ivf.assign(df, coarse)
    if coarse.metric == "ip":
        return train_product(assigned, segments, bits, dims=dims, rounds=rounds)
    return train_product(residual(assigned, coarse), segments, bits, dims=dims, column="residual", rounds=rounds)


def encode_ivf_product(df: DataFrame, coarse: ivf.CoarseModel, model: ProductModel) -> DataFrame:
    """Add ``list_id`` and ``codes``."""
    assigned = ivf.assign(df, coarse)
    if coarse.metric == "ip":
        return encode_product(assigned, model)
    return encode_product(residual(assigned, coarse), model, "residual").drop("residual")


def decode_ivf_product(encoded: DataFrame, coarse: ivf.CoarseModel, model: ProductModel,
                       out: str = "decoded") -> DataFrame:
    decoded = decode_product(encoded, model, out=out)
    if coarse.metric == "ip":
        return decoded
    centres = F.broadcast(coarse.table(encoded.sparkSession))
    return (decoded.join(centres, "list_id")
            .withColumn(out, F.zip_with(out, "centroid", lambda a, b: a + b)).drop("centroid"))


def search_ivf_product(encoded: DataFrame, queries: DataFrame, coarse: ivf.CoarseModel, model: ProductModel,
                       k: int, *, nprobe: int = 10, limits: Limits = Limits()) -> DataFrame:
    """Probe lists, then score the codes of their rows against the query's residual for that list."""
    check_k(k)
    probed = ivf.probe(queries, coarse, nprobe)
    vector: Column | str = "embedding"
    if coarse.metric != "ip":
        probed, vector = residual(probed, coarse), "residual"
    hits = match_tables(encoded, probed, Ask(model.scorer(coarse.metric), k=k), group="list_id",
                        base_vector="codes", query_vector=vector,
                        width=8 * coarse.centres.shape[1], limits=limits)
    return ranked(hits, coarse.metric)
