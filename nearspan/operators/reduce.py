"""Linear pre-transforms: principal components, random rotation, rotation fitted to product codes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearspan.errors import ConfigError
from nearspan.operators.quantize import ProductModel, train_product
from nearspan.plans.kernels import list_column, matrix
from nearspan.plans.lloyd import nearest_one
from nearspan.plans.sums import sum_by_slot
from nearspan.session import attach


@dataclass(frozen=True)
class LinearModel:
    """``(x - mean) @ weights``."""

    mean: np.ndarray
    weights: np.ndarray

    def table(self, spark: SparkSession) -> DataFrame:
        """``(dim, mean, weights)``: one row per input dimension."""
        rows = [(i, float(m), w.tolist()) for i, (m, w) in enumerate(zip(self.mean, self.weights))]
        return spark.createDataFrame(rows, "dim int, mean double, weights array<double>")

    @classmethod
    def from_table(cls, table: DataFrame) -> "LinearModel":
        rows = table.orderBy("dim").toArrow()
        return cls(rows.column("mean").to_numpy(), matrix(rows.column("weights")))


def transform(df: DataFrame, model: LinearModel, column: str = "embedding") -> DataFrame:
    """Replace the vector column by its image."""
    attach(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def apply(v: pa.Array) -> pa.Array:
        return list_column(np.ascontiguousarray((matrix(v) - held.value.mean) @ held.value.weights),
                           pa.float64())

    return df.withColumn(column, apply(F.col(column)))


def mean_vector(df: DataFrame) -> np.ndarray:
    means = (df.select(F.posexplode("embedding").alias("dim", "x"))
             .groupBy("dim").agg(F.avg("x").alias("mean")).orderBy("dim").toArrow())
    return means.column("mean").to_numpy()


def train_pca(df: DataFrame, components: int, *, rotate: bool = False, seed: int = 11) -> LinearModel:
    """Leading principal components; ``rotate`` adds a seeded random rotation, which evens out the
    variance of the components."""
    vectors = df.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    weights = PCA(k=components, inputCol="v", outputCol="p").fit(vectors).pc.toArray()
    if rotate:
        weights = weights @ random_rotation(components, seed)
    return LinearModel(mean_vector(df), weights)


def random_rotation(dims: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def train_opq(df: DataFrame, segments: int, bits: int, *, dims: int, out_dims: int | None = None,
              rotations: int = 3, rounds: int = 3) -> tuple[LinearModel, ProductModel]:
    """Rotation that lowers the product-quantisation error (Ge et al. 2013, alternating form).

    Each step rotates, trains codebooks, sums the dims x dims cross-product of vectors and their decoded
    codes on the executors, and solves the orthogonal Procrustes problem on the driver.
    """
    out_dims = out_dims or dims
    if out_dims > dims or out_dims % segments:
        raise ConfigError("out_dims must not exceed dims and must be a multiple of segments")
    start = train_pca(df, out_dims, rotate=True) if out_dims < dims else None
    model = start or LinearModel(np.zeros(dims), random_rotation(dims))
    for _ in range(rotations):
        product = train_product(transform(df, model), segments, bits, dims=out_dims, rounds=rounds)
        cross = _cross_product(df, model, product)
        u, _, vt = np.linalg.svd(cross, full_matrices=False)
        model = LinearModel(model.mean, u @ vt)
    return model, train_product(transform(df, model), segments, bits, dims=out_dims, rounds=rounds)


def _cross_product(df: DataFrame, model: LinearModel, product: ProductModel) -> np.ndarray:
    """Sum over rows of x^T decoded(x), one result row per input dimension."""
    held = df.sparkSession.sparkContext.broadcast((model, product.codebooks))
    dims, out_dims = model.weights.shape

    def add(totals, batch):
        m, books = held.value
        x = matrix(batch.column(0)) - m.mean
        y, width = x @ m.weights, books.shape[2]
        for s, book in enumerate(books):
            part = slice(s * width, (s + 1) * width)
            y[:, part] = book[nearest_one(np.ascontiguousarray(y[:, part]), book)]
        totals.add_sums(np.arange(dims), np.ones(dims, np.int64), x.T @ y)

    return sum_by_slot(df.select("embedding"), add, dims, out_dims).total
