"""One object for a vector table, its settings and its trained models.

Every method that changes the table returns a new index; tables are ordinary lazy DataFrames.
"""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearspan.config import IndexConfig
from nearspan.errors import ConfigError, DimensionError, EmptyTableError, NotTrainedError
from nearspan.operators import exact, graph, hashing, ivf, maintain, quantize, reduce
from nearspan.operators.prep import split_valid, split_valid_codes
from nearspan.plans.search import Limits, check_k
from nearspan.session import cut_lineage
from nearspan.sources import tables


@dataclass(frozen=True)
class VectorIndex:
    """``rows`` holds ``vec_id``, the original vector and whatever the kind adds (list, codes)."""

    config: IndexConfig
    rows: DataFrame | None = None
    models: dict = field(default_factory=dict)
    graph: graph.Graph | None = None
    limits: Limits = Limits()

    # ---- training and content

    @property
    def column(self) -> str:
        return "code" if self.config.is_bits else "embedding"

    @property
    def is_trained(self) -> bool:
        return not self.config.needs_training or bool(self.models)

    def train(self, df: DataFrame) -> "VectorIndex":
        """Fit the models the kind needs: reduction, coarse centres, quantiser, in this order."""
        c, models = self.config, {}
        df = self._checked(df)
        if not c.needs_training:
            return self
        rounds = c.train_rounds
        if c.reduction == "OPQ":
            models["linear"], _ = reduce.train_opq(
                df, c.option("pq_segments"), c.option("pq_bits"), dims=c.dims, out_dims=c.work_dims, rounds=3)
        elif c.reduction:
            models["linear"] = reduce.train_pca(df, c.work_dims, rotate=c.reduction == "PCAR")
        if c.reduction:
            df = reduce.transform(df, models["linear"])
        if "IVF" in c.kind:
            models["coarse"] = ivf.train(df, c.option("nlist"), rounds=rounds, metric=c.work_metric)
        if c.kind.endswith("SQ"):
            models["scalar"] = quantize.train_scalar(df, c.option("sq_type"))
        elif c.kind == "PQ":
            models["product"] = quantize.train_product(
                df, c.option("pq_segments"), c.option("pq_bits"), dims=c.work_dims, rounds=rounds)
        elif c.kind == "IVF_PQ":
            models["product"] = quantize.train_ivf_product(
                df, models["coarse"], c.option("pq_segments"), c.option("pq_bits"), dims=c.work_dims, rounds=rounds)
        return replace(self, models=models)

    def add(self, df: DataFrame, *, auto_train: bool = False) -> "VectorIndex":
        """Add rows ``(vec_id, vector)``. With ``auto_train`` an untrained index is trained on them."""
        index = self
        if not index.is_trained:
            if not auto_train:
                raise NotTrainedError(f"{self.config.label} must be trained before rows are added")
            index = index.train(df)
        fresh = index._encoded(index._checked(df))
        rows = fresh if index.rows is None else index.rows.unionByName(fresh)
        if index.graph is not None:  # new rows are linked into it
            return replace(index, rows=rows, graph=graph.insert(index.graph, fresh, limits=index.limits))
        return index._with_rows(rows)

    def _checked(self, df: DataFrame) -> DataFrame:
        split = split_valid_codes if self.config.is_bits else split_valid
        good, _ = split(df.select("vec_id", self.column), self.config.dims, strict=True)
        return good

    def _reduced(self, df: DataFrame, out: str = "embedding") -> DataFrame:
        return reduce.transform(df, self.models["linear"]) if "linear" in self.models else df

    def _encoded(self, df: DataFrame) -> DataFrame:
        kind, models = self.config.kind, self.models
        df = self._reduced(df)
        if kind == "IVF_PQ":
            df = quantize.encode_ivf_product(df, models["coarse"], models["product"])
        elif kind == "PQ":
            df = quantize.encode_product(df, models["product"])
        else:
            if "coarse" in models:
                df = ivf.assign(df, models["coarse"])
            if "scalar" in models:
                df = quantize.encode_scalar(df, models["scalar"])
        return df.drop("embedding") if "codes" in df.columns else df

    def _with_rows(self, rows: DataFrame) -> "VectorIndex":
        return replace(self, rows=rows, graph=None)

    def materialize(self) -> "VectorIndex":
        """Write the rows once (and build the graph of a graph kind), so that searches do not encode again."""
        index = replace(self, rows=cut_lineage(self._filled()))
        return replace(index, graph=index._graph()) if self.config.kind.endswith("HNSW") else index

    def _filled(self) -> DataFrame:
        if self.rows is None:
            raise EmptyTableError("the index has no rows")
        return self.rows

    def _graph(self) -> graph.Graph:
        if self.graph is not None:
            return self.graph
        c = self.config
        built = graph.build(self._filled(), dims=c.work_dims, metric=c.work_metric, degree=c.option("degree"),
                            pool=c.option("ef_construction"), limits=self.limits)
        object.__setattr__(self, "graph", built)  # kept: later searches of this index do not build it again
        return built

    # ---- search

    def search(self, queries: DataFrame, k: int, *, nprobe: int | None = None, ef: int | None = None,
               strict: bool = False) -> DataFrame:
        """``(query_id, rank, vec_id, distance)`` of the k best rows per query."""
        check_k(k)
        if nprobe is not None and "coarse" not in self.models:
            raise ConfigError("nprobe needs an index with lists")
        rows, c, m = self._filled(), self.config, self.models
        if strict and rows.isEmpty():
            raise EmptyTableError("the index has no rows")
        queries = self._reduced(queries)
        lists = {"nprobe": nprobe or c.option("nprobe"), "limits": self.limits} if "coarse" in m else {}
        plain = {"limits": self.limits}
        match c.kind:
            case "FLAT_L2" | "FLAT_IP":
                return exact.knn(rows, queries, k, metric=c.work_metric, dims=c.work_dims, **plain)
            case "IVF_FLAT" | "BINARY_IVF":
                return ivf.search(rows, queries, m["coarse"], k, **lists)
            case "SQ":
                return quantize.search_scalar(rows, queries, m["scalar"], k, metric=c.work_metric, **plain)
            case "IVF_SQ":
                return quantize.search_ivf_scalar(rows, queries, m["coarse"], m["scalar"], k, **lists)
            case "PQ":
                return quantize.search_product(rows, queries, m["product"], k, metric=c.work_metric, **plain)
            case "IVF_PQ":
                return quantize.search_ivf_product(rows, queries, m["coarse"], m["product"], k, **lists)
            case "BINARY_FLAT":
                return exact.hamming_knn(rows, queries, k, dims=c.dims, **plain)
            case "BINARY_HASH":
                return hashing.search(rows, queries, k, dims=c.dims, hash_bits=c.option("hash_bits"),
                                      nflip=c.option("hash_nflip"), tables=c.option("hash_tables"), **plain)
            case _:
                return graph.search(self._graph(), queries, k, ef=ef or c.option("ef_search"), limits=self.limits)

    def range_search(self, queries: DataFrame, radius: float) -> DataFrame:
        """``(query_id, vec_id, distance)`` within the radius, over the stored (or decoded) vectors."""
        self._no_bits("range search")
        return exact.within(self.vectors(), self._reduced(queries), radius, metric=self.config.work_metric,
                            dims=self.config.work_dims, limits=self.limits)

    def range_counts(self, queries: DataFrame, radius: float) -> DataFrame:
        self._no_bits("range search")
        return exact.radius_counts(self.vectors(), self._reduced(queries), radius,
                                   metric=self.config.work_metric, dims=self.config.work_dims, limits=self.limits)

    def _no_bits(self, what: str) -> None:
        if self.config.is_bits:
            raise ConfigError(f"{what} is for float kinds")

    # ---- maintenance and inspection

    def vectors(self) -> DataFrame:
        """``(vec_id, vector)`` as stored: codes are decoded, a reduction stays applied."""
        rows, m = self._filled(), self.models
        if "codes" in rows.columns:
            if "scalar" in m:
                rows = quantize.decode_scalar(rows, m["scalar"])
            elif "coarse" in m:
                rows = quantize.decode_ivf_product(rows, m["coarse"], m["product"])
            else:
                rows = quantize.decode_product(rows, m["product"])
            return rows.select("vec_id", F.col("decoded").alias("embedding"))
        return rows.select("vec_id", self.column)

    def reconstruct(self, ids: DataFrame) -> DataFrame:
        """``(pos, vec_id, vector)`` of requested ids ``(pos, vec_id)``."""
        return maintain.lookup(self.vectors(), ids)

    def remove(self, ids: DataFrame) -> "VectorIndex":
        return self._with_rows(maintain.remove(self._filled(), ids))

    def removed_count(self, ids: DataFrame) -> DataFrame:
        return maintain.removed_count(self._filled(), ids)

    def merge(self, other: "VectorIndex") -> "VectorIndex":
        """Rows of ``other`` after the own ones. Indexes with models are encoded anew from vectors, so
        both must be plain, or share their models."""
        if other is self:
            raise ConfigError("an index cannot be merged with itself")
        if other.config.dims != self.config.dims or other.config.is_bits != self.config.is_bits:
            raise DimensionError("indexes of different width cannot be merged")
        if not same_models(self.models, other.models):
            raise ConfigError("indexes with different models cannot be merged")
        moved = other._filled().withColumn("vec_id", F.col("vec_id") + F.lit(maintain.next_id(self._filled())))
        return self._with_rows(self._filled().unionByName(moved))

    def reset(self) -> "VectorIndex":
        return self._with_rows(maintain.reset(self._filled()))

    def stats(self) -> DataFrame:
        c = self.config
        return maintain.stats(self._filled(), dims=c.dims, kind=c.label, metric=c.work_metric,
                              is_trained=self.is_trained)

    def inspect(self) -> DataFrame:
        """Statistics, settings and, for kinds with lists, their size distribution, as one row."""
        settings = {k: v for k, v in dataclasses.asdict(self.config).items() if v is not None}
        row = self.stats().withColumn("settings", F.to_json(F.create_map(
            *[F.lit(str(x)) for pair in sorted(settings.items()) for x in pair])))
        if "coarse" in self.models:
            skew = maintain.list_skew(self._filled())
            values = skew.first()
            row = row.select("*", *[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in skew.schema])
        hints = maintain.hints(row.sparkSession, kind=self.config.kind, metric=self.config.work_metric)
        texts = [r.hint for r in hints.collect()]
        return row.withColumn("hints", F.lit(texts) if texts else F.array().cast("array<string>"))

    def check(self, sample_size: int = 3) -> DataFrame:
        return maintain.check(self.vectors(), dims=self.config.work_dims, metric=self.config.work_metric,
                              sample_size=sample_size)

    # ---- persistence

    def save(self, path: str, extra: dict | None = None, mode: str = "errorifexists") -> None:
        """Rows (laid out by list where there are lists), models and description below one folder."""
        spark = self._filled().sparkSession
        c = self.config
        tables.save_table(
            self.rows, path, dims=c.dims, kind=c.kind, metric=c.work_metric, mode=mode,
            extra={"config": dataclasses.asdict(c), "user": extra or {}},
            partition_by="list_id" if "coarse" in self.models else None)
        for name, model in self.models.items():
            tables.save_model(spark, model, f"{path}/model_{name}", mode)
        if c.kind.endswith("HNSW"):
            graph.save(self._graph(), f"{path}/graph", mode)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "VectorIndex":
        index = cls.load_models(spark, path)
        c = index.config
        built = graph.load(spark, f"{path}/graph", c.work_metric, c.option("degree")) if c.kind.endswith("HNSW") else None
        return replace(index, rows=tables.load_table(spark, path, dims=c.dims), graph=built)

    @classmethod
    def load_models(cls, spark: SparkSession, path: str) -> "VectorIndex":
        """Settings and models of a saved index, without its rows."""
        meta = tables.load_metadata(spark, path)
        if meta is None:
            raise ConfigError(f"{path} has no description")
        config = IndexConfig(**meta["extra"]["config"])
        classes = {"linear": (reduce.LinearModel, {}), "scalar": (quantize.ScalarModel, {}),
                   "product": (quantize.ProductModel, {}),
                   "coarse": (ivf.CoarseModel, {"metric": config.work_metric})}
        wanted = []
        if config.reduction:
            wanted.append("linear")
        if "IVF" in config.kind:
            wanted.append("coarse")
        if config.kind.endswith("SQ"):
            wanted.append("scalar")
        if "PQ" in config.kind:
            wanted.append("product")
        models = {n: tables.load_model(spark, classes[n][0], f"{path}/model_{n}", **classes[n][1]) for n in wanted}
        return cls(config, None, models)


def same_models(a: dict, b: dict) -> bool:
    """Equal names, and equal values in every field: two loads of one folder have the same models."""
    def equal(x, y) -> bool:
        return type(x) is type(y) and all(
            np.array_equal(getattr(x, f.name), getattr(y, f.name)) for f in dataclasses.fields(x))

    return a.keys() == b.keys() and all(a[n] is b[n] or equal(a[n], b[n]) for n in a)
