"""An index in a folder: rows as a versioned table (``sources.store``), models beside it, changes by commits."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from nearspan.errors import ConfigError, DimensionError
from nearspan.index import VectorIndex, same_models
from nearspan.sources import store, tables


@dataclass(frozen=True)
class StoredIndex:
    """One version of a stored index. Every change writes new files only and returns the next version."""

    index: VectorIndex
    at: store.Version

    @classmethod
    def create(cls, index: VectorIndex, path: str) -> "StoredIndex":
        """Store an index with rows: models, description, first version."""
        spark = index._filled().sparkSession
        for name, model in index.models.items():
            tables.save_model(spark, model, f"{path}/model_{name}")
        c = index.config
        tables.save_description(spark, path, dims=c.dims, kind=c.kind, metric=c.work_metric, n=0, extra={"config": dataclasses.asdict(c)})
        return cls(index, store.create(index.rows, path, partition_by=_layout(index)))._reread(spark)

    @classmethod
    def open(cls, spark: SparkSession, path: str, version: int | None = None) -> "StoredIndex":
        index = VectorIndex.load_models(spark, path)
        return cls(index, store.open_version(spark, path, version))._reread(spark)

    def _reread(self, spark: SparkSession) -> "StoredIndex":
        return StoredIndex(dataclasses.replace(self.index, rows=store.rows(spark, self.at), graph=None), self.at)

    def _moved(self, at: store.Version) -> "StoredIndex":
        return StoredIndex(self.index, at)._reread(self.index.rows.sparkSession)

    def search(self, queries: DataFrame, k: int, **options) -> DataFrame:
        return self.index.search(queries, k, **options)

    def add(self, df: DataFrame, *, token: str | None = None) -> "StoredIndex":
        """Encode rows by the stored models and commit them as one new part."""
        fresh = dataclasses.replace(self.index, rows=None, graph=None).add(df).rows
        return self._moved(store.append(fresh.select(*self.index.rows.columns), self.at, partition_by=_layout(self.index), token=token))

    def remove(self, ids: DataFrame, *, token: str | None = None) -> "StoredIndex":
        return self._moved(store.remove(ids, self.at, token=token))

    def merge(self, other: "StoredIndex", *, token: str | None = None) -> "StoredIndex":
        """Rows of another stored index with equal models, behind the own ids."""
        a, b = self.index, other.index
        if self.at.path == other.at.path:
            raise ConfigError("an index cannot be merged with itself")
        if a.config.dims != b.config.dims or a.config.is_bits != b.config.is_bits:
            raise DimensionError("indexes of different width cannot be merged")
        if not same_models(a.models, b.models):
            raise ConfigError("indexes with different models cannot be merged")
        return self._moved(store.merge(a.rows.sparkSession, self.at, other.at, partition_by=_layout(a), token=token))

    def reset(self, *, token: str | None = None) -> "StoredIndex":
        return self._moved(store.reset(self.index.rows.sparkSession, self.at, token=token))

    def compact(self, *, token: str | None = None) -> "StoredIndex":
        return self._moved(store.compact(self.index.rows.sparkSession, self.at, partition_by=_layout(self.index), token=token))


def _layout(index: VectorIndex) -> str | None:
    return "list_id" if "coarse" in index.models else None
