"""Saved vector tables and models: Parquet data with a one-row JSON description beside it."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearspan.errors import DimensionError

FORMAT_VERSION = 1


def save_table(df: DataFrame, path: str, *, dims: int, kind: str, metric: str, extra: dict | None = None,
               partition_by: str | None = None, mode: str = "errorifexists") -> None:
    """Write the rows to ``path/data`` and their description to ``path/meta``.

    ``partition_by="list_id"`` lays an assigned table out by list, so that a search reads only the
    probed lists.
    """
    if partition_by:
        # one task per list where lists are small, several where a list is large (adaptive split)
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{path}/data")
    n = df.sparkSession.read.parquet(f"{path}/data").count()
    save_description(df.sparkSession, path, dims=dims, kind=kind, metric=metric, n=n, extra=extra, mode=mode)


def save_description(spark: SparkSession, path: str, *, dims: int, kind: str, metric: str, n: int, extra: dict | None = None,
                     mode: str = "errorifexists") -> None:
    """The one-row description in ``path/meta``."""
    row = (FORMAT_VERSION, kind, metric, dims, n, json.dumps(extra or {}, sort_keys=True))
    meta = spark.createDataFrame(
        [row], "version int, kind string, metric string, dims int, ntotal long, extra string")
    meta.withColumn("saved_at", F.current_timestamp()).coalesce(1).write.mode(mode).json(f"{path}/meta")


def load_metadata(spark: SparkSession, path: str) -> dict | None:
    """The description, or None when there is none."""
    try:
        row = spark.read.schema(
            "version int, kind string, metric string, dims int, ntotal long, extra string, saved_at timestamp"
        ).json(f"{path}/meta").first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if row is None else {**row.asDict(), "extra": json.loads(row.extra)}


def load_table(spark: SparkSession, path: str, *, dims: int | None = None, check: bool = True) -> DataFrame:
    """The rows of a saved table. With ``check`` the row count and width are compared with the
    description (the count comes from Parquet footers)."""
    df = spark.read.parquet(f"{path}/data")
    meta = load_metadata(spark, path) if check else None
    if meta:
        if dims is not None and dims != meta["dims"]:
            raise DimensionError(f"{path} holds vectors of width {meta['dims']}, not {dims}")
        n = df.count()
        if n != meta["ntotal"]:
            raise DimensionError(f"{path} holds {n} rows, its description says {meta['ntotal']}")
    return df


def save_model(spark: SparkSession, model, path: str, mode: str = "errorifexists") -> None:
    """Any model of this package: they all have a ``table(spark)`` form."""
    model.table(spark).coalesce(1).write.mode(mode).parquet(path)


def load_model(spark: SparkSession, model_class, path: str, **options):
    return model_class.from_table(spark.read.parquet(path), **options)


def write_results(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Result rows as JSON lines, one file per task."""
    df.write.mode(mode).json(path)
