"""A stored vector table that changes by adding files: immutable parts, bitmaps of removed rows, commit records.

Below one folder: ``data/part=<name>/`` holds rows that never change, ``deletes/<name>/`` one bitmap per data file and block
of 32,768 rows with the rows taken out, ``commits/v=<number>/`` one record each. A record names every part and bitmap
folder of its version and is written last, so a change that fails half-way leaves files nobody reads, and a reader keeps
the version it opened. A version can be written once: of two writers that start from the same version the second gets an
error and may try again. A change with a ``token`` that is already recorded does nothing.

Removing writes bitmaps only. Reading joins them to the scan by file and block, which leaves data where it lies and keeps
partition filters; without removed rows a read is a plain scan.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from nearspan.errors import ConfigError

RECORD = "version long, token string, parts array<string>, deletes array<string>, ntotal long, next_id long, schema string"


@dataclass(frozen=True)
class Version:
    """One version of a stored table."""

    path: str
    version: int
    parts: tuple[str, ...]
    deletes: tuple[str, ...]
    ntotal: int
    next_id: int
    schema: str


def create(rows: DataFrame, path: str, *, partition_by: str | None = None, token: str | None = None) -> Version:
    """A new table from ``rows`` (with ``vec_id``); its first version is 1."""
    if _records(rows.sparkSession, path) is not None:
        raise ConfigError(f"{path} already holds a table")
    empty = Version(path, 0, (), (), 0, 0, rows.schema.json())
    return append(rows, empty, partition_by=partition_by, token=token)


def open_version(spark: SparkSession, path: str, version: int | None = None) -> Version:
    """The newest version, or the one asked for."""
    records = _records(spark, path)
    if records is None:
        raise ConfigError(f"{path} holds no table")
    wanted = records if version is None else records.where(F.col("version") == version)
    row = wanted.orderBy(F.desc("version")).first()
    if row is None:
        raise ConfigError(f"{path} has no version {version}")
    return Version(path, row.version, tuple(row.parts), tuple(row.deletes), row.ntotal, row.next_id, row.schema)


def history(spark: SparkSession, path: str) -> DataFrame:
    """``(version, token, parts, deletes, ntotal)``: one row per commit, with numbers of folders."""
    records = _records(spark, path)
    if records is None:
        raise ConfigError(f"{path} holds no table")
    return records.select("version", "token", F.size("parts").alias("parts"), F.size("deletes").alias("deletes"), "ntotal")


def rows(spark: SparkSession, at: Version) -> DataFrame:
    """The rows of a version."""
    return _located(spark, at).drop("__file", "__row")


def append(new: DataFrame, at: Version, *, partition_by: str | None = None, token: str | None = None) -> Version:
    """The next version with more rows, written as one new part."""
    spark = new.sparkSession
    done = _done(spark, at, token)
    if done:
        return done
    name = uuid.uuid4().hex
    out = new.hint("rebalance", partition_by) if partition_by else new
    writer = out.write.mode("errorifexists")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{at.path}/data/part={name}")
    written = _parts(spark, at, [name])
    n, top = written.agg(F.count(F.lit(1)), F.max("vec_id")).first()
    return _commit(spark, replace(at, parts=(*at.parts, name), ntotal=at.ntotal + n, next_id=max(at.next_id, (top if top is not None else -1) + 1)), token)


def remove(ids: DataFrame, at: Version, *, token: str | None = None) -> Version:
    """The next version without the rows whose ``vec_id`` is listed; only their places are written."""
    spark = ids.sparkSession
    done = _done(spark, at, token)
    if done:
        return done
    name = uuid.uuid4().hex
    gone = _located(spark, at).join(ids.select("vec_id").distinct(), "vec_id", "left_semi")
    bits = (gone.groupBy(F.col("__file").alias("file"), F.bitmap_bucket_number("__row").alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__row")).alias("bits")))
    bits.write.mode("errorifexists").parquet(f"{at.path}/deletes/{name}")
    n = spark.read.parquet(f"{at.path}/deletes/{name}").agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0))).first()[0]
    return _commit(spark, replace(at, deletes=(*at.deletes, name), ntotal=at.ntotal - n), token)


def merge(spark: SparkSession, at: Version, other: Version, *, partition_by: str | None = None, token: str | None = None) -> Version:
    """The next version with the rows of another table, whose ids move up behind those ever used here."""
    moved = rows(spark, other).withColumn("vec_id", F.col("vec_id") + F.lit(at.next_id))
    return append(moved, at, partition_by=partition_by, token=token)


def reset(spark: SparkSession, at: Version, *, token: str | None = None) -> Version:
    """The next version, without any rows; older versions stay readable."""
    return _done(spark, at, token) or _commit(spark, replace(at, parts=(), deletes=(), ntotal=0), token)


def compact(spark: SparkSession, at: Version, *, partition_by: str | None = None, token: str | None = None) -> Version:
    """The next version, with the same rows in one part and nothing to leave out."""
    return append(rows(spark, at), replace(at, parts=(), deletes=(), ntotal=0), partition_by=partition_by, token=token)


# ---- records and files

def _records(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(RECORD).json(f"{path}/commits/*")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _done(spark: SparkSession, at: Version, token: str | None) -> Version | None:
    """The newest version, if the change was made before."""
    records = _records(spark, at.path) if token is not None else None
    if records is None or records.where(F.col("token") == token).isEmpty():
        return None
    return open_version(spark, at.path)


def _commit(spark: SparkSession, new: Version, token: str | None) -> Version:
    new = replace(new, version=new.version + 1)
    row = (new.version, token, list(new.parts), list(new.deletes), new.ntotal, new.next_id, new.schema)
    try:
        spark.createDataFrame([row], RECORD).coalesce(1).write.mode("errorifexists").json(f"{new.path}/commits/v={new.version:09d}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_ALREADY_EXISTS":
            raise ConfigError(f"version {new.version} of {new.path} was written by another change") from error
        raise
    return new


def _parts(spark: SparkSession, at: Version, names: list[str]) -> DataFrame:
    """Rows of some parts with the file and the place they are stored at."""
    schema = _schema(at)
    if not names:
        return spark.createDataFrame([], schema).select("*", F.lit("").alias("__file"), F.lit(0).cast("long").alias("__row"))
    read = spark.read.schema(schema).option("basePath", f"{at.path}/data").parquet(*[f"{at.path}/data/part={n}" for n in names])
    file = F.substring_index("_metadata.file_path", "/part=", -1)
    return read.select(*schema.fieldNames(), file.alias("__file"), F.col("_metadata.row_index").alias("__row"))


def _schema(at: Version) -> StructType:
    return StructType.fromJson(json.loads(at.schema))


def _located(spark: SparkSession, at: Version) -> DataFrame:
    whole = _parts(spark, at, list(at.parts))
    if not at.deletes or not at.parts:
        return whole
    bits = (spark.read.schema("file string, block long, bits binary").parquet(*[f"{at.path}/deletes/{n}" for n in at.deletes])
            .groupBy("file", "block").agg(F.bitmap_or_agg("bits").alias("__bits")))
    spot = F.bitmap_bit_position("__row")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(spot / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    taken = byte.bitwiseAND(F.expr("shiftleft(1, cast(bitmap_bit_position(__row) % 8 as int))")) != 0
    joined = whole.join(bits, (F.col("__file") == F.col("file")) & (F.bitmap_bucket_number("__row") == F.col("block")), "left")
    return joined.where(~F.coalesce(taken, F.lit(False))).select(*whole.columns)
