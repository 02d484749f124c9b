"""Session plumbing: shipping the package to executors, size of Arrow batches, checkpoint folder, scratch tables."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()

BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def attach(spark: SparkSession) -> None:
    """Make this package importable in Python workers (once per application)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="nearspan-ship-"), "nearspan_pkg"),
        "zip", root_dir=root, base_dir="nearspan",
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def bound_batches(spark: SparkSession) -> None:
    """Whole texts go to Python workers in batches of about 4 MB, not of 10,000 rows or 64 MB.

    A batch is held by the writer of the task, its queue of rows that wait for results, and the worker, and none of them
    gives all of it back afterwards. The limit is read when a plan runs, so it is set for the rest of the session; a
    smaller one that is set already stays.
    """
    number, unit = re.match(r"(\d+)([kmgtp]?)", spark.conf.get(BATCH_LIMIT).strip().lower()).groups()
    if int(number) << 10 * " kmgtp".index(unit or " ") > BATCH_BYTES:
        spark.conf.set(BATCH_LIMIT, f"{BATCH_BYTES}b")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A folder of our own is made only in local mode (tests); a cluster without the setting is an
    error, since a machine-local folder is lost together with its machine.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if named:
        if current is None:
            sc.setCheckpointDir(named)
        return named
    if current is not None:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="nearspan-checkpoint-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """Write the rows to the shared folder and read them back.

    The written table survives the loss of executors, is computed once, and has known size, so that
    later joins are planned from facts.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_bucketed(df: DataFrame, key: str) -> DataFrame:
    """Like :func:`cut_lineage`, stored in hash buckets of ``key``: later joins on the key shuffle only
    their other side. The table is known to the session catalogue under a name of its own."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"nearspan_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", scratch_path(spark, "buckets")).saveAsTable(name))
    return spark.table(name)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/nearspan/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Split a scan that has fewer partitions than the cluster has slots.

    Meant for plain scans (no shuffle yet), where asking for the partition count runs no job. A table
    of many files passes through unchanged.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df
