"""Raw record files: fixed-length binary records without any header."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearspan.plans.kernels import matrix
from nearspan.sources.vectors import pack_float32
from nearspan.session import attach


def write_float32_records(df: DataFrame, path: str, *, order: str = "vec_id") -> int:
    """Write vectors as little-endian float32 records in ``order``; returns the number of records."""
    attach(df.sparkSession)
    return _write(df.select(order, pack_float32("embedding").alias("code")), path, order)


def write_bit_records(df: DataFrame, path: str, *, order: str = "vec_id") -> int:
    """Write packed bit codes in ``order``; returns the number of records."""
    return _write(df.select(order, "code"), path, order)


def _write(df: DataFrame, path: str, order: str) -> int:
    """One file per range partition, named so that file order is record order.

    Files are written under a name of the attempt and then moved, so a repeated task leaves one file.
    The path must be a folder that all executors reach; without a scheme it is one of Hadoop's default file system,
    where the records are read again.
    """
    target = path
    if ":/" not in path:
        target = df.sparkSession._jsc.hadoopConfiguration().get("fs.defaultFS").rstrip("/") + path
        if target.startswith("file:/") and not target.startswith("file:///"):
            target = f"file://{path}"
    ordered = df.repartitionByRange(order).sortWithinPartitions(order).select("code")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        system, folder = fs.FileSystem.from_uri(target)
        system.create_dir(folder, recursive=True)
        name = f"{folder}/part-{task.partitionId():06d}"
        attempt = f"{folder}/_{task.partitionId():06d}-{task.taskAttemptId()}"
        n = 0
        with system.open_output_stream(attempt) as out:
            for batch in batches:
                if batch.num_rows:
                    out.write(np.ascontiguousarray(matrix(batch.column(0))))
                n += batch.num_rows
        system.move(attempt, name)
        yield pa.record_batch({"n": pa.array([n], pa.int64())})

    return ordered.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
