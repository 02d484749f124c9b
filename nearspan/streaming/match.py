"""Continuous matching of arriving query vectors against a vector table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def match_stream(queries: DataFrame, search: Callable[[DataFrame], DataFrame], target: str,
                 checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Run ``search`` (any search of this package, bound to its table) on every micro-batch of queries.

    Hits of a batch go to a folder of its own that a replay overwrites. ``trigger`` as in ``ingest``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        search(batch).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return (queries.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def matched(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop("batch_id")
