"""Continuous ingest of vectors into a numbered table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from nearspan.operators.prep import numbered

PROGRESS = "batch_id long, batch_rows long, processed long"


def ingest(stream: DataFrame, target: str, checkpoint: str, *, order: list[str], start: int = 0,
           trigger: dict | None = None) -> StreamingQuery:
    """Append micro-batches with consecutive ids and a progress row per batch.

    A batch writes to folders named after its number and overwrites them, and its first id is the sum of
    the earlier batches' progress. A replayed batch therefore gives the same rows again, never a second
    copy. ``trigger`` is passed to ``DataStreamWriter.trigger``: by default what is there is ingested and the query ends,
    ``{"processingTime": "10 seconds"}`` keeps it running.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        done = _progress_before(spark, target, batch_id)
        rows = numbered(batch, order, start=start + done, out="vec_id")
        data = f"{target}/data/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(data)
        n = spark.read.parquet(data).count()
        (spark.createDataFrame([(batch_id, n, done + n)], PROGRESS).coalesce(1)
         .write.mode("overwrite").parquet(f"{target}/progress/batch={batch_id}"))

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _progress_before(spark: SparkSession, target: str, batch_id: int) -> int:
    if batch_id == 0:
        return 0
    rows = progress(spark, target).where(F.col("batch_id") < batch_id)
    return rows.agg(F.coalesce(F.sum("batch_rows"), F.lit(0))).first()[0]


def progress(spark: SparkSession, target: str) -> DataFrame:
    """``(batch_id, batch_rows, processed)``."""
    return spark.read.parquet(f"{target}/progress").drop("batch")


def ingested(spark: SparkSession, target: str) -> DataFrame:
    """The table so far."""
    return spark.read.parquet(f"{target}/data").drop("batch_id")
