"""Retrieval: hits joined with the table they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_items(hits: DataFrame, items: DataFrame, item_key: str) -> DataFrame:
    """Hits with the columns of their items, null where the item table has no such key: no hit is lost."""
    return hits.join(items.withColumnRenamed(item_key, "vec_id"), "vec_id", "left")


def documents(hits: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """l2 hits with their documents and ``similarity = 1 / (1 + distance)``."""
    return with_items(hits, docs, key).withColumn("similarity", 1.0 / (1.0 + F.col("distance")))


def scored_items(hits: DataFrame, items: DataFrame, key: str, places: int = 4) -> DataFrame:
    """Cosine hits with their items and the score rounded for display."""
    return with_items(hits, items, key).withColumn("score", score(places))


def score(places: int = 4) -> Column:
    return F.round("distance", places)
