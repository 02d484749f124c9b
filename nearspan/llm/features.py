"""Shared parts of the two classifiers: the labelled sample, the held-out rule and hashed words."""

from __future__ import annotations

import re
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
LETTERS = re.compile(rb"[a-z\x80-\xff]+")


def held_out(doc_id: Column) -> Column:
    """The rows whose labels are never learnt from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, *extra: str) -> DataFrame:
    """(doc_id, y, text, extra columns) of at most ``rows`` labelled documents, chosen by a hash of their ids, held-out ids left out.

    The chosen ids are a bounded set and are broadcast; texts are filtered where they lie.
    """
    marks = (labels.select("doc_id", F.col(label).cast("int").alias("y")).dropna().filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    chosen = docs.select("doc_id", F.struct("text", *extra).alias("row")).join(F.broadcast(marks), "doc_id")
    return chosen.groupBy("doc_id", "y").agg(F.min("row").alias("row")).select("doc_id", "y", "row.*")


def bucket(word: bytes, size: int) -> int:
    return zlib.crc32(word) % size
