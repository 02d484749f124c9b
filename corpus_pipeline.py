"""The corpus pipeline: quality rules, near-duplicates, repeated passages, decontamination, mixing.

``STAGES`` are applied in order; each reads what the one before it kept, as a written table. Documents that the
quality rules reject go; of each class of near copies one document stays; passages of 100 bytes or more that occur
earlier are cut out of the texts (``n_chars`` follows); documents contaminated by the benchmark go; what is left is
mixed to the target weights of its sources. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearspan.llm import decontaminate, mixing, order_minhash, quality_rules, suffix_dedup
from nearspan.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return order_minhash.drop_near(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    stripped = suffix_dedup.strip_repeats(docs).select(*docs.columns)
    return stripped.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(docs)


STAGES = [("quality rules", quality), ("MinHash near-dedup", near_copies), ("suffix-array dedup", repeats),
          ("benchmark decontamination", benchmark), ("mixing sources", mix)]
#: The classes of near copies (order MinHash) and the risk-controlled cutoffs cannot be stated in SQL; tests hold the
#: stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
