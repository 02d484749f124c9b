"""Registered queries of this subpackage, thin over the operators, and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearspan.llm import (
    decontaminate, html_lstm, language_centroids, licenses, masked_lm, mixing, order_minhash, phrase_automata, quality_fm,
    quality_rules, source_divergence, suffix_dedup, toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_lstm.extract(table(spark, sf, "pages"))


def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf, "documents")).drop("source")


def op4_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return quality_fm.score(docs, quality_fm.train(docs, table(spark, sf, "labels")))


def op5_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return order_minhash.classes(table(spark, sf, "documents")).select("doc_id", "class_id")


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf, "labels")))


def op7_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return masked_lm.train_and_score(docs)


def op8_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.strip_repeats(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "repeats.*")


def op9_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents"))


def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return judged.select("doc_id", *[F.col("f")[c].alias(c) for c in quality_rules.BASE], "base_failed", "kept")


def op11_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return language_centroids.identify(docs, language_centroids.train(docs))


def op12_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf, "documents"))


def op13_phrase_mining(spark: SparkSession, sf: str) -> DataFrame:
    return phrase_automata.mine(table(spark, sf, "documents"))


def queries() -> dict[str, Query]:
    return {"op1_html_extraction": op1_html_extraction, "op2_decontamination": op2_decontamination, "op3_mixing": op3_mixing,
            "op4_quality_classifier": op4_quality_classifier, "op5_near_duplicates": op5_near_duplicates, "op6_toxicity": op6_toxicity,
            "op7_lm_scoring": op7_lm_scoring, "op8_suffix_dedup": op8_suffix_dedup, "op9_license_scan": op9_license_scan,
            "op10_quality_rules": op10_quality_rules, "op11_language_id": op11_language_id,
            "op12_source_divergence": op12_source_divergence, "op13_phrase_mining": op13_phrase_mining}


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": decontaminate.SQL, "op3_mixing": mixing.SQL,
            "op9_license_scan": licenses.sql(), "op12_source_divergence": source_divergence.SQL,
            "op13_phrase_mining": phrase_automata.SQL}
