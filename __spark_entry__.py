"""Registered queries and their SQL statements.

``queries()`` runs every operator over the whole of the given tables; ``oracle_sql()`` states the same
results in SQL (see ``oracles.py``).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
from nearspan.config import IndexConfig  # noqa: E402
from nearspan.functions import bits, distance, vectors  # noqa: E402
from nearspan.index import VectorIndex  # noqa: E402
from nearspan.operators import (  # noqa: E402
    evaluate, exact, graph, hashing, ivf, maintain, pairwise, prep, quantize, reduce, retrieve,
)
from nearspan.session import cut_lineage, scratch_path, spread  # noqa: E402
from nearspan.sources import raw, store, tables  # noqa: E402
from nearspan.sources import vectors as sources  # noqa: E402
from nearspan.stored import StoredIndex  # noqa: E402
from nearspan.streaming import ingest, match  # noqa: E402

try:  # the text operators are a subpackage of their own, which may be absent
    import corpus_pipeline  # noqa: E402
    from nearspan.llm import queries as text_queries  # noqa: E402
except ImportError:
    corpus_pipeline = text_queries = None

DIMS, K = oracles.DIMS, oracles.K
LISTS, COARSE_ROUNDS = oracles.LISTS, oracles.COARSE_ROUNDS
SEGMENTS, PQ_BITS, PQ_ROUNDS = oracles.SEGMENTS, 4, oracles.PQ_ROUNDS
Query = Callable[[SparkSession, str], DataFrame]


# ---- tables

def embeddings(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    return sources.read_vectors(spark, f"{sf}/embeddings.parquet", keep=keep)


def scaled(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors stretched by id, so that the metrics rank differently."""
    return embeddings(spark, sf).withColumn(
        "embedding", vectors.scale(F.col("embedding"), 1 + F.col("vec_id") % 7))


def as_queries(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("vec_id", "query_id")


def codes(spark: SparkSession, sf: str) -> DataFrame:
    return prep.binarize(embeddings(spark, sf), DIMS).select("vec_id", "code")


def damaged(spark: SparkSession, sf: str) -> DataFrame:
    """The table with faults by label: NaN inside, all zero, too short, infinite ends."""
    v, nan, inf = F.col("embedding").cast("array<double>"), F.lit(float("nan")), F.lit(float("inf"))
    label = F.col("label")
    broken = (F.when(label == 1, F.concat(F.slice(v, 1, 2), F.array(nan), F.slice(v, 4, DIMS)))
              .when(label == 2, F.transform(v, lambda x: F.lit(0.0)))
              .when(label == 3, F.slice(v, 1, 60))
              .when(label == 4, F.concat(F.array(inf), F.slice(v, 2, DIMS - 2), F.array(-inf)))
              .otherwise(v))
    return embeddings(spark, sf, "label").withColumn("embedding", broken)


def total():
    return F.round(F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x), 6).alias("total")


def mean_query(df: DataFrame) -> DataFrame:
    """One query row: the mean vector of the whole table."""
    by_pos = (df.select(F.posexplode("embedding").alias("pos", "x")).groupBy("pos").agg(F.avg("x").alias("m")))
    return (by_pos.agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("a"))
            .select(F.lit(0).cast("bigint").alias("query_id"), F.col("a.m").alias("embedding")))


def rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("distance", F.round("distance", 6))


def exploded(df: DataFrame, vector: str, *keys: str, pos: str = "pos", value: str = "value") -> DataFrame:
    return df.select(*keys, F.posexplode(vector).alias(pos, value))


# ---- sources and sinks

def vector_scan(spark, sf):
    return embeddings(spark, sf).select("vec_id", F.size("embedding").alias("dims"), total())


def float32_records(spark, sf):
    path = scratch_path(spark, "float32")
    raw.write_float32_records(embeddings(spark, sf), path, order="vec_id")
    return sources.read_float32_records(spark, path, DIMS).select(
        "vec_id", F.size("embedding").alias("dims"), total())


def bit_records(spark, sf):
    path = scratch_path(spark, "bits")
    raw.write_bit_records(codes(spark, sf), path, order="vec_id")
    words = bits.words(F.col("code"), DIMS)
    ones = F.aggregate(words, F.lit(0).cast("bigint"), lambda t, w: t + F.bit_count(w))
    return sources.read_bit_records(spark, path, DIMS).select("vec_id", ones.alias("ones"))


def saved_table(spark, sf):
    path = scratch_path(spark, "table")
    tables.save_table(embeddings(spark, sf), path, dims=DIMS, kind="FLAT_L2", metric="l2")
    meta = tables.load_metadata(spark, path)
    return tables.load_table(spark, path, dims=DIMS).select("vec_id", "embedding", total()).agg(
        F.lit(meta["kind"]).alias("kind"), F.count(F.lit(1)).alias("ntotal"),
        F.max(F.size("embedding")).alias("dims"),
        F.round(F.sum(F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x)), 6).alias("total"))


def json_results(spark, sf):
    path = scratch_path(spark, "json")
    tables.write_results(exact.knn(scaled(spark, sf), as_queries(embeddings(spark, sf)), 3, dims=DIMS), path)
    schema = "query_id long, rank int, vec_id long, distance double"
    return rounded(spark.read.schema(schema).json(path))


def synthetic_vectors(spark, sf):
    made = sources.synthetic_vectors(embeddings(spark, sf), 32)
    return exploded(made, "embedding", "vec_id").withColumn("value", F.round("value", 6))


def text_embedding(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    made = sources.embed_text(spread(docs), dims=256).withColumnRenamed("vec_id", "doc_id")
    return (exploded(made, "embedding", "doc_id", pos="slot").where("value <> 0")
            .withColumn("value", F.round("value", 6)))


# ---- preparation and quality

def normalize(spark, sf):
    return exploded(prep.normalize(scaled(spark, sf)), "embedding", "vec_id").withColumn(
        "value", F.round("value", 6))


def non_finite_positions(spark, sf):
    value = F.when(F.isnan("value"), "nan").when(F.col("value") > 0, "inf").otherwise("-inf")
    return prep.non_finite(damaged(spark, sf)).withColumn("value", value)


def good_reject_split(spark, sf):
    good, bad = prep.split_valid(damaged(spark, sf), DIMS)
    return good.select("vec_id", F.lit("good").alias("part")).unionByName(
        bad.select("vec_id", F.lit("reject").alias("part")))


def validate_codes(spark, sf):
    table = prep.binarize(embeddings(spark, sf, "label"), DIMS)
    short = F.when(F.col("label") == 3, F.substring("code", 1, 5)).otherwise(F.col("code"))
    return prep.code_report(table.withColumn("code", short), DIMS)


def chunks(spark, sf):
    return prep.chunked(embeddings(spark, sf), 128).groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"), F.max("vec_id").alias("last_id"))


def sign_codes(spark, sf):
    return codes(spark, sf).select("vec_id", F.hex("code").alias("code"))


# ---- pairwise distances

def _three(make) -> DataFrame:
    a, b, c = (make(m).withColumnRenamed("distance", m) for m in distance.METRICS)
    return a.join(b, "vec_id").join(c, "vec_id").select(
        "vec_id", *[F.round(m, 6).alias(m) for m in distance.METRICS])


def pairwise_aligned(spark, sf):
    left, right = embeddings(spark, sf), scaled(spark, sf)
    return pairwise.aligned(left, right, "vec_id", *distance.METRICS).select(
        "vec_id", *[F.round(m, 6).alias(m) for m in distance.METRICS])


def pairwise_one_to_many(spark, sf):
    many = scaled(spark, sf)
    one = mean_query(many)
    return _three(lambda m: pairwise.one_to_many(one, many, "vec_id", m))


def pairwise_hamming(spark, sf):
    e = embeddings(spark, sf)
    there = bits.words(bits.sign_code(F.col("embedding"), DIMS), DIMS)
    back = bits.words(bits.sign_code(F.reverse("embedding"), DIMS), DIMS)
    return e.select("vec_id", distance.hamming(there, back).alias("hamming"))


# ---- exact search

def knn_single(spark, sf):
    base = scaled(spark, sf)
    return rounded(exact.knn(base, mean_query(base), K, dims=DIMS).drop("query_id"))


def _knn(metric: str) -> Query:
    def run(spark, sf):
        return rounded(exact.knn(scaled(spark, sf), as_queries(embeddings(spark, sf)), K, metric=metric, dims=DIMS))
    return run


def knn_cosine(spark, sf):
    base = scaled(spark, sf)
    return rounded(exact.knn(base, as_queries(base), K, metric="cosine", dims=DIMS))


def radius_l2(spark, sf):
    e = embeddings(spark, sf)
    return rounded(exact.within(e, as_queries(e), 1.4, dims=DIMS))


def radius_ip(spark, sf):
    return rounded(exact.within(scaled(spark, sf), as_queries(embeddings(spark, sf)), 1.5, metric="ip", dims=DIMS))


def radius_counts(spark, sf):
    return exact.radius_counts(scaled(spark, sf), as_queries(embeddings(spark, sf)), 2.5, dims=DIMS)


def knn_hamming(spark, sf):
    c = codes(spark, sf)
    return exact.hamming_knn(c, as_queries(c), K, dims=DIMS)


# ---- partitioned search

def _coarse(df: DataFrame) -> ivf.CoarseModel:
    return ivf.train(df, LISTS, rounds=COARSE_ROUNDS)


def ivf_train(spark, sf):
    table = _coarse(embeddings(spark, sf)).table(spark)
    return exploded(table, "centroid", "list_id").withColumn("value", F.round("value", 6))


def ivf_assign(spark, sf):
    e = embeddings(spark, sf)
    return ivf.assign(e, _coarse(e)).select("vec_id", "list_id")


def _ivf_hits(spark, sf, nprobe: int) -> DataFrame:
    e = embeddings(spark, sf)
    model = _coarse(e)
    return ivf.search(ivf.assign(e, model), as_queries(e), model, K, nprobe=nprobe)


def auto_train(spark, sf):
    config = IndexConfig(DIMS, "IVF_FLAT", nlist=LISTS, train_rounds=COARSE_ROUNDS)
    return ivf.list_sizes(VectorIndex(config).add(embeddings(spark, sf), auto_train=True).rows)


def ivf_recall(spark, sf):
    e = embeddings(spark, sf)
    truth = exact.knn(e, as_queries(e), K, dims=DIMS)
    return evaluate.mean_recall(_ivf_hits(spark, sf, 3), truth).withColumn("recall", F.round("recall", 6))


def recall_by_nprobe(spark, sf):
    e = embeddings(spark, sf)
    model, truth = _coarse(e), exact.knn(e, as_queries(e), K, dims=DIMS)
    return evaluate.recall_by_nprobe(truth, ivf.assign(e, model), as_queries(e), model).withColumn("recall", F.round("recall", 6))


# ---- scalar codes

def _scalar_codes(sq_type: str) -> Query:
    def run(spark, sf):
        base = scaled(spark, sf)
        coded = quantize.encode_scalar(base, quantize.train_scalar(base, sq_type))
        return exploded(coded, "codes", "vec_id", value="code").withColumn("code", F.col("code").cast("int"))
    return run


def sq8_decode(spark, sf):
    base = scaled(spark, sf)
    model = quantize.train_scalar(base, "SQ8")
    both = quantize.decode_scalar(quantize.encode_scalar(base, model), model)
    gap = F.zip_with("embedding", "decoded", lambda a, b: F.abs(a - b))
    steps = F.lit(model.step.tolist())
    return (both.select("vec_id", F.posexplode(gap).alias("pos", "gap"))
            .withColumn("half", F.get(steps, F.col("pos")) / 2)
            .groupBy("vec_id").agg(
                F.count(F.lit(1)).alias("n"), F.round(F.sum("gap"), 6).alias("error"),
                (F.max(F.col("gap") - F.col("half")) <= 1e-9).alias("within_half_step")))


def fp16_codes(spark, sf):
    e = embeddings(spark, sf)
    model = quantize.train_scalar(e, "SQfp16")
    both = quantize.decode_scalar(quantize.encode_scalar(e, model), model)
    return exploded(both, "decoded", "vec_id").withColumn("value", F.round("value", 9))


def sq8_search(spark, sf):
    base = scaled(spark, sf)
    model = quantize.train_scalar(base, "SQ8")
    return rounded(quantize.search_scalar(
        quantize.encode_scalar(base, model), as_queries(embeddings(spark, sf)), model, K))


def ivf_sq_search(spark, sf):
    e = embeddings(spark, sf)
    coarse, model = _coarse(e), quantize.train_scalar(e, "SQ8")
    coded = quantize.encode_scalar(ivf.assign(e, coarse), model)
    return rounded(quantize.search_ivf_scalar(coded, as_queries(e), coarse, model, K, nprobe=3))


def sq_ip_search(spark, sf):
    base = scaled(spark, sf)
    model = quantize.train_scalar(base, "SQ8")
    return rounded(quantize.search_scalar(
        quantize.encode_scalar(base, model), as_queries(embeddings(spark, sf)), model, K, metric="ip"))


def ivf_ip_search(spark, sf):
    base = scaled(spark, sf)
    model = ivf.train(base, LISTS, rounds=COARSE_ROUNDS, metric="ip")
    return rounded(ivf.search(ivf.assign(base, model), as_queries(embeddings(spark, sf)), model, K, nprobe=3))


# ---- product codes

def _product(df: DataFrame) -> quantize.ProductModel:
    return quantize.train_product(df, SEGMENTS, PQ_BITS, dims=DIMS, rounds=PQ_ROUNDS)


def pq_train(spark, sf):
    table = _product(embeddings(spark, sf)).table(spark)
    return exploded(table, "centroid", "segment", "code").withColumn("value", F.round("value", 6))


def pq_codes(spark, sf):
    e = embeddings(spark, sf)
    coded = quantize.encode_product(e, _product(e))
    return exploded(coded, "codes", "vec_id", pos="segment", value="code").withColumn(
        "code", F.col("code").cast("int"))


def pq_decode(spark, sf):
    e = embeddings(spark, sf)
    model = _product(e)
    both = quantize.decode_product(quantize.encode_product(e, model), model)
    return both.select("vec_id", F.round(distance.squared_l2(F.col("embedding"), F.col("decoded")), 6).alias("error"))


def pq_search(spark, sf):
    e = embeddings(spark, sf)
    model = _product(e)
    return rounded(quantize.search_product(quantize.encode_product(e, model), as_queries(e), model, K))


def pq_ip_search(spark, sf):
    base = scaled(spark, sf)
    model = _product(base)
    return rounded(quantize.search_product(
        quantize.encode_product(base, model), as_queries(embeddings(spark, sf)), model, K, metric="ip"))


def ivf_pq_search(spark, sf):
    e = embeddings(spark, sf)
    coarse = _coarse(e)
    model = quantize.train_ivf_product(e, coarse, SEGMENTS, PQ_BITS, dims=DIMS, rounds=PQ_ROUNDS)
    coded = quantize.encode_ivf_product(e, coarse, model)
    return rounded(quantize.search_ivf_product(coded, as_queries(e), coarse, model, K, nprobe=3))


# ---- reductions and pipelines

def pca_full_width(spark, sf):
    """All components kept: a rotation, so neighbours must be those of the unreduced table."""
    base = scaled(spark, sf)
    model = reduce.train_pca(base, DIMS, rotate=True)
    return rounded(exact.knn(reduce.transform(base, model),
                             as_queries(reduce.transform(embeddings(spark, sf), model)), K, dims=DIMS))


def pca_search(spark, sf):
    e = embeddings(spark, sf)
    index = VectorIndex(IndexConfig(DIMS, "FLAT_L2", reduction="PCA", reduced_dims=16))
    return rounded(index.add(e, auto_train=True).search(as_queries(e), K))


def pca_reduced(spark, sf):
    """Neighbours found after reduction to 16 components, against the true ones."""
    e = embeddings(spark, sf)
    found = evaluate.mean_recall(pca_search(spark, sf), exact.knn(e, as_queries(e), K, dims=DIMS))
    chance = K / e.count()
    return found.select("queries", (F.col("recall") > 2 * chance).alias("better_than_chance"))


def opq_search(spark, sf):
    e = embeddings(spark, sf)
    config = IndexConfig(DIMS, "PQ", pq_segments=SEGMENTS, pq_bits=PQ_BITS, reduction="OPQ", train_rounds=PQ_ROUNDS)
    return rounded(VectorIndex(config).add(e, auto_train=True).search(as_queries(e), K))


def opq_improves(spark, sf):
    """Mean coding error with the fitted rotation against plain product codes of the same size."""
    e = embeddings(spark, sf)
    linear, rotated_model = reduce.train_opq(e, SEGMENTS, PQ_BITS, dims=DIMS)
    plain_model = quantize.train_product(e, SEGMENTS, PQ_BITS, dims=DIMS, rounds=3)

    def error(df, model, name):
        coded = quantize.decode_product(quantize.encode_product(df, model), model)
        return coded.select("vec_id", distance.squared_l2(F.col("embedding"), F.col("decoded")).alias(name))

    both = error(reduce.transform(e, linear), rotated_model, "rotated").join(error(e, plain_model, "plain"), "vec_id")
    return both.agg(F.count(F.lit(1)).alias("vectors"), (F.avg("rotated") <= 1.02 * F.avg("plain")).alias("not_worse"))


def composed_exact(spark, sf):
    """Rotation, then lists, all of them probed: must equal the exact search."""
    e = embeddings(spark, sf)
    config = IndexConfig(DIMS, "IVF_FLAT", nlist=LISTS, nprobe=LISTS, reduction="PCAR", train_rounds=COARSE_ROUNDS)
    return rounded(VectorIndex(config).add(e, auto_train=True).search(as_queries(e), K))


def composed_pipeline(spark, sf):
    """OPQ, then lists, then product codes."""
    e = embeddings(spark, sf)
    config = IndexConfig(DIMS, "IVF_PQ", nlist=LISTS, nprobe=3, pq_segments=SEGMENTS, pq_bits=PQ_BITS,
                         reduction="OPQ", reduced_dims=32, train_rounds=PQ_ROUNDS)
    return rounded(VectorIndex(config).add(e, auto_train=True).search(as_queries(e), K))


# ---- graphs

def graph_search(spark, sf):
    e = embeddings(spark, sf)
    return rounded(graph.search(graph.build(e, dims=DIMS), as_queries(e), K))


def graph_recall(spark, sf):
    """Share of the true neighbours found over small lists, for beams of a few widths."""
    e = embeddings(spark, sf)
    built, truth = graph.build(e, dims=DIMS, pool=50), exact.knn(e, as_queries(e), K, dims=DIMS)
    return _recall_by_width(spark, lambda ef: graph.search(built, as_queries(e), K, ef=ef), truth)


def _recall_by_width(spark, found, truth: DataFrame) -> DataFrame:
    truth = cut_lineage(truth, "truth")
    rows = [evaluate.mean_recall(found(ef), truth).select(F.lit(ef).alias("ef"), "queries", F.round("recall", 6).alias("recall"))
            for ef in (K, 2 * K, 5 * K)]
    return rows[0].union(rows[1]).union(rows[2])


def graph_full_beam(spark, sf):
    """Beams as wide as the table open every node, so nothing can be missed: equal to the exact search."""
    e = embeddings(spark, sf)
    return rounded(graph.search(graph.build(e, dims=DIMS, pool=50), as_queries(e), K, ef=e.count()))


def graph_insert(spark, sf):
    """Half of the table linked into a graph of the other half, then searched with full beams."""
    e = embeddings(spark, sf)
    old, new = e.where("vec_id % 2 = 0"), e.where("vec_id % 2 = 1")
    grown = graph.insert(graph.build(old, dims=DIMS, pool=50), new)
    return rounded(graph.search(grown, as_queries(e), K, ef=e.count()))


def bit_graph_search(spark, sf):
    c = codes(spark, sf)
    return graph.search(graph.build(c, dims=DIMS, metric="hamming", degree=32), as_queries(c), K)


def bit_graph_recall(spark, sf):
    c = codes(spark, sf)
    built, truth = graph.build(c, dims=DIMS, metric="hamming", degree=32, pool=50), exact.hamming_knn(c, as_queries(c), K, dims=DIMS)
    return _recall_by_width(spark, lambda ef: graph.search(built, as_queries(c), K, ef=ef), truth)


def bit_graph_full_beam(spark, sf):
    c = codes(spark, sf)
    return graph.search(graph.build(c, dims=DIMS, metric="hamming", degree=32, pool=50), as_queries(c), K, ef=c.count())


# ---- bit codes

def bit_ivf_train(spark, sf):
    model = ivf.train(codes(spark, sf), LISTS, rounds=COARSE_ROUNDS, metric="hamming")
    text = F.concat(*[bits.bit(F.col("centroid"), i).cast("string") for i in range(DIMS)])
    return model.table(spark).select("list_id", text.alias("bits"))


def bit_ivf_search(spark, sf):
    c = codes(spark, sf)
    model = ivf.train(c, LISTS, rounds=COARSE_ROUNDS, metric="hamming")
    return ivf.search(ivf.assign(c, model), as_queries(c), model, K, nprobe=3)


def _hash(tables_: int) -> Query:
    def run(spark, sf):
        c = codes(spark, sf)
        return hashing.search(c, as_queries(c), K, dims=DIMS, hash_bits=8, nflip=1, tables=tables_)
    return run


# ---- maintenance

def _requests(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/labels.parquet").select(
        F.col("doc_id").alias("pos"), F.col("doc_id").alias("vec_id"))


def _poor(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/labels.parquet").where("quality = 0").select(F.col("doc_id").alias("vec_id"))


def append(spark, sf):
    e = embeddings(spark, sf, "label").select("vec_id", "label")
    old, new = e.withColumn("src", F.lit("old")), e.withColumn("src", F.lit("new"))
    new = new.withColumnRenamed("vec_id", "source_id")
    return maintain.append(old, new, ["label", "source_id"])


def _ingested(spark, sf) -> str:
    """The table arrives in four parts, by id modulo 4; each part is many files, and what is new is one batch."""
    target = scratch_path(spark, "ingest")
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    for i in range(4):
        e.where(F.pmod("vec_id", F.lit(4)) == i).write.mode("append").parquet(f"{target}/arriving")
        stream = spark.readStream.schema(e.schema).parquet(f"{target}/arriving").withColumnRenamed("vec_id", "source_id")
        ingest.ingest(stream, f"{target}/table", f"{target}/log", order=["label", "source_id"]).awaitTermination()
    return f"{target}/table"


def ingest_stream(spark, sf):
    return ingest.ingested(spark, _ingested(spark, sf)).select("vec_id", "source_id", "label")


def ingest_progress(spark, sf):
    return ingest.progress(spark, _ingested(spark, sf))


def lookup(spark, sf):
    ids = _requests(spark, sf)
    repeated = ids.unionByName(ids.withColumn("pos", F.col("pos") + 1_000_000_000))
    return maintain.lookup(embeddings(spark, sf), repeated).select("pos", "vec_id", total())


def remove(spark, sf):
    return maintain.remove(embeddings(spark, sf, "label").select("vec_id", "label"), _poor(spark, sf))


def merge(spark, sf):
    e = embeddings(spark, sf).withColumn("embedding", F.col("embedding").cast("array<double>"))
    return maintain.merge(e, scaled(spark, sf)).select("vec_id", total())


def reset(spark, sf):
    full = VectorIndex(IndexConfig(DIMS)).add(embeddings(spark, sf))
    had = full.stats().select((F.col("ntotal") > 0).alias("had_rows"), F.lit(1).alias("one"))
    return (full.reset().stats().select("ntotal", "is_trained", F.lit(1).alias("one"))
            .join(had, "one").drop("one"))


def stats(spark, sf):
    return VectorIndex(IndexConfig(DIMS)).add(embeddings(spark, sf)).stats()


def inspect(spark, sf):
    config = IndexConfig(DIMS, "IVF_FLAT", nlist=LISTS, train_rounds=COARSE_ROUNDS)
    row = VectorIndex(config).add(embeddings(spark, sf), auto_train=True).inspect()
    return row.select("ntotal", "kind", "lists", "smallest", "largest", F.round("mean", 6).alias("mean"),
                      F.round("skew", 6).alias("skew"), F.size("hints").alias("hint_count"))


def stats_codes(spark, sf):
    return VectorIndex(IndexConfig(DIMS, "BINARY_FLAT")).add(codes(spark, sf)).stats()


def check_codes(spark, sf):
    return VectorIndex(IndexConfig(DIMS, "BINARY_FLAT")).add(codes(spark, sf)).check()


def merge_codes(spark, sf):
    c = codes(spark, sf)
    return maintain.merge(c, c).select("vec_id", F.hex("code").alias("code"))


def check(spark, sf):
    return VectorIndex(IndexConfig(DIMS)).add(embeddings(spark, sf)).check()


def _stored(spark, sf) -> StoredIndex:
    """Even ids, then odd ids, then without the poor ones: three commits."""
    e = embeddings(spark, sf)
    config = IndexConfig(DIMS, "IVF_FLAT", nlist=LISTS, nprobe=LISTS, train_rounds=COARSE_ROUNDS)
    first = VectorIndex(config).train(e).add(e.where("vec_id % 2 = 0"))
    stored = StoredIndex.create(first, scratch_path(spark, "stored")).add(e.where("vec_id % 2 = 1"), token="odd")
    return stored.remove(_poor(spark, sf), token="poor")


def stored_changes(spark, sf):
    """Rows of every version, and of the last one after a change was sent twice."""
    last = _stored(spark, sf)
    again = StoredIndex.open(spark, last.at.path).add(embeddings(spark, sf).where("vec_id % 2 = 1"), token="odd")
    rows = store.rows(spark, again.at).select(F.lit(0).cast("long").alias("version"), "vec_id", total())
    for v in (1, 2, 3):
        rows = rows.union(store.rows(spark, store.open_version(spark, last.at.path, v)).select(F.lit(v).cast("long"), "vec_id", total()))
    return rows


def stored_history(spark, sf):
    return store.history(spark, _stored(spark, sf).at.path)


def stored_search(spark, sf):
    return rounded(_stored(spark, sf).search(as_queries(embeddings(spark, sf)), K))


def stored_merge(spark, sf):
    """A stored table and another one behind it."""
    e, path = embeddings(spark, sf), scratch_path(spark, "stored")
    a = store.create(e, f"{path}/a")
    b = store.remove(_poor(spark, sf), store.create(scaled(spark, sf).withColumn("embedding", F.col("embedding").cast(e.schema["embedding"].dataType)), f"{path}/b"))
    return store.rows(spark, store.compact(spark, store.merge(spark, a, b))).select("vec_id", F.size("embedding").alias("dims"))


# ---- retrieval

def retrieve_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "n_chars")
    hits = exact.knn(scaled(spark, sf), as_queries(embeddings(spark, sf)), 3, dims=DIMS)
    return retrieve.documents(hits, docs).select(
        "query_id", "rank", F.col("vec_id").alias("doc_id"), "source", "n_chars",
        F.round("similarity", 6).alias("similarity"))


def _cosine_hits(spark, sf, k: int) -> DataFrame:
    base = scaled(spark, sf)
    return exact.knn(base, as_queries(base), k, metric="cosine", dims=DIMS)


def recommend(spark, sf):
    items = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label")
    return rounded(retrieve.with_items(_cosine_hits(spark, sf, 3), items, "vec_id")).select(
        "query_id", "rank", "vec_id", "label", "distance")


def media_similarity(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    return retrieve.scored_items(_cosine_hits(spark, sf, 2), pages, "page_id").select(
        "query_id", "rank", "url", "score")


def match_stream(spark, sf):
    target = scratch_path(spark, "match")
    schema = spark.read.parquet(f"{sf}/embeddings.parquet").schema
    arriving = as_queries(spark.readStream.schema(schema).parquet(f"{sf}/embeddings*.parquet"))
    base = scaled(spark, sf)
    match.match_stream(arriving, lambda batch: exact.knn(base, batch, 5, dims=DIMS),
                       f"{target}/hits", f"{target}/log").awaitTermination()
    return rounded(match.matched(spark, f"{target}/hits"))


def queries() -> dict[str, Query]:
    return vector_queries() | (text_queries.queries() | {"pipeline": corpus_pipeline.run} if text_queries else {})


def vector_queries() -> dict[str, Query]:
    return {
        "vector_scan": vector_scan, "float32_records": float32_records, "bit_records": bit_records,
        "saved_table": saved_table, "json_results": json_results, "synthetic_vectors": synthetic_vectors,
        "text_embedding": text_embedding,
        "normalize": normalize,
        "validate_vectors": lambda spark, sf: prep.validation_report(damaged(spark, sf), DIMS),
        "non_finite_positions": non_finite_positions,
        "zero_norm_vectors": lambda spark, sf: prep.zero_norm(damaged(spark, sf)),
        "good_reject_split": good_reject_split, "validate_codes": validate_codes, "chunks": chunks,
        "sign_codes": sign_codes,
        "pairwise_aligned": pairwise_aligned, "pairwise_one_to_many": pairwise_one_to_many,
        "pairwise_hamming": pairwise_hamming,
        "knn_single": knn_single, "knn_l2": _knn("l2"), "knn_ip": _knn("ip"), "knn_cosine": knn_cosine,
        "radius_l2": radius_l2, "radius_ip": radius_ip, "radius_counts": radius_counts, "knn_hamming": knn_hamming,
        "ivf_train": ivf_train, "ivf_assign": ivf_assign, "auto_train": auto_train,
        "ivf_search": lambda spark, sf: rounded(_ivf_hits(spark, sf, 3)),
        "ivf_all_lists": lambda spark, sf: rounded(_ivf_hits(spark, sf, LISTS)), "ivf_recall": ivf_recall,
        "recall_by_nprobe": recall_by_nprobe,
        "sq8_codes": _scalar_codes("SQ8"), "sq4_codes": _scalar_codes("SQ4"), "sq8_decode": sq8_decode,
        "fp16_codes": fp16_codes, "sq8_search": sq8_search, "ivf_sq_search": ivf_sq_search,
        "pq_train": pq_train, "pq_codes": pq_codes, "pq_decode": pq_decode, "pq_search": pq_search,
        "ivf_pq_search": ivf_pq_search,
        "sq_ip_search": sq_ip_search, "ivf_ip_search": ivf_ip_search, "pq_ip_search": pq_ip_search,
        "pca_full_width": pca_full_width, "pca_search": pca_search, "pca_reduced": pca_reduced,
        "opq_search": opq_search, "opq_improves": opq_improves,
        "composed_exact": composed_exact, "composed_pipeline": composed_pipeline,
        "graph_search": graph_search, "graph_recall": graph_recall,
        "bit_graph_search": bit_graph_search, "bit_graph_recall": bit_graph_recall,
        "graph_full_beam": graph_full_beam, "graph_insert": graph_insert, "bit_graph_full_beam": bit_graph_full_beam,
        "bit_ivf_train": bit_ivf_train, "bit_ivf_search": bit_ivf_search,
        "hash_search": _hash(1), "multi_hash_search": _hash(4),
        "append": append, "ingest_stream": ingest_stream, "ingest_progress": ingest_progress,
        "lookup": lookup, "remove": remove,
        "removed_count": lambda spark, sf: maintain.removed_count(embeddings(spark, sf), _poor(spark, sf)),
        "merge": merge, "reset": reset, "stats": stats, "inspect": inspect, "check": check,
        "stored_changes": stored_changes, "stored_history": stored_history, "stored_search": stored_search, "stored_merge": stored_merge,
        "stats_codes": stats_codes, "check_codes": check_codes, "merge_codes": merge_codes,
        "retrieve_documents": retrieve_documents, "recommend": recommend, "media_similarity": media_similarity,
        "match_stream": match_stream,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.build() | (text_queries.oracle_sql() if text_queries else {})


def entry(spark: SparkSession) -> DataFrame:
    """The ten nearest neighbours of every vector."""
    return queries()["knn_l2"](spark, "/root/testdata/sf0.001")
