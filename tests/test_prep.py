import numpy as np
import pytest
from pyspark.sql import functions as F

from nearspan.errors import ConfigError, InvalidVectorError
from nearspan.functions import bits, distance
from nearspan.operators import pairwise, prep

NAN, INF = float("nan"), float("inf")


def test_normalize(make):
    rows = prep.normalize(make([[3, 4, 0, 0], [0, 0, 5, 12], [0, 0, 0, 0]])).orderBy("vec_id").collect()
    assert rows[0].embedding == pytest.approx([.6, .8, 0, 0])
    assert rows[1].embedding == pytest.approx([0, 0, 5 / 13, 12 / 13])
    assert rows[2].embedding == [0, 0, 0, 0]


def test_report_and_positions(make):
    table = make([[1, 0, NAN, 0], [1, 0, 0, 0], [0, 0, 0, 0], [NAN] * 4, [1, 2, 3]])
    row = prep.validation_report(table, 4).first()
    assert (row.vector_count, row.non_finite, row.non_finite_vectors) == (5, 5, 2)
    assert (row.zero_norm_vectors, row.wrong_dims_vectors, row.valid) == (2, 1, False)
    first = prep.non_finite(table).where("vec_id = 0").collect()
    assert [(r.vec_id, r.component) for r in first] == [(0, 2)]
    assert {r.vec_id for r in prep.zero_norm(table).collect()} == {2, 3}


def test_zero_norm_alone_is_valid(make):
    assert prep.validation_report(make([[0, 0], [1, 0]]), 2).first().valid


def test_split(make, spark):
    table = make([[1, 2], [INF, 0], [1], [3, 4]]).unionByName(
        spark.createDataFrame([(9, None)], "vec_id long, embedding array<double>"))
    good, bad = prep.split_valid(table, 2)
    assert {r.vec_id for r in good.collect()} == {0, 3}
    assert {r.vec_id for r in bad.collect()} == {1, 2, 9}
    with pytest.raises(InvalidVectorError):
        prep.split_valid(table, 2, strict=True)


def test_codes(make_codes):
    good, bad = prep.split_valid_codes(make_codes(["0000", "ff"]), 16)
    assert good.count() == 1 and bad.count() == 1
    assert not prep.code_report(make_codes(["0000", "ff"]), 16).first().valid
    with pytest.raises(ConfigError):
        prep.split_valid_codes(make_codes(["00"]), 12)


def test_chunks(make):
    sizes = prep.chunked(make(np.eye(3)), 2).groupBy("chunk_id").count().orderBy("chunk_id").collect()
    assert [(r.chunk_id, r["count"]) for r in sizes] == [(0, 2), (1, 1)]
    with pytest.raises(ConfigError):
        prep.chunked(make(np.eye(3)), 0)


def test_numbers_are_consecutive_under_a_hot_key(spark):
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    table = spark.range(5000).repartition(7).select("id", hot.alias("key"))
    rows = prep.numbered(table, ["key", "id"], start=10).orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(10, 5010))
    assert [(r.key, r.id) for r in rows] == sorted((r.key, r.id) for r in rows)


def test_sign_codes_and_words(make, randoms):
    v = randoms(20, 72)
    table = prep.binarize(make(v), 72)
    rows = table.orderBy("vec_id").select("code", bits.words("code", 72).alias("w")).collect()
    want = np.packbits(v > 0, axis=1, bitorder="little")
    assert [bytes(r.code) for r in rows] == [w.tobytes() for w in want]
    one = table.select("vec_id", bits.words("code", 72).alias("w"))
    gap = one.alias("a").join(one.alias("b"), F.col("a.vec_id") + 1 == F.col("b.vec_id")).select(
        F.col("a.vec_id").alias("i"), distance.hamming(F.col("a.w"), F.col("b.w")).alias("d")).collect()
    assert {r.i: r.d for r in gap} == {i: int(((v[i] > 0) != (v[i + 1] > 0)).sum()) for i in range(19)}


@pytest.mark.parametrize("metric,want", [("l2", 2.0), ("ip", 0.0), ("cosine", 0.0)])
def test_pairs(make, metric, want):
    a, b = make([[1, 0, 0, 0]]), make([[0, 1, 0, 0]])
    assert pairwise.aligned(a, b, "vec_id", metric).first().distance == want
    assert pairwise.one_to_many(a, b, "vec_id", metric).first().distance == want


def test_pair_rules(make):
    zero = make([[0, 0]])
    assert pairwise.aligned(zero, make([[1, 1]]), "vec_id", "cosine").first().distance == 0
    with pytest.raises(ValueError):
        pairwise.one_to_many(make([[1, 0], [0, 1]]), zero, "vec_id")
    with pytest.raises(ConfigError):
        pairwise.aligned(zero, zero, "vec_id", "l1")
