import math

import numpy as np
import pytest
from conftest import brute, ids_of
from pyspark.sql import functions as F

from nearspan.errors import ConfigError, EmptyTableError
from nearspan.operators import exact
from nearspan.plans.search import Limits

EYE = np.eye(4)
PATHS = [
    Limits(path="base"), Limits(path="query"), Limits(path="cells", cell_bytes=4_000),
    Limits(path="query", sample_from_bytes=0, sample_share=0.2),
    Limits(path="cells", cell_bytes=4_000, sample_from_bytes=0, sample_share=0.2),
]


@pytest.mark.parametrize("limits", PATHS)
@pytest.mark.parametrize("metric", ["l2", "ip"])
def test_every_path_equals_brute_force(make, randoms, limits, metric):
    base, queries = randoms(400, 16), randoms(60, 16, seed=2)
    hits = exact.knn(make(base).repartition(5), make(queries, "query_id").repartition(3), 7, metric=metric,
                     dims=16, limits=limits)
    assert ids_of(hits) == brute(queries, base, 7, metric)


@pytest.mark.parametrize("limits", PATHS)
def test_a_third_of_copies(make, randoms, limits):
    base = randoms(600, 8)
    base[::3] = base[0]
    hits = exact.knn(make(base).repartition(4), make(base, "query_id").repartition(4), 5, dims=8, limits=limits)
    assert ids_of(hits) == brute(base, base, 5)


@pytest.mark.parametrize("limits", PATHS)
def test_radius_and_counts_agree(make, randoms, limits):
    base, queries = randoms(300, 4), np.vstack([randoms(20, 4, seed=3), np.full((1, 4), 99.0)])
    hits = exact.within(make(base), make(queries, "query_id"), 2.0, dims=4, limits=limits)
    want = {(i, j) for i, q in enumerate(queries) for j in np.flatnonzero(((base - q) ** 2).sum(axis=1) < 2.0)}
    assert {(r.query_id, r.vec_id) for r in hits.collect()} == want
    counts = exact.radius_counts(make(base), make(queries, "query_id"), 2.0, dims=4, limits=limits)
    got = {r.query_id: r.n for r in counts.collect()}
    assert got == {i: sum(1 for q, _ in want if q == i) for i in range(21)}
    assert got[20] == 0


def test_units_on_the_radius_are_outside(make):
    hits = exact.within(make(EYE), make(EYE[:1], "query_id"), 2.0, dims=4).collect()
    assert [(r.vec_id, r.distance) for r in hits] == [(0, 0.0)]


def test_inner_product_scores_descend(make):
    rows = exact.knn(make(EYE[:3]), make(EYE[:1], "query_id"), 2, metric="ip", dims=4).orderBy("rank").collect()
    assert rows[0].distance > rows[1].distance and rows[0].vec_id == 0


def test_inner_product_threshold_may_be_negative(make):
    hits = exact.within(make([[1.0, 0], [-1.0, 0]]), make([[1.0, 0]], "query_id"), -0.5, metric="ip", dims=2)
    assert [r.vec_id for r in hits.collect()] == [0]


def test_cosine_ignores_length(make, randoms):
    base, queries = randoms(100, 8), randoms(10, 8, seed=5)
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    stretched = base * np.arange(1, 101)[:, None]
    hits = exact.knn(make(stretched), make(queries, "query_id"), 5, metric="cosine", dims=8)
    assert ids_of(hits) == brute(queries, unit, 5, "ip")


def test_items_by_cosine(make):
    items = [[.95, .02, .01, 0], [.90, .10, 0, 0], [.10, .90, .05, 0], [0, .10, .95, .05], [0, 0, .20, .98]]
    hits = exact.knn(make(items), make([[.93, .07, .02, 0]], "query_id"), 3, metric="cosine", dims=4)
    q, b = np.array([.93, .07, .02, 0]), np.array(items)
    score = b @ q / np.linalg.norm(b, axis=1) / np.linalg.norm(q)
    assert ids_of(hits)[0] == list(np.argsort(-score)[:3])


def test_k_is_clamped_and_checked(make):
    assert exact.knn(make(np.eye(5)), make(np.eye(5)[:1], "query_id"), 100, dims=5).count() == 5
    for k in (0, -1, 1.5, True):
        with pytest.raises(ConfigError):
            exact.knn(make(EYE), make(EYE, "query_id"), k, dims=4)


def test_radius_is_checked(make):
    for radius in (-1, math.nan, math.inf, "1"):
        with pytest.raises(ConfigError):
            exact.within(make(EYE), make(EYE, "query_id"), radius, dims=4)


@pytest.mark.parametrize("limits", PATHS)
def test_empty_table(make, limits):
    empty = make(EYE).where("vec_id < 0")
    assert exact.knn(empty, make(EYE, "query_id"), 2, dims=4, limits=limits).count() == 0
    with pytest.raises(EmptyTableError):
        exact.knn(empty, make(EYE, "query_id"), 2, dims=4, strict=True)


def test_batch_equals_single(make, randoms):
    base, queries = randoms(200, 8), randoms(5, 8, seed=9)
    together = ids_of(exact.knn(make(base), make(queries, "query_id"), 3, dims=8))
    for i in range(5):
        one = make(queries, "query_id").where(F.col("query_id") == i)
        assert ids_of(exact.knn(make(base), one, 3, dims=8)) == {i: together[i]}


def test_ten_thousand(make, randoms):
    base = np.random.default_rng(4).random((10_000, 128))
    rows = exact.knn(make(base).repartition(8), make(base[:1], "query_id"), 10, dims=128).orderBy("rank").collect()
    assert [r.rank for r in rows] == list(range(1, 11))
    assert [r.distance for r in rows] == sorted(r.distance for r in rows)
    assert [r.vec_id for r in rows] == brute(base[:1], base, 10)[0]


@pytest.mark.parametrize("limits", [Limits(path="base"), Limits(path="query"), Limits(path="cells", cell_bytes=64)])
def test_hamming(make_codes, limits):
    base = make_codes(["0000", "ffff", "f00f"])
    hits = exact.hamming_knn(base, make_codes(["0000"], "query_id"), 2, dims=16, limits=limits).orderBy("rank").collect()
    assert [(r.vec_id, r.distance) for r in hits] == [(0, 0), (2, 8)]


def test_plan_of_the_resident_base_has_no_shuffle(make, randoms):
    hits = exact.knn(make(randoms(50, 4)), make(randoms(5, 4), "query_id"), 3, dims=4, limits=Limits(path="base"))
    assert "Exchange" not in hits._jdf.queryExecution().executedPlan().toString()


def test_partial_top_k_before_the_merge_shuffle(make, randoms):
    hits = exact.knn(make(randoms(50, 4)), make(randoms(5, 4), "query_id"), 3, dims=4, limits=Limits(path="query"))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(query_id") < plan.index("Partial")


@pytest.mark.parametrize("bad", [[1.0, math.nan], [1.0, math.inf], [1.0], [1.0, 2.0, 3.0]])
def test_a_bad_vector_fails_the_search_loudly(make, bad):
    base = make([[0.0, 1.0], bad, [1.0, 1.0]]).coalesce(1)
    with pytest.raises(Exception, match="vectors"):
        exact.knn(base, make([[0.0, 1.0]], "query_id"), 1, dims=2).collect()


def test_null_vectors_fail_loudly(spark, make):
    base = spark.createDataFrame([(0, [0.0, 1.0, 2.0, 3.0]), (1, None)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="vectors"):
        exact.knn(base.coalesce(1), make([[0.0, 1.0]], "query_id"), 1, dims=2).collect()


@pytest.mark.parametrize("limits", [Limits(path="base"), Limits(path="cells", cell_bytes=8_000)])
def test_counts_score_only_what_rounding_could_move(spark, make, randoms, monkeypatch, limits):
    """Hits well inside the radius are counted from the block; only pairs near it are scored from their components."""
    from nearspan.plans import kernels
    v = np.r_[randoms(300, 8, seed=61), np.zeros((1, 8)), np.eye(8)[:1] * 5.0]  # the last two lie at the radius exactly
    got = {r.query_id: r.n for r in exact.radius_counts(make(v), make(v, "query_id"), 25.0, dims=8, limits=limits).collect()}
    assert got == {i: int((((v - q) ** 2).sum(axis=1) < 25.0).sum()) for i, q in enumerate(v)}
    scored, rescore = [], kernels.Scorer.rescore
    monkeypatch.setattr(kernels.Scorer, "rescore", lambda self, q, x, qi, xi, keys: scored.append(len(qi)) or rescore(self, q, x, qi, xi, keys))
    sink, side = kernels.Within(len(v), 25.0, counting=True), kernels.Side.of(np.arange(len(v)), v)
    for _ in kernels.match(kernels.Scorer("l2"), side, side, sink):
        pass
    assert sink.counts.tolist() == list(got[i] for i in range(len(v))) and sum(scored) < sum(got.values()) / 100


@pytest.mark.parametrize("width", [2, 8, 31, 32, 40])
def test_keys_of_codes_are_counted_in_small_numbers(width):
    """Counts of bits fill one byte (two for wide codes), and limits with a fraction or beyond that range cut them rightly."""
    from nearspan.plans import kernels
    rng = np.random.default_rng(width)
    q, x = (rng.integers(0, 256, (n, width)).astype(np.uint8) for n in (70, 300))
    x[:70] = ~q
    want = np.unpackbits(q[:, None] ^ x[None], axis=2).sum(axis=2)
    scorer, a, b = kernels.Scorer("hamming"), kernels.packed(q), kernels.packed(x)
    keys, shift, slack = scorer.block(kernels.Rows(a), kernels.Rows(b))
    assert (keys == want).all() and (shift, slack) == (0, 0) and keys.dtype == (np.uint8 if width <= 24 else np.uint16)
    for radius in (-1.0, 0.0, 2.5, 4.0 * width, 8.0 * width, 8.0 * width + 0.5, 1e9):
        for counting in (False, True):
            sink = kernels.Within(70, radius, counting)
            for _ in kernels.offer_pairs(scorer, a, np.arange(70), b, np.arange(300), sink):
                pass
            got = sink.counts if counting else np.bincount(sink.rows()[0].astype(int), minlength=70)
            assert (got == (want < radius).sum(axis=1)).all()
    slot, at, key = kernels.closest(scorer, a, b, 9)
    order = np.argsort(want, axis=1, kind="stable")[:, :9]
    assert (at.reshape(70, 9) == order).all() and (key.reshape(70, 9) == np.take_along_axis(want, order, 1)).all()


@pytest.mark.parametrize("shape", [(1, 1), (3, 8), (5, 7), (64, 33)])
def test_true_cells_are_found_in_order(shape):
    from nearspan.plans import kernels
    for share in (0.0, 0.02, 0.7):
        near = np.random.default_rng(7).random(shape) < share
        assert kernels._true(near).tolist() == np.flatnonzero(near).tolist()
        assert kernels._true(near[:, ::2]).tolist() == np.flatnonzero(near[:, ::2]).tolist()
