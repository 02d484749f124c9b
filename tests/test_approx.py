import numpy as np
import pytest
from conftest import brute, ids_of
from pyspark.sql import functions as F

from nearspan.errors import ConfigError
from nearspan.operators import evaluate, exact, graph, hashing, ivf, prep, quantize, reduce
from nearspan.plans import descent, walk
from nearspan.plans.search import Limits

PATHS = [Limits(path="base"), Limits(path="query"), Limits(path="cells", cell_bytes=8_000, sample_from_bytes=0, sample_share=0.3)]


@pytest.fixture(scope="module")
def cloud(make, randoms):
    v = randoms(500, 16, seed=8)
    v[::3] = v[1]  # a third of the rows are copies
    return v, make(v).repartition(4).cache(), make(v, "query_id").repartition(4).cache()


@pytest.fixture(scope="module")
def coarse(cloud):
    return ivf.train(cloud[1], 6, rounds=4)


@pytest.mark.parametrize("limits", PATHS)
def test_all_lists_equal_exact(cloud, coarse, limits):
    v, base, queries = cloud
    hits = ivf.search(ivf.assign(base, coarse), queries, coarse, 5, nprobe=6, limits=limits)
    assert ids_of(hits) == brute(v, v, 5)


def test_paths_agree_and_recall_grows(cloud, coarse):
    _, base, queries = cloud
    truth = exact.knn(base, queries, 5, dims=16)
    assigned, last = ivf.assign(base, coarse), 0.0
    for nprobe in (1, 2, 4):
        found = [ids_of(ivf.search(assigned, queries, coarse, 5, nprobe=nprobe, limits=p)) for p in PATHS]
        assert found[0] == found[1] == found[2]
        now = evaluate.mean_recall(ivf.search(assigned, queries, coarse, 5, nprobe=nprobe), truth).first().recall
        assert now >= last
        last = now


def test_inner_product_lists(cloud):
    v, base, queries = cloud
    model = ivf.train(base, 4, rounds=2, metric="ip")
    hits = ivf.search(ivf.assign(base, model), queries, model, 5, nprobe=4)
    assert ids_of(hits) == brute(v, v, 5, "ip")


def test_training_needs_enough_rows(make, randoms):
    with pytest.raises(ConfigError):
        ivf.train(make(randoms(2, 4)), 10)
    assert ivf.train(make(randoms(5, 4)), 5, rounds=1).nlist == 5


def test_training_refuses_nan(make):
    with pytest.raises(ValueError):
        ivf.train(make([[1.0, float("nan")], [0.0, 1.0]]), 2)


def test_means_do_not_depend_on_partitions(cloud):
    _, base, _ = cloud
    one, many = (ivf.train(base.repartition(n), 5, rounds=3).centres for n in (1, 9))
    assert np.allclose(one, many, atol=1e-9)


def test_few_candidates_give_few_rows(make):
    base = make([[0.0, 0], [0.1, 0], [9.0, 9], [9.1, 9]])
    model = ivf.CoarseModel(np.array([[0.0, 0], [9.0, 9]]))
    hits = ivf.search(ivf.assign(base, model), make([[0.0, 0]], "query_id"), model, 4, nprobe=1)
    assert ids_of(hits) == {0: [0, 1]}


@pytest.mark.parametrize("kind,bits", [("SQ8", 8), ("SQ6", 6), ("SQ4", 4)])
def test_scalar_error_is_within_half_a_step(cloud, kind, bits):
    v, base, _ = cloud
    model = quantize.train_scalar(base, kind)
    rows = quantize.decode_scalar(quantize.encode_scalar(base, model), model).orderBy("vec_id").collect()
    gap = np.abs(np.array([r.decoded for r in rows]) - v)
    assert (gap <= model.step / 2 + 1e-12).all()
    assert max(max(r.codes) for r in rows) == 2 ** bits - 1


@pytest.mark.parametrize("kind", ["SQ8", "SQfp16"])
@pytest.mark.parametrize("limits", PATHS)
def test_scalar_search_equals_search_of_decoded(cloud, coarse, kind, limits):
    _, base, queries = cloud
    model = quantize.train_scalar(base, kind)
    coded = quantize.encode_scalar(ivf.assign(base, coarse), model)
    decoded = quantize.decode_scalar(coded, model).select("vec_id", F.col("decoded").alias("embedding"))
    want = ids_of(exact.knn(decoded, queries, 4, dims=16))
    assert ids_of(quantize.search_scalar(coded, queries, model, 4, limits=limits)) == want
    assert ids_of(quantize.search_ivf_scalar(coded, queries, coarse, model, 4, nprobe=6, limits=limits)) == want


def test_unknown_scalar_type(cloud):
    with pytest.raises(ConfigError):
        quantize.train_scalar(cloud[1], "SQ5")


@pytest.mark.parametrize("metric", ["l2", "ip"])
@pytest.mark.parametrize("limits", PATHS)
def test_product_search_equals_search_of_decoded(cloud, metric, limits):
    v, base, queries = cloud
    model = quantize.train_product(base, 4, 3, dims=16, rounds=3)
    coded = quantize.encode_product(base, model)
    rows = quantize.decode_product(coded, model).orderBy("vec_id").collect()
    decoded = np.array([r.decoded for r in rows])
    hits = quantize.search_product(coded, queries, model, 3, metric=metric, limits=limits).collect()
    # equal codes tie, and sums by table may round differently: compare distances
    for r in hits[:200]:
        want = ((v[r.query_id] - decoded[r.vec_id]) ** 2).sum() if metric == "l2" else v[r.query_id] @ decoded[r.vec_id]
        assert r.distance == pytest.approx(want, abs=1e-9)
    best = brute(v, decoded, 3, metric)
    for q, ids in ids_of(quantize.search_product(coded, queries, model, 3, metric=metric, limits=limits)).items():
        key = (lambda i: ((v[q] - decoded[i]) ** 2).sum()) if metric == "l2" else (lambda i: -(v[q] @ decoded[i]))
        assert [key(i) for i in ids] == pytest.approx([key(i) for i in best[q]], abs=1e-9)


def test_centres_code_to_themselves(cloud, make):
    model = quantize.train_product(cloud[1], 2, 3, dims=16, rounds=3)
    centres = [np.concatenate([model.codebooks[0][i], model.codebooks[1][7 - i]]) for i in range(8)]
    rows = quantize.decode_product(quantize.encode_product(make(centres), model), model).orderBy("vec_id").collect()
    assert np.allclose([r.decoded for r in rows], centres)


def test_ivf_product_counts(make, formula):
    train, base = make(formula(64)), make(formula(24))
    coarse = ivf.train(train, 4, rounds=3)
    model = quantize.train_ivf_product(train, coarse, 2, 4, dims=8, rounds=3)
    coded = quantize.encode_ivf_product(base, coarse, model)
    hits = quantize.search_ivf_product(coded, make(formula(1), "query_id"), coarse, model, 5, nprobe=4)
    assert hits.count() == 5
    decoded = quantize.decode_ivf_product(coded, coarse, model).orderBy("vec_id").collect()
    for r in hits.collect():
        gap = np.array(formula(1)[0]) - np.array(decoded[r.vec_id].decoded)
        assert r.distance == pytest.approx(gap @ gap, abs=1e-9)


def test_pca_keeps_distances_at_full_width(cloud):
    v, base, queries = cloud
    model = reduce.train_pca(base, 16, rotate=True)
    hits = exact.knn(reduce.transform(base, model), reduce.transform(queries, model), 1, dims=16)
    assert all(r.distance < 1e-18 for r in hits.collect())
    cut = reduce.train_pca(base, 4)
    image = np.array([r.embedding for r in reduce.transform(base, cut).orderBy("vec_id").collect()])
    top = np.sort(np.linalg.eigvalsh(np.cov(v.T)))[::-1][:4]
    assert np.allclose(image.var(axis=0, ddof=1), top) and np.allclose(image.mean(axis=0), 0)


def test_opq_rotation(cloud):
    linear, product = reduce.train_opq(cloud[1], 4, 2, dims=16, rotations=2, rounds=2)
    assert np.allclose(linear.weights.T @ linear.weights, np.eye(16))
    assert product.segments == 4
    narrow, _ = reduce.train_opq(cloud[1], 4, 2, dims=16, out_dims=8, rotations=1, rounds=1)
    assert np.allclose(narrow.weights.T @ narrow.weights, np.eye(8))


@pytest.fixture(scope="module")
def codes(cloud):
    v, base, _ = cloud
    table = prep.binarize(base, 16).select("vec_id", "code").cache()
    return (v > 0), table, table.withColumnRenamed("vec_id", "query_id")


def _hamming(bits, k, allowed=lambda a, b: True):
    out = {}
    for i, q in enumerate(bits):
        d = (bits != q).sum(axis=1)
        order = [j for j in np.lexsort((np.arange(len(bits)), d)) if allowed(q, bits[j])]
        out[i] = order[:k]
    return out


@pytest.mark.parametrize("limits", PATHS)
def test_bit_lists(codes, limits):
    bits, base, queries = codes
    model = ivf.train(base, 4, rounds=2, metric="hamming")
    hits = ivf.search(ivf.assign(base, model), queries, model, 5, nprobe=4, limits=limits)
    assert ids_of(hits) == _hamming(bits, 5)


def test_small_bit_fixtures(make_codes):
    base = make_codes(["0000", "0001", "0003", "0f0f", "f0f0", "ffff", "aaaa", "5555"])
    model = ivf.train(base, 2, rounds=3, metric="hamming")
    first = ivf.search(ivf.assign(base, model), make_codes(["0001"], "query_id"), model, 1, nprobe=2).first()
    assert (first.vec_id, first.distance) == (1, 0)
    nodes = make_codes(["0000", "0f0f", "f0f0", "ffff"])
    g = graph.build(nodes, dims=16, metric="hamming", degree=8)
    first = graph.search(g, make_codes(["ffff"], "query_id"), 1).first()
    assert (first.vec_id, first.distance) == (3, 0)


@pytest.mark.parametrize("limits", PATHS)
@pytest.mark.parametrize("nflip", [0, 1, 6])
def test_hash_buckets(codes, limits, nflip):
    bits, base, queries = codes
    hits = hashing.search(base, queries, 5, dims=16, hash_bits=6, nflip=nflip, limits=limits)
    assert ids_of(hits) == _hamming(bits, 5, lambda a, b: (a[:6] != b[:6]).sum() <= nflip)


@pytest.mark.parametrize("limits", PATHS)
def test_several_hash_tables(codes, limits):
    bits, base, queries = codes
    hits = hashing.search(base, queries, 5, dims=16, hash_bits=4, nflip=1, tables=3, limits=limits)
    near = lambda a, b: any((a[t:t + 4] != b[t:t + 4]).sum() <= 1 for t in (0, 4, 8))
    assert ids_of(hits) == _hamming(bits, 5, near)


def test_hash_of_64_bits(make_codes):
    base = make_codes(["ff" * 8, "ff" * 7 + "7f", "00" * 8])
    hits = hashing.search(base, make_codes(["ff" * 8], "query_id"), 3, dims=64, hash_bits=64, nflip=1)
    assert ids_of(hits) == {0: [0, 1]}
    hits = hashing.search(base, make_codes(["ff" * 7 + "fc"], "query_id"), 3, dims=64, hash_bits=64, nflip=3)
    assert ids_of(hits) == {0: [0, 1]}


def test_graph_recall_and_copies(cloud):
    v, base, queries = cloud
    g = graph.build(base, dims=16, degree=8, pool=60)
    assert g.nodes.count() == len(np.unique(v, axis=0))
    assert g.nodes.selectExpr("max(size(neighbours))").first()[0] <= 16
    hits = graph.search(g, queries, 5, ef=40)
    truth = exact.knn(base, queries, 5, dims=16)
    assert evaluate.mean_recall(hits, truth).first().recall > 0.95
    assert ids_of(hits)[3] == brute(v, v, 5)[3]  # a copy finds the smallest ids of its group


def test_recall_by_nprobe_equals_single_runs(cloud, coarse):
    truth, assigned = exact.knn(cloud[1], cloud[2], 5, dims=16), ivf.assign(cloud[1], coarse)
    got = {r.nprobe: r.recall for r in evaluate.recall_by_nprobe(truth, assigned, cloud[2], coarse).collect()}
    for p in (1, 3, coarse.nlist):
        single = evaluate.mean_recall(ivf.search(assigned, cloud[2], coarse, 5, nprobe=p), truth).first().recall
        assert got[p] == pytest.approx(single)
    assert sorted(got) == list(range(1, coarse.nlist + 1)) and got[coarse.nlist] == 1


def clustered(n, dims, seed):
    """Vectors in tight clusters of unequal size."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dims)) * 4
    return centres[np.minimum(rng.geometric(0.25, n) - 1, 11)] + 0.4 * rng.standard_normal((n, dims))


@pytest.mark.parametrize("metric", ["l2", "ip", "hamming"])
def test_descent_finds_the_nearest(make, make_codes, randoms, metric):
    v = randoms(400, 16, seed=21)
    if metric == "ip":
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    points = make(v) if metric != "hamming" else make_codes([np.packbits(x > 0).tobytes().hex() + f"{i:04x}" for i, x in enumerate(v)])
    column = "code" if metric == "hamming" else "embedding"
    got = descent.neighbour_edges(points, column, metric, 16, 128, method="descent")
    want = descent.neighbour_edges(points, column, metric, 16, 128, method="exact")
    assert got.groupBy("src").count().agg({"count": "max"}).first()[0] <= 16
    both = got.join(want, ["src", "dst"], "left_semi") if metric != "hamming" else got.join(
        want.groupBy("src").agg(F.max("distance").alias("worst")), "src").where("distance <= worst")
    assert both.count() / want.count() > 0.95


def test_edges_are_chosen_by_direction():
    node, ends = np.zeros((1, 2)), np.array([[[1.0, 0], [1.2, 0.1], [0, 3.0], [9, 9]]])
    ids, real = np.arange(4)[None], np.array([[True, True, True, False]])
    chosen = lambda degree, spread: np.flatnonzero(walk.choose_edges("l2", node, ends, ids, real, degree, spread)[0]).tolist()
    assert chosen(2, True) == [0, 2] and chosen(2, False) == [0, 1]
    assert chosen(3, True) == [0, 1, 2]  # what is hidden fills the room that is left


def test_spread_edges_find_more(make):
    """Clustered rows and narrow beams: with spread edges more is found, from fewer places to begin."""
    v = clustered(600, 8, 31)
    base, queries = make(v), make(v, "query_id")
    truth = exact.knn(base, queries, 5, dims=8)
    spread, plain = (graph.build(base, dims=8, degree=3, pool=600, spread=s) for s in (True, False))
    found = [evaluate.mean_recall(graph.search(g, queries, 5, ef=10), truth).first().recall for g in (spread, plain)]
    assert found[0] > found[1] and found[0] > 0.99
    assert 2 * spread.entries.count() < plain.entries.count()


def test_walks_by_list_and_over_the_whole_agree(cloud):
    g = graph.build(cloud[1], dims=16, degree=8, pool=40)
    truth = exact.knn(cloud[1], cloud[2], 5, dims=16)
    whole = graph.search(g, cloud[2], 5, ef=60, limits=Limits(path="base"))
    lists = graph.search(g, cloud[2], 5, ef=60, limits=Limits(path="cells"))
    assert evaluate.mean_recall(whole, truth).first().recall > 0.97
    assert evaluate.mean_recall(lists, truth).first().recall > 0.95
    assert lists.groupBy("query_id").count().where("count <> 5").isEmpty()


def test_hot_lists_are_dealt_over_tasks(cloud, monkeypatch):
    g = graph.build(cloud[1], dims=16, degree=8, pool=40)
    want = graph.search(g, cloud[2], 5, ef=60, limits=Limits(path="cells")).collect()
    monkeypatch.setattr(graph, "HOT_QUERIES", 20)
    assert sorted(graph.search(g, cloud[2], 5, ef=60, limits=Limits(path="cells")).collect()) == sorted(want)


def test_full_beams_are_exact(cloud):
    g = graph.build(cloud[1], dims=16, degree=8, pool=40)
    truth = exact.knn(cloud[1], cloud[2], 7, dims=16)
    assert ids_of(graph.search(g, cloud[2], 7, ef=500)) == ids_of(truth)


@pytest.mark.parametrize("path", ["base", "cells"])
def test_insert_equals_a_fresh_build(make, path):
    v = clustered(500, 8, 41)
    v[450:460] = v[:10]  # equal to old rows
    v[470:480] = v[460:470]  # equal among the new
    base, queries, limits = make(v), make(v, "query_id"), Limits(path=path)
    old, new = base.where("vec_id < 400"), base.where("vec_id >= 400")
    truth = exact.knn(base, queries, 5, dims=8)
    grown = graph.insert(graph.build(old, dims=8, degree=6, pool=60), new, limits=limits)
    fresh = graph.build(base, dims=8, degree=6, pool=60)
    recalls = [evaluate.mean_recall(graph.search(g, queries, 5, ef=40, limits=Limits(path="base")), truth).first().recall for g in (grown, fresh)]
    assert recalls[0] >= recalls[1] - 0.01 and recalls[0] > 0.95
    assert grown.nodes.count() == fresh.nodes.count() == len(np.unique(v, axis=0))
    assert grown.nodes.selectExpr("max(size(neighbours))").first()[0] <= 12
    assert ids_of(graph.search(grown, queries, 2, ef=40))[455] == [5, 455]
    assert graph.insert(grown, new.limit(0)).nodes.count() == grown.nodes.count()


def test_graph_by_inner_product(make, randoms):
    v = randoms(300, 8, seed=3)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    base, queries = make(v), make(v, "query_id")
    hits = graph.search(graph.build(base, dims=8, metric="ip", degree=8, pool=60), queries, 5, ef=40)
    truth = exact.knn(base, queries, 5, metric="ip", dims=8)
    assert evaluate.mean_recall(hits, truth).first().recall > 0.95
    best = hits.where("rank = 1").collect()
    assert all(r.distance == pytest.approx(1.0) for r in best)


def test_seeds_skip_copies_of_the_whole_table(spark, make):
    from nearspan.plans.lloyd import seeds
    rows = [[1.0, 0.0]] * 300 + [[float(i), 5.0] for i in range(7)]
    found = seeds(make(rows), "embedding", 8)
    assert len({tuple(r) for r in found}) == 8
    assert len(seeds(make([[1.0, 2.0]] * 9), "embedding", 8)) == 8


def test_many_centres_are_scored_in_bounded_blocks(randoms):
    from nearspan.plans import lloyd
    centres, x = randoms(20_000, 8), randoms(600, 8, seed=2)
    best = lloyd.nearest_one(x, centres)
    want = [((centres - r) ** 2).sum(axis=1).argmin() for r in x[:50]]
    assert best[:50].tolist() == want
    assert lloyd.SCORE_BLOCK // 20_000 < 600


def test_scalar_training_refuses_spoiled_tables(spark, make):
    from nearspan.errors import NearspanError
    from nearspan.operators.quantize import train_scalar
    for rows in ([[1.0, float("nan")], [1.0, 2.0]], [[1.0, 2.0], [1.0]], []):
        with pytest.raises(Exception) as e:
            train_scalar(make(rows))
        assert isinstance(e.value, NearspanError) or "vectors" in str(e.value)


def test_full_beams_open_no_node_twice(monkeypatch, randoms):
    """Beams as wide as the block are what their starts reach: scored in blocks, not node by node in beams of thousands."""
    n = 3000
    v, ids = randoms(n, 8, seed=51), np.arange(n)
    ends = np.stack([(ids + 1) % 2000, (ids + 7) % 2000], axis=1)  # the last 1,000 are reached from nowhere
    block = walk.Block.of("l2", ids, v, np.full(n, 2), ends.ravel(), np.zeros(2 * n, int), None)
    monkeypatch.setattr(block, "_walk", None)
    starts = np.r_[np.zeros(50, int), 5, 2500]
    found = [np.concatenate(p) for p in zip(*block.walk(v[:51], np.r_[np.arange(51), 50], starts, n, 4))]
    want = brute(v[:50], v[:2000], 4)
    assert {s: found[1][found[0] == s].tolist() for s in range(50)} == want
    own = np.r_[np.arange(2000), 2500]
    assert found[1][found[0] == 50].tolist() == own[np.lexsort((own, ((v[own] - v[50]) ** 2).sum(axis=1)))[:4]].tolist()
    assert (found[2] == ((v[found[0]] - v[found[1]]) ** 2).sum(axis=1)).all()


@pytest.mark.parametrize("metric", ["l2", "hamming"])
def test_full_beams_are_exact_place_by_place(make, make_codes, randoms, metric):
    v = randoms(400, 64, seed=52)
    texts = [np.packbits(x > 0).tobytes().hex() for x in v]
    base, queries = (make(v), make(v, "query_id")) if metric == "l2" else (make_codes(texts), make_codes(texts, "query_id"))
    knn = exact.knn if metric == "l2" else exact.hamming_knn
    g = graph.build(base, dims=64, metric=metric, degree=8, pool=40)
    hits = graph.search(g, queries, 7, ef=400, limits=Limits(path="cells", place_bytes=60_000))
    assert sorted(hits.collect()) == sorted(knn(base, queries, 7, dims=64).select(*hits.columns).collect())


@pytest.mark.parametrize("metric", ["l2", "ip"])
def test_codes_are_preselected_by_product_and_scored_by_tables(randoms, metric):
    """The block of keys of codes is one matrix product; only few pairs are looked up, and their keys are the table sums."""
    from nearspan.plans import kernels
    books, q = randoms(4 * 8, 3, seed=71).reshape(4, 8, 3), randoms(40, 12, seed=72)
    codes = np.random.default_rng(73).integers(0, 8, (3000, 4)).astype(float)
    scorer = quantize.ProductModel(books).scorer(metric)
    looked, exact_keys = [], kernels.Scorer.exact
    def counted(self, *a):
        looked.append(len(a[2]))
        return exact_keys(self, *a)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(kernels.Scorer, "exact", counted)
        slot, at, key = kernels.closest(scorer, q, codes, 5)
    tables = scorer._tables(q)
    want = sum((tables[s][:, codes[:, s].astype(int)] for s in range(4)), np.zeros((40, 3000)))
    order = np.argsort(want, axis=1, kind="stable")[:, :5]
    assert at.reshape(40, 5).tolist() == order.tolist() and (key.reshape(40, 5) == np.take_along_axis(want, order, 1)).all()
    assert sum(looked) < 40 * 3000 / 50


def test_product_search_treats_repeated_rows_as_before(randoms):
    """Rows that come twice take two of the k places of their block, as in every other search of one block."""
    from nearspan.plans import kernels
    books, q = randoms(2 * 4, 2, seed=81).reshape(2, 4, 2), randoms(6, 4, seed=82)
    codes = np.random.default_rng(83).integers(0, 4, (60, 2)).astype(float)
    ids = np.repeat(np.arange(30), 2)
    codes = codes[ids]
    scorer, sink = quantize.ProductModel(books).scorer("ip"), kernels.TopK(6, 4)
    for _ in kernels.offer_pairs(scorer, q, np.arange(6), codes, ids, sink):
        pass
    tables = scorer._tables(q)
    keys = sum((tables[s][:, codes[:, s].astype(int)] for s in range(2)), np.zeros((6, 60)))
    inside = keys <= np.sort(keys, axis=1)[:, 3:4]
    want = [sorted({(keys[i, j], ids[j]) for j in np.flatnonzero(inside[i])})[:4] for i in range(6)]
    slot, at, key = sink.rows()
    assert [[(k, a) for s, a, k in zip(slot, at, key) if s == i] for i in range(6)] == want


def test_lists_side_by_side_are_one_place(make, randoms, monkeypatch):
    """A walk meets bounded blocks of many lists, and what leaves them is one row per query and new place."""
    v = randoms(400, 8, seed=91)
    base, queries = make(v), make(v, "query_id")
    g = graph.build(base, dims=8, degree=6, pool=10)
    most = 150
    places = graph._places(g, most)
    sizes = np.bincount(places, weights=[r.n for r in ivf.list_sizes(g.nodes).orderBy("list_id").collect()])
    assert 3 <= len(sizes) < g.coarse.nlist / 3 and sizes.max() <= most and sizes.sum() == 400
    rounds, one = [], graph._round
    monkeypatch.setattr(graph, "_round", lambda *a: rounds.append(one(*a)) or rounds[-1])
    limits = Limits(path="cells", place_bytes=most * graph._node_bytes(g))
    hits = graph.search(g, queries, 5, ef=30, limits=limits)
    assert evaluate.mean_recall(hits, exact.knn(base, queries, 5, dims=8)).first().recall > 0.97
    first = rounds[0].collect()
    onward = [(r.query_id, r.place) for r in first if r.distance is None]
    assert onward and len(onward) <= graph.ENTRY_LISTS * len(set(onward))  # at most one row from each place a query goes to
    assert all(r.starts for r in first if r.distance is None)
    assert max(np.unique([r.query_id for r in first if r.distance is not None], return_counts=True)[1]) <= 5 * len(sizes)


@pytest.mark.parametrize("metric", ["l2", "hamming"])
def test_walks_from_the_same_starts_score_them_in_blocks(monkeypatch, randoms, metric):
    """Queries that begin at the same nodes walk as from pairs, and no start is gathered once per query."""
    n, rng = 600, np.random.default_rng(5)
    v = randoms(n, 8) if metric == "l2" else rng.integers(0, 256, (n, 2)).astype(np.uint8)
    ends = rng.integers(0, n, (n, 6))
    block = walk.Block.of(metric, np.arange(n) * 3, v, np.full(n, 6), ends.ravel() * 3, None, None)
    starts, pairs, whole = np.arange(0, n, 2), [], walk.chosen_keys
    given = [np.concatenate(p) for p in zip(*block.walk(v[:40], np.repeat(np.arange(40), len(starts)), np.tile(starts, 40), 20, 5))]
    monkeypatch.setattr(walk, "chosen_keys", lambda *a: pairs.append(len(a[3])) or whole(*a))
    shared = [np.concatenate(p) for p in zip(*block.walk(v[:40], None, starts, 20, 5))]
    assert all((a == b).all() for a, b in zip(given, shared))
    assert sum(pairs) <= 40 * (n - len(starts))
    key = ((v[:40, None].astype(float) - v[None]) ** 2).sum(axis=2) if metric == "l2" else np.bitwise_count(v[:40, None] ^ v[None]).sum(axis=2)
    best = [np.lexsort((starts, key[i, starts]))[:1] for i in range(40)]
    assert all(shared[2][shared[0] == i].min() <= key[i, starts[b]].min() + 1e-9 for i, b in enumerate(best))


def test_links_shuffle_ids_where_vectors_fit(make, make_codes, randoms):
    """Vectors below the broadcast limit are not shuffled once per candidate; both ways choose the same neighbours."""
    for metric, points in (("l2", make(randoms(60, 8))), ("hamming", make_codes([f"{i * 7919 % 65536:04x}" for i in range(60)]))):
        column = "code" if metric == "hamming" else "embedding"
        nodes = points.withColumn("list_id", (F.col("vec_id") % 5).cast("int"))
        pairs = points.select(F.col("vec_id").alias("src")).crossJoin(points.select(F.col("vec_id").alias("dst"))).where("src <> dst and dst % 3 <> 0")
        linked = [graph._link(nodes, pairs, nodes, metric, 6, True, 64, limits) for limits in (Limits(), Limits(broadcast_bytes=0))]
        rows = [{(r.vec_id, bytes(r[column]) if metric == "hamming" else tuple(r[column]), *e) for r in d.collect()
                 for e in zip(r.neighbours, r.places)} for d in linked]
        assert rows[0] == rows[1] and len(rows[0]) == 360
        shuffled = [d._jdf.queryExecution().optimizedPlan().toString().split("collect_list(")[1] for d in linked]
        assert not shuffled[0].startswith("end") and shuffled[1].startswith("end")


def test_self_join_of_a_small_file_runs_in_many_tasks(spark, make, randoms, monkeypatch):
    asked, whole = [], descent.match_tables
    monkeypatch.setattr(descent, "match_tables", lambda base, queries, *a, **k: asked.append(queries) or whole(base, queries, *a, **k))
    edges = descent.neighbour_edges(make(randoms(50, 8)).coalesce(1), "embedding", "l2", 4, 64)
    assert edges.count() == 200
    assert asked[0].rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_true_neighbours_are_worked_out_once(spark):
    import __spark_entry__ as registered

    made = spark.sparkContext.accumulator(0)

    def rows(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    truth = spark.createDataFrame([(q, 1, v, 0.0) for q in range(4) for v in range(3)], "query_id long, rank int, vec_id long, distance double")
    found = registered._recall_by_width(spark, lambda ef: truth.where("vec_id < 2"), truth.mapInArrow(rows, truth.schema))
    assert [(r.ef, r.queries, r.recall) for r in found.orderBy("ef").collect()] == [(ef, 4, 0.666667) for ef in (10, 20, 50)]
    assert made.value == 12


def test_full_beams_from_shared_starts_repeat_no_start(randoms):
    """Queries that begin at the same nodes hold these once, not once per query, and no copy of all vectors."""
    import tracemalloc

    n = 40_000
    v, ids = randoms(n, 8, seed=61), np.arange(n)
    block = walk.Block.of("l2", ids, v, np.full(n, 1), (ids + 1) % n, None, None)
    starts = np.arange(0, n, 8)
    tracemalloc.start()
    shared = [np.concatenate(p) for p in zip(*block.walk(v[:400], None, starts, n, 3))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 * len(starts) * 8 * 2
    assert {s: shared[1][shared[0] == s].tolist() for s in range(20)} == brute(v[:20], v, 3)
    given = [np.concatenate(p) for p in zip(*block.walk(v[:20], np.repeat(np.arange(20), len(starts)), np.tile(starts, 20), n, 3))]
    assert all((a[shared[0] < 20] == b).all() for a, b in zip(shared, given))


def test_the_whole_graph_is_gathered_without_lists_of_ids(cloud, monkeypatch):
    """The driver gets positions made in tasks and fills one block; it is the one that lists of ids would give."""
    g = graph.build(cloud[1], dims=16, degree=8, pool=60)
    table = g.nodes.select("vec_id", "embedding", "neighbours").toArrow()
    want = graph._block("l2", table, "embedding", None)
    monkeypatch.setattr(graph, "_block", None)
    got = graph._whole(g)
    width = want.inner.shape[1]
    assert (got.ids == want.ids).all() and (got.data == want.data).all() and (got.inner[:, :width] == want.inner).all()
    assert (got.inner[:, width:] == -1).all() and got.inner.dtype == np.int32
    assert ids_of(graph.search(g, cloud[2], 5, ef=500)) == ids_of(exact.knn(cloud[1], cloud[2], 5, dims=16))


def test_edges_beyond_the_broadcast_limit_are_exact_while_that_is_cheaper(make, randoms, monkeypatch):
    """The exact join also runs in cells; NN-descent begins where the square of the rows costs more than its rounds."""
    points, limits = make(randoms(300, 8, seed=23)), Limits(broadcast_bytes=1000, cell_bytes=20_000)
    want = sorted(descent.neighbour_edges(points, "embedding", "l2", 6, 64).collect())
    with monkeypatch.context() as m:
        m.setattr(descent, "descend", None)
        assert sorted(descent.neighbour_edges(points, "embedding", "l2", 6, 64, limits).collect()) == want
    monkeypatch.setattr(descent, "EXACT_ROWS", 299)
    monkeypatch.setattr(descent, "descend", lambda *a: a)
    assert descent.neighbour_edges(points, "embedding", "l2", 6, 64, limits)[1:] == ("embedding", "l2", 6)
