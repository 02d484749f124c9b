import numpy as np
import pytest
from conftest import SF, brute, ids_of

from nearspan import IndexConfig, VectorIndex
from nearspan.errors import ConfigError, DimensionError, InvalidVectorError, NotTrainedError
from nearspan.sources import vectors
from nearspan.streaming import ingest, match


@pytest.mark.parametrize("bad", [
    dict(dims=0), dict(dims=4.0), dict(dims=True), dict(dims=4, kind="LSH"), dict(dims=4, metric="cosine"),
    dict(dims=4, kind="FLAT_L2", metric="ip"), dict(dims=4, kind="FLAT_IP", metric="l2"),
    dict(dims=4, nlist=3), dict(dims=4, kind="HNSW", nprobe=2), dict(dims=4, kind="IVF_FLAT", degree=4),
    dict(dims=4, kind="IVF_FLAT", nlist=0), dict(dims=4, kind="IVF_SQ", pq_bits=4),
    dict(dims=4, kind="IVF_FLAT", sq_type="SQ8"), dict(dims=4, kind="IVF_SQ", sq_type=""),
    dict(dims=12, kind="BINARY_FLAT"), dict(dims=16, kind="BINARY_FLAT", metric="l2"),
    dict(dims=16, kind="BINARY_IVF", hash_bits=4), dict(dims=16, kind="BINARY_HASH", hash_nflip=-1),
    dict(dims=4, reduced_dims=2), dict(dims=4, reduction="OPQ"), dict(dims=4, kind="FLAT_L2", reduction="LDA"),
])
def test_refused_settings(bad):
    with pytest.raises(ConfigError):
        IndexConfig(**bad)


def test_width_rules():
    for bad in (dict(dims=10, kind="PQ", pq_segments=4), dict(dims=4, reduction="PCA", reduced_dims=9)):
        with pytest.raises(DimensionError):
            IndexConfig(**bad)


def test_defaults():
    c = IndexConfig(8, "IVF_PQ")
    assert [c.option(x) for x in ("nlist", "nprobe", "pq_segments", "pq_bits")] == [100, 10, 8, 8]
    assert [IndexConfig(8, "HNSW").option(x) for x in ("degree", "ef_construction", "ef_search")] == [16, 200, 50]
    assert IndexConfig(8, "BINARY_HNSW").option("degree") == 32
    assert [IndexConfig(8, "BINARY_HASH").option(x) for x in ("hash_bits", "hash_nflip")] == [64, 0]
    assert IndexConfig(8, "IVF_SQ").option("sq_type") == "SQ8"


EXACT = [
    dict(kind="FLAT_L2"), dict(kind="IVF_FLAT", nlist=4, nprobe=4),
    dict(kind="FLAT_L2", reduction="PCAR", reduced_dims=8),
    dict(kind="IVF_FLAT", nlist=4, nprobe=4, reduction="PCA", reduced_dims=8),
]


@pytest.mark.parametrize("options", EXACT)
def test_exact_kinds(make, randoms, options):
    v = randoms(120, 8)
    index = VectorIndex(IndexConfig(8, train_rounds=3, **options)).add(make(v), auto_train=True)
    assert ids_of(index.search(make(v, "query_id"), 4)) == brute(v, v, 4)


LOSSY = [
    dict(kind="PQ", pq_segments=2, pq_bits=4), dict(kind="IVF_PQ", nlist=4, nprobe=2, pq_segments=2, pq_bits=4),
    dict(kind="IVF_SQ", nlist=4, nprobe=2), dict(kind="SQ", sq_type="SQ4"),
    dict(kind="HNSW", degree=4, ef_construction=30), dict(kind="FLAT_L2", reduction="PCA", reduced_dims=4),
    dict(kind="PQ", pq_segments=2, pq_bits=3, reduction="OPQ"), dict(kind="IVF_FLAT", nlist=4, metric="ip", nprobe=2),
]


@pytest.mark.parametrize("options", LOSSY)
def test_lossy_kinds_save_and_load(spark, make, formula, tmp_path, options):
    config = IndexConfig(8, train_rounds=2, **options)
    index = VectorIndex(config)
    if config.needs_training:
        with pytest.raises(NotTrainedError):
            index.add(make(formula(24)))
        index = index.train(make(formula(64)))
    index = index.add(make(formula(24)))
    before = ids_of(index.search(make(formula(2), "query_id"), 2))
    assert {q: len(v) for q, v in before.items()} == {0: 2, 1: 2}
    index.save(str(tmp_path / "i"))
    again = VectorIndex.load(spark, str(tmp_path / "i"))
    assert again.config == config
    assert ids_of(again.search(make(formula(2), "query_id"), 2)) == before
    assert again.stats().first().ntotal == 24
    assert again.reconstruct(spark.createDataFrame([(0, 3)], "pos int, vec_id long")).count() == 1


@pytest.mark.parametrize("options", [
    dict(kind="BINARY_FLAT"), dict(kind="BINARY_IVF", nlist=2, nprobe=2), dict(kind="BINARY_HNSW", degree=8),
    dict(kind="BINARY_HASH", hash_bits=4, hash_nflip=4), dict(kind="BINARY_HASH", hash_bits=4, hash_nflip=4, hash_tables=2),
])
def test_bit_kinds(make_codes, options):
    base = make_codes(["0000", "0001", "0003", "0f0f", "f0f0", "ffff", "aaaa", "5555"])
    index = VectorIndex(IndexConfig(16, **options)).add(base, auto_train=True)
    rows = index.search(make_codes(["0003"], "query_id"), 3).orderBy("rank").collect()
    assert [(r.vec_id, r.distance) for r in rows] == [(2, 0), (1, 1), (0, 2)]
    with pytest.raises(ConfigError):
        index.range_search(base, 2.0)


def test_lifecycle(spark, make):
    eye = np.eye(4)
    index = VectorIndex(IndexConfig(4)).add(make(eye[:3]))
    gone = spark.createDataFrame([(0, 1)], "pos int, vec_id long")
    assert index.removed_count(gone).first().removed == 1
    assert index.remove(gone).stats().first().ntotal == 2
    both = index.merge(VectorIndex(IndexConfig(4)).add(make(eye[3:])))
    assert ids_of(both.search(make(eye[3:], "query_id"), 1)) == {0: [3]}
    assert index.stats().first().ntotal == 3  # the first index did not change
    assert index.reset().stats().first().ntotal == 0
    assert {r.vec_id for r in index.range_search(make(eye[:1], "query_id"), 2.5).collect()} == {0, 1, 2}
    assert index.range_counts(make(eye[:1], "query_id"), 2.5).first().n == 3
    assert all(r.passed for r in index.check().collect())
    with pytest.raises(ConfigError):
        index.merge(index)
    with pytest.raises(DimensionError):
        index.merge(VectorIndex(IndexConfig(3)).add(make(np.eye(3))))
    with pytest.raises(ConfigError):
        index.search(make(eye, "query_id"), 1, nprobe=3)


def test_removal_in_lists(spark, make):
    index = VectorIndex(IndexConfig(4, "IVF_FLAT", nlist=2, nprobe=2)).add(make(np.eye(4)), auto_train=True)
    left = index.remove(spark.createDataFrame([(0, 1)], "pos int, vec_id long"))
    assert left.stats().first().ntotal == 3
    row = left.reconstruct(spark.createDataFrame([(0, 0)], "pos int, vec_id long")).first()
    assert row.embedding == [1, 0, 0, 0]
    assert left.inspect().first().lists <= 2


def test_bad_rows_are_refused(make):
    index = VectorIndex(IndexConfig(2))
    for rows in ([[1.0, float("nan")]], [[1.0, 2.0, 3.0]], [[1.0]]):
        with pytest.raises(InvalidVectorError):
            index.add(make(rows))


def _stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_ingest_in_batches(spark, make, tmp_path):
    eye, source = np.eye(4), tmp_path / "in"
    make(eye[:2], "source_id").coalesce(1).write.parquet(str(source / "a"))
    make(eye[2:], "source_id").coalesce(1).write.parquet(str(source / "b"))
    schema = "source_id long, embedding array<double>"
    target, log = str(tmp_path / "out"), str(tmp_path / "log")
    ingest.ingest(_stream(spark, str(source / "*"), schema), target, log, order=["source_id"]).awaitTermination()
    rows = ingest.progress(spark, target).orderBy("batch_id").collect()
    assert [(r.batch_rows, r.processed) for r in rows] == [(2, 2), (2, 4)]
    assert sorted(r.vec_id for r in ingest.ingested(spark, target).collect()) == [0, 1, 2, 3]

    # the same batch once more (its log entry lost): no second copy
    ingest.ingest(_stream(spark, str(source / "*"), schema), target, str(tmp_path / "log2"),
                  order=["source_id"]).awaitTermination()
    assert sorted(r.vec_id for r in ingest.ingested(spark, target).collect()) == [0, 1, 2, 3]
    assert ingest.progress(spark, target).count() == 2


def test_match_stream(spark, make, tmp_path):
    eye = np.eye(4)
    make(eye[2:], "query_id").write.parquet(str(tmp_path / "q"))
    index = VectorIndex(IndexConfig(4)).add(make(eye))
    arriving = _stream(spark, str(tmp_path / "q"), "query_id long, embedding array<double>")
    match.match_stream(arriving, lambda b: index.search(b, 1), str(tmp_path / "hits"), str(tmp_path / "log")).awaitTermination()
    assert ids_of(match.matched(spark, str(tmp_path / "hits"))) == {0: [2], 1: [3]}


def test_metadata_of_index(spark, make, tmp_path):
    VectorIndex(IndexConfig(4)).add(make(np.eye(4))).save(str(tmp_path / "i"), extra={"note": "n"})
    from nearspan.sources import tables
    assert tables.load_metadata(spark, str(tmp_path / "i"))["extra"]["user"] == {"note": "n"}
    with pytest.raises(ConfigError):
        VectorIndex.load(spark, str(tmp_path / "nothing"))


def test_real_table(spark):
    base = vectors.read_vectors(spark, f"{SF}/embeddings.parquet")
    index = VectorIndex(IndexConfig(64, "IVF_FLAT", nlist=8, nprobe=8, train_rounds=2)).add(base, auto_train=True)
    hits = index.search(base.withColumnRenamed("vec_id", "query_id"), 1, nprobe=1)
    assert hits.where("query_id = vec_id").count() == base.count()


def test_graph_is_saved_and_loaded_whole(spark, make, randoms, tmp_path, monkeypatch):
    from nearspan.operators import graph
    base = make(randoms(120, 8).tolist())
    queries = base.limit(10).withColumnRenamed("vec_id", "query_id")
    index = VectorIndex(IndexConfig(8, "HNSW", degree=6, ef_construction=20)).add(base)
    want = sorted(map(str, index.search(queries, 3).collect()))
    index.save(str(tmp_path / "g"))
    loaded = VectorIndex.load(spark, str(tmp_path / "g"))
    monkeypatch.setattr(graph, "build", lambda *a, **b: pytest.fail("the graph was built again"))
    assert sorted(map(str, loaded.search(queries, 3).collect())) == want
    assert sorted(map(str, index.search(queries, 3).collect())) == want


def test_two_loads_of_one_index_merge(spark, make, randoms, tmp_path):
    base = make(randoms(60, 8).tolist())
    VectorIndex(IndexConfig(8, "IVF_FLAT", nlist=4)).train(base).add(base).save(str(tmp_path / "m"))
    a, b = (VectorIndex.load(spark, str(tmp_path / "m")) for _ in range(2))
    assert a.merge(b).rows.count() == 120


def test_codes_are_checked_merged_and_hashed_widely(spark, make_codes):
    c = make_codes(["00" * 8, "ff" * 8, "0f" * 8])
    index = VectorIndex(IndexConfig(64, "BINARY_HASH", hash_bits=64, hash_nflip=3)).add(c)
    assert all(r.passed for r in index.check().collect())
    assert index.stats().first().bytes_per_vector == 8
    near = make_codes(["00" * 7 + "07"], "query_id")
    assert [(r.vec_id, r.distance) for r in index.search(near, 2).collect()] == [(0, 3)]
    assert index.merge(VectorIndex(index.config).add(c)).rows.count() == 6
