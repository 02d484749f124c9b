"""Stored tables and indexes: versions, bitmaps of removed rows, repeated and competing changes."""

import os

import pytest
from conftest import ids_of
from pyspark.sql import functions as F

from nearspan.config import IndexConfig
from nearspan.errors import ConfigError
from nearspan.index import VectorIndex
from nearspan.operators import evaluate, exact, graph
from nearspan.sources import store
from nearspan.stored import StoredIndex


def ids(df):
    return sorted(r.vec_id for r in df.select("vec_id").collect())


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names}


def wanted(spark, *numbers):
    return spark.createDataFrame([(i,) for i in numbers], "vec_id long")


def test_versions_only_add_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda a, b: spark.range(a, b).select(F.col("id").alias("vec_id"), (F.col("id") % 3).cast("int").alias("list_id"), F.lit("é").alias("x"))
    one = store.create(rows(0, 50), path, partition_by="list_id")
    seen = files(path)
    two = store.append(rows(50, 60), one, partition_by="list_id")
    three = store.remove(wanted(spark, 3, 55, 999), two)
    four = store.remove(wanted(spark, 4, 3), three)  # 3 is gone already
    five = store.append(rows(3, 4), four, partition_by="list_id")  # and may come back
    assert all(files(path)[f] == t for f, t in seen.items())
    gone = {3, 4, 55}
    for at, want in ((one, range(50)), (two, range(60)), (three, set(range(60)) - {3, 55}), (four, set(range(60)) - gone), (five, (set(range(60)) - gone) | {3})):
        assert ids(store.rows(spark, at)) == sorted(want) and at.ntotal == len(set(want))
        assert ids(store.rows(spark, store.open_version(spark, path, at.version))) == sorted(want)
    assert store.open_version(spark, path) == five and five.next_id == 60
    assert store.rows(spark, five).columns == ["vec_id", "list_id", "x"]
    whole = store.compact(spark, five)
    assert ids(store.rows(spark, whole)) == ids(store.rows(spark, five)) and (len(whole.parts), whole.deletes) == (1, ())
    empty = store.reset(spark, whole)
    assert (ids(store.rows(spark, empty)), empty.ntotal, empty.next_id) == ([], 0, 60)
    merged = store.merge(spark, empty, one)
    assert ids(store.rows(spark, merged)) == list(range(60, 110))
    assert store.history(spark, path).count() == 8


def test_many_rows_in_one_file(spark, tmp_path):
    """Bits of several blocks of one file, first and last of each."""
    at = store.create(spark.range(100_000).select(F.col("id").alias("vec_id")).coalesce(1), str(tmp_path / "t"))
    out = [0, 7, 8, 32_767, 32_768, 65_535, 65_536, 99_999]
    at = store.remove(wanted(spark, *out), at)
    assert at.ntotal == 99_992
    assert ids(spark.range(100_000).withColumnRenamed("id", "vec_id").join(store.rows(spark, at), "vec_id", "left_anti")) == out


def test_repeated_and_competing_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    one = store.create(wanted(spark, 1, 2), path, token="a")
    two = store.append(wanted(spark, 3), one, token="b")
    before = files(path)
    assert store.append(wanted(spark, 3), two, token="b") == two == store.append(wanted(spark, 3), one, token="b")
    assert store.remove(wanted(spark, 1), two, token="a") == two
    assert files(path) == before
    with pytest.raises(ConfigError, match="another change"):
        store.append(wanted(spark, 4), one)
    assert ids(store.rows(spark, store.open_version(spark, path))) == [1, 2, 3]  # its files are there, but nobody reads them
    for bad in (lambda: store.create(wanted(spark, 1), path), lambda: store.open_version(spark, path, 9), lambda: store.open_version(spark, path + "x")):
        with pytest.raises(ConfigError):
            bad()


@pytest.mark.parametrize("config", [IndexConfig(8, "IVF_FLAT", nlist=4, nprobe=4), IndexConfig(8, "IVF_SQ", nlist=4, nprobe=4), IndexConfig(8, "FLAT_L2")])
def test_stored_index(spark, make, randoms, tmp_path, config):
    v = randoms(90, 8, seed=3)
    base, queries = make(v), make(v, "query_id")
    index = VectorIndex(config).train(base) if config.needs_training else VectorIndex(config)
    stored = StoredIndex.create(index.add(base.where("vec_id < 50")), str(tmp_path / "i"))
    first = stored
    stored = stored.add(base.where("vec_id >= 50")).remove(wanted(spark, 0, 60))
    plain = index.add(base.where("vec_id NOT IN (0, 60)"))
    assert ids_of(StoredIndex.open(spark, str(tmp_path / "i")).search(queries, 4)) == ids_of(plain.search(queries, 4))
    assert ids(first.index.rows) == list(range(50)) and first.search(queries, 1).where("vec_id >= 50").isEmpty()
    other = StoredIndex.create(index.add(base.limit(5)), str(tmp_path / "j"))
    assert stored.merge(other).at.ntotal == 93
    with pytest.raises(ConfigError):
        stored.merge(first)


def test_adding_keeps_the_graph(spark, make, randoms, tmp_path, monkeypatch):
    v = randoms(300, 8, seed=5)
    base, queries = make(v), make(v, "query_id")
    config = IndexConfig(8, "HNSW", degree=8, ef_construction=40)
    truth = exact.knn(base, queries, 5, dims=8)
    want = evaluate.mean_recall(VectorIndex(config).add(base).search(queries, 5), truth).first().recall
    index = VectorIndex(config).add(base.where("vec_id < 200")).materialize()
    monkeypatch.setattr(graph, "build", lambda *a, **b: pytest.fail("the graph was built again"))
    index = index.add(base.where("vec_id >= 200"))
    index.save(str(tmp_path / "g"))
    for grown in (index, VectorIndex.load(spark, str(tmp_path / "g"))):
        assert evaluate.mean_recall(grown.search(queries, 5), truth).first().recall >= want - 0.01
