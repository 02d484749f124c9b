import numpy as np
import pytest
from pyspark.sql import functions as F

from nearspan.errors import DimensionError
from nearspan.operators import ivf, maintain
from nearspan.session import scratch_path
from nearspan.sources import raw, tables, vectors

EYE = np.eye(4)


def ids(df):
    return sorted(r.vec_id for r in df.collect())


@pytest.fixture
def table(make):
    return make(EYE[:3])


def req(spark, *wanted):
    return spark.createDataFrame(list(enumerate(wanted)), "pos int, vec_id long")


def test_lookup_keeps_order_and_repeats(spark, table):
    rows = maintain.lookup(table, req(spark, 0, 2, 2)).orderBy("pos").collect()
    assert [(r.pos, r.vec_id) for r in rows] == [(0, 0), (1, 2), (2, 2)]
    assert rows[1].embedding == [0, 0, 1, 0]


def test_remove(spark, table):
    gone = req(spark, 1, 1, 77)
    assert ids(maintain.remove(table, gone)) == [0, 2]
    assert maintain.removed_count(table, gone).first().removed == 1


def test_removed_ids_stay_reachable_afterwards(spark, make):
    left = maintain.remove(make(EYE), req(spark, 1))
    assert ids(maintain.lookup(left, req(spark, 3))) == [3]


def test_merge_moves_ids_up(make):
    merged = maintain.merge(make(EYE[:2]), make(EYE[2:]))
    rows = merged.orderBy("vec_id").collect()
    assert [r.vec_id for r in rows] == [0, 1, 2, 3] and rows[2].embedding == [0, 0, 1, 0]
    with pytest.raises(DimensionError):
        maintain.merge(make(EYE), make([[1.0, 2.0]]))


def test_merge_with_an_empty_side(make):
    empty = make(EYE).limit(0)
    assert ids(maintain.merge(empty, make(EYE))) == [0, 1, 2, 3]
    assert ids(maintain.merge(make(EYE), empty)) == [0, 1, 2, 3]


def test_append_and_reset(spark, table):
    new = spark.createDataFrame([("b", [1.0] * 4), ("a", [2.0] * 4)], "name string, embedding array<double>")
    rows = maintain.append(table.select("vec_id", "embedding"), new, ["name"]).orderBy("vec_id").collect()
    assert [r.vec_id for r in rows] == [0, 1, 2, 3, 4] and rows[3].embedding == [2.0] * 4
    empty = maintain.reset(table)
    assert empty.count() == 0 and empty.schema == table.schema
    assert maintain.next_id(empty) == 0


def test_check_samples_and_finds(make, table):
    rows = {r.check: r for r in maintain.check(table, dims=4).collect()}
    assert all(r.passed for r in rows.values()) and rows["reconstruct"].message == "sampleIds=0,1,2"
    broken = make([[1.0, float("nan")], [1.0, 2.0]])
    rows = {r.check: r.passed for r in maintain.check(broken, dims=2).collect()}
    assert rows == {"dimensions": True, "vectorCount": True, "reconstruct": False, "selfSearch": False}
    assert maintain.check(make(EYE).limit(0), dims=4).count() == 2


@pytest.mark.parametrize("n,size,want", [(10, 3, [0, 3, 6, 9]), (11, 3, [0, 3, 6, 10]), (2, 2, [0, 1]), (1, 1, [0])])
def test_sample_positions(spark, n, size, want):
    table = spark.range(n).select(F.col("id").alias("vec_id"))
    assert ids(maintain.sample_ids(table, n, size)) == want


def test_list_skew(make):
    model = ivf.CoarseModel(np.array([[0.0], [10.0]]))
    row = maintain.list_skew(ivf.assign(make([[0.1], [0.2], [0.3], [9.0]]), model)).first()
    assert (row.lists, row.smallest, row.largest, row.mean, row.skew) == (2, 1, 3, 2.0, 1.5)


def test_float_records(spark, tmp_path):
    EYE[:3].astype("<f4").tofile(tmp_path / "v.bin")
    rows = vectors.read_float32_records(spark, str(tmp_path / "v.bin"), 4).orderBy("vec_id").collect()
    assert [(r.vec_id, r.embedding) for r in rows] == [(i, EYE[i].tolist()) for i in range(3)]
    with pytest.raises(DimensionError):
        vectors.read_float32_records(spark, str(tmp_path / "v.bin"), 5)


def test_bit_records(spark, tmp_path):
    (tmp_path / "b.bin").write_bytes(bytes.fromhex("0000fffff00f"))
    rows = vectors.read_bit_records(spark, str(tmp_path / "b.bin"), 16).orderBy("vec_id").collect()
    assert [bytes(r.code).hex() for r in rows] == ["0000", "ffff", "f00f"]


def test_raw_files_keep_the_order(spark, make, randoms):
    v = randoms(300, 3).astype(np.float32)
    path = scratch_path(spark, "raw")
    assert raw.write_float32_records(make(v, kind="array<float>").repartition(5), path) == 300
    rows = vectors.read_float32_records(spark, path, 3).orderBy("vec_id").collect()
    assert np.array_equal(np.array([r.embedding for r in rows], np.float32), v)


def test_save_and_load(spark, table, tmp_path):
    path = str(tmp_path / "t")
    tables.save_table(table, path, dims=4, kind="FLAT_L2", metric="l2", extra={"owner": "x"})
    assert ids(tables.load_table(spark, path, dims=4)) == [0, 1, 2]
    meta = tables.load_metadata(spark, path)
    assert (meta["kind"], meta["ntotal"], meta["extra"]) == ("FLAT_L2", 3, {"owner": "x"})
    with pytest.raises(DimensionError):
        tables.load_table(spark, path, dims=5)
    table.limit(1).write.mode("append").parquet(f"{path}/data")
    with pytest.raises(DimensionError):
        tables.load_table(spark, path)
    assert tables.load_table(spark, path, check=False).count() == 4


def test_missing_description(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t/data"))
    assert tables.load_metadata(spark, str(tmp_path / "t")) is None
    assert tables.load_table(spark, str(tmp_path / "t")).count() == 3


def test_probed_lists_are_the_only_ones_read(spark, make, tmp_path):
    from nearspan.plans.search import Limits

    model = ivf.CoarseModel(np.array([[0.0], [10.0], [20.0]]))
    path = str(tmp_path / "t")
    tables.save_table(ivf.assign(make([[0.0], [9.0], [21.0]]), model), path, dims=1, kind="IVF_FLAT", metric="l2",
                      partition_by="list_id")
    hits = ivf.search(tables.load_table(spark, path), make([[19.0]], "query_id"), model, 1, nprobe=1,
                      limits=Limits(path="query"))
    assert [r.vec_id for r in hits.collect()] == [2]
    plan = hits._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "list_id" in filters and " 2" in filters


def test_read_vectors_prunes_columns(spark):
    df = vectors.read_vectors(spark, "/root/testdata/sf0.001/embeddings.parquet")
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in \
        df._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(DimensionError):
        vectors.read_vectors(spark, "/root/testdata/sf0.001/embeddings.parquet", vector="label")


def test_vector_text(spark):
    df = spark.createDataFrame([("[1,2.5,-3]",)], "t string")
    assert df.select(vectors.parse_vector_text(F.col("t")).alias("v")).first().v == [1.0, 2.5, -3.0]


def test_synthetic_vectors_are_reproducible(spark):
    ids_ = spark.range(200).select(F.col("id").alias("vec_id"))
    a, b = (vectors.synthetic_vectors(ids_.repartition(n), 16).orderBy("vec_id").collect() for n in (1, 7))
    assert a == b
    m = np.array([r.embedding for r in a])
    assert np.allclose((m ** 2).sum(axis=1), 1) and abs(m.mean()) < 0.02


def test_text_embedding(spark):
    docs = spark.createDataFrame([(0, "a b  A"), (1, "b a a"), (2, ""), (3, "zebra")], "doc_id long, text string")
    rows = [r.embedding for r in vectors.embed_text(docs, dims=64).orderBy("vec_id").collect()]
    assert rows[0] == rows[1] and rows[0] != rows[3]
    assert rows[2] == [0.0] * 64
    assert np.isclose(np.linalg.norm(rows[0]), 1)


def test_text_embedding_shuffles_no_words(spark):
    """Words become slots where they are read; rows that share an id are one document, and signs are summed."""
    import contextlib
    import hashlib
    import io
    docs = spark.createDataFrame([(1, "b A a  b c"), (2, None), (1, "C"), (3, " "), (4, "x " * 500)], "doc_id long, text string")
    made = vectors.embed_text(docs, dims=8)
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        made.explain("simple")
    keys = [line for line in plan.getvalue().splitlines() if "Exchange hashpartitioning" in line]
    assert keys and not any("word" in line for line in keys)
    want = np.zeros((5, 8))
    for row, text in ((1, "b a a b c c"), (4, "x " * 500)):
        for w in text.split():
            h = hashlib.md5(w.encode()).hexdigest()
            want[row, int(h[:8], 16) % 8] += 1 if int(h[8], 16) < 8 else -1
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-300)
    rows = made.collect()
    assert sorted(r.vec_id for r in rows) == [1, 1, 2, 3, 4]
    assert all(np.allclose(r.embedding, want[r.vec_id], atol=1e-12) for r in rows)
