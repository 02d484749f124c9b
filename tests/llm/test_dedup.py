"""Near-duplicates, components, repeated passages and the pipeline against brute force."""

import hashlib
import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF

import corpus_pipeline
from nearspan.llm import order_minhash, suffix_dedup
from nearspan.llm.components import components
from nearspan.session import cut_lineage

R = random.Random(4)


def text_of(n, vocabulary=4000):
    return " ".join(f"w{R.randrange(vocabulary)}" for _ in range(n))


def edited(text, edits):
    words = text.split()
    for _ in range(edits):
        words[R.randrange(len(words))] = f"e{R.randrange(10**6)}"
    return " ".join(words)


# ---- near-duplicates

def labelled(text):
    words, seen, out = text.split(), defaultdict(int), []
    for i in range(max(1, len(words) - 4) if words else 0):
        g = tuple(words[i:i + 5])
        out.append((g, seen[g]))
        seen[g] += 1
    return out


def chain(a, b):
    """Longest common subsequence, the plain way."""
    best = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(best[j] + 1 if x == y else max(best[j + 1], row[j]))
        best = row
    return best[-1]


def same(x, y):
    a, b = labelled(x), labelled(y)
    if not a or not b:
        return False
    m = chain(a, b)
    return m / (len(a) + len(b) - m) >= 0.8


def brute_classes(rows):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            x, y = rows[i][1], rows[j][1]
            if x is not None and y is not None and x.split() and (x == y or same(x, y)):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return sorted((-1 if rows[i][0] is None else rows[i][0],
                   min((d for d in groups[find(i)] if d is not None), default=-1)) for i in range(len(rows)))


@pytest.fixture(scope="module")
def near_rows():
    bases = [text_of(n) for n in (3, 30, 120, 120, 200, 60)]
    rows = [(i, b) for i, b in enumerate(bases)]
    for b in bases[1:]:
        for e in (1, 1, 2, 3, 6, 20):
            rows.append((len(rows), edited(b, e)))
    half = bases[3].split()
    rows += [(len(rows), " ".join(half[60:] + half[:60])), (len(rows) + 1, bases[3] + " " + text_of(20)),
             (900, None), (901, ""), (902, "  \n"), (903, None), (904, bases[0]), (904, bases[0]), (None, bases[1]),
             (None, "only here alone"), (905, "a b c"), (906, "a  b\nc"), (907, "the same " * 300), (908, "the same " * 320)]
    return rows


@pytest.mark.parametrize("settings", [order_minhash.Settings(), order_minhash.Settings(few=1)])
def test_classes_equal_brute_force(spark, near_rows, settings):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in near_rows], "doc_id long, text string, digest string, root int").repartition(3)
    got = order_minhash.classes(docs, settings).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.class_id is None else r.class_id) for r in got) == brute_classes(near_rows)


def template_rows():
    """Texts whose common part alone is below the threshold, in pairs of near copies."""
    r = random.Random(11)
    common, rows = [f"t{i}" for i in range(110)], []
    for g in range(250):
        own = [f"o{r.randrange(10**6)}" for _ in range(16)]
        for _ in range(2):
            words = own.copy()
            for at in r.sample(range(16), 2):
                words[at] = f"e{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(common[:55] + words + common[55:])))
    return rows


def test_pairs_among_many_templates_equal_brute_force(spark):
    rows = template_rows()
    labels = [order_minhash.labels_of(t.encode()) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if order_minhash.similarity(labels[i], labels[j]) >= 0.8]
    assert all(same(rows[i][1], rows[j][1]) for i, j in pairs[:20])
    for i, j in pairs:
        root[max(find(i), find(j))] = min(find(i), find(j))
    classes = {find(i) for i in range(len(rows))}
    assert len(pairs) > 100 and len(classes) > 100
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.class_id for r in order_minhash.classes(docs).collect()}
    assert got == {i: find(i) for i in range(len(rows))}


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(3)
    counts = rng.integers(1, 50, 64)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = rng.choice(1000, n, replace=False).astype(np.uint64)
        b = np.concatenate([a[int(rng.integers(0, n // 6 + 1)):], rng.choice(np.arange(1000, 2000), int(rng.integers(0, 8)), replace=False).astype(np.uint64)])
        common = len(np.intersect1d(a, b))
        if common / (len(a) + len(b) - common) >= 0.8:
            small, large = sorted((a, b), key=len)
            (x, short), (y, _) = order_minhash.prefix(small, counts, 0.8), order_minhash.prefix(large, counts, 0.8)
            assert len(np.intersect1d(x[:short], y))


def test_texts_that_pass_share_a_difference_to_a_hub():
    """If one of two similar sets is not near the hub, they have a difference in common among the first of either."""
    rng, c, seen = np.random.default_rng(8), 0.2 / 1.8, 0
    counts = rng.integers(1, 50, 64)

    def changed(x, most):
        kept = rng.permutation(x)[int(rng.integers(0, most)):]
        return np.concatenate([kept, rng.integers(10**6, 10**9, int(rng.integers(0, most)))]).astype(np.uint64)

    for _ in range(3000):
        n = int(rng.integers(20, 120))
        hub = np.arange(n, dtype=np.uint64)
        a = changed(hub, n // 3)
        b = changed(a, n // 5)
        common = len(np.intersect1d(a, b))
        rows = []
        for x in (a, b):
            diff = np.setxor1d(x, hub)
            w = len(diff) - c * len(x)
            assert w >= -c * n - 1e-6
            assert (w <= c * n + 1e-6) == (len(np.intersect1d(x, hub)) / len(np.union1d(x, hub)) >= 0.8 - 1e-9)
            rows.append((w, len(diff), *order_minhash.first_differences(diff, w, c * n, counts)))
        (wx, nx, x, short, _), (wy, ny, y, _, long) = sorted(rows, key=lambda r: r[0])
        if common / (len(a) + len(b) - common) >= 0.8 and wy > c * n + 1e-6:
            seen += 1
            at = [(i, j) for i, v in enumerate(x[:short]) for j in np.flatnonzero(y[:long] == v)]
            assert at and min(nx - at[0][0], ny - at[0][1]) >= (wx + wy) / 2 - 1e-6
    assert seen > 300


def test_pairs_at_a_template_stay_few(spark):
    """Texts of one template with edits of their own and no link above the threshold: few of all pairs meet."""
    r = random.Random(5)
    common, rows = [f"t{i}" for i in range(300)], []
    for i in range(300):
        words = common.copy()
        for at in r.sample(range(300), 5):
            words[at] = f"e{r.randrange(10**9)}"
        rows.append((i, " ".join(words)))
    docs, s = spark.createDataFrame(rows, "doc_id long, text string"), order_minhash.Settings()
    shared = order_minhash._shared(cut_lineage(order_minhash._sketch_table(docs, s)))
    texts = order_minhash._texts(docs, shared.select("digest").distinct(), s)
    good = cut_lineage(order_minhash._verify(order_minhash._stars(shared), texts, s))
    differences = order_minhash._differences(order_minhash._mixed(shared, components(good), s), texts, s)
    assert differences.count() >= 300
    assert order_minhash._share_differences(differences, s).count() < 0.35 * 300 * 299 / 2


def test_reordered_copies_near_a_hub_find_each_other(spark):
    """Two orders of one text: near one hub by their labels, two classes by alignment; plus copies far from either hub."""
    r = random.Random(21)
    parts = [[f"p{k}_{i}" for i in range(60)] for k in range(4)]
    rows = []
    for order in ((0, 1, 2, 3), (2, 3, 0, 1)):
        for _ in range(14):
            words = [w for k in order for w in parts[k]]
            for at in r.sample(range(240), r.choice((1, 2, 4))):
                words[at] = f"e{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = order_minhash.classes(docs, order_minhash.Settings(few=1)).collect()
    assert sorted((x.doc_id, x.class_id) for x in got) == brute_classes(rows)


def test_one_of_each_class_stays(spark, near_rows):
    docs = spark.createDataFrame([(i, t, "x") for i, t in near_rows], "doc_id long, text string, digest string").repartition(3)
    kept = order_minhash.drop_near(docs)
    assert kept.columns == docs.columns
    want = {c for d, c in brute_classes(near_rows) if c >= 0}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted(want) and got.count(None) == 1
    assert order_minhash.drop_near(docs.limit(0)).count() == 0


def test_order_matters_to_sketches_and_alignment():
    words = text_of(200).split()
    a, b = order_minhash.labels_of(" ".join(words).encode()), order_minhash.labels_of(" ".join(words[100:] + words[:100]).encode())
    assert len(np.intersect1d(a, b)) > 0.9 * len(a)
    assert order_minhash.similarity(a, b) < 0.6 and order_minhash.similarity(a, a) == 1.0
    assert len(set(order_minhash.labels_of(b"x " * 50))) == 46
    long = order_minhash.labels_of(text_of(3000).encode())
    assert (order_minhash.sketches(long) == order_minhash.sketches(long.copy())).all()


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 200), (300, 300)]
    for alone in (0, 5, 10_000):
        got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long"), alone).collect()}
        assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- repeated passages

def brute_strip(rows, length=100):
    """{(doc_id, bytes): figures} by the definition; rows are (doc_id, bytes)."""
    last = 1 << 63
    docs = sorted({(last if d is None else d, r) for d, r in rows})
    first, out = {}, {}
    for d, r in docs:
        gone = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if first.setdefault(r[p:p + length], (d, p)) < (d, p):
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(r, gone, strict=True) if not g)
        spans = sum(bool(g) and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[d, r] = (len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return [(-1 if d is None else d, *out[last if d is None else d, r]) for d, r in rows]


@pytest.fixture(scope="module")
def passages():
    shared = [text_of(n, 10**6) for n in (14, 16, 30, 80, 300)]
    rows = [(i, " ".join([text_of(R.randrange(40)), R.choice(shared), text_of(R.randrange(30)), R.choice(shared)])) for i in range(60)]
    line = "é" * 60 + "ü" * 70
    rows += [(70, line + "a"), (71, "b" + line), (72, line), (73, "x" * 99), (74, "x" * 99), (75, "x" * 500), (76, "ab" * 400),
             (77, None), (78, ""), (79, shared[4]), (80, shared[4]), (80, shared[4]), (None, shared[3]), (3, rows[3][1]), (81, "\0" * 130), (82, "\0" * 101)]
    return rows


@pytest.mark.parametrize("settings", [suffix_dedup.Settings(), suffix_dedup.Settings(block_bytes=4_000, chunk=30, crowd=12),
                                      suffix_dedup.Settings(block_bytes=1, chunk=5)])
def test_strip_equals_brute_force(spark, passages, settings):
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in passages], "doc_id long, text string, block string, n_bytes int").repartition(4)
    got = suffix_dedup.strip_repeats(docs, settings)
    assert got.columns == [*docs.columns, "repeats"]
    rows = got.collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, *r.repeats) for r in rows) == sorted(
        brute_strip([(i, (t or "").encode()) for i, t in passages]))
    assert all(r.block == "x" and r.n_bytes == 5 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[77].text is None and by[80].text == "" and by[73].text == "x" * 99
    for r in rows:
        if r.text and r.repeats.n_removed == 0:
            assert hashlib.sha256(r.text.encode()).hexdigest() == r.repeats.kept_sha256


def test_strip_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.strip_repeats(docs).count() == 0
    clash = spark.createDataFrame([(1, "x" * 300, "mine")], "doc_id int, text string, repeats string")
    out = suffix_dedup.strip_repeats(clash)
    assert out.columns == ["doc_id", "text", "repeats", "repeats_"]
    assert [(r.repeats, r.repeats_.n_bytes) for r in out.collect()] == [("mine", 300)]
    with pytest.raises(TypeError, match="integer"):
        suffix_dedup.strip_repeats(clash.withColumn("doc_id", clash.doc_id.cast("string")))
    assert suffix_dedup.strip_repeats(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).count() == 2


def test_anchors_and_contexts_in_pieces(monkeypatch):
    rng = np.random.default_rng(4)
    for n, texts in ((0, 1), (99, 1), (100, 1), (5_000, 40), (20_000, 3)):
        buf = rng.integers(97, 99, n).astype(np.uint8)
        ends = np.sort(np.append(rng.integers(0, n + 1, texts - 1), n))
        got = []
        for piece in (1 << 30, 1_000, 77):
            monkeypatch.setattr(suffix_dedup, "PIECE", piece)
            monkeypatch.setattr(suffix_dedup, "ROWS", piece)
            at, h = suffix_dedup.anchors(buf, ends)
            got.append([at, h, *(suffix_dedup.contexts(buf, ends, at) if n else ())])
        for other in got[1:]:
            assert all(np.array_equal(x, y) for x, y in zip(got[0], other, strict=True))


def test_a_block_takes_little_memory():
    buf = np.random.default_rng(3).integers(97, 123, 2 << 20).astype(np.uint8)
    ends = np.array([1 << 20, 2 << 20])
    tracemalloc.start()
    at, _ = suffix_dedup.anchors(buf, ends)
    suffix_dedup.contexts(buf, ends, at[:20_000])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20


def test_multikey_sort():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 3, (500, 24)).astype(np.uint8)
    rows[100:200] = rows[:100]
    order, lcp = suffix_dedup.multikey_sort(suffix_dedup._characters(rows))
    ranked = [rows[i].tobytes() for i in order]
    assert ranked == sorted(r.tobytes() for r in rows)
    want = [0] + [next((k for k in range(24) if a[k] != b[k]), 24) for a, b in zip(ranked, ranked[1:])]
    assert lcp.tolist() == want


# ---- pipeline

def test_pipeline_stages(spark):
    """Each stage against its definition, on what the one before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = cut_lineage(stage(spark, docs, SF), "stage")
        assert out.columns == columns, name
        before, after = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()}
        assert set(after) <= set(before) and len(after) == out.count() > 0
        if name == "suffix-array dedup":
            want = {d: f for d, *f in brute_strip([(d, r.text.encode()) for d, r in before.items()])}
            for d, r in after.items():
                assert r.n_chars == len(r.text) and len(before[d].text.encode()) - want[d][1] >= len(r.text.encode())
                if not want[d][1]:
                    assert r.text == before[d].text
            assert len(after) == len(before)
        else:
            assert all(r == before[d] for d, r in after.items())
        if name == "MinHash near-dedup":
            assert set(after) == {c for _, c in brute_classes([(d, r.text) for d, r in before.items() if len(r.text) < 1500])
                                  } | {d for d in after if len(before[d].text) >= 1500}
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count()
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, last.collect()))
