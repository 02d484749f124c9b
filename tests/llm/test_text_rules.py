"""Quality rules, decontamination, mixing and license scans on small fixtures."""

import hashlib
import random
import re
from collections import Counter
from math import comb

import duckdb
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from nearspan.llm import decontaminate, known_licenses, licenses, mixing, order_minhash, queries, quality_rules, suffix_dedup
from nearspan.session import BATCH_BYTES, BATCH_LIMIT, bound_batches
from tools_check import comparable

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (None, "one two three", None, None, None), (3, " \n\t ", "en", "b", 4),
       (4, "x " * 60, "en", "b", 120), (4, "x " * 60, "en", "b", 120), (5, "a b c a b c " + "w " * 3, "de", "c", 20)]


def docs_of(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


# ---- quality rules

def brute_figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


@pytest.mark.parametrize("text", [None, "", " \n ", "a b a b a b", "é# *ü\né# *ü\n\n\n", "a b c d\x0ba b c\x1fd", "x " * 500,
                                  "\n".join(["same line here", "other", "same line here "] * 3)])
def test_figures_equal_brute_force(text):
    raw = (text or "").encode()
    assert quality_rules.figures_of(raw, len(text or ""))[:5] == brute_figures(text)


def test_binomial_is_exact():
    for n, k, p in ((10, 2, 0.3), (100, 0, 0.05), (500, 7, 0.01), (2000, 30, 0.02), (5, 5, 0.1), (40, 39, 0.95)):
        assert quality_rules.at_most(k, n, p) == pytest.approx(sum(comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1)), rel=1e-9)


def test_cutoffs_need_evidence_and_hold_the_risk():
    m = quality_rules.Settings().steps
    few = {(0, "symbols", m, 0): 5, (0, "symbols", 0, 1): 100}
    assert quality_rules.choose(few) == {}
    many = {(0, "symbols", m, 0): 500, (0, "symbols", 0, 1): 20_000}
    assert quality_rules.choose(many) == {(0, "symbols"): 1.0}
    spoiled = many | {(0, "symbols", m, 1): 2_000}
    assert quality_rules.choose(spoiled) == {}


def test_judge_on_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, None, 0), (4, 0, 1), (4, 1, 1)], "doc_id long, quality int, toxic int")
    rows = docs_of(spark, ODD).withColumnRenamed("lang", "n_words")
    got = quality_rules.judge(rows, labels).collect()
    assert len(got) == len(ODD)
    assert sorted((r.doc_id or 0, *[r.f[c] for c in quality_rules.BASE], r.base_failed, r.kept) for r in got) == sorted(
        (d or 0, *(b := brute_figures(t)), failed := b[0] < 50 or 100 * b[4] > 50 * b[0], not failed) for d, t, *_ in ODD)
    kept = quality_rules.keep_good(rows, labels)
    assert kept.columns == rows.columns and kept.count() == 0
    assert quality_rules.judge(rows.limit(0), labels.limit(0)).count() == 0


def test_rules_reject_what_labels_mark(spark):
    good = [(i, " ".join(f"w{i}x{j}" for j in range(80)), "en", "s", 1) for i in range(3000)]
    bad = [(10_000 + i, " ".join(f"w{i}x{j}***" for j in range(80)), "en", "s", 1) for i in range(300)]
    docs = docs_of(spark, good + bad).repartition(4)
    labels = spark.createDataFrame([(d[0], int(d[0] < 10_000), 0) for d in good + bad], "doc_id long, quality int, toxic int")
    got = quality_rules.keep_good(docs, labels)
    assert got.filter("doc_id < 10000").count() == 3000 and got.filter("doc_id >= 10000").count() == 0
    base = quality_rules.judge(docs, labels)
    assert base.filter("base_failed").count() == 0 and base.filter("kept").count() == 3000


def test_figures_read_texts_in_batches_of_bounded_bytes(spark, monkeypatch):
    plain = quality_rules._figures

    def checked(texts: pa.Array) -> pa.Array:
        if texts.nbytes > BATCH_BYTES + 200_000:
            raise ValueError(f"{texts.nbytes} bytes in a batch")
        return plain(texts)

    monkeypatch.setattr(quality_rules, "_figures", checked)
    long = F.repeat(F.concat(F.lit("word"), F.col("id").cast("string"), F.lit(" ")), 10_000)
    docs = spark.range(0, 120, 1, 1).select(F.col("id").alias("doc_id"), long.alias("text"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for step in (quality_rules.judge, quality_rules.keep_good):
        spark.conf.unset(BATCH_LIMIT)
        assert step(docs, labels).count() == (120 if step is quality_rules.judge else 0)


def test_batches_are_bounded_but_never_widened(spark):
    for given, narrowed in (("1g", True), ("4097k", True), ("4m", False), ("65536", False)):
        spark.conf.set(BATCH_LIMIT, given)
        before = spark.conf.get(BATCH_LIMIT)
        bound_batches(spark)
        assert spark.conf.get(BATCH_LIMIT) == (f"{BATCH_BYTES}b" if narrowed else before)
    docs = docs_of(spark, ODD)
    for step in (order_minhash.drop_near, suffix_dedup.strip_repeats):
        spark.conf.unset(BATCH_LIMIT)
        step(docs)
        assert spark.conf.get(BATCH_LIMIT) == f"{BATCH_BYTES}b"
    spark.conf.unset(BATCH_LIMIT)


# ---- decontamination

BENCH = [(7, "Alpha beta GAMMA delta"), (70, "alpha Beta gamma delta."), (8, None), (9, "..."), (None, "é É x9 y"),
         (10, " ".join(f"q{i}" for i in range(20)))]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_report(doc, bench):
    w, hit, items = words(doc), set(), set()
    for item, text in bench:
        g = words(text)
        for n in {min(len(g), 13)} - {0}:
            for i in range(len(g) - n + 1):
                for j in range(len(w) - n + 1):
                    if w[j:j + n] == g[i:i + n]:
                        hit.update(range(j, j + n))
                        items.add("" if item is None else str(item))
    sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return len(w), len(hit), len(items), sha, len(hit) > 0 and 20 * len(hit) >= len(w)


TEXTS = ["say ALPHA-beta gamma, Delta end " + "pad " * 200, "alpha beta gamma", " ".join(f"Q{i}" for i in range(3, 18)), "É é x9 y",
         "é É x9 y é É x9 y", " ".join(f"q{i}" for i in range(12)), None, "", "alpha beta gamma delta"]


def test_report_equals_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[0]), (0, TEXTS[0]), (0, TEXTS[2])]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_hit int, item string")
    bench = spark.createDataFrame([(i, t, "c") for i, t in BENCH], "item_id long, text string, w string")
    want = sorted(((i if i is not None else -1), *brute_report(t, BENCH)) for i, t in rows)
    for block in (100_000, 3):
        got = decontaminate.report(docs, bench, block=block)
        assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
        assert sorted(((r[0] if r[0] is not None else -1), *r[1:]) for r in got.collect()) == want
    assert decontaminate.report(docs.limit(0), bench).count() == 0
    assert {r.n_hit for r in decontaminate.report(docs, bench.limit(0)).collect()} == {0}


def test_contaminated_documents_and_spans_go(spark):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_hit int, digest string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, t in enumerate(TEXTS) if not brute_report(t, BENCH)[4]]
    cut = {r.doc_id: r.text for r in decontaminate.cut_spans(docs, bench).collect()}
    assert cut[0] == "say end " + "pad " * 200 and cut[1] == TEXTS[1] and cut[6] is None
    assert cut[8] == "" and cut[7] == ""


def test_no_python_in_decontamination(spark, capsys):
    decontaminate.report(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan


# ---- mixing

def fill(sizes, share=1.5, cap=2):
    """Repeated sharing, step by step."""
    names = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[n] for n in open_)
        above = {n for n in open_ if cap * sizes[n] < left * weight[n] / total}
        if not above:
            return out | {n: left * weight[n] / total for n in open_}
        for n in above:
            out[n] = float(cap * sizes[n])
        left -= sum(out[n] for n in above)
        open_ -= above
    return out


def test_mix_meets_its_targets(spark):
    rows = [(i, "w " * (i % 37 + 1), "en", ["b", "a", None, "Ü", "z"][min(i % 11, 4)], 0) for i in range(400)] + ODD
    docs = docs_of(spark, rows).withColumnRenamed("n_chars", "size").withColumnRenamed("lang", "part")
    plan = mixing.plan_mix(docs).collect()
    assert len(plan) == len(rows)
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len((t or "").split())
    want = fill(sizes)
    taken = Counter()
    for r in plan:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.51 for s in sizes)
    again = mixing.plan_mix(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, plan))
    assert mixing.plan_mix(docs.limit(0)).count() == 0
    assert [r.taken for r in mixing.plan_mix(docs_of(spark, ODD[:2])).collect()] == [0, 0]


def test_mixture_repeats_documents(spark):
    docs = docs_of(spark, [(1, "a b c d", "en", "x", 0), (2, "e f", "en", "x", 0), (3, "g", "en", "y", 0)])
    plan = mixing.plan_mix(docs)
    reads = mixing.mixture(docs, plan).collect()
    want = {r.doc_id: r.taken for r in plan.collect() if r.taken}
    got = Counter()
    for r in reads:
        got[r.doc_id] += r.words
    assert dict(got) == want


# ---- licenses

def test_scan_finds_whole_texts(spark):
    mit = known_licenses.TEXTS[0][1]
    spelled = mit.replace("sublicense", "sub-license").replace('"', "'").upper()
    rows = [(1, "Copyright (c) 2020 Somebody\n\n" + mit), (2, spelled), (3, mit[:-40]), (4, None), (5, ""), (None, "some text\nReleased under the MIT Licence!\nmore"),
            (6, "intro\n\nLicensed under CC BY-NC 4.0.\nlicensed under cc by 4.0"), (6, "no licence here"), (7, "Licensed")]
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, license string, own int")
    got = sorted((str(r.doc_id), r.licenses, r.n_licenses) for r in licenses.scan(docs).collect())
    assert got == sorted([("1", "MIT", 1), ("2", "MIT", 1), ("3", "", 0), ("4", "", 0), ("5", "", 0), ("None", "MIT", 1),
                          ("6", "CC-BY-4.0,CC-BY-NC-4.0", 2), ("6", "", 0), ("7", "", 0)])
    assert licenses.scan(docs.limit(0)).count() == 0


def test_units_of_a_text_normalised_once_equal_their_own_canonical_forms(spark, monkeypatch):
    """The digest of every paragraph and line that is cut from the normalised text is that of the unit by itself, without normalising it again."""
    parts = ["\n", "\n\n", "\r\n", "\n \t\r\n", "\x0b", "\n\x0b\n", " ", "-", "\r", "\u0085", "\n\n\n", "\x0c", "“", "•", "\xa0", "(c) 2020 x", "copyright\x0b2020",
             "Copyright 2021 Y", "\n© <year> z\r\n", "licence licence", "sub\nlicense", "sub licence", "v2.0", "v3 v3", "ΑΣ", "İ", "\n---\n", "\n.\n", "a", "MIT", "Released under the"]
    rng = random.Random(3)
    texts = ["".join(rng.choices(parts, k=rng.choice([1, 4, 12]))) for _ in range(400)] + [None, "", "\n\n", "“”‘’–—•©\xa0 x"]
    docs = docs_of(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)])
    units = sorted({u for t in texts if t is not None for u in [t, *re.split(r"\n[ \t\r]*\n", t), *t.split("\n")]})
    forms = docs_of(spark, [(0, u, "", "", 0) for u in units]).select("text", licenses.canonical(F.col("text")).alias("form"))
    digests = forms.select(F.md5("form").alias("digest"), F.col("form").alias("license")).distinct().localCheckpoint()
    want = {r.text: r.form for r in forms.collect()}
    monkeypatch.setattr(licenses, "known", lambda spark: digests)
    monkeypatch.setattr(licenses, "canonical", lambda text: pytest.fail("a unit is normalised by itself"))
    got = {(r.doc_id, r.unit, r.license) for r in licenses.matches(docs).collect()}
    assert got == {(i, u, want[u]) for i, t in enumerate(texts) if t is not None
                   for u in [t, *re.split(r"\n[ \t\r]*\n", t), *t.split("\n")]}


# ---- SQL

@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = comparable(queries.queries()[name](spark, SF).toPandas()), comparable(con.execute(queries.oracle_sql()[name]).fetchdf())
    assert list(got.columns) == list(want.columns) and len(got) == len(want) > 0
    for c in got:
        assert got[c].dtype == want[c].dtype and got[c].astype(str).tolist() == want[c].astype(str).tolist(), c


def test_blocks_stay_small_when_all_items_share_a_window(spark):
    template = " ".join(f"word{i}" for i in range(13))
    bench = spark.createDataFrame([(f"i{k}", template) for k in range(400)], "item_id string, text string")
    grams, blocks = decontaminate.in_blocks(decontaminate.windows(bench), 100)
    sizes = [r["count"] for r in grams.groupBy("block").count().collect()]
    assert blocks == 4 == len(sizes) and max(sizes) < 150
    docs = spark.createDataFrame([(1, f"before {template} after"), (2, "nothing here")], "doc_id long, text string")
    few, all_at_once = (sorted(map(str, decontaminate.report(docs, bench, block=b).collect())) for b in (100, 100_000))
    assert few == all_at_once and "n_items=400" in few[0]
