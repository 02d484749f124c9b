"""Language identification, source divergence and phrase mining: brute force, small settings, odd rows."""

import dataclasses
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from conftest import SF

from nearspan.llm import language_centroids, phrase_automata, queries, source_divergence
from nearspan.llm.phrase_automata import Automaton

ODD = "doc_id long, text string, lang string, source string, item string, value long"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def odd_rows():
    """Null columns, copies, empty and long texts, words that differ in case or by one accent, control characters."""
    rng = random.Random(5)
    words = ["Alpha", "alpha", "beta", "été", "Été", "x\x01y", "日本", "gamma-delta", "no1", "of", "the"]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 1, 5, 60]))) + rng.choice(["", ".", "\n", ", the of"]) for _ in range(120)]
    rows = [(i, t, rng.choice(["a", "b", None]), rng.choice(["s", "t", "u", None, ""]), "x", 1) for i, t in enumerate(texts)]
    rows += rows[:5] + [(None, None, None, None, None, None), (500, "", "c", "s", "x", 1), (501, None, "a", "v", "x", 1),
                        (502, "one two", "d", "s", "x", 1), (503, "alpha beta " * 20_000, "a", "s", "x", 1), (504, "z" * 300_000, "b", "t", "x", 1)]
    return rows


@pytest.mark.parametrize("name", ["op12_source_divergence", "op13_phrase_mining"])
def test_query_equals_sql(spark, name):
    want = duckdb.connect().execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'").execute(queries.oracle_sql()[name]).fetchall()
    got = queries.queries()[name](spark, SF)
    assert rows_of(got.select("lang", "rank", *sorted(set(got.columns) - {"lang", "rank"}))) == sorted(
        (tuple(dict(zip(COLUMNS[name], r))[c] for c in ["lang", "rank", *sorted(set(COLUMNS[name]) - {"lang", "rank"})]) for r in want),
        key=lambda r: tuple((x is None, str(x)) for x in r))


COLUMNS = {"op12_source_divergence": ["lang", "source", "part", "item", "value", "rank"],
           "op13_phrase_mining": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]}


# ---- divergence

def brute_divergence(rows, top=200):
    docs = [(t or "", g or "", s or "") for _, t, g, s, *_ in rows]
    n, df = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text)]
        n[lang, source].update(found)
        df[lang].update(set(found))
    out = []
    for lang in {d[1] for d in docs}:
        kept = sorted(t for t, c in df[lang].items() if c >= 3)
        sources = sorted({d[2] for d in docs if d[1] == lang})

        def shares(counts):
            size = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (size + len(kept)) for t in kept}
        p = {s: shares(n[lang, s]) for s in sources}
        q = shares(sum((n[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)]
    return out


@pytest.mark.parametrize("settings", [{}, {"digest_bits": 3, "entries": 20, "top": 3, "broadcast_rows": 0}])
def test_divergence_equals_brute_force(spark, odd_rows, settings):
    docs = spark.createDataFrame(odd_rows, ODD).repartition(3)
    s = dataclasses.replace(source_divergence.Settings(), **settings)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(rows_of(source_divergence.audit(docs, s)), key=key) == sorted(brute_divergence(odd_rows, s.top), key=key)


def test_shares_are_exact(spark):
    some = [(n, size, k) for n in (0, 7, 10**12, 3 * 10**15 - 2) for size in (n, n + 10**9, 4 * 10**15) for k in (1, 999, 10**9) if n <= size]
    df = spark.createDataFrame(some, "n long, size long, k long").withColumn("p", source_divergence.share("n", "size", "k"))
    assert all(r.p == 1 + 10**9 * (r.n + 1) // (r.size + r.k) for r in df.collect())


def test_terms_of_many_texts_are_counted_at_once():
    """Tables take texts in blocks; their count rows hold every term of a group once, and its documents once a language."""
    rng = random.Random(8)
    parts = ["Ab", "ab", "é", "É", "x\x01y", "no1", "日本", "-", "", " ", "@[`{z"]
    rows = [(rng.choice(["a", "b"]), rng.choice(["s", "t", ""]), " ".join(rng.choices(parts, k=rng.choice([0, 1, 9])))) for _ in range(200)]
    for strings in (False, True):
        table = source_divergence._Table(source_divergence.Settings(), strings)
        for low in (0, 70, 140):
            some = rows[low:low + 70]
            table.add([r[:2] for r in some], [r[2].encode() for r in some])
        got = [r for b in table.batches() for r in b.to_pylist()]
        n, df, digest = Counter(), Counter(), lambda t: source_divergence._digest(t.encode(), 64)
        for lang, source, text in rows:
            found = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text)]
            n.update((lang, source, digest(w)) for w in found)
            df.update((lang, w) for w in set(found))
        assert len(got) == len(n) and {(r["lang"], r["source"], r["digest"]): r["n"] for r in got} == n
        first = [r for r in got if r["df"] is not None]
        assert len(first) == len(df) and {(r["lang"], r["term"]): r["df"] for r in first} == df
        assert all((r["term"] is not None) == (strings or r["df"] is not None) for r in got)
        assert list(table.batches()) == [] and not table.full


def test_divergence_of_nothing(spark, odd_rows):
    assert source_divergence.audit(spark.createDataFrame(odd_rows[:1], ODD).limit(0)).count() == 0


# ---- phrases

def brute_phrases(rows, s):
    counts, sizes = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^ \t]+", piece)
            sizes[lang] += len(w)
            for m in range(1, 5):
                counts[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        found, long = [], {p: n for p, n in f.items() if len(p) > 1 and n >= s.min_count}
        inside = defaultdict(int)
        for p, n in long.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i:i + m]] = max(inside[p[i:i + m]], n)
        for p, a in long.items():
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if not 100 * inside[p] >= 80 * a:
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(found)[:s.top]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, sizes[lang], -score))
    return out


@pytest.mark.parametrize("settings", [{"min_count": 5}, {"min_count": 3, "block_bytes": 40, "range_bytes": 200, "sample_bytes": 5000,
                                                         "bucket_rows": 3, "top": 20}])
def test_phrases_equal_brute_force(spark, odd_rows, settings):
    rows = [r if r[0] != 503 else (503, "alpha beta " * 300, *r[2:]) for r in odd_rows]
    docs = spark.createDataFrame(rows, ODD).repartition(3)
    s = dataclasses.replace(phrase_automata.Settings(), **settings)
    assert sorted(rows_of(phrase_automata.mine(docs, s))) == sorted(brute_phrases(rows, s))
    assert phrase_automata.mine(docs.limit(0), s).count() == 0


def test_one_phrase_start_is_spread_over_ranges(spark):
    """A word pair in every document is cut into several ranges and still counted once."""
    rng = random.Random(1)
    rows = [(i, " ".join(f"of the w{rng.randrange(50)} v{rng.randrange(50)}" for _ in range(40)), "a", "s", "x", 1) for i in range(60)]
    s = dataclasses.replace(phrase_automata.Settings(), range_bytes=1500, sample_bytes=1 << 20, block_bytes=3000)
    docs = spark.createDataFrame(rows, ODD)
    cuts = phrase_automata.find_cuts(phrase_automata._prepared(docs), s)["a"]
    assert sum(c[:2] == (b"of", b"the") for c in cuts) >= 3
    assert sorted(rows_of(phrase_automata.mine(docs, s))) == sorted(brute_phrases(rows, s))


def automaton(sequences):
    words, rows, weight = phrase_automata.sequences([(b" ".join(q) + b".", 0) for q in sequences], 4)
    return Automaton.build(words, rows, weight)


def counts_of(a):
    return {p: int(n) for names, weight in zip(a.paths(), a.weight) for p, n in zip(names, weight)}


def test_automata():
    rng = random.Random(3)
    texts = [[rng.choice([b"a", b"b", b"c", b"\xc3\xa9"]) for _ in range(rng.randrange(1, 9))] for _ in range(50)]
    want = Counter(b" ".join(t[i:i + m]) for t in texts for m in range(1, 5) for i in range(len(t) - m + 1))
    whole = automaton(texts)
    assert counts_of(whole) == want
    parts = [automaton(texts[i::4]) for i in range(4)]
    assert counts_of(Automaton.union(parts)) == want
    back = Automaton.from_bytes(whole.to_bytes())
    assert counts_of(back) == want and back.words == whole.words
    for d, met in enumerate(parts[0].compose(whole)):
        assert [whole.paths()[d][i] for i in met.tolist()] == parts[0].paths()[d]
    for d, met in enumerate(whole.compose(parts[0])):
        held = set(parts[0].paths()[d])
        assert [i >= 0 for i in met.tolist()] == [p in held for p in whole.paths()[d]]
    assert [len(whole.follow((b"a", b"zz"))), len(whole.follow((b"zz",)))] == [1, 0]


def test_long_texts_are_cut_without_loss():
    rng = random.Random(4)
    for _ in range(30):
        raw = "".join(rng.choice(["a ", "bb ", "c", ".", "  ", "ddddddddddd ", " . "]) for _ in range(200)).encode()
        want = Counter()
        for piece in raw.split(b"."):
            w = piece.split()
            want.update(tuple(w[i:i + 4]) for i in range(len(w)))
        words, rows, weight = phrase_automata.sequences(list(phrase_automata.chunks(raw, 20)), 4)
        assert {tuple(words[i - 1] for i in r if i): int(n) for r, n in zip(rows.tolist(), weight)} == want


# ---- languages

SMALL = dataclasses.replace(language_centroids.Settings(), per_language=100)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_centroids.identify(docs, language_centroids.train(docs, SMALL)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 200 and (got.lang == got.lang_pred).mean() > 0.98
    assert got.rejected.mean() < 0.15


def test_held_out_languages_are_never_learnt(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    from pyspark.sql import functions as F
    spoiled = docs.withColumn("lang", F.when(language_centroids.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    a, b = (language_centroids.train(d, SMALL) for d in (docs, spoiled))
    assert a.owner == b.owner and np.allclose(a.centres, b.centres)


def test_odd_texts(spark):
    learn = [(i, f"the {w} of that was here", "en") for i, w in enumerate(["one", "two", "three", "four"] * 5)]
    learn += [(100 + i, f"der {w} und das war hier", "de") for i, w in enumerate(["eins", "zwei", "drei", "vier"] * 5)]
    odd = [(None, "the", None), (201, None, "en"), (202, "", "de"), (203, "12 34 !?", "en"), (204, "DER UND", None),
           (205, "the of that " * 40_000, None), (205, "the of that " * 40_000, None), (206, "Ωμέγα", None), (207, "a", None)]
    docs = spark.createDataFrame([(*r, 1.0, True) for r in learn + odd], "doc_id long, text string, lang string, score double, rejected boolean")
    model = language_centroids.train(docs.where("doc_id < 200"))
    got = {(r.doc_id, r.lang_pred, 0 <= r.score <= 1, r.rejected) for r in language_centroids.identify(docs, model).where("doc_id IS NULL OR doc_id > 200").collect()}
    assert {g[:3] for g in got if g[0] not in (206, 207)} == {(None, "en", True), (201, "und", True), (202, "und", True), (203, "und", True), (204, "de", True), (205, "en", True)}
    assert {(g[1] in ("de", "en"), g[3]) for g in got if g[0] == 206} == {(True, True)}
    nothing = language_centroids.identify(docs, language_centroids.train(docs.where("lang IS NULL")))
    assert nothing.select("lang_pred", "score").distinct().collect() == [("und", 0.0)]
    assert language_centroids.identify(docs.limit(0), model).count() == 0


def test_pieces_do_not_change_vectors():
    rng = random.Random(2)
    text = "".join(rng.choice("abcé ß,日本 Ω") for _ in range(5000))
    s = language_centroids.Settings()
    assert (language_centroids.counts([text, "x"], dataclasses.replace(s, piece=64)) == language_centroids.counts([text, "x"], s)).all()
