"""HTML extraction, the classifiers and the language model: definitions, gradients, held-out accuracy, odd rows."""

import html
import re

import numpy as np
import pytest

from nearspan.llm import html_lstm, masked_lm, quality_fm, toxicity
from nearspan.llm.html_blocks import blocks_of

PAGE = ('<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{a:b}</style></head><body><nav><ul><li><a href="/a">Home</a></li>'
        '<li><a href=/b>News</a></ul></nav><div class="ad">Buy this now.</div><article><h1>Big  &eacute;vent</h1><p>First <b>bold</b>\n text'
        '<br>goes on<p>Second &lt;one&gt; here, with <a href="x>y">a link</a> inside.<script>var t="</p>";</script></p></article>'
        '<footer>&copy; example.com</footer></body></html>')


# ---- pages

def test_blocks_of_a_page():
    assert [b.text for b in blocks_of(PAGE)] == ["Home", "News", "Buy this now.", "Big évent", "First bold text goes on",
                                                 "Second <one> here, with a link inside.", "© example.com"]
    assert blocks_of(None) == [] and blocks_of("") == [] and blocks_of("<!-- open") == []
    assert [b.text for b in blocks_of("a < b<p>c</p><p class='q'>d<unclosed")] == ["a < b", "c", "d"]
    assert [b.text for b in blocks_of("<table><tr><td>a<td>b<tr><td>c</table>x&am")] == ["a", "b", "c", "x&am"]
    deep = "<div>" * 5000 + "<p>end" + "</div>" * 10
    assert [b.text for b in blocks_of(deep)] == ["end"]


def test_an_end_tag_closes_its_element_below_many_open_ones():
    for inside in ("<span class='q'>" * 200, "<div class='q'>" * 200, "<h2>" * 200):
        first, after = blocks_of(f"<nav class='menu'>{inside}x</nav><article>y</article>")
        assert (first.text, after.text) == ("x", "y") and "t:nav" in first.path
        assert after.path == ("t:article",)
    # a start tag closes nothing beyond a fence
    a, b = blocks_of("<ul><li>a<table><tr><td>b<li>c</table></ul>")[:2]
    assert "t:li" in b.path and "t:table" in b.path
    assert blocks_of("<p>a</section></p>b")[1].path == ()


@pytest.fixture(scope="module")
def labeller():
    return html_lstm.train()


def test_labels_of_unseen_pages(labeller):
    pages = html_lstm.sample_pages(150, 4242)
    got = labeller.label([p for p, _ in pages])
    right = np.concatenate([g == y for g, (_, y) in zip(got, pages, strict=True)])
    assert right.mean() > 0.985


def test_gradient():
    s = html_lstm.Settings(hidden=3, paths=16, words=16, path_width=3, word_width=2)
    model, rng = html_lstm.Labeller(s), np.random.default_rng(1)
    for p in model.parameters():
        p += rng.normal(0, 0.2, p.shape).astype(np.float32)
    blocks = [([1, 2], [3], [0.1] * 6), ([], [4, 4], [0.5] * 6), ([7], [], [0.2] * 6), ([1], [1], [0.9] * 6), ([2], [5], [0.3] * 6)]
    sizes, y = np.array([3, 2]), np.array([1, 0, 1, 0, 1], np.float32)
    _, grads = model.loss(blocks, sizes, y)
    for p, g in zip(model.parameters(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep = p[at]
        up, down = [], []
        for step, out in ((1e-2, up), (-1e-2, down)):
            p[at] = keep + step
            out.append(model.loss(blocks, sizes, y)[0])
        p[at] = keep
        assert (up[0] - down[0]) / 2e-2 == pytest.approx(float(g[at]), rel=0.05, abs=1e-3)


def test_extract(spark, labeller):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<nav><a href=1>only menu</a></nav>")]
    pages = spark.createDataFrame([(*r, "x", 7) for r in rows], "page_id long, url string, html string, text string, n_blocks int")
    got = html_lstm.extract(pages, labeller).collect()
    want = "Big évent\nFirst bold text goes on\nSecond <one> here, with a link inside."
    assert sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in got) == sorted(
        [(1, "u", want, len(want)), (1, "u", want, len(want)), (2, "", "", 0), (0, "v", "", 0), (3, "w", "", 0)])
    assert html_lstm.extract(pages.limit(0), labeller).count() == 0


def test_extract_equals_article_of_given_pages(spark, labeller):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = r.html[r.html.index("<article>"):r.html.index("</article>")]
        parts = [html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))) for x in re.split(r"</?(?:p|h1|article)>", inner)]
        want[r.page_id] = "\n".join(y for x in parts if (y := re.sub(r"[\x20\x09-\x0d]+", " ", x).strip(" ")))
    got = {r.page_id: r.text for r in html_lstm.extract(pages, labeller).collect()}
    assert got == want


# ---- classifiers

def corpus(n, seed=0):
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.integers(300)}" for _ in range(int(rng.integers(20, 60)))]
        good, toxic = rng.random() < 0.7, rng.random() < 0.3
        if toxic:
            for at in rng.integers(0, len(words), 3):
                words[at] = str(rng.choice(["idiot", "zorgfoo", "zorgbar", "zorgbaz", "scum"]))
        text = " ".join(words if good else [w.upper() + "!!" for w in words])
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


ODD = [(5001, None, None, None, None), (5002, "", "", "", 0), (5003, "word " * 30_000, "en", "s", None), (None, "some text", "en", "s", 9),
       (5004, "some text", "en", "s", 9), (5004, "some text", "en", "s", 9)]


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus(900)
    docs = spark.createDataFrame(rows + ODD, "doc_id long, text string, score string, y string, n_chars long")
    marks = spark.createDataFrame(labels + [(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    return docs, marks, {d: (q, t) for d, q, t in labels}


@pytest.mark.parametrize("op, column, threshold", [(quality_fm, 0, 0.3), (toxicity, 1, 0.5)])
def test_classifier(spark, tables, op, column, threshold):
    docs, marks, truth = tables
    model = op.train(docs, marks)
    got = op.score(docs, model).collect()
    assert len(got) == 900 + len(ODD)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 100
    assert np.mean([r.predicted == truth[r.doc_id][column] for r in held]) > 0.93
    twice = [r.score for r in got if r.doc_id == 5004]
    assert len(twice) == 2 and twice[0] == twice[1]
    again = {r.doc_id: r.score for r in op.score(docs, op.train(docs.repartition(2), marks)).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in got)
    blind = op.train(docs, marks.limit(0))
    assert op.score(docs, blind).count() == len(got) and op.score(docs.limit(0), model).count() == 0


def test_held_out_labels_are_never_learnt(spark, tables):
    from pyspark.sql import functions as F

    from nearspan.llm.features import held_out
    docs, marks, _ = tables
    flipped = marks.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality_fm.train(docs, marks), quality_fm.train(docs, flipped)
    assert (a.w == b.w).all() and (a.v == b.v).all()


def test_pairs_in_linear_time():
    rng = np.random.default_rng(3)
    m = quality_fm.Machine(0.3, rng.normal(size=20), rng.normal(size=(20, 4)), 10)
    at, x = np.array([1, 5, 7, 2]), np.array([0.5, 1.0, 2.0, -1.0])
    want = 0.3 + (m.w[at] * x).sum() + sum(m.v[at[i]] @ m.v[at[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert m.margins(at, x, np.array([4]))[0] == pytest.approx(want)


def test_label_model_discounts_copies():
    rng = np.random.default_rng(5)
    y = rng.random(4000) < 0.2
    good = [np.where(y, rng.random(4000) < 0.7, rng.random(4000) < 0.02) for _ in range(4)]
    noise = rng.random(4000) < 0.1
    votes = np.stack([*good, noise, noise, noise], axis=1).astype(int)
    model = toxicity.label_model(votes, 0.2)
    assert model.weights[4:].max() < 0.5 < model.weights[:4].min()
    assert np.abs(model.rates[1][:4] - 0.7).max() < 0.1
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.93


# ---- language model

def test_language_model(spark):
    rng = np.random.default_rng(8)
    def sentence(n):
        out = []
        while len(out) < n:
            k = int(rng.integers(30))
            out += [f"a{k}", f"b{k}", f"c{k}"]
        return out[:n]
    rows = [(i, " ".join(sentence(int(rng.integers(50, 400))))) for i in range(400)]
    mixed = [(1000 + i, " ".join(rng.permutation(t.split()))) for i, t in rows[:100]]
    odd = [(2000, None), (2001, " \n"), (None, "a1 b1 c1"), (2002, "A1 B1 c1"), (2002, "A1 B1 c1"), (2003, "a1 b1 c1 " * 9000)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows + odd], "doc_id long, text string, n_tokens int").repartition(4)
    s = masked_lm.Settings(stride=3, rounds=3)
    vocab, net = masked_lm.train(docs, s)
    got = masked_lm.score(docs, vocab, net, s).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    assert by[2000].log_likelihood == 0 == by[2001].n_tokens and by[2000].mean_log_likelihood is None
    assert all(r.n_tokens == len((t or "").split()) for (i, t) in rows + odd if i is not None and (r := by[i]))
    other = {r.doc_id: r.mean_log_likelihood for r in masked_lm.score(spark.createDataFrame(mixed, "doc_id long, text string"), vocab, net, s).collect()}
    assert np.mean([by[i - 1000].mean_log_likelihood > m for i, m in other.items()]) > 0.97
    # the definition, token by token
    words = [w.lower().encode() for w in rows[0][1].split()]
    tokens, total = vocab.tokens(words), 0.0
    for i in range(len(tokens)):
        sides = [tokens[j] if 0 <= j < len(tokens) else 0 for j in (i - 2, i - 1, i + 1, i + 2)]
        h = np.tanh(net.c + sum(net.e[k][t] for k, t in enumerate(sides)))
        group, member = divmod(int(vocab.class_table()[tokens[i]]), s.group)
        for z, taken in ((h @ net.u + net.b, group), (h @ net.inner_u[group] + net.inner_b[group], member)):
            total += float(z[taken] - np.log(np.exp(z.astype(float)).sum()))
    assert by[0].log_likelihood == pytest.approx(total, rel=1e-4)
    empty = masked_lm.train(docs.limit(0), s)
    assert masked_lm.score(docs, *empty, s).count() == len(got)


def test_words_count_inside_their_class(spark):
    """Unseen and rarer words lower the score, whether counts are broadcast or joined."""
    rng = np.random.default_rng(4)
    rank = np.minimum(rng.zipf(1.2, 40_000), 3000)
    rows = [(i, " ".join(f"v{k}" for k in rank[100 * i:100 * i + 100])) for i in range(400)]
    docs = spark.createDataFrame([*rows, (None, rows[0][1])], "doc_id long, text string").repartition(3)
    every = masked_lm.Settings(words=60, hashed=31, classes=48, own_classes=32)
    for s in (every, masked_lm.Settings(words=60, hashed=31, classes=48, own_classes=32, held=100)):
        vocab, net = masked_lm.train(docs, s)
        assert (vocab.rare is None) == (s is every)
        by = {r.doc_id: r.log_likelihood for r in masked_lm.score(docs, vocab, net, s).collect()}
        counts = {}
        for w in " ".join(t for _, t in [*rows, rows[0]]).split():
            counts[w.encode()] = counts.get(w.encode(), 0) + 1
        totals = np.zeros(s.classes)
        table = vocab.class_table()
        for w, n in counts.items():
            totals[table[vocab.tokens([w])[0]]] += n
        assert (totals == vocab.totals).all()

        def definition(text):
            words = [w.encode() for w in text.split()]
            tokens = vocab.tokens(words)
            total = float(net.log_probabilities(masked_lm.windows(tokens, np.arange(len(tokens)), s), table[tokens]).sum(dtype=float))
            for w, c in zip(words, table[tokens]):
                if c >= s.own_classes:
                    total += np.log(counts[w] / (totals[c] + 1)) if w in counts else -np.log(totals[c] + 1) - (len(w) + 1) * np.log(257)
            return total

        assert by[None] == pytest.approx(by[0], rel=1e-9)
        for i, text in rows[:20]:
            assert by[i] == pytest.approx(definition(text), rel=1e-4)
        # every rare word by an unseen one of the same input token
        swapped, unseen = [], {}
        for k in range(4000):
            unseen.setdefault(int(vocab.tokens([b"q%d" % k])[0]), f"q{k}")
        for i, text in rows[:20]:
            words = text.split()
            tokens = vocab.tokens([w.encode() for w in words])
            swapped.append((i, " ".join(unseen[int(t)] if t > s.words else w for w, t in zip(words, tokens, strict=True))))
        other = masked_lm.score(spark.createDataFrame(swapped, "doc_id long, text string"), vocab, net, s).collect()
        assert all(r.log_likelihood < by[r.doc_id] for r in other)
        for r in other:
            assert r.log_likelihood == pytest.approx(definition(dict(swapped)[r.doc_id]), rel=1e-4)


def test_registered_training_takes_every_window(spark):
    s = masked_lm.Settings()
    for n in (1, 2, 3, 50, 501):
        taken = np.concatenate([masked_lm.places(b"text %d" % n, n, turn, s) for turn in range(s.rounds)])
        assert set(taken.tolist()) == set(range(n))
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(f"{x}{k}" for k in rng.integers(30, size=40) for x in "abc")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    vocab, net = masked_lm.train(docs)
    mixed = [(i, " ".join(rng.permutation(t.split()))) for i, t in rows]
    a, b = ({r.doc_id: r.log_likelihood for r in masked_lm.score(spark.createDataFrame(x, "doc_id long, text string"), vocab, net).collect()}
            for x in (rows, mixed))
    assert np.mean([a[i] > b[i] for i in a]) > 0.97


def test_class_probabilities_sum_to_one():
    s = masked_lm.Settings()
    rng = np.random.default_rng(2)
    net = masked_lm.Network(s, np.log(rng.dirichlet(np.ones(s.classes))))
    sides = np.repeat(rng.integers(net.width, size=(7, 2 * s.reach)), s.classes, axis=0)
    got = net.log_probabilities(sides, np.tile(np.arange(s.classes), 7)).reshape(7, s.classes)
    assert np.exp(got.astype(float)).sum(axis=1) == pytest.approx(np.ones(7), rel=1e-4)
    with pytest.raises(ValueError):
        masked_lm.Settings(classes=250)


def test_training_step_follows_the_gradient():
    """The change of every parameter has the sign of the numeric gradient of the mean log-likelihood."""
    s = masked_lm.Settings(words=20, hashed=5, classes=32, own_classes=16, hidden=4, rate=1e-3)
    rng = np.random.default_rng(3)
    sides, y = rng.integers(1, 26, size=(300, 4)), rng.integers(32, size=300)
    net = masked_lm.Network(s)
    before, sums = net.flat().astype(float), [np.full_like(p, 1e-12) for p in net.parameters()]
    numeric = np.zeros(len(before))
    for i in range(len(before)):
        for sign in (1, -1):
            moved = before.copy()
            moved[i] += sign * 1e-2
            numeric[i] += sign * masked_lm.Network(s).load(moved.astype(np.float32)).log_probabilities(sides, y).mean(dtype=float) / 2e-2
    net.step(sides, y, sums)
    change = net.flat() - before
    clear = np.abs(numeric) > 1e-4
    assert clear.sum() > len(before) / 2 and (np.sign(change[clear]) == np.sign(numeric[clear])).all()
    # an unused row of the embedding stays
    assert (change.reshape(-1)[:s.hidden] == 0).all()


def test_scores_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{k}" for k in np.minimum(rng.zipf(1.4, 80), 500))) for i in range(200)]
    long = "x" * 4000
    rows += [(None, rows[0][1])] * 30 + [(500, f"{long} w1 {long}"), (501, None), (502, "")]
    s = masked_lm.Settings(shard=3000, held=100)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one, many = (sorted(((r.doc_id is None, r.doc_id), r.n_tokens, r.log_likelihood) for r in masked_lm.train_and_score(d, s).collect())
                 for d in (docs.coalesce(1), docs.repartition(7)))
    assert [x[:2] for x in one] == [x[:2] for x in many]
    assert [x[2] for x in one] == pytest.approx([x[2] for x in many], rel=1e-5)
    assert len({round(x[2], 6) for x in one if x[0][0] or x[0][1] == 0}) == 1


def test_held_words_become_tokens_by_one_lookup(spark, monkeypatch):
    """Words whose counts are broadcast have their tokens worked out once a task, not once an occurrence."""
    s = masked_lm.Settings(words=3, hashed=31, classes=16, own_classes=2, group=4, held=6)
    texts = ["a b c d e f " * 20 + f"rare{i} x" for i in range(10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    vocab, _ = masked_lm.vocabulary(docs, s)
    assert len(vocab.counts) == 6 and vocab.rare is not None
    batch, asked, runs, whole = docs.toArrow().combine_chunks().to_batches()[0], [], [], masked_lm.Vocabulary.tokens
    monkeypatch.setattr(masked_lm.Vocabulary, "tokens", lambda self, words: asked.append(len(words)) or whole(self, words))
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: runs.append(run) or self)
    masked_lm.encode(docs, vocab, s)
    got = [r for b in runs[0]([batch]) for r in b.to_pylist()]
    assert len(got) == 10 and sum(asked) <= 6 + 10 * 2
    table = vocab.class_table()
    for r, text in zip(got, texts, strict=True):
        words = masked_lm.words_of(text.encode())
        want = whole(vocab, words)
        classes = table[want].tolist()
        assert (np.frombuffer(r["tokens"], np.uint16) == want).all()
        assert r["inside"] == sum(vocab.share(w, vocab.counts[w], c) for w, c in zip(words, classes) if w in vocab.counts)
        others = [w for w, c in zip(words, classes) if w not in vocab.counts and c >= s.own_classes]
        assert [(x["word"], x["times"]) for x in r["rare"]] == [(w, 1) for w in others]


def test_words_of_many_texts_are_taken_at_once(spark, monkeypatch):
    """Neither counting nor encoding makes an object of every word; blocks with a word of more than LONG bytes do, for its digest."""
    texts = ["", "A b\x00c\td\n", None, " x\x0b\x0cé  É\x1f\u00a0 ", "b " * 50, "\r", "w" * masked_lm.LONG + " a", "Zz"]
    raws = [(t or "").encode() for t in texts]
    long = [*raws, b"q " + b"L" * (masked_lm.LONG + 1), b"r"]
    for some in (raws, long, [], [b""]):
        words, sizes = masked_lm.words_of_all(some)
        want = [masked_lm.words_of(r) for r in some]
        assert words.to_pylist() == [w for x in want for w in x] and sizes.tolist() == [len(x) for x in want]
    s = masked_lm.Settings(words=3, hashed=31, classes=16, own_classes=2, group=4, held=4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    vocab, _ = masked_lm.vocabulary(docs, s)
    batch, runs, plain = docs.toArrow().combine_chunks().to_batches()[0], [], masked_lm.words_of
    for name in ("words_of", "BLOCK"):
        monkeypatch.setattr(masked_lm, name, {"words_of": lambda raw: pytest.fail("a text word by word"), "BLOCK": 60}[name])
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: runs.append(run) or self)
    masked_lm.encode(docs, vocab, s)
    got = [r for b in runs[0]([batch]) for r in b.to_pylist()]
    assert [r["doc_id"] for r in got] == list(range(len(texts)))
    for r, raw in zip(got, raws, strict=True):
        words = plain(raw)
        classes = vocab.class_table()[vocab.tokens(words)].tolist()
        assert np.frombuffer(r["tokens"], np.uint16).tolist() == vocab.tokens(words).tolist()
        assert r["inside"] == sum(vocab.share(w, vocab.counts[w], c) for w, c in zip(words, classes) if w in vocab.counts)
        rare = [w for w, c in zip(words, classes) if w not in vocab.counts and c >= s.own_classes]
        assert [(x["word"], x["times"]) for x in r["rare"]] == [(w, rare.count(w)) for w in dict.fromkeys(rare)]
