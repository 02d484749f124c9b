"""Near-duplicates by order MinHash, verified by banded alignment.

A text is the sequence of its five-word shingles, each labelled with its occurrence number, so that all labels of
a text differ. For each of ``repeats`` hash functions the ``picks`` smallest labels are taken and kept *in text
order*; the tuple is one sketch. Two texts share a sketch only if the same labels are smallest and stand in the
same order: that is sensitive to edit similarity. With 3 picks and 16 repeats two texts of similarity 0.8 share
none with a chance below 1e-4 (0.8^3 per repeat).

Candidates are verified: labels common to both are aligned in order inside a band, similarity = aligned /
(labels of either text), link from ``threshold`` on. The band is as wide as the threshold allows, so no alignment
that would pass is cut. A class is a connected component of the links.

Copies count once: everything runs on distinct texts. Texts that share a sketch are not compared all with all.
First every text meets the hub of each of its sketches: the text that most texts share sketches with (the middle of a
group of near copies). Only sketches that hold two components after that are looked at again. At one of up to ``few``
texts all of them meet. At a crowded one texts are compared by their differences to the hub H: D(A) holds the labels of
either A or H, but not of both. |A| labels and |B| labels pass only if the texts differ in at most c (|A| + |B|) labels,
c = (1 - threshold) / (1 + threshold), and they differ in |D(A)| + |D(B)| - 2 |D(A) & D(B)|. With w(A) = |D(A)| - c |A|
a pair that passes has (w(A) + w(B)) / 2 labels or more in D(A) & D(B). No text has w below -c |H|, and a text that has
too few labels in common with H has w above c |H|: so a pair with one such text has a common *difference*, and what all
texts share with the hub, a template, never brings two of them together. Of the differences, rare ones first, a prefix
is enough, and a place in it bounds what can follow. Every pair of different components that meets is verified.

A text with enough labels in common with H, but in another order, is in another component too. Such texts, and those
near H that they meet, are decided by a prefix join over all their labels: two texts of similarity ``threshold`` have a
label in common among the first of either, rare ones first. So no pair that passes is left, except those without a
common sketch. Work of the first two steps is linear in the sketches. That of the others is not bounded by it: texts that
share the same edit meet, and so do reordered copies of one text.

Defined cases: words are runs of anything but ASCII white space, compared as they are; a text of fewer than five
words is one shingle; null texts and texts without words are alone in their class. The class id is the smallest
doc_id of the class that is not null (null if there is none). Repeated rows are copies. Only doc_id and text are
used; :func:`drop_near` keeps all columns.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearspan.llm.components import components
from nearspan.session import attach, bound_batches, cut_lineage


@dataclass(frozen=True)
class Settings:
    width: int = 5
    picks: int = 3
    repeats: int = 16
    threshold: float = 0.8
    few: int = 4
    hot: int = 1_000
    broadcast_rows: int = 100_000
    count_slots: int = 1 << 20


FOLD, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * SPREAD
    return x ^ (x >> np.uint64(29))


def labels_of(raw: bytes, width: int = 5, known: dict | None = None) -> np.ndarray:
    """Occurrence-labelled shingles of a text, in order; all differ (up to 64-bit collisions)."""
    words = raw.split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    known = {} if known is None else known
    known.update({w: xxhash.xxh64_intdigest(w) for w in set(words).difference(known)})
    ids = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    k = min(width, n)
    with np.errstate(over="ignore"):
        h = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            h = h * FOLD + ids[i:n - k + 1 + i]
        h = _mix(h + np.uint64(k))
        order = np.argsort(h, kind="stable")
        ranked = h[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        if not new.all():
            starts = np.flatnonzero(new)
            nth = np.arange(len(h)) - starts[np.cumsum(new) - 1]
            h[order] = np.where(nth > 0, _mix(ranked + nth.astype(np.uint64) * FOLD), ranked)
    return h


def _draws(repeats: int) -> np.ndarray:
    return np.random.default_rng(20_240).integers(1, 1 << 63, (repeats, 2), dtype=np.uint64)


def sketches(labels: np.ndarray, s: Settings = Settings(), draws: np.ndarray | None = None) -> np.ndarray:
    """One 64-bit key per repeat."""
    draws = _draws(s.repeats) if draws is None else draws
    take, together = min(s.picks, len(labels)), max(1, 2_000_000 // len(labels))
    out = np.empty(s.repeats, np.uint64)
    with np.errstate(over="ignore"):
        for low in range(0, s.repeats, together):
            some = draws[low:low + together]
            g = (labels ^ some[:, :1]) * (some[:, 1:] | np.uint64(1))
            g ^= g >> np.uint64(32)
            at = np.sort(np.argpartition(g, take - 1, axis=1)[:, :take], axis=1)
            key = some[:, 0]
            for i in range(take):
                key = _mix(key * FOLD + labels[at[:, i]])
            out[low:low + together] = key
    return out


def aligned(a: np.ndarray, b: np.ndarray, threshold: float) -> int:
    """Length of the longest in-order chain of common labels inside the band."""
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(ia) < threshold * (len(a) + len(b) - len(ia)):
        return len(ia)  # even in any order too few
    band = int(np.ceil((1 - threshold) / (1 + threshold) * (len(a) + len(b)))) + 1
    order = np.argsort(ia)
    ia, ib = ia[order], ib[order]
    chain = ib[np.abs(ia - ib) <= band]
    if len(chain) < 2 or (np.diff(chain) > 0).all():
        return len(chain)
    tails: list[int] = []
    for v in chain.tolist():
        at = bisect_left(tails, v)
        tails[at:at + 1] = [v]
    return len(tails)


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = 0.8) -> float:
    """aligned / (labels of either). Exact from the threshold on, an upper bound below it."""
    if not len(a) or not len(b):
        return 0.0
    m = aligned(a, b, threshold)
    return m / (len(a) + len(b) - m)


def digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _sketch_table(docs: DataFrame, s: Settings) -> DataFrame:
    """(digest, n, key): the sketches of distinct texts with words; copies inside a batch are skipped at once."""
    given = docs.select(digest(F.col("text")).alias("digest"), "text")

    def run(batches):
        known, draws = {}, _draws(s.repeats)
        for b in batches:
            seen, digests, sizes, keys = set(), [], [], []
            raws = b.column("text").cast(pa.large_binary())
            for d, i in zip(b.column("digest").to_pylist(), range(b.num_rows), strict=True):
                if d in seen:
                    continue
                seen.add(d)
                labels = labels_of(raws[i].as_py() or b"", s.width, known)
                if len(labels):
                    digests += [d] * s.repeats
                    sizes += [len(labels)] * s.repeats
                    keys.append(sketches(labels, s, draws))
                if len(known) > 300_000:
                    known.clear()
            keys = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            yield pa.record_batch([pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(keys)],
                                  ["digest", "n", "key"])

    return given.mapInArrow(run, "digest binary, n int, key long").distinct()


def _texts(docs: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """(digest, packed) of the wanted digests, each once."""
    wanted = cut_lineage(wanted, "wanted")
    if wanted.count() <= s.broadcast_rows:  # a few MB; beyond, both sides are shuffled
        wanted = F.broadcast(wanted)

    def pack(batches):
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            raws = b.column("text").cast(pa.large_binary())
            yield pa.record_batch([b.column("digest"), pa.array([z.compress(raws[i].as_py()) for i in range(len(raws))],
                                                                pa.binary())], ["digest", "packed"])

    rows = docs.select(digest(F.col("text")).alias("digest"), "text").dropna().join(wanted, "digest", "left_semi")
    return cut_lineage(rows.mapInArrow(pack, "digest binary, packed binary")
                       .groupBy("digest").agg(F.first("packed").alias("packed")), "texts")


def _met(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b, ...) with the packed texts pa and pb. An end of more than ``hot`` pairs is a hub: its pairs are
    dealt over several keys, and its text is sent to each of them."""
    given = pairs = cut_lineage(pairs, "pairs")
    for end, packed in (("a", "pa"), ("b", "pb")):
        hubs = _bounded(cut_lineage(given.groupBy(end).count().filter(F.col("count") > s.hot)
                        .select(F.col(end).alias("hub"), F.ceil(F.col("count") / s.hot).cast("int").alias("parts")), "hubs"), s)
        sent = texts.join(hubs, texts.digest == hubs.hub, "left").select(
            F.col("digest").alias(end), F.col("packed").alias(packed),
            F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
        other = "b" if end == "a" else "a"
        part = F.coalesce(F.pmod(F.xxhash64(other), F.col("parts")).cast("int"), F.lit(0))
        dealt = pairs.join(hubs, pairs[end] == hubs.hub, "left").withColumn("part", part).drop("hub", "parts")
        pairs = dealt.join(sent, [end, "part"]).drop("part")
    return pairs


def _verify(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """(a, b, similarity) of the pairs that pass."""
    met = _met(pairs, texts, s).select("a", "b", "pa", "pb")

    def run(batches):
        z, known, recent = zstandard.ZstdDecompressor(), {}, {}

        def labels(key: bytes, packed: bytes) -> np.ndarray:
            got = recent.get(key)
            if got is None:
                if len(recent) > 200:
                    recent.clear()
                if len(known) > 300_000:
                    known.clear()
                got = recent[key] = labels_of(z.decompress(packed), s.width, known)
            return got

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            x, y = batch.column("pa"), batch.column("pb")
            sims = np.array([similarity(labels(a[i], x[i].as_py()), labels(b[i], y[i].as_py()), s.threshold)
                             for i in range(len(a))])
            yield pa.record_batch([batch.column("a"), batch.column("b"), pa.array(sims, pa.float64())],
                                  ["a", "b", "similarity"])

    return met.mapInArrow(run, "a binary, b binary, similarity double").filter(F.col("similarity") >= s.threshold)


def _shared(sketch: DataFrame) -> DataFrame:
    """(key, digest, n, weight): the sketches that two or more texts have. The weight of a text, the number of texts at
    its sketches, is largest for the text that its near copies have most in common with."""
    rows = cut_lineage(sketch.join(sketch.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1"), "key"), "shared")
    return cut_lineage(rows.drop("c").join(rows.groupBy("digest").agg(F.sum("c").alias("weight")), "digest"), "weighted")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _hubs(shared: DataFrame) -> DataFrame:
    """(key, hub): the weightiest text of each sketch."""
    return shared.groupBy("key").agg(F.max(F.struct("weight", "digest")).digest.alias("hub"))


def _stars(shared: DataFrame) -> DataFrame:
    """(a, b): every text with the hub of each of its sketches."""
    return _ordered(shared.select("key", F.col("digest").alias("x")).join(_hubs(shared).withColumnRenamed("hub", "y"), "key")
                    .filter("x <> y").select("x", "y"))


def _bounded(df: DataFrame, s: Settings) -> DataFrame:
    """A written table of short rows, to be broadcast if its counted rows allow."""
    return F.broadcast(df) if df.count() <= s.broadcast_rows else df


def _mixed(shared: DataFrame, roots: DataFrame, s: Settings) -> DataFrame:
    """(key, digest, n, root, hub, members) of the sketches that hold more than one component."""
    rows = cut_lineage(shared.join(_bounded(roots, s), shared.digest == roots.node, "left").select(
        "key", "digest", "n", "weight", F.coalesce("root", "digest").alias("root")), "rooted")
    keys = rows.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members"),
        F.max(F.struct("weight", "digest")).digest.alias("hub")).filter("low <> high").drop("low", "high")
    return cut_lineage(rows.drop("weight").join(_bounded(cut_lineage(keys, "mixed"), s), "key"), "mixed")


def _few(mixed: DataFrame, s: Settings) -> DataFrame:
    """(a, b): the texts of different components at a sketch of few texts, without those that met its hub."""
    few = mixed.filter((F.col("members") <= s.few) & (F.col("digest") != F.col("hub"))).select("key", "digest", "n", "root")
    x = few.withColumnsRenamed({"digest": "x", "n": "nx", "root": "rx"})
    y = few.withColumnsRenamed({"digest": "y", "n": "ny", "root": "ry"})
    close = (F.col("nx") >= s.threshold * F.col("ny")) & (F.col("ny") >= s.threshold * F.col("nx"))
    return _ordered(x.join(y, "key").filter((F.col("x") < F.col("y")) & (F.col("rx") != F.col("ry")) & close).select("x", "y"))


def _small(batches, rows: int = 500):
    """The batches in slices, as many arrays of a text's labels are held at once."""
    for b in batches:
        for low in range(0, b.num_rows, rows):
            yield b.slice(low, rows)


def _differences(mixed: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """(hub, digest, root, w, near, diff): the texts of crowded sketches by their difference to the hub. ``near`` tells
    that text and hub have enough labels in common, ``w`` is counted from c |H|."""
    crowded = mixed.filter(F.col("members") > s.few)
    pairs = crowded.select(F.col("digest").alias("a"), F.col("hub").alias("b"), "root").distinct()
    c = (1 - s.threshold) / (1 + s.threshold)

    def run(batches):
        z, known, hubs = zstandard.ZstdDecompressor(), {}, {}
        for batch in _small(batches):
            w, limit, diffs = [], [], []
            for a, hub, b in zip(batch.column("pa"), batch.column("b").to_pylist(), batch.column("pb"), strict=True):
                if len(known) > 300_000:
                    known.clear()
                if hub not in hubs:
                    if len(hubs) > 50:
                        hubs.clear()
                    hubs[hub] = labels_of(z.decompress(b.as_py()), s.width, known)
                x, h = labels_of(z.decompress(a.as_py()), s.width, known), hubs[hub]
                diff = np.setxor1d(x, h, assume_unique=True)
                diffs.append(diff.view(np.int64))
                w.append(len(diff) - c * len(x))
                limit.append(c * len(h))
            w, limit = np.array(w, np.float64), np.array(limit, np.float64)
            yield pa.record_batch(
                [batch.column("b"), batch.column("a"), batch.column("root"), pa.array(w), pa.array(limit), pa.array(w <= limit + 1e-6),
                 pa.array(diffs, pa.list_(pa.int64()))], ["hub", "digest", "root", "w", "limit", "near", "diff"])

    kind = "hub binary, digest binary, root binary, w double, limit double, near boolean, diff array<long>"
    return cut_lineage(_met(pairs, texts, s).select("a", "b", "root", "pa", "pb").mapInArrow(run, kind), "differences")


def first_differences(diff: np.ndarray, w: float, limit: float, counts: np.ndarray) -> tuple[np.ndarray, int, int]:
    """The differences of a text to a hub, rare ones first, and how many of them do: as the text of smaller ``w``, and as
    that of larger ``w`` (0 unless it is above ``limit``, that is, unless the text alone shows that a difference is shared)."""
    n = len(diff)
    ranked = diff[np.lexsort((diff, counts[diff % np.uint64(len(counts))]))]

    def needs(other: float) -> int:
        return max(1, int(np.ceil((w + other) / 2 - 1e-6)))

    return ranked, max(0, n - needs(max(w, limit)) + 1), max(0, n - needs(-limit) + 1) if w > limit + 1e-6 else 0


def _share_differences(rows: DataFrame, s: Settings) -> DataFrame:
    """(a, b): every pair of the texts of one hub that are in different components, of which one is not near the hub, and
    that share a difference where two texts of similarity ``threshold`` must."""
    sent = rows.sparkSession.sparkContext.broadcast(_slots(rows.select("diff"), lambda diff, _: diff.values.to_numpy().view(np.uint64), s))

    def run(batches):
        counts = sent.value
        for b in _small(batches):
            hubs = np.array([xxhash.xxh64_intdigest(x) for x in b.column("hub").to_pylist()], np.uint64)
            ws, limits = b.column("w").to_numpy(), b.column("limit").to_numpy()
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for i, diff in enumerate(b.column("diff")):
                ranked, short, long = first_differences(diff.values.to_numpy().view(np.uint64), ws[i], limits[i], counts)
                most = max(short, long)
                at = np.arange(most)
                with np.errstate(over="ignore"):
                    keys = _mix(ranked[:most] * FOLD + hubs[i])
                for column, x in zip(out, (np.full(most, i), keys.view(np.int64), len(ranked) - at, at < short, at < long), strict=True):
                    column.append(x)
            row, key, left, small, large = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
            for low in range(0, len(row), 50_000):
                cut = slice(low, low + 50_000)
                mine = pa.array(row[cut].astype(np.int64))
                yield pa.record_batch(
                    [pa.array(key[cut].astype(np.int64)), b.column("digest").take(mine), b.column("root").take(mine), b.column("w").take(mine),
                     pa.array(left[cut].astype(np.int32)), pa.array(small[cut].astype(bool)), pa.array(large[cut].astype(bool))],
                    ["key", "digest", "root", "w", "left", "small", "large"])

    kind = "key long, digest binary, root binary, w double, left int, small boolean, large boolean"
    keyed = cut_lineage(rows.mapInArrow(run, kind), "prefixes")
    meet = keyed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.bool_or("small").alias("s"),
                                    F.bool_or("large").alias("l")).filter("low <> high and s and l").select("key")
    keyed = cut_lineage(keyed.join(_bounded(cut_lineage(meet, "meet"), s), "key"), "meeting")
    x = keyed.filter("small").select("key", F.col("digest").alias("x"), F.col("root").alias("rx"), F.col("w").alias("wx"), F.col("left").alias("lx"))
    y = keyed.filter("large").select("key", F.col("digest").alias("y"), F.col("root").alias("ry"), F.col("w").alias("wy"), F.col("left").alias("ly"))
    met = x.join(y, "key").filter((F.col("rx") != F.col("ry")) & (F.col("wx") <= F.col("wy"))
                                  & (F.least("lx", "ly") >= (F.col("wx") + F.col("wy")) / 2 - 1e-6))
    return _ordered(met.select("x", "y"))


def _reordered(rows: DataFrame) -> DataFrame:
    """(digest, root): the texts near a hub that has texts of more than one component near it."""
    near = rows.filter("near")
    hubs = near.groupBy("hub").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("hub")
    return cut_lineage(near.join(hubs, "hub").select("digest", "root").distinct(), "reordered")


SIZE_STEP = 1.05


def size_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(n) / np.log(SIZE_STEP)).astype(np.int32)


def prefix(labels: np.ndarray, counts: np.ndarray, threshold: float) -> tuple[np.ndarray, int]:
    """The labels, rare ones first, of which any text of similarity ``threshold`` has one; and how many of them do for
    texts that are not smaller."""
    n = len(labels)
    ranked = labels[np.lexsort((labels, counts[labels % np.uint64(len(counts))]))]
    longest = n - int(np.ceil(threshold * n - 1e-6)) + 1
    short = n - int(np.ceil(2 * threshold / (1 + threshold) * n - 1e-6)) + 1
    return ranked[:min(n, longest)], short


def _slots(rows: DataFrame, labels, s: Settings) -> np.ndarray:
    """Counts of the ``labels`` of all rows, per slot of their hash. The counts only set the order of the labels, and any
    order is exact; so what is broadcast is bounded."""
    def count(batches):
        known, total = {}, np.zeros(s.count_slots, np.int64)
        for b in batches:
            for value in b.column(0):
                total += np.bincount((labels(value, known) % np.uint64(s.count_slots)).astype(np.int64), minlength=s.count_slots)
                if len(known) > 300_000:
                    known.clear()
        at = np.flatnonzero(total)
        for low in range(0, len(at), 50_000):
            some = at[low:low + 50_000]
            yield pa.record_batch([pa.array(some), pa.array(total[some])], ["slot", "n"])

    # few tasks: each returns up to one row a slot
    parts = rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism)
    got = parts.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(s.count_slots, np.int64)
    counts[got["slot"].to_numpy()] = got["n"].to_numpy()
    return counts


def _exact(undecided: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """(a, b): every pair of the texts that are in different components and share a label where two texts of similarity
    ``threshold`` must.

    Of a pair the smaller text, of n labels, comes with its short prefix under its class of sizes; the larger one goes to
    every class of sizes that the place of the label leaves possible. So keys are pairs of label and class.
    """
    some = texts.join(_bounded(undecided, s), "digest").select("digest", "root", "packed")
    sent = texts.sparkSession.sparkContext.broadcast(_slots(
        some.select("packed"), lambda packed, known: labels_of(zstandard.decompress(packed.as_py()), s.width, known), s))
    t = s.threshold

    def run(batches):
        z, known, counts = zstandard.ZstdDecompressor(), {}, sent.value
        for b in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for i, packed in enumerate(b.column("packed")):
                labels = labels_of(z.decompress(packed.as_py()), s.width, known)
                n = len(labels)
                first, short = prefix(labels, counts, t)
                place = np.arange(len(first))
                own = int(size_class(np.array([n]))[0])
                # as the larger text: sizes m with t / (1 + t) * (n + m) <= n - place, m >= t * n
                top = np.minimum(n, (n - place) * (1 + t) / t - n + 1e-6)
                low = int(size_class(np.array([max(1.0, t * n - 1e-6)]))[0])
                spans = np.maximum(0, size_class(np.maximum(top, 1.0)) - low + 1) * (top >= t * n - 1e-6)
                begin = np.repeat(np.cumsum(spans) - spans, spans)
                kinds = np.concatenate([low + np.arange(spans.sum()) - begin, np.full(min(short, len(first)), own)])
                at = np.concatenate([np.repeat(place, spans), place[:short]])
                small = np.arange(len(at)) >= spans.sum()
                for column, x in zip(out, (np.full(len(at), i), first[at].view(np.int64), kinds, at, np.full(len(at), n), small), strict=True):
                    column.append(x)
                if len(known) > 300_000:
                    known.clear()
            row, label, kind, at, n, small = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
            for low in range(0, len(row), 50_000):
                cut = slice(low, low + 50_000)
                mine = pa.array(row[cut].astype(np.int64))
                yield pa.record_batch(
                    [b.column("digest").take(mine), b.column("root").take(mine), pa.array(label[cut].astype(np.int64)),
                     pa.array(kind[cut].astype(np.int32)), pa.array(at[cut].astype(np.int32)), pa.array(n[cut].astype(np.int32)),
                     pa.array(small[cut].astype(bool))], ["digest", "root", "label", "kind", "at", "n", "small"])

    rows = cut_lineage(some.mapInArrow(run, "digest binary, root binary, label long, kind int, at int, n int, small boolean"), "prefixes")
    meet = rows.groupBy("label", "kind").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.bool_or("small").alias("s"), F.bool_or(~F.col("small")).alias("l"),
    ).filter("low <> high and s and l").select("label", "kind")
    rows = cut_lineage(rows.join(cut_lineage(meet, "meet"), ["label", "kind"]), "meeting")
    x = rows.filter("small").select("label", "kind", F.col("digest").alias("x"), F.col("root").alias("rx"), F.col("n").alias("nx"), F.col("at").alias("ax"))
    y = rows.filter("not small").select("label", "kind", F.col("digest").alias("y"), F.col("root").alias("ry"), F.col("n").alias("ny"), F.col("at").alias("ay"))
    left = F.least(F.col("nx") - F.col("ax"), F.col("ny") - F.col("ay"))
    met = x.join(y, ["label", "kind"]).filter(
        (F.col("rx") != F.col("ry")) & (F.col("nx") <= F.col("ny")) & (F.col("nx") >= t * F.col("ny") - 1e-6)
        & (left >= t / (1 + t) * (F.col("nx") + F.col("ny")) - 1e-6))
    return _ordered(met.select("x", "y"))


def links(docs: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b, similarity) between digests of distinct texts, and the components (node, root)."""
    attach(docs.sparkSession)
    bound_batches(docs.sparkSession)
    shared = _shared(cut_lineage(_sketch_table(docs, s), "sketches"))
    texts = _texts(docs, shared.select("digest").distinct(), s)
    good = cut_lineage(_verify(_stars(shared), texts, s), "links")
    roots = components(good)
    mixed = _mixed(shared, roots, s)
    if mixed.isEmpty():
        return good, roots
    rows = _differences(mixed, texts, s)
    pairs = _few(mixed, s).union(_share_differences(rows, s))
    reordered = _reordered(rows)
    if not reordered.isEmpty():
        pairs = pairs.union(_exact(reordered, texts, s))
    more = cut_lineage(_verify(pairs.distinct(), texts, s), "links")
    if more.isEmpty():
        return good, roots
    good = good.union(more)
    return good, components(good)


def classes(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, digest, class_id, leader) for every row; ``leader`` is the digest of the text that stands for the class:
    that of the smallest doc_id, of equals the smaller digest."""
    _, roots = links(docs, s)
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = cut_lineage(docs.select("doc_id", digest(F.col("text")).alias("digest"), has_words.alias("worded")), "rows")
    last = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    reps = rows.filter("worded").groupBy("digest").agg(F.min(last).alias("first"))
    grouped = reps.join(roots, reps.digest == roots.node)
    heads = grouped.groupBy("root").agg(F.min("first").alias("head"))
    joined = grouped.select("digest", "root").join(heads, "root").select("digest", "head")
    every = reps.join(joined, "digest", "left").select("digest", F.coalesce("head", "first").alias("head"))
    out = rows.filter("worded").join(every, "digest").select("doc_id", "digest", F.col("head.doc_id").alias("class_id"),
                                                             F.col("head.digest").alias("leader"))
    alone = rows.filter("not worded").select("doc_id", "digest", F.col("doc_id").alias("class_id"), F.col("digest").alias("leader"))
    return out.union(alone)


def drop_near(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row of each class, with all columns; rows without words all stay."""
    heads = classes(docs, s).filter("digest = leader and doc_id <=> class_id").select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).distinct()
    keyed = docs.withColumn("__own", digest(F.col("text")))
    kept = keyed.join(heads, keyed["doc_id"].eqNullSafe(F.col("__id")) & (keyed["__own"] == F.col("__digest")), "left_semi")
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return kept.filter(has_words).dropDuplicates(["doc_id", "__own"]).union(kept.filter(~has_words)).drop("__own")
