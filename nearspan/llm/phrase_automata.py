"""Phrase collocations per language, counted by weighted acyclic automata.

An :class:`Automaton` holds word sequences of up to four words as paths from one start; the weight of a state is how
often its path occurs. A task cuts its texts into blocks, sorts the sequences that start at every word of a block and
builds the automaton of the block level by level from the sorted rows. Every automaton is cut at the same sampled
sequences into prefix ranges, so that a word that starts very many phrases is spread over many ranges. The automata of a
range are united, weights of equal paths added, and paths below ``min_count`` go; the few paths that lie across a cut are
kept with their partial weights and summed afterwards. So all counts are exact.

What frequent phrases are made of is frequent too, so the counts of their parts are looked up by composing the automaton
of the wanted parts with that of the frequent phrases, bucket by bucket.

Sizes: a task holds one block of texts (``block_bytes``; longer texts are cut at a separator, or between words with
three words of overlap) or one range (about ``range_bytes`` of text, a single word may be longer). The cuts are tuples of
words shortened to 24 bytes; all of them are on the driver and in every task, some 60 bytes for each ``range_bytes`` of
text. They come from a sample, which decides where work is done and nothing else.

Defined cases: null text is empty; null language is ``und``. Repeated rows count each time. Languages without a phrase of
``min_count`` occurrences have no rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearspan.session import attach, cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STOP = b"."
#: Lower case; every separator becomes STOP and a tab becomes a space.
TABLE = bytes.maketrans(UPPER.encode() + b",;:!?\n\x0b\x0c\r\t", LOWER.encode() + STOP * 9 + b" ")
NONE = "und"


@dataclass(frozen=True)
class Settings:
    min_count: int = 30
    words: int = 4
    top: int = 2000
    covered: int = 80
    factor: int = 2000  # of the score, times 1000
    block_bytes: int = 8 << 20
    range_bytes: int = 8 << 20
    sample_bytes: int = 16 << 20
    samples: int = 64
    bucket_rows: int = 20_000


@dataclass
class Automaton:
    """Level d lists its states ordered by path: ``parent`` (position in the level before), ``label`` (number of the word
    in the sorted ``words``), ``weight``."""

    words: list[bytes]
    parent: list[np.ndarray]
    label: list[np.ndarray]
    weight: list[np.ndarray]

    @classmethod
    def build(cls, words: list[bytes], rows: np.ndarray, weight: np.ndarray) -> "Automaton":
        """From sorted distinct rows of word numbers + 1 (0 after the end of a sequence)."""
        out = cls(words, [], [], [])
        fresh, up = np.zeros(len(rows), bool), np.zeros(len(rows), np.int64)
        for d in range(rows.shape[1]):
            column = rows[:, d]
            fresh[:1] = True
            fresh[1:] |= column[1:] != column[:-1]
            here = np.flatnonzero(fresh & (column > 0))
            inside = np.where(column > 0, weight, 0)
            state = np.cumsum(fresh & (column > 0)) - 1
            totals = np.zeros(len(here), np.int64)
            if len(here):
                ends = np.r_[here[1:], len(rows)]
                sums = np.r_[0, inside.cumsum()]
                totals = sums[ends] - sums[here]
            out.parent.append(up[here])
            out.label.append(column[here] - 1)
            out.weight.append(totals)
            up = state
        return out

    @classmethod
    def union(cls, parts: list["Automaton"]) -> "Automaton":
        """All paths of the parts; weights of equal paths are added."""
        words = sorted(set().union(*[p.words for p in parts]))
        number = {w: i for i, w in enumerate(words)}
        maps = [np.fromiter(map(number.__getitem__, p.words), np.int64, len(p.words)) for p in parts]
        out, state = cls(words, [], [], []), [np.zeros(1, np.int64) for _ in parts]
        for d in range(max((len(p.label) for p in parts), default=0)):
            up = np.concatenate([state[i][p.parent[d]] for i, p in enumerate(parts)])
            label = np.concatenate([maps[i][p.label[d]] for i, p in enumerate(parts)])
            weight = np.concatenate([p.weight[d] for p in parts])
            key = up * len(words) + label
            order = np.argsort(key, kind="stable")
            key = key[order]
            fresh = np.r_[True, key[1:] != key[:-1]][:len(key)]
            first = np.flatnonzero(fresh)
            at = np.empty(len(key), np.int64)
            at[order] = np.cumsum(fresh) - 1
            out.parent.append(key[first] // max(len(words), 1))
            out.label.append(key[first] % max(len(words), 1))
            out.weight.append(np.add.reduceat(weight[order], first) if len(first) else weight)
            ends = np.cumsum([len(p.label[d]) for p in parts])
            state = np.split(at, ends[:-1])
        return out

    def follow(self, path: tuple[bytes, ...]) -> list[int]:
        """States along a path, as far as it goes."""
        states, low = [], 0
        for d, word in enumerate(path[:len(self.label)]):
            i = bisect_left(self.words, word)
            if i == len(self.words) or self.words[i] != word:
                break
            a, b = (0, len(self.label[0])) if d == 0 else np.searchsorted(self.parent[d], [low, low + 1])
            at = a + int(np.searchsorted(self.label[d][a:b], i))
            if at == b or self.label[d][at] != i:
                break
            states.append(at)
            low = at
        return states

    def compose(self, other: "Automaton") -> list[np.ndarray]:
        """For every state, by level, the state of ``other`` with the same path (or -1)."""
        number = {w: i for i, w in enumerate(other.words)}
        same = np.fromiter((number.get(w, -1) for w in self.words), np.int64, len(self.words))
        met, width = [np.zeros(1, np.int64)], max(len(other.words), 1)
        for d in range(len(self.label)):
            up, label = met[-1][self.parent[d]], same[self.label[d]]
            found = np.full(len(label), -1)
            if d < len(other.label) and len(other.label[d]):
                keys, want = other.parent[d] * width + other.label[d], up * width + label
                at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                good = (up >= 0) & (label >= 0) & (keys[at] == want)
                found[good] = at[good]
            met.append(found)
        return met[1:]

    def paths(self) -> list[list[bytes]]:
        """The words of every state, space-joined, by level."""
        out = [[self.words[i] for i in self.label[0].tolist()]] if self.label else []
        for d in range(1, len(self.label)):
            out.append([out[-1][p] + b" " + self.words[i] for p, i in zip(self.parent[d].tolist(), self.label[d].tolist())])
        return out

    # ---- as one binary value

    def to_bytes(self) -> bytes:
        """Children are listed below their parents, so the number of children of a state tells its parent."""
        arrays = []
        for d in range(len(self.label)):
            above = len(self.label[d - 1]) if d else 1
            arrays += [np.bincount(self.parent[d], minlength=above), self.label[d], self.weight[d]]
        raw = [b"\n".join(self.words)] + [a.astype(np.min_scalar_type(int(a.max(initial=0)))) for a in arrays]
        sizes = np.array([[len(r), r.itemsize if isinstance(r, np.ndarray) else 1] for r in raw], np.int64)
        body = sizes.tobytes() + raw[0] + b"".join(a.tobytes() for a in raw[1:])
        return len(body).to_bytes(8, "little") + len(raw).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)

    @classmethod
    def from_bytes(cls, data: bytes) -> "Automaton":
        size, count = int.from_bytes(data[:8], "little"), int.from_bytes(data[8:16], "little")
        body = pa.decompress(data[16:], decompressed_size=size, codec="zstd", asbytes=True)
        sizes = np.frombuffer(body, np.int64, 2 * count).reshape(count, 2)
        at, arrays = 16 * count + int(sizes[0, 0]), []
        words = body[16 * count:at].split(b"\n") if sizes[0, 0] else []
        for n, width in sizes[1:]:
            arrays.append(np.frombuffer(body, f"u{width}", n, at).astype(np.int64))
            at += int(n * width)
        parent = [np.repeat(np.arange(len(a)), a) for a in arrays[0::3]]
        return cls(words, parent, arrays[1::3], arrays[2::3])


# ---- blocks of texts

def chunks(raw: bytes, size: int):
    """Pieces of a translated text and how many words at their end are only context (they start the next piece)."""
    start = 0
    while len(raw) - start > size:
        cut = raw.rfind(STOP, start + 1, start + size)
        if cut < 0:
            cut = raw.find(b" ", start + size)
            stop = raw.find(STOP, start + size)
            if stop >= 0 and (cut < 0 or stop < cut):
                cut = stop
            if cut < 0:
                break
        if raw[cut:cut + 1] == STOP:
            yield raw[start:cut], 0
            start = cut + 1
            continue
        piece = raw[start:cut]
        back = len(piece)
        for _ in range(3):
            while back and piece[back - 1:back] == b" ":
                back -= 1
            while back and piece[back - 1:back] != b" ":
                back -= 1
        if back == 0:
            size *= 2  # fewer than four words: longer pieces
            continue
        yield piece, 3
        start += back
    yield raw[start:], 0


def sequences(texts: list[tuple[bytes, int]], width: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Sorted words, the sorted distinct sequences that start at the words of the texts, and how often each occurs."""
    tokens, starts = [], []
    for text, context in texts:
        found = text.replace(STOP, b" . ").split()
        tokens += found
        tokens.append(STOP)
        if context:
            starts.append((len(tokens) - 1 - context, len(tokens) - 1))
    words = sorted(set(tokens) - {STOP})
    number = {w: i + 1 for i, w in enumerate(words)}
    number[STOP] = 0
    ids = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
    del tokens
    first = ids > 0
    for a, b in starts:
        first[a:b] = False
    padded = np.r_[ids, np.zeros(width, np.int64)]
    at = np.flatnonzero(first)
    columns = [padded[at]]
    for d in range(1, width):
        columns.append(np.where(columns[-1] > 0, padded[at + d], 0))
    bits = len(words).bit_length()
    per = max(1, 62 // max(bits, 1))
    keys = []
    for low in range(0, width, per):
        key = columns[low]
        for c in columns[low + 1:low + per]:
            key = (key << bits) | c
        keys.append(key)
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    rows = np.stack([c[order] for c in columns], axis=1) if len(order) else np.empty((0, width), np.int64)
    fresh = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)][:len(rows)])
    return words, rows[fresh], np.diff(np.r_[fresh, len(rows)])


def place(words: list[bytes], rows: np.ndarray, cut: tuple[bytes, ...]) -> int:
    """How many sorted rows lie before a cut."""
    low, high = 0, len(rows)
    for d in range(rows.shape[1]):
        if d >= len(cut):
            return low
        i = bisect_left(words, cut[d])
        column = rows[low:high, d]
        a = low + int(np.searchsorted(column, i + 1, "left"))
        if i == len(words) or words[i] != cut[d]:
            return a
        low, high = a, low + int(np.searchsorted(column, i + 1, "right"))
    return low


def _shards(texts: list[tuple[bytes, int]], cuts: list[tuple[bytes, ...]], width: int):
    """(range, automaton) of one block of texts of one language."""
    words, rows, weight = sequences(texts, width)
    ends = [0, *(place(words, rows, c) for c in cuts), len(rows)]
    for r, (a, b) in enumerate(zip(ends, ends[1:])):
        if b > a:
            used = np.unique(rows[a:b])
            used = used[used > 0]
            part = np.searchsorted(used, rows[a:b]) + 1
            part[rows[a:b] == 0] = 0
            yield r, Automaton.build([words[i - 1] for i in used.tolist()], part, weight[a:b])


# ---- jobs

def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"), F.col("text")).where("text IS NOT NULL")


def find_cuts(docs: DataFrame, s: Settings) -> dict[str, list[tuple[bytes, ...]]]:
    """The cuts of every language, from a hashed sample of its documents that holds about ``sample_bytes`` of text in all."""
    size = docs.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")).collect()
    total = sum(r.bytes for r in size)
    wanted = {r.lang: int(r.bytes // s.range_bytes) for r in size}
    if not any(wanted.values()):
        return {}
    share = min(1.0, s.sample_bytes / total)
    rate = min(1.0, s.samples * sum(wanted.values()) * 6 / (share * total))
    width = s.words

    def draw(batches):
        for b in batches:
            langs, found = [], []
            for lang, raw in zip(b.column(0).to_pylist(), b.column(1).cast(pa.large_binary())):
                for piece, _ in chunks(raw.as_py().translate(TABLE), s.block_bytes):
                    tokens = piece.replace(STOP, b" . ").split()
                    rng = np.random.default_rng(zlib.crc32(piece))
                    for i in np.flatnonzero(rng.random(len(tokens)) < rate).tolist():
                        run = tokens[i:i + width]
                        run = run[:run.index(STOP)] if STOP in run else run
                        if run:
                            langs.append(lang)
                            found.append([w[:24] for w in run])
            yield pa.record_batch([pa.array(langs, pa.string()), pa.array(found, pa.list_(pa.binary()))], ["lang", "run"])

    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < max(1, int(share * (1 << 20)))).select("lang", "text")
    runs: dict[str, list] = {}
    for r in sample.mapInArrow(draw, "lang string, run array<binary>").collect():
        runs.setdefault(r.lang, []).append(tuple(bytes(w) for w in r.run))
    out = {}
    for lang, found in runs.items():
        found.sort()
        n = wanted[lang]
        out[lang] = sorted({found[len(found) * i // (n + 1)] for i in range(1, n + 1)}) if n else []
    return out


def frequent(docs: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, n) of all sequences of at least ``min_count`` occurrences, and (lang, n) of all words."""
    attach(docs.sparkSession)
    docs = _prepared(docs)
    shared = docs.sparkSession.sparkContext.broadcast(find_cuts(docs, s))
    width, floor = s.words, s.min_count

    def shard(batches):
        cuts = shared.value

        def flush(held):
            for lang, texts in held.items():
                found = list(_shards(texts, cuts.get(lang, []), width))
                yield pa.record_batch([pa.repeat(pa.scalar(lang), len(found)), pa.array([r for r, _ in found], pa.int32()),
                                       pa.array([a.to_bytes() for _, a in found], pa.binary())], ["lang", "range", "automaton"])
            held.clear()

        held, size = {}, 0
        for b in batches:
            for lang, raw in zip(b.column(0).to_pylist(), b.column(1).cast(pa.large_binary())):
                for piece in chunks(raw.as_py().translate(TABLE), s.block_bytes):
                    held.setdefault(lang, []).append(piece)
                    size += len(piece[0])
                    if size >= s.block_bytes:
                        yield from flush(held)
                        size = 0
        yield from flush(held)

    def unite(key, table):
        lang, r = key[0].as_py(), key[1].as_py()
        cuts = shared.value.get(lang, [])
        whole = Automaton.union([Automaton.from_bytes(x.as_py()) for x in table.column("automaton")])
        keep = [w >= floor for w in whole.weight]
        for cut in cuts[max(r - 1, 0):r + 1]:  # paths that may go on in the range before or behind
            for d, state in enumerate(whole.follow(cut)):
                keep[d][state] = True
        phrases, words, n = [None], [0], [int(whole.weight[0].sum())]
        up: list[bytes] = []
        for d, k in enumerate(keep):
            at = np.flatnonzero(k)
            back = {}  # kept states of the level before have kept parents, so their paths are at hand
            if d:
                back = dict(zip(np.flatnonzero(keep[d - 1]).tolist(), up))
            labels, parents = whole.label[d][at].tolist(), whole.parent[d][at].tolist()
            up = [whole.words[i] if d == 0 else back[p] + b" " + whole.words[i] for p, i in zip(parents, labels)]
            phrases += up
            words += [d + 1] * len(up)
            n += whole.weight[d][at].tolist()
        return pa.table({"lang": pa.array([lang] * len(n), pa.string()), "phrase": pa.array(phrases, pa.binary()).cast(pa.string()),
                         "words": pa.array(words, pa.int32()), "n": pa.array(n, pa.int64())})

    shards = docs.mapInArrow(shard, "lang string, range int, automaton binary")
    united = shards.groupBy("lang", "range").applyInArrow(unite, "lang string, phrase string, words int, n long")
    rows = cut_lineage(united, "frequent-phrases")
    sizes = rows.where("phrase IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    whole = rows.where("phrase IS NOT NULL").groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= floor)
    return cut_lineage(whole, "frequent-phrases"), sizes


def _of_phrases(phrases: pa.ChunkedArray, weight: pa.ChunkedArray | None, width: int) -> tuple[Automaton, np.ndarray]:
    """Automaton of some phrases (distinct), and for each of them (in order) its state in the level of its length."""
    split = [p.as_py().encode().split(b" ") for p in phrases]
    words = sorted(set().union(*split))
    number = {w: i + 1 for i, w in enumerate(words)}
    rows = np.zeros((len(split), width), np.int64)
    for i, p in enumerate(split):
        rows[i, :len(p)] = [number[w] for w in p]
    order = np.lexsort(rows.T[::-1])
    n = np.ones(len(rows), np.int64) if weight is None else weight.to_numpy()
    made = Automaton.build(words, rows[order], n[order])
    state, sorted_rows = np.empty(len(rows), np.int64), rows[order]
    fresh = np.zeros(len(rows), bool)
    length = (rows > 0).sum(axis=1)
    for d in range(width):
        fresh[:1] = True
        fresh[1:] |= sorted_rows[1:, d] != sorted_rows[:-1, d]
        at = np.cumsum(fresh & (sorted_rows[:, d] > 0)) - 1
        here = length[order] == d + 1
        state[order[here]] = at[here]
    return made, state


def part_counts(parts: DataFrame, counts: DataFrame, s: Settings) -> DataFrame:
    """(lang, phrase, n) of the wanted parts (lang, phrase, distinct): their automaton composed with that of the counts."""
    attach(parts.sparkSession)
    buckets = max(1, counts.count() // s.bucket_rows)
    width = s.words
    bucket = F.pmod(F.xxhash64("lang", "phrase"), F.lit(buckets)).alias("bucket")

    def look(key, wanted, known):
        phrase, n = wanted.column("phrase"), np.zeros(wanted.num_rows, np.int64)
        if wanted.num_rows and known.num_rows:
            asked, state = _of_phrases(phrase, None, width)
            held, held_state = _of_phrases(known.column("phrase"), known.column("n"), width)
            own = [np.zeros(len(w), np.int64) for w in held.weight]  # a state's weight there adds up longer phrases too
            sizes = np.array([p.as_py().count(" ") for p in known.column("phrase")])
            values = known.column("n").to_numpy()
            for d in range(width):
                own[d][held_state[sizes == d]] = values[sizes == d]
            met = asked.compose(held)
            length = np.array([p.as_py().count(" ") for p in phrase])
            for d in range(width):
                here = np.flatnonzero(length == d)
                found = met[d][state[here]]
                n[here[found >= 0]] = own[d][found[found >= 0]]
        return pa.table({"lang": pa.array([key[0].as_py()] * len(n), pa.string()), "phrase": phrase, "n": pa.array(n, pa.int64())})

    left = parts.select("lang", "phrase", bucket).groupBy("lang", "bucket")
    right = counts.select("lang", "phrase", "n", bucket).groupBy("lang", "bucket")
    return left.cogroup(right).applyInArrow(look, "lang string, phrase string, n long")


def _joined(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def mine(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the strongest phrases of every language."""
    counts, sizes = frequent(docs, s)
    split = F.split("phrase", " ")
    candidates = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _joined(split, 1, F.col("k")).alias("first"),
        _joined(split, F.col("k") + 1, F.col("words")).alias("rest"))
    wanted = cuts.select("lang", F.explode(F.array("first", "rest")).alias("phrase")).distinct()
    found = cut_lineage(part_counts(wanted, counts, s), "part-counts")
    for name, column in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(found.select("lang", F.col("phrase").alias(name), F.col("n").alias(column)), ["lang", name])
    # floor(1000 * factor * a / (l + r)) by long division, inside 64 bits
    cuts = (cuts.withColumn("of", F.col("l") + F.col("r")).withColumn("part", F.col("a") * s.factor)
            .withColumn("score", F.expr("(part div of) * 1000 + ((part % of) * 1000) div of")))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    spots = F.expr("flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> struct(i, m))))")
    inner = (candidates.where("words > 2").select("lang", "a", split.alias("w"), F.explode(spots).alias("at"))
             .select("lang", _joined(F.col("w"), F.col("at.i"), F.col("at.m")).alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    open_ = (best.join(inner, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < s.covered * F.col("a"), F.lit(True)))
             .select("lang", "phrase", "a", "best.*"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    few = open_.withColumn("place", F.row_number().over(part)).where(F.col("place") <= s.top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    out = few.withColumn("rank", rank).where(F.col("rank") <= s.top).join(sizes, "lang")
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = f"""WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
z AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
s AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS t(m) WHERE len(w) >= m),
f AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM s GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m > 1),
x AS (SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r, CAST(2000000::HUGEINT * a // (l.f + r.f) AS BIGINT) AS score
      FROM c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ')
      JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:c.m], ' ')),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT f.lang, f AS longer, string_split(phrase, ' ') AS w, m, j, unnest(range(1, m - j + 2)) AS i
      FROM f, (VALUES (2), (3)) AS t(j) WHERE m > j),
d AS (SELECT lang, array_to_string(w[i:i + j - 1], ' ') AS phrase, max(longer) AS longer FROM o GROUP BY ALL)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM b LEFT JOIN d USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a)
JOIN z USING (lang) WHERE rank <= 2000"""
