"""Language-model scores: masked pseudo-likelihood of a bidirectional window network.

Every token is predicted from the ``reach`` tokens on either side of it, never from itself; a document's score is the
sum of the log probabilities of all its tokens. The network is an embedding per side position, one hidden layer and a
softmax in two levels, trained in numpy: the classes lie in groups of ``group``, and the probability of a class is that
of its group times that of the class among the classes of its group.

Tokens are white-space words, lower-cased over A-Z. The most frequent words of the whole corpus are tokens of their
own, all others share hashed tokens; the softmax has a class for each of the most frequent words and hashed classes
for the rest. The probability of a word is that of its class times its share of the class: with n occurrences of the
word and N of its class in the corpus, n / (N + 1); words the corpus does not hold share the one occurrence more, over
their bytes (257 ** -(bytes + 1) each, which sums to 1 over all strings). Up to ``held`` of the words' counts are
broadcast, those of rarer words are joined. Counts cover all documents. Training covers all documents too: texts are dealt
by a hash of text and doc_id into shards of some ``shard`` words, each a group of Spark's in the order of a digest; a shard
fits a copy of the current network on every ``stride``-th window of its texts (the first seeded by the text, the next one
in the next round, so ``stride`` rounds train on every window once); the copies are averaged by the number of their
windows, per slot of the parameters and inside Spark in two steps, for a few rounds. So what is gathered grows with the
corpus, what the driver holds is one network, and neither shards nor their order depend on how the table is split. Words
become tokens once: training and scoring read the written token table.

Defined cases: null texts and texts without words have 0 tokens and score 0.0, mean null; tokens beyond the ends are
a padding token; repeated rows get equal scores; a corpus without words gives the untrained network; only doc_id and
text are used. Very long texts are taken in pieces of ``piece`` tokens that see their neighbours; a word of more than
``LONG`` bytes stands for itself under a digest of 33 bytes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from itertools import repeat
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearspan.llm.words import blocks, split
from nearspan.session import attach, cut_lineage


@dataclass(frozen=True)
class Settings:
    words: int = 1536
    hashed: int = 511
    classes: int = 256
    own_classes: int = 192
    group: int = 16
    reach: int = 2
    hidden: int = 16
    stride: int = 2
    rounds: int = 2
    batch: int = 2048
    rate: float = 0.25
    shard: int = 2_000_000
    piece: int = 20_000
    held: int = 100_000
    seed: int = 3

    def __post_init__(self):
        if self.classes % self.group:
            raise ValueError("classes must be a multiple of group")


LETTER_CASE = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Letter case, and white space as blanks.
SPACED = LETTER_CASE.translate(bytes.maketrans(b"\t\n\v\f\r", b" " * 5))
#: Words of more bytes are replaced by a digest, so that tables of words are bounded in bytes.
LONG = 256
#: Bytes of text whose words are taken at once, and of words that a task collects before it counts them.
BLOCK, HELD = 4 << 20, 48 << 20


@dataclass
class Vocabulary:
    """Token and class numbers of words; token 0 is the padding."""

    own: dict[bytes, int]
    s: Settings
    #: Counts of the most frequent words, of all classes, and of the words that are not in ``counts`` (if there are any).
    counts: dict[bytes, int]
    totals: np.ndarray
    rare: DataFrame | None

    def tokens(self, words: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(self.own.get, words, repeat(-1)), np.int32, len(words)) + np.int32(1)
        rest = np.flatnonzero(out == 0)
        hashes = np.fromiter((zlib.crc32(words[i]) for i in rest.tolist()), np.int64, len(rest))
        out[rest] = 1 + self.s.words + hashes % self.s.hashed
        return out

    def class_table(self) -> np.ndarray:
        """Class of every token."""
        s = self.s
        t = np.arange(1 + s.words + s.hashed) - 1
        rest = s.own_classes + (t * 2654435761 >> 7) % (s.classes - s.own_classes)
        return np.where((t >= 0) & (t < s.own_classes), t, rest).astype(np.int32)

    def share(self, word: bytes, count: int, c: int) -> float:
        """log P(word | class c) of a word that occurs ``count`` times; a class of its own holds no other word."""
        if c < self.s.own_classes:
            return 0.0
        rest = -log(self.totals[c] + 1)
        return rest + log(count) if count else rest - (len(word) + 1) * log(257)


class Network:
    def __init__(self, s: Settings, shares: np.ndarray | None = None):
        """``shares``: the log share of every class in the corpus, where an untrained network starts."""
        rng = np.random.default_rng(s.seed)
        groups = s.classes // s.group
        start = np.zeros((groups, s.group)) if shares is None else shares.reshape(groups, s.group)
        self.s = s
        self.width = 1 + s.words + s.hashed
        self.e = rng.normal(0, 0.3, (2 * s.reach, self.width, s.hidden)).astype(np.float32)
        self.c = np.zeros(s.hidden, np.float32)
        self.u = rng.normal(0, 0.3, (s.hidden, groups)).astype(np.float32)
        self.b = np.log(np.exp(start).sum(axis=1)).astype(np.float32)
        self.inner_u = rng.normal(0, 0.3, (groups, s.hidden, s.group)).astype(np.float32)
        self.inner_b = start.astype(np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.e, self.c, self.u, self.b, self.inner_u, self.inner_b]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()])

    def load(self, flat: np.ndarray) -> Network:
        at = 0
        for p in self.parameters():
            p[...] = flat[at:at + p.size].reshape(p.shape)
            at += p.size
        return self

    def hidden(self, sides: np.ndarray) -> np.ndarray:
        """sides: (n, 2 * reach) tokens."""
        h = self.c + self.e[0].take(sides[:, 0], axis=0)
        for i in range(1, sides.shape[1]):
            h += self.e[i].take(sides[:, i], axis=0)
        return np.tanh(h, out=h)

    def _by_group(self, y: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
        """The order of rows by the group of their class, and where each group lies in it."""
        g = (y // self.s.group).astype(np.uint16)
        ends = np.cumsum(np.bincount(g, minlength=len(self.b))).tolist()
        return np.argsort(g, kind="stable"), [(k, slice(a, b)) for k, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]

    def _logits(self, h: np.ndarray, spans: list[tuple[int, slice]]) -> list[np.ndarray]:
        """Logits of groups and of the classes inside the own group, a column per row of h, the largest of a column 0."""
        inner = np.empty((self.s.group, len(h)), np.float32)
        for k, rows in spans:
            inner[:, rows] = self.inner_u[k].T @ h[rows].T + self.inner_b[k][:, None]
        both = [self.u.T @ h.T + self.b[:, None], inner]
        for z in both:
            z -= z.max(axis=0)
        return both

    def log_probabilities(self, sides: np.ndarray, y: np.ndarray) -> np.ndarray:
        order, spans = self._by_group(y)
        h, y = self.hidden(sides.take(order, axis=0)), y[order]
        at = np.arange(len(y))
        got = np.zeros(len(y), np.float32)
        for z, taken in zip(self._logits(h, spans), np.divmod(y, self.s.group), strict=True):
            got += z[taken, at]
            got -= np.log(np.exp(z, out=z).sum(axis=0))
        out = np.empty_like(got)
        out[order] = got
        return out

    def step(self, sides: np.ndarray, y: np.ndarray, g: list[np.ndarray]) -> None:
        """One Adagrad step on a batch; g holds the sums of squares."""
        order, spans = self._by_group(y)
        sides, y = sides.take(order, axis=0), y[order]
        h, at = self.hidden(sides), np.arange(len(y))
        outer, inner = self._logits(h, spans)
        for z, taken in zip((outer, inner), np.divmod(y, self.s.group), strict=True):
            np.exp(z, out=z)
            z /= z.sum(axis=0) * len(y)
            z[taken, at] -= 1 / len(y)
        inner_u, inner_b = np.zeros_like(self.inner_u), np.zeros_like(self.inner_b)
        dh = (self.u @ outer).T.copy()
        for k, rows in spans:
            inner_u[k] = (inner[:, rows] @ h[rows]).T
            inner_b[k] = inner[:, rows].sum(axis=1)
            dh[rows] += (self.inner_u[k] @ inner[:, rows]).T
        dh *= 1 - h * h
        rate = self.s.rate
        grads = [dh.sum(axis=0), (outer @ h).T, outer.sum(axis=1), inner_u, inner_b]
        for param, grad, sq in zip(self.parameters()[1:], grads, g[1:], strict=True):
            sq += grad * grad
            param -= rate * grad / np.sqrt(sq)
        # all sides at once: rows of the embedding that the batch uses, each with the sum of its gradients
        rows = (sides + np.arange(sides.shape[1], dtype=sides.dtype) * self.width).T.ravel()
        if len(self.e) * self.width <= 1 << 16:
            rows = rows.astype(np.uint16)
        by = np.argsort(rows, kind="stable")
        rows = rows[by]
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        used = rows[first].astype(np.intp)
        grad = np.add.reduceat(dh.take(by % len(y), axis=0), first, axis=0)
        e, sq = self.e.reshape(-1, self.s.hidden), g[0].reshape(-1, self.s.hidden)
        new = sq.take(used, axis=0)
        new += grad * grad
        sq[used] = new
        grad /= np.sqrt(new, out=new)
        grad *= -rate
        grad += e.take(used, axis=0)
        e[used] = grad


def words_of(raw: bytes) -> list[bytes]:
    words = raw.translate(LETTER_CASE).split()
    if len(raw) > LONG and max(map(len, words), default=0) > LONG:
        words = [w if len(w) <= LONG else b"\0" + hashlib.sha256(w).digest() for w in words]
    return words


def words_of_all(raws: Sequence[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after the other, as ``words_of`` has them, and their number in each text."""
    words, sizes = split(raws, SPACED)
    if len(words) and pc.max(pc.binary_length(words)).as_py() > LONG:
        words = pa.array([w for raw in raws for w in words_of(raw)], pa.binary())
    return words, sizes


def windows(tokens: np.ndarray, at: np.ndarray, s: Settings) -> np.ndarray:
    """Tokens on both sides of the places ``at``; padding beyond the ends."""
    padded = np.concatenate([np.zeros(s.reach, np.int32), tokens, np.zeros(s.reach, np.int32)])
    offsets = [o for o in range(2 * s.reach + 1) if o != s.reach]
    return padded.take(at[:, None] + np.array(offsets))


def places(raw: bytes, n: int, turn: int, s: Settings) -> np.ndarray:
    """The places of a text of n words that a round trains on; ``stride`` rounds have every place once."""
    return _places(zlib.crc32(raw), n, turn, s)


def _places(seed: int, n: int, turn: int, s: Settings) -> np.ndarray:
    return np.arange((seed + turn) % s.stride, n, s.stride)


def vocabulary(docs: DataFrame, s: Settings = Settings()) -> tuple[Vocabulary, np.ndarray]:
    """The most frequent words of all documents, and the log share of every class."""
    def count(batches):
        held, n = [], 0

        def rows() -> pa.RecordBatch:
            found = pa.chunked_array(held, pa.binary()).value_counts()
            held.clear()
            return pa.RecordBatch.from_arrays(found.flatten(), ["word", "n"])

        for b in batches:
            raws = b.column("text").cast(pa.large_binary())
            for some in blocks((x.as_py() or b"" for x in raws), BLOCK):
                words, _ = words_of_all(some)
                held.append(words)
                n += words.nbytes
                if n > HELD:
                    yield rows()
                    n = 0
        if held:
            yield rows()

    counted = cut_lineage(docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word")
                          .agg(F.sum("n").alias("n")), "words")
    top = counted.orderBy(F.desc("n"), "word").limit(max(s.words, s.held)).toArrow()
    counts = dict(zip(top["word"].to_pylist(), top["n"].to_pylist(), strict=True))
    rare = None
    if counted.count() > len(counts):
        least = min(counts.values())
        last = max(w for w, n in counts.items() if n == least)
        rare = counted.filter((F.col("n") < least) | ((F.col("n") == least) & (F.col("word") > F.lit(bytearray(last)))))
    vocab = Vocabulary({w: i for i, w in enumerate(list(counts)[:s.words])}, s, {}, np.zeros(s.classes, np.int64), None)
    table = vocab.class_table()

    def class_of(words: pa.Array) -> pa.Array:
        return pa.array(table[vocab.tokens(words.to_pylist())])

    hashed = F.arrow_udf(class_of, "int")
    shares = np.ones(s.classes)
    for r in counted.select(hashed("word").alias("c"), "n").groupBy("c").agg(F.sum("n").alias("n")).collect():
        shares[r.c] += r.n
        vocab.totals[r.c] = r.n
    return replace(vocab, counts=counts, rare=rare), np.log(shares / shares.sum())


SLOT = 4096
CODED = "row long, key long, seed long, tokens binary, inside double, rare array<struct<word: binary, times: bigint>>"


def encode(docs: DataFrame, vocab: Vocabulary, s: Settings = Settings()) -> DataFrame:
    """The token table, a row per document: doc_id, a number of the row, digest and seed of the text, its tokens (two bytes
    each, four in a larger vocabulary), the sum of log P(word | class) over the words whose counts are broadcast, and the
    other words with their occurrences."""
    spark = docs.sparkSession
    joined, kind = vocab.rare is not None, _token_type(s)
    sent = spark.sparkContext.broadcast(replace(vocab, rare=None))

    def run(batches):
        vocab = sent.value
        table, held = vocab.class_table(), pa.array(list(vocab.counts), pa.binary())
        # of the held words, then of one that is not held
        token_of = np.append(vocab.tokens(list(vocab.counts)), np.int32(0))
        share_of = np.array([vocab.share(w, n, c) for (w, n), c in zip(vocab.counts.items(), table[token_of[:-1]].tolist(), strict=True)] + [0.0])

        def coded(raws: list[bytes]) -> tuple[list[bytes], list[float], pa.Array]:
            words, sizes = words_of_all(raws)
            at = pc.index_in(words, value_set=held).fill_null(-1).to_numpy()
            tokens, shares = token_of.take(at, mode="wrap"), share_of.take(at, mode="wrap")
            # the words that are not held: each is worked out once
            lost = np.flatnonzero(at < 0)
            found = words.take(pa.array(lost)).dictionary_encode()
            others, codes = found.dictionary.to_pylist(), found.indices.to_numpy()
            token = vocab.tokens(others)
            tokens[lost] = token.take(codes)
            classes = table[token]
            if not joined:
                shares[lost] = np.array([vocab.share(w, 0, c) for w, c in zip(others, classes.tolist(), strict=True)], float).take(codes)
            ends = np.cumsum(sizes).tolist()
            spans = [slice(a, b) for a, b in zip([0, *ends], ends)]
            sums = [sum(x[x != 0].tolist()) for x in (shares[span] for span in spans)]
            # those whose counts are joined, once a text in the order of first occurrence
            where = np.flatnonzero((classes >= s.own_classes).take(codes) if joined else np.zeros(len(codes), bool))
            codes, texts = codes.take(where), np.repeat(np.arange(len(raws)), sizes).take(lost.take(where))
            _, first, times = np.unique(texts * len(others) + codes, return_index=True, return_counts=True)
            order = np.argsort(first)
            first = first[order]
            each = pa.StructArray.from_arrays([found.dictionary.take(pa.array(codes.take(first))), pa.array(times[order])], ["word", "times"])
            rare_ends = np.searchsorted(texts.take(first), np.arange(len(raws) + 1)).astype(np.int32)
            tokens = tokens.astype(kind)
            return [tokens[span].tobytes() for span in spans], sums, pa.ListArray.from_arrays(pa.array(rare_ends), each)

        for b in batches:
            at = 0
            for raws in blocks((x.as_py() or b"" for x in b.column("text").cast(pa.large_binary())), BLOCK):
                tokens, sums, rares = coded(raws)
                yield pa.record_batch([
                    b.column("doc_id").slice(at, len(raws)),
                    pa.array([int.from_bytes(hashlib.md5(raw).digest()[:8], "big", signed=True) for raw in raws], pa.int64()),
                    pa.array([zlib.crc32(raw) for raw in raws], pa.int64()), pa.array(tokens, pa.binary()), pa.array(sums, pa.float64()),
                    rares], ["doc_id", "key", "seed", "tokens", "inside", "rare"])
                at += len(raws)

    given = docs.select("doc_id", "text")
    return given.mapInArrow(run, f"doc_id {dict(given.dtypes)['doc_id']}, {CODED.removeprefix('row long, ')}").withColumn(
        "row", F.monotonically_increasing_id())


def _token_type(s: Settings) -> type:
    return np.uint16 if 1 + s.words + s.hashed <= 1 << 16 else np.int32


def _tokens(column: pa.Array, i: int, s: Settings) -> np.ndarray:
    return np.frombuffer(column[i].as_py(), _token_type(s)).astype(np.int32)


def _round(coded: DataFrame, table: np.ndarray, flat: np.ndarray, turn: int, shards: int, s: Settings) -> np.ndarray:
    """One round of training: the average of the networks that the shards fit on their own texts."""
    sent = coded.sparkSession.sparkContext.broadcast((flat, table))

    def fit(key: tuple[pa.Scalar, ...], rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, table = sent.value
        net = Network(s).load(flat)
        g = [np.full_like(p, 1e-3) for p in net.parameters()]
        held, seen, waiting = [], 0, 0

        def learn() -> None:
            sides, y = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.random.default_rng(s.seed + turn + seen).permutation(len(y))
            for low in range(0, len(y), s.batch):
                some = order[low:low + s.batch]
                net.step(sides.take(some, axis=0), y[some], g)
            held.clear()

        for b in rows:
            column, seeds = b.column("tokens"), b.column("seed").to_pylist()
            for i, seed in enumerate(seeds):
                tokens = _tokens(column, i, s)
                every = _places(seed, len(tokens), turn, s)
                for low in range(0, len(every), s.piece):
                    at = every[low:low + s.piece]
                    held.append((windows(tokens, at, s), table[tokens[at]]))
                    seen, waiting = seen + len(at), waiting + len(at)
                    if waiting >= 5 * s.piece:
                        learn()
                        waiting = 0
        if held:
            learn()
        change = net.flat() if seen else np.zeros(0, np.float32)
        slots = np.arange(0, len(change), SLOT)
        yield pa.record_batch([pa.array(np.full(len(slots), key[0].as_py())), pa.array(slots // SLOT),
                               pa.array([change[a:a + SLOT].tobytes() for a in slots], pa.binary()),
                               pa.array(np.full(len(slots), seen))], ["fold", "slot", "part", "seen"])

    def add(key: tuple[pa.Scalar, ...], rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = None, 0
        for b in rows:
            for part, n in zip(b.column("part"), b.column("seen").to_pylist(), strict=True):
                x = np.frombuffer(part.as_py(), np.float32).astype(np.float64) * n
                total, seen = x if total is None else total + x, seen + n
        yield pa.record_batch([pa.array([k.as_py() for k in key[:1]], pa.int64()), pa.array([key[-1].as_py()], pa.int64()),
                               pa.array([(total / seen).astype(np.float32).tobytes()], pa.binary()), pa.array([seen], pa.int64())],
                              ["fold", "slot", "part", "seen"])

    kind = "fold long, slot long, part binary, seen long"
    texts = coded.filter(F.length("tokens") > 0).select(
        F.pmod(F.xxhash64("key", "doc_id"), F.lit(shards)).alias("shard"), "key", "seed", "tokens")
    parts = texts.repartition("shard").sortWithinPartitions("shard", "key").groupBy("shard").applyInArrow(fit, kind)
    some = parts.withColumn("fold", F.pmod("fold", F.lit(int(np.ceil(np.sqrt(shards)))))).groupBy("fold", "slot").applyInArrow(add, kind)
    got = some.groupBy("slot").applyInArrow(add, kind).select("slot", "part").collect()
    if not got:
        return flat
    return np.concatenate([np.frombuffer(bytes(r.part), np.float32) for r in sorted(got, key=lambda r: r.slot)])


def _train(coded: DataFrame, vocab: Vocabulary, shares: np.ndarray, s: Settings) -> Network:
    flat, shards = Network(s, shares).flat(), max(1, -(-int(vocab.totals.sum()) // s.shard))
    for turn in range(s.rounds):
        flat = _round(coded, vocab.class_table(), flat, turn, shards, s)
    return Network(s).load(flat)


def train(docs: DataFrame, s: Settings = Settings()) -> tuple[Vocabulary, Network]:
    attach(docs.sparkSession)
    vocab, shares = vocabulary(docs, s)
    return vocab, _train(cut_lineage(encode(docs, vocab, s), "tokens"), vocab, shares, s)


def score(docs: DataFrame, vocab: Vocabulary, net: Network, s: Settings = Settings()) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood) for every row of documents."""
    attach(docs.sparkSession)
    coded = encode(docs, vocab, s)
    return _score(coded if vocab.rare is None else cut_lineage(coded, "tokens"), vocab, net, s)


def train_and_score(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Scores of all documents by the network that they train, from one token table."""
    attach(docs.sparkSession)
    vocab, shares = vocabulary(docs, s)
    coded = cut_lineage(encode(docs, vocab, s), "tokens")
    return _score(coded, vocab, _train(coded, vocab, shares, s), s)


def _score(coded: DataFrame, vocab: Vocabulary, net: Network, s: Settings) -> DataFrame:
    sent = coded.sparkSession.sparkContext.broadcast((net.flat(), vocab.class_table()))

    def run(batches):
        flat, table = sent.value
        net = Network(s).load(flat)
        for b in batches:
            column = b.column("tokens")
            sums, sizes, held, waiting = np.zeros(b.num_rows), np.zeros(b.num_rows, np.int64), [], 0

            def flush() -> None:
                sides, y, owners = (np.concatenate(x) for x in zip(*held, strict=True))
                for low in range(0, len(y), 4096):
                    some = slice(low, low + 4096)
                    sums[:] += np.bincount(owners[some], net.log_probabilities(sides[some], y[some]), len(sums))
                held.clear()

            for i in range(b.num_rows):
                tokens = _tokens(column, i, s)
                sizes[i] = len(tokens)
                for low in range(0, len(tokens), s.piece):
                    at = np.arange(low, min(low + s.piece, len(tokens)))
                    held.append((windows(tokens, at, s), table[tokens[at]], np.full(len(at), i)))
                    waiting += len(at)
                    if waiting >= s.piece:
                        flush()
                        waiting = 0
            if held:
                flush()
            yield pa.record_batch([b.column("doc_id"), b.column("row"), pa.array(sizes),
                                   pa.array(sums + b.column("inside").to_numpy())], ["doc_id", "row", "n_tokens", "log_likelihood"])

    rows = coded.select("doc_id", "row", "tokens", "inside").mapInArrow(
        run, f"doc_id {dict(coded.dtypes)['doc_id']}, row long, n_tokens long, log_likelihood double")
    if vocab.rare is not None:
        rows = rows.join(_rare_shares(coded, vocab), "row", "left").withColumn(
            "log_likelihood", F.col("log_likelihood") + F.coalesce("more", F.lit(0.0)))
    return rows.select("doc_id", "n_tokens", "log_likelihood", F.when(
        F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")).alias("mean_log_likelihood"))


def _rare_shares(coded: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(row, more): the sum of log P(word | class) over the words of a text whose counts were not broadcast."""
    sent = coded.sparkSession.sparkContext.broadcast(replace(vocab, counts={}, rare=None))
    used = coded.select("row", F.inline("rare"))

    def share(words: pa.Array, counts: pa.Array) -> pa.Array:
        vocab = sent.value
        words = words.to_pylist()
        classes = vocab.class_table()[vocab.tokens(words)].tolist()
        return pa.array([vocab.share(*x) for x in zip(words, counts.to_pylist(), classes, strict=True)], pa.float64())

    each = used.select("word").distinct().join(vocab.rare, "word", "left").select(
        "word", F.arrow_udf(share, "double")("word", F.coalesce("n", F.lit(0))).alias("share"))
    return used.join(each, "word").groupBy("row").agg(F.sum(F.col("times") * F.col("share")).alias("more"))
