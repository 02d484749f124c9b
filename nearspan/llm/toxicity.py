"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posteriors.

Voters are lexicons and patterns. Some are written down here; others are mined from the labelled sample: words and
word beginnings that are much more frequent in texts marked toxic, dealt over several voters, so that no single
list decides. A voter votes toxic (1) or is silent (0). The label model is a two-class generative model fitted by
expectation maximisation on the votes alone: each voter's rate of voting in either class (its accuracy), and the
correlation of the voters inside a class, by which voters that repeat each other are discounted. Its posteriors
are the training labels of a sparse logistic regression over hashed words and word beginnings, which scores all
texts.

Labels are read of at most ``Settings.sample`` documents (a fixed bound); scoring is one map over the whole table.

Defined cases: null and empty texts score as texts without any word; without usable labels only the written
voters and a prior of one tenth are used; repeated rows get equal scores; only named columns are used.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearspan.llm.features import LETTERS, held_out, labelled_sample
from nearspan.session import attach


@dataclass(frozen=True)
class Settings:
    sample: int = 8_000
    buckets: int = 1 << 18
    mined_voters: int = 12
    mined_patterns: int = 240
    evidence: float = 30.0
    rounds: int = 25
    epochs: int = 8
    steps: int = 800
    batch: int = 128
    rate: float = 0.3
    sparsity: float = 3e-4
    seed: int = 11


#: Plain insults by language, each list one voter.
LEXICONS = {
    "people": "idiot moron imbecile clown loser scum bastard creep freak weirdo degenerate parasite",
    "worth": "worthless pathetic useless disgusting stupid dumb trash garbage filth vermin vile repulsive",
    "hate": "hate despise loathe",
    "german": "idiot dumm dumme dummer trottel depp arschloch abschaum versager widerlich wertlos",
    "french": "idiot imbécile crétin connard salaud ordure débile minable dégueulasse nul pourriture",
    "spanish": "idiota imbécil estúpido basura escoria payaso inútil asqueroso patético cabrón",
}
PATTERNS = {
    "address": re.compile(r"\b(?:you|your|you're|u)\s+(?:are\s+|re\s+)?(?:a\s+|an\s+|such\s+)?(?:\w+\s+)?(?:idiot|moron|loser|clown|scum|trash)\b"),
    "masked": re.compile(r"\b[a-z]+[@*#$]+[a-z]*(?:t|n|k|d)\b\s+(?:you|off)"),
    "stretched": re.compile(r"\b(?:lo+ser|id+i+o+t|stu+pid|mo+ron|du+mb)\b"),
}


def beginnings(word: str) -> tuple[str, ...]:
    """What a word contributes: itself and its first four and five letters."""
    return (word, *(f"{word[:k]}~" for k in (4, 5) if len(word) > k))


def words_of(raw: bytes) -> set[bytes]:
    return set(LETTERS.findall(raw.lower()))


def sign(text: str) -> int:
    return zlib.crc32(text.encode("utf8", "replace"))


def signs(raw: bytes) -> np.ndarray:
    """Sorted 32-bit digests of the distinct signs of a text."""
    return np.array(sorted({sign(s) for w in words_of(raw) for s in beginnings(w.decode("utf8", "replace").lower())}),
                    np.uint32)


def written_votes(raw: bytes) -> list[int]:
    """Votes of the lexicons and the patterns."""
    text = raw.lower().decode("utf8", "replace")
    found = {w.decode("utf8", "replace").lower() for w in words_of(raw)}
    return ([int(not found.isdisjoint(x.split())) for x in LEXICONS.values()]
            + [int(p.search(text) is not None) for p in PATTERNS.values()])


def evidence(a: int, n: int, b: int, m: int) -> float:
    """Likelihood ratio statistic of a/n above b/m; 0 unless the first share is eight times the second."""
    if not n or not m or a / n < 8 * b / m:
        return 0.0
    share = (a + b) / (n + m)
    parts = ((a, n * share), (n - a, n * (1 - share)), (b, m * share), (m - b, m * (1 - share)))
    return 2 * sum(x * np.log(x / e) for x, e in parts if x)


def mine(y: np.ndarray, found: list[np.ndarray], s: Settings = Settings()) -> list[np.ndarray]:
    """Signs of the toxic rows, the clearest first, dealt over the voters in turn: one array per voter."""
    n = [int((y == 0).sum()), int((y != 0).sum())]
    empty = [np.zeros(0, np.uint32)]
    signs_of = [np.concatenate(empty + [f for f, t in zip(found, y, strict=True) if bool(t) == c]) for c in (False, True)]
    kinds, toxic = np.unique(signs_of[1], return_counts=True)
    clean = np.bincount(np.searchsorted(kinds, signs_of[0][np.isin(signs_of[0], kinds)]), minlength=len(kinds)) \
        if len(kinds) else np.zeros(0, int)
    scored = [(evidence(int(a), n[1], int(b), n[0]), int(w)) for w, a, b in zip(kinds, toxic, clean, strict=True) if a > 2]
    best = sorted((v for v in scored if v[0] >= s.evidence), key=lambda v: (-v[0], v[1]))[:s.mined_patterns]
    return [np.array([w for _, w in best[i::s.mined_voters]], np.uint32) for i in range(s.mined_voters)]


@dataclass
class LabelModel:
    """Rates of voting by class, and the weight that is left of each voter beside those it repeats."""

    prior: float
    rates: np.ndarray
    weights: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        yes = np.log(self.rates[1] / self.rates[0]) * self.weights
        no = np.log((1 - self.rates[1]) / (1 - self.rates[0])) * self.weights
        odds = np.log(self.prior / (1 - self.prior)) + votes @ yes + (1 - votes) @ no
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def label_model(votes: np.ndarray, prior: float, s: Settings = Settings()) -> LabelModel:
    """Expectation maximisation from the number of votes, first with independent voters, then with discounted ones.

    Correlations are those left inside the classes; a voter is never believed to vote more in clean texts.
    """
    votes = votes.astype(float)
    n, m = votes.shape
    model = LabelModel(prior, np.tile([[0.01], [0.2]], (1, m)), np.ones(m))
    q = 1 - 0.5 ** votes.sum(axis=1)
    for i in range(2 * s.rounds if n else 0):
        shares = np.stack([1 - q, q])
        rates = (shares @ votes + np.array([[0.02], [0.5]])) / (shares.sum(axis=1, keepdims=True) + np.array([[20.0], [2.0]]))
        rates[1] = np.maximum(rates[1], rates[0])
        weights = model.weights
        if i == s.rounds:
            centred = votes - q[:, None] * rates[1] - (1 - q)[:, None] * rates[0]
            spread = np.sqrt(np.maximum((centred ** 2).mean(axis=0), 1e-12))
            corr = np.clip(centred.T @ centred / n / spread[:, None] / spread[None, :], 0, 1)
            np.fill_diagonal(corr, 1)
            weights = 1 / corr.sum(axis=1)
        model = LabelModel(prior, np.clip(rates, 1e-6, 1 - 1e-6), weights)
        q = model.posterior(votes)
    return model


@dataclass
class Classifier:
    """Sparse logistic regression: log odds of a text are the sum of its distinct signs' weights."""

    bias: float
    weights: np.ndarray

    def scorer(self):
        """Function of raw text; words are looked up once, only signs of some weight are kept."""
        size, weights, known = len(self.weights), self.weights, {}

        def of(word: bytes) -> tuple[int, ...]:
            at = {sign(s) % size for s in beginnings(word.decode("utf8", "replace").lower())}
            return tuple(i for i in at if weights[i])

        def score(raw: bytes) -> float:
            if len(known) > 400_000:
                known.clear()
            hit: set[int] = set()
            for w in words_of(raw):
                got = known.get(w)
                if got is None:
                    got = known[w] = of(w)
                if got:
                    hit.update(got)
            odds = self.bias + sum(float(weights[i]) for i in sorted(hit))
            return float(1 / (1 + np.exp(-np.clip(odds, -40, 40))))

        return score


def fit_linear(found: list[np.ndarray], q: np.ndarray, s: Settings = Settings()) -> Classifier:
    """Adagrad with soft thresholding on posterior labels; few rows are passed over more often."""
    rng = np.random.default_rng(s.seed)
    rows = [np.unique(f % np.uint32(s.buckets)).astype(np.int32) for f in found]
    share = float((q.sum() + 1) / (len(q) + 2))
    weights, g, bias, gb = np.zeros(s.buckets), np.full(s.buckets, 1e-4), float(np.log(share / (1 - share))), 1e-4
    passes = max(s.epochs, s.steps * s.batch // max(len(rows), 1))
    for _ in range(passes if rows else 0):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), s.batch):
            part = order[i:i + s.batch]
            size = np.array([len(rows[j]) for j in part])
            at = np.concatenate([rows[j] for j in part])
            owner = np.repeat(np.arange(len(part)), size)
            odds = bias + np.bincount(owner, weights[at], len(part))
            error = 1 / (1 + np.exp(-np.clip(odds, -40, 40))) - q[part]
            used, inverse = np.unique(at, return_inverse=True)
            grad = np.bincount(inverse, error[owner], len(used)) / len(part)
            g[used] += grad * grad
            step = s.rate / np.sqrt(g[used])
            moved = weights[used] - step * grad
            weights[used] = np.sign(moved) * np.maximum(np.abs(moved) - step * s.sparsity, 0)
            gb += float(error.mean()) ** 2
            bias -= s.rate * 0.1 * float(error.mean()) / gb ** 0.5
    return Classifier(bias, weights.astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Classifier:
    """Voters, label model and classifier from the bounded sample; only its distinct words reach the driver."""
    attach(docs.sparkSession)
    sample = labelled_sample(docs, labels, "toxic", s.sample)

    def shrink(batches):
        for b in batches:
            raws = [x.as_py() or b"" for x in b.column("text").cast(pa.large_binary())]
            yield pa.record_batch([b.column("doc_id"), b.column("y"), pa.array([signs(x).tobytes() for x in raws], pa.binary()),
                                   pa.array([written_votes(x) for x in raws], pa.list_(pa.int32()))],
                                  ["doc_id", "y", "signs", "votes"])

    kind = f"doc_id {dict(sample.dtypes)['doc_id']}, y int, signs binary, votes array<int>"
    rows = sorted(sample.mapInArrow(shrink, kind).collect(), key=lambda r: str(r.doc_id))
    y, found = np.array([r.y for r in rows]), [np.frombuffer(r.signs, np.uint32) for r in rows]
    mined = mine(y, found, s)
    votes = np.array([r.votes + [int(np.isin(f, m).any()) for m in mined] for r, f in zip(rows, found, strict=True)])
    votes = votes.reshape(len(rows), len(LEXICONS) + len(PATTERNS) + len(mined))
    prior = (y.sum() + 1) / (len(y) + 10)
    return fit_linear(found, label_model(votes, prior, s).posterior(votes), s)


def score(docs: DataFrame, model: Classifier, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of documents (doc_id, text)."""
    attach(docs.sparkSession)
    given = docs.select("doc_id", "text")

    def run(batches):
        of = model.scorer()
        for b in batches:
            raws = b.column("text").cast(pa.large_binary())
            yield pa.record_batch([b.column("doc_id"), pa.array([of(raws[i].as_py() or b"") for i in range(len(raws))],
                                                                pa.float64())], ["doc_id", "score"])

    scored = given.mapInArrow(run, f"doc_id {dict(given.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
