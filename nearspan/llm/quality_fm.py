"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text is a sparse vector: its distinct words, hashed, with damped counts of unit length; one indicator per
structure statistic (symbols, capitals, repeats, lengths, ...) for the interval it falls into; and the interval
of the ``n_chars`` column. The score is a logistic function of w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j,
where the pairs cost linear time: half of sum_f (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2.

The machine is fitted on at most ``Settings.sample`` labelled documents (a fixed bound, whatever the corpus);
scoring is one map over the whole table and the model has a fixed size.

Defined cases: null and empty texts are scored from their statistics; null n_chars has an interval of its own;
without usable labels every score is 0.5; repeated rows get equal scores; only named columns are used.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearspan.llm.features import WORD, bucket, held_out, labelled_sample
from nearspan.llm.quality_rules import FIELDS, figures_of
from nearspan.session import attach


@dataclass(frozen=True)
class Settings:
    sample: int = 15_000
    buckets: int = 1 << 16
    rank: int = 8
    epochs: int = 8
    batch: int = 256
    rate: float = 0.05
    decay: float = 1e-5
    seed: int = 7


BINS, STATISTICS = 16, 11


def _bin(value: float, scale: float) -> int:
    """Interval of a rate: 0 for zero, then by halves below ``scale``."""
    if value <= 0:
        return 0
    return int(min(BINS - 1, max(1, BINS - 2 + np.floor(np.log2(value / scale)))))


def statistics(raw: bytes, chars: int, distinct: int, total: int, n_chars: int | None) -> list[int]:
    f = dict(zip(FIELDS, figures_of(raw, chars), strict=True))
    words, lines, letters = max(f["n_words"], 1), max(f["n_lines"], 1), max(f["word_chars"], 1)
    return [_bin(f["n_symbols"] / words, 4), _bin(f["n_upper"] / letters, 1), _bin(f["n_marks"] / words, 2),
            _bin(f["n_dup_lines"] / lines, 1), _bin(f["n_repeat_words"] / words, 1), _bin(f["n_wide"] / letters, 1),
            _bin(letters / words, 64), _bin(f["n_words"], 1 << 14), _bin(words / lines, 1 << 12),
            _bin(distinct / max(total, 1), 1), BINS - 1 if n_chars is None else min(BINS - 2, _bin(n_chars, 1 << 17))]


def vector(raw: bytes, chars: int, n_chars: int | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of one text."""
    found = WORD.findall(raw.lower())
    counts = Counter(found)
    k = len(counts)
    at = np.empty(k + STATISTICS, np.int32)
    x = np.empty(k + STATISTICS, np.float32)
    at[:k] = [bucket(w, buckets) for w in counts]
    if k:
        x[:k] = 1 + np.log(np.fromiter(counts.values(), np.float32, k))
        x[:k] /= np.sqrt((x[:k] ** 2).sum())
    bins = statistics(raw, chars, k, len(found), n_chars)
    at[k:] = [buckets + s * BINS + b for s, b in enumerate(bins)]
    x[k:] = 0.5
    return at, x


@dataclass
class Machine:
    w0: float
    w: np.ndarray
    v: np.ndarray
    buckets: int

    def margins(self, at: np.ndarray, x: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One margin per text; texts lie one after the other and end at ``ends``."""
        starts = np.concatenate([[0], ends[:-1]])
        vx = self.v[at] * x[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat((vx * vx).sum(axis=1), starts)
        return self.w0 + np.add.reduceat(self.w[at] * x, starts) + 0.5 * ((sums * sums).sum(axis=1) - squares)


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], s: Settings = Settings()) -> Machine:
    """Adagrad over shuffled batches of the logistic loss."""
    rng = np.random.default_rng(s.seed)
    width = s.buckets + STATISTICS * BINS
    model = Machine(0.0, np.zeros(width, np.float32), rng.normal(0, 0.02, (width, s.rank)).astype(np.float32), s.buckets)
    if not rows:
        model.v[:] = 0
        return model
    y = np.array([r[0] for r in rows], np.float32)
    share = (y.sum() + 1) / (len(y) + 2)
    model.w0 = float(np.log(share / (1 - share)))
    g0, gw, gv = 1e-8, np.full(width, 1e-8, np.float32), np.full((width, s.rank), 1e-8, np.float32)
    for _ in range(s.epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), s.batch):
            part = [rows[j] for j in order[i:i + s.batch]]
            at = np.concatenate([p[1] for p in part])
            x = np.concatenate([p[2] for p in part])
            size = np.array([len(p[1]) for p in part])
            ends = size.cumsum()
            error = 1 / (1 + np.exp(-model.margins(at, x, ends))) - y[order[i:i + s.batch]]
            e = np.repeat(error, size).astype(np.float32)
            vx = model.v[at] * x[:, None]
            sums = np.repeat(np.add.reduceat(vx, np.concatenate([[0], ends[:-1]]), axis=0), size, axis=0)
            used, inverse = np.unique(at, return_inverse=True)
            dw = np.bincount(inverse, e * x, len(used)) / len(part) + s.decay * model.w[used]
            full = (e * x)[:, None] * (sums - vx)
            dv = np.stack([np.bincount(inverse, full[:, f], len(used)) for f in range(s.rank)], axis=1) / len(part)
            dv += s.decay * model.v[used]
            g0 += float(error.mean()) ** 2
            gw[used] += dw * dw
            gv[used] += dv * dv
            model.w0 -= s.rate * float(error.mean()) / g0 ** 0.5
            model.w[used] -= s.rate * dw / np.sqrt(gw[used])
            model.v[used] -= s.rate * dv / np.sqrt(gv[used])
    return model


def _vectors(texts: pa.Array, n_chars: pa.Array, buckets: int):
    raws, chars = texts.cast(pa.large_binary()), pc.fill_null(pc.utf8_length(texts), 0)
    for i in range(len(raws)):
        yield vector(raws[i].as_py() or b"", chars[i].as_py(), n_chars[i].as_py(), buckets)


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Machine:
    attach(docs.sparkSession)
    buckets = s.buckets

    def featurise(batches):
        for b in batches:
            rows = list(_vectors(b.column("text"), b.column("n_chars"), buckets))
            yield pa.record_batch([b.column("doc_id"), b.column("y"), pa.array([r[0].tobytes() for r in rows], pa.binary()),
                                   pa.array([r[1].tobytes() for r in rows], pa.binary())], ["doc_id", "y", "at", "x"])

    sample = labelled_sample(docs, labels, "quality", s.sample, "n_chars")
    kind = f"doc_id {dict(sample.dtypes)['doc_id']}, y int, at binary, x binary"
    rows = sample.mapInArrow(featurise, kind).collect()
    rows.sort(key=lambda r: str(r.doc_id))
    return fit([(r.y, np.frombuffer(r["at"], np.int32), np.frombuffer(r["x"], np.float32)) for r in rows], s)


def score(docs: DataFrame, model: Machine, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of documents (doc_id, text, n_chars)."""
    attach(docs.sparkSession)
    given = docs.select("doc_id", "text", F.col("n_chars").cast("long").alias("n_chars"))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            out = np.empty(b.num_rows)
            texts, n_chars = b.column("text"), b.column("n_chars")
            for low in range(0, b.num_rows, 64):
                rows = list(_vectors(texts.slice(low, 64), n_chars.slice(low, 64), model.buckets))
                ends = np.cumsum([len(r[0]) for r in rows])
                out[low:low + len(rows)] = model.margins(np.concatenate([r[0] for r in rows]),
                                                         np.concatenate([r[1] for r in rows]), ends)
            yield pa.record_batch([b.column("doc_id"), pa.array(1 / (1 + np.exp(-out)))], ["doc_id", "score"])

    scored = given.mapInArrow(run, f"doc_id {dict(given.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
