"""Language identification: the nearest of several clustered centroids per language, by cosine, with rejection.

A text is a sparse vector of its character n-grams (one to three lower-cased letters; every run of anything else is one
word border), hashed to a fixed number of slots, damped counts times inverse document frequency, of unit length. The
frequencies come from every learnable document; the centroids of a language from a clustering (spherical k-means,
farthest-first seeds) of at most ``per_language`` of its documents and ``sample`` in all, picked by a hash. Each language
also keeps the similarity that all but ``reject_share`` of its sample reach; a text further from its nearest centroid is
``rejected``. The language of the nearest centroid is given in any case, so a caller may trust it or not.

The model has a fixed size per language (``centroids`` rows of ``slots`` numbers); scoring is one map over the table.
Very long texts are read in pieces of bounded size, whole; a vector does not depend on where the pieces end.

Defined cases: a null text, or one without any letter, is ``und`` with score 0 and rejected; so is every text when there
is nothing to learn from. Null languages are not learnt. Equal similarities fall to the language first by code point.
Repeated rows get equal rows; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearspan.session import attach, cut_lineage

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    slots: int = 1 << 14
    per_language: int = 600
    sample: int = 20_000
    centroids: int = 4
    rounds: int = 6
    reject_share: float = 0.01
    piece: int = 1 << 18
    batch_chars: int = 1 << 18
    batch_rows: int = 64


@dataclass(frozen=True)
class Model:
    """``centres`` (rows, slots) of unit length; ``owner`` names the language of each row, ``floor`` its least similarity."""

    weights: np.ndarray
    centres: np.ndarray
    owner: list[str]
    floor: np.ndarray
    settings: Settings


def held_out(doc_id: Column) -> Column:
    """The rows whose language is never learnt; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


# ---- vectors

@cache
def _letters() -> np.ndarray:
    """True at every code point that is a letter."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def _mix(n: int, *points: np.ndarray, slots: int) -> np.ndarray:
    h = np.full(len(points[0]), 0x9E3779B9 * n & 0xFFFFFFFF, np.uint32)
    for p in points:
        h = (h ^ p) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
    return (h % np.uint32(slots)).astype(np.int64)


def _count(texts: list[str], s: Settings) -> np.ndarray:
    """(texts, slots) n-gram counts of a few short texts, read as one array of code points."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts)), np.fromiter((len(t) + 1 for t in lowered), np.int64, len(texts)))
    points, row = np.where(_letters()[points], points, 0), np.r_[0, row]
    keep = (points > 0) | np.r_[True, points[:-1] > 0]
    points, row = points[keep], row[keep]
    if points[-1]:
        points, row = np.r_[points, 0].astype(np.uint32), np.r_[row, row[-1]]
    middle = np.flatnonzero(points > 0)
    if not len(middle):
        return np.zeros((len(texts), s.slots))
    a, b, c, r = points[middle - 1], points[middle], points[middle + 1], row[middle] * s.slots
    last = c == 0  # a pair belongs to its first letter, and to its second at the start of a word
    first = a == 0
    at = np.concatenate([r + _mix(1, b, slots=s.slots), r + _mix(2, b, c, slots=s.slots),
                         (r + _mix(2, a, b, slots=s.slots))[first], (r + _mix(3, a, b, c, slots=s.slots))[~(first & last)]])
    return np.bincount(at, minlength=len(texts) * s.slots).reshape(len(texts), s.slots)


def counts(texts: list[str], s: Settings) -> np.ndarray:
    """(texts, slots) n-gram counts. A long text is cut at word borders into pieces whose counts add up."""
    if max(map(len, texts), default=0) <= s.piece:
        return _count(texts, s)
    out = np.zeros((len(texts), s.slots))
    for i, text in enumerate(texts):
        for piece in _pieces(text, s.piece):
            out[i] += _count([piece], s)[0]
    return out


def _pieces(text: str, size: int):
    """Cuts at non-letters, so that no n-gram lies across; a run of letters longer than ``size`` stays in one piece."""
    start, n = 0, len(text)
    while start < n:
        end = min(start + size, n)
        while end < n and text[end].isalpha():
            end += 1
        yield text[start:end]
        start = end


def _slices(texts: pa.Array, s: Settings):
    """(position, texts) of a few rows at a time."""
    part, low, chars = [], 0, 0
    for i in range(len(texts)):
        part.append(texts[i].as_py() or "")
        chars += len(part[-1])
        if chars > s.batch_chars or len(part) == s.batch_rows:
            yield low, part
            part, low, chars = [], i + 1, 0
    if part:
        yield low, part


def vectors(found: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Damped counts times weights, of unit length (zero without any letter)."""
    x = np.zeros(found.shape, np.float32)
    at = np.nonzero(found)
    x[at] = (1 + np.log(found[at])) * weights[at[1]]
    length = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(length > 0, length, 1)[:, None]


# ---- training

def train(docs: DataFrame, s: Settings = Settings()) -> Model:
    """Learns from (text, lang) of the rows of documents whose id is not held out."""
    attach(docs.sparkSession)
    known = docs.filter(~held_out(F.col("doc_id"))).filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    weights = _weights(known, s)
    sizes = cut_lineage(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-sizes")
    sizes = F.broadcast(sizes) if sizes.count() <= s.sample else sizes
    wanted = F.least(F.lit(1.0), 4.0 * s.per_language / F.col("n"))  # so few rows of a language that one task ranks them
    pick = Window.partitionBy("lang").orderBy("h", "id")
    turn = (known.select("lang", F.xxhash64("doc_id").alias("h"), F.col("doc_id").cast("string").alias("id"))
            .join(sizes, "lang").where(F.col("h") / 2.0 ** 64 + 0.5 <= wanted)
            .withColumn("turn", F.row_number().over(pick)).where(F.col("turn") <= s.per_language)
            .orderBy("turn", "h", "id", "lang").limit(s.sample).select("id", F.col("lang").alias("of")).distinct())
    sample = known.join(F.broadcast(turn), F.col("doc_id").cast("string").eqNullSafe(F.col("id")) & (F.col("lang") == F.col("of")))
    sample = cut_lineage(sample.groupBy("id", "lang").agg(F.min("text").alias("text")), "language-sample")

    def cluster(table: pa.Table) -> pa.Table:
        texts = table.sort_by("id").column("text").combine_chunks()
        x = np.concatenate([vectors(counts(part, s), weights) for _, part in _slices(texts, s)])
        centres, floor = clusters(x, s)
        raw = pa.array([c.astype(np.float32).tobytes() for c in centres], pa.binary())
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(centres), pa.string()),
                         "part": pa.array(range(len(centres)), pa.int32()), "centre": raw,
                         "floor": pa.array([floor] * len(centres), pa.float64())})

    found = sample.groupBy("lang").applyInArrow(cluster, "lang string, part int, centre binary, floor double").collect()
    found.sort(key=lambda r: (r.lang, r.part))
    centres = np.frombuffer(b"".join(r.centre for r in found), np.float32).reshape(len(found), s.slots)
    return Model(weights, centres, [r.lang for r in found], np.array([r.floor for r in found]), s)


def _weights(known: DataFrame, s: Settings) -> np.ndarray:
    """Inverse document frequency of every slot, over all learnable documents; tasks return one row per slot at most."""
    def frequencies(batches):
        seen, total = np.zeros(s.slots, np.int64), 0
        for b in batches:
            for _, part in _slices(b.column(0), s):
                seen += (counts(part, s) > 0).sum(axis=0)
                total += len(part)
        at = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(np.r_[at, -1]), pa.array(np.r_[seen[at], total])], ["slot", "n"])

    rows = known.select("text").mapInArrow(frequencies, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(s.slots + 1)
    seen[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    return np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1


def clusters(x: np.ndarray, s: Settings) -> tuple[np.ndarray, float]:
    """Unit centroids of one language and the similarity that all but a small share of ``x`` reach."""
    x = x[np.einsum("ij,ij->i", x, x) > 0]
    if not len(x):
        return np.empty((0, x.shape[1]), np.float32), 0.0
    centres = [_unit(x.mean(axis=0))]
    near = x @ centres[0]
    while len(centres) < min(s.centroids, len(x)) and near.min() < 1 - 1e-6:
        centres.append(x[near.argmin()])
        near = np.maximum(near, x @ centres[-1])
    c = np.stack(centres)
    for _ in range(s.rounds):
        mine = (x @ c.T).argmax(axis=1)
        c = np.stack([_unit(x[mine == j].mean(axis=0)) if (mine == j).any() else c[j] for j in range(len(c))])
    return c, float(np.quantile((x @ c.T).max(axis=1), s.reject_share))


def _unit(v: np.ndarray) -> np.ndarray:
    return v / max(np.sqrt(v @ v), 1e-12)


# ---- scoring

def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected): the nearest language, its cosine, and whether it lies too far."""
    attach(docs.sparkSession)
    s = model.settings
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            names, score, far = np.full(b.num_rows, UNKNOWN, object), np.zeros(b.num_rows), np.ones(b.num_rows, bool)
            if m.owner:
                for low, part in _slices(b.column("text"), s):
                    found = counts(part, s)
                    near = vectors(found, m.weights) @ m.centres.T
                    best = near.argmax(axis=1)
                    some = found.any(axis=1)
                    at = np.flatnonzero(some) + low
                    names[at] = [m.owner[j] for j in best[some]]
                    value = near[np.arange(len(part)), best].astype(np.float64)
                    score[at] = np.clip(np.round(value[some], 6), 0, 1)
                    far[at] = (value < m.floor[best])[some]
            yield pa.record_batch([b.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(far)],
                                  ["doc_id", "lang_pred", "score", "rejected"])

    given = docs.select("doc_id", "text")
    out = given.mapInArrow(run, f"doc_id {dict(given.dtypes)['doc_id']}, lang_pred string, score double, rejected boolean")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
