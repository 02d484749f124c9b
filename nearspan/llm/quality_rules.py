"""Quality rules whose cutoffs come from labelled holdouts, with a bound on false rejections.

Each text gives a few figures (words, symbols, repeated lines and windows, capitals). A rule rejects a text when
its figure lies above the cutoff of the text's stratum. Cutoffs are tested from the loosest to the strictest; a
cutoff is certified while an exact binomial test refutes "more than ``risk`` of the good texts are rejected".
Testing along a fixed order needs no correction inside one order; the level is divided by the number of orders
(strata times rules), and the risk of a stratum is divided among its rules, so that with probability
``confidence`` no stratum loses more than ``max_false_rejection`` of its good texts. Among the certified cutoffs
the one that separates the labels best is used, the loosest of equals; without evidence a rule stays unused.

Defined cases: a null text is an empty text; without words it fails the base. Labels that are null, of null or
unknown documents are unused; a document labelled twice is good only if all its labels say so. Copies of
a text count once as evidence. Repeated rows each get the same verdict. Extra columns pass through
:func:`keep_good` and never clash: the figures live in one struct column with a private name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearspan.session import attach, bound_batches, cut_lineage

FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks",
          "n_wide", "digest")
BASE = FIELDS[:5]
SPACE, SYMBOLS, MARKS = b" \t\n\r\x0b\x0c", b"#*$%&|<>", b"!?"
CAPITALS = bytes(range(65, 91))
_PRIVATE = "__text_figures"


@dataclass(frozen=True)
class Settings:
    max_false_rejection: float = 0.02
    confidence: float = 0.95
    steps: int = 40


#: Loosest cutoff of each rule; every further step of the order is 0.85 times the one before.
LOOSEST = {"symbols": 1.0, "capitals": 1.0, "marks": 1.0, "dup_lines": 1.0, "repeats": 1.0}


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    width = len(known)
    if width == n:
        return 0
    codes = ids[:-1] * width + ids[1:]
    if width > 2_000_000:
        codes = np.unique(codes, return_inverse=True)[1]
    codes = codes[:-1] * width + ids[2:]
    order = np.argsort(codes, kind="stable")
    equal = codes[order[1:]] == codes[order[:-1]]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    hit = np.zeros(n, bool)
    for shift in range(3):
        hit[shift:n - 2 + shift] |= twice
    return int(hit.sum())


def figures_of(raw: bytes, chars: int) -> tuple[int, ...]:
    """The figures of one UTF-8 text of so many code points, in the order of FIELDS."""
    words = raw.split()
    blanks = len(raw) - len(raw.translate(None, SPACE))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), chars - blanks, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words), len(lines), len(raw) - len(raw.translate(None, CAPITALS)),
            len(raw) - len(raw.translate(None, MARKS)), len(raw) - chars, xxhash.xxh3_64_intdigest(raw) >> 1)


def _figures(texts: pa.Array) -> pa.Array:
    chars = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
    raws = texts.cast(pa.large_binary())
    rows = [figures_of(raws[i].as_py() or b"", chars[i]) for i in range(len(raws))]
    table = np.array(rows, dtype=np.int64).reshape(len(rows), len(FIELDS))
    return pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(len(FIELDS))], list(FIELDS))


def figures(text: Column) -> Column:
    """Struct of FIELDS for a text column."""
    kind = "struct<" + ",".join(f"{f}:bigint" for f in FIELDS) + ">"
    return F.arrow_udf(_figures, kind)(text)


def base_failed(f: Column) -> Column:
    return (f.n_words < 50) | (100 * f.n_repeat_words > 50 * f.n_words)


def stratum(f: Column) -> Column:
    """Three lengths, each for plain and for accented scripts."""
    band = F.when(f.n_words < 200, 0).when(f.n_words < 800, 2).otherwise(4)
    return band + F.when(100 * f.n_wide > f.word_chars, 1).otherwise(0)


STRATA = 6


def _rates(f: Column) -> dict[str, Column]:
    words, lines = F.greatest(f.n_words, F.lit(1)), F.greatest(f.n_lines, F.lit(1))
    return {"symbols": f.n_symbols / words, "capitals": f.n_upper / F.greatest(f.word_chars, F.lit(1)),
            "marks": f.n_marks / words, "dup_lines": f.n_dup_lines / lines, "repeats": f.n_repeat_words / words}


def grid(rule: str, steps: int) -> list[float]:
    return [LOOSEST[rule] * 0.85 ** i for i in range(steps)]


def at_most(k: int, n: int, p: float) -> float:
    """Exact P(X <= k) of a binomial(n, p): the incomplete beta function I(1-p; n-k, k+1)."""
    if k >= n:
        return 1.0
    return _beta(n - k, k + 1, 1 - p)


def _beta(a: float, b: float, x: float) -> float:
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta(b, a, 1 - x)
    if x <= 0:
        return 0.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, total, c, d = 1e-300, 1.0, 1.0, 0.0
    for i in range(2000):
        m = i // 2
        if i == 0:
            term = 1.0
        elif i % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / ((1 + term * d) or tiny)
        c = (1 + term / c) or tiny
        total *= c * d
        if abs(1 - c * d) < 1e-12:
            break
    return min(1.0, front * (total - 1))


def choose(counts: dict[tuple[int, str, int, int], int], settings: Settings = Settings()) -> dict[tuple[int, str], float]:
    """Cutoffs by (stratum, rule) from counts by (stratum, rule, level, quality).

    A level is the number of the order's cutoffs that the figure exceeds.
    """
    rules = list(LOOSEST)
    risk = settings.max_false_rejection / len(rules)
    level = (1 - settings.confidence) / (STRATA * len(rules))
    out: dict[tuple[int, str], float] = {}
    for s in range(STRATA):
        for rule in rules:
            cuts, m = grid(rule, settings.steps), settings.steps
            by = [[counts.get((s, rule, lv, q), 0) for lv in range(m + 1)] for q in (0, 1)]
            bad, good = sum(by[0]), sum(by[1])
            best, gain = None, 0.0
            for i in range(m):
                # a figure above cutoff i is above the stricter cutoffs i..m-1 as well: its level is m - i or more
                false = sum(by[1][m - i:])
                if good == 0 or at_most(false, good, risk) > level:
                    break
                now = sum(by[0][m - i:]) / max(bad, 1) - 10 * false / good
                if now > gain + 1e-12:
                    best, gain = cuts[i], now
            if best is not None:
                out[s, rule] = best
    return out


def _level(rate: Column, cuts: list[float]) -> Column:
    """How many of the cutoffs the rate exceeds."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: rate > c))


def calibrate(measured: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> dict[tuple[int, str], float]:
    """Cutoffs from a table (doc_id, f) of figures and labels (doc_id, quality).

    What comes to the driver are counts by stratum, rule, level and label: at most 6 x 5 x 41 x 2 rows.
    """
    marks = (labels.select("doc_id", "quality").dropna().groupBy("doc_id")
             .agg(F.min("quality").cast("int").alias("q")))
    f = F.col("f")
    seen = (measured.select("doc_id", "f").join(marks, "doc_id").filter(~base_failed(f)).select("f", "q").distinct())
    levels = [F.struct(F.lit(rule).alias("rule"), _level(rate, grid(rule, settings.steps)).alias("level"))
              for rule, rate in _rates(f).items()]
    rows = (seen.select(stratum(f).alias("s"), "q", F.explode(F.array(*levels)).alias("x"))
            .groupBy("s", "q", "x.rule", "x.level").count().collect())
    return choose({(r.s, r["rule"], r.level, r.q): r["count"] for r in rows}, settings)


def rejected(f: Column, cutoffs: dict[tuple[int, str], float]) -> Column:
    """True where the method's rules reject."""
    rates, out = _rates(f), F.lit(False)
    for (s, rule), cut in sorted(cutoffs.items()):
        out = out | ((stratum(f) == s) & (rates[rule] > F.lit(cut)))
    return out


def judge(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, f, base_failed, kept) for every row of documents (doc_id, text)."""
    attach(docs.sparkSession)
    bound_batches(docs.sparkSession)
    measured = cut_lineage(docs.select("doc_id", figures(F.col("text")).alias("f")), "figures")
    f, cutoffs = F.col("f"), calibrate(measured, labels, settings)
    return measured.select("doc_id", "f", base_failed(f).alias("base_failed"),
                           (~base_failed(f) & ~rejected(f, cutoffs)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of documents that no rule rejects, with all their columns.

    Only figures are joined with labels; texts are read once more and filtered where they lie.
    """
    attach(docs.sparkSession)
    bound_batches(docs.sparkSession)
    # written first: else the filters of the calibration find the figures once more
    measured = cut_lineage(docs.select("doc_id", figures(F.col("text")).alias("f")), "figures")
    cutoffs, f = calibrate(measured, labels, settings), F.col(_PRIVATE)
    return (docs.withColumn(_PRIVATE, figures(F.col("text")))
            .filter(~base_failed(f) & ~rejected(f, cutoffs)).drop(_PRIVATE))
