"""Divergence of sources inside each language, by the terms they use; strings are fetched only for what is reported.

Tasks count the terms of their texts in memory and hand on 64-bit digests instead of strings: a count row is
(language, source, digest, occurrences). One row of each term of a language and task also has the string and the number of
documents; the least and the greatest string of a digest tell whether two terms share it. Digests that
two terms share are counted once more from the texts, with the string as second part of the key (``split``), so that
results are exact. All later steps
(document counts, sizes, ranks) shuffle digests; texts are joined back for the ranked terms alone.

Shares are whole numbers out of ``SCALE`` and all arithmetic is exact. The sum of a pair of sources over all kept terms
of their language comes from histograms: a term that neither has, or only one of them, adds a value that depends on one
count alone, so those are taken from the number of terms per count; only sources that do share a term meet, and they are
counted by their two counts before any value is computed. Sums fit 64 bits for up to 10^9 kept terms of a language.

Defined cases: null text, language and source are ''. Every occurring (language, source) is a group, also without any
term. Repeated rows are documents of their own. A language without kept terms has pairs of value 0 and no terms. Ties
rank by the UTF-8 order of the item. Long texts are counted whole. A task counts the terms
of many texts at once, taken in blocks of four bytes an entry of ``Settings.entries`` until they are more than two occurrences an
entry or 32 MB, and hands on what it counted. Extra columns are ignored. The ``pair`` part has as many rows as there are ordered
pairs of sources of one language, and a term shared by m sources makes m * m rows before they are counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearspan.llm.words import blocks, split
from nearspan.session import attach, cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A-Z in lower case, and all bytes that are in no term as blanks.
TERMS = bytes(b if chr(b) in LOWER or b >= 0x80 else 0x20 for b in bytes.maketrans(UPPER.encode(), LOWER.encode()))
#: Bytes of terms that a task collects before it counts them, and rows that it hands on at once.
HELD, ROWS = 32 << 20, 100_000
SCALE = 1_000_000_000
COUNTS = "lang string, source string, digest long, term string, n long, df long"


@dataclass(frozen=True)
class Settings:
    min_documents: int = 3
    top: int = 200
    entries: int = 1_000_000
    digest_bits: int = 64
    broadcast_rows: int = 100_000


def _digest(term: bytes, bits: int) -> int:
    x = xxhash.xxh3_64_intdigest(term) >> (64 - bits)
    return x - (1 << 64) if x >> 63 else x


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in their order, and how often each occurs; sorts in place."""
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(first, append=len(keys))


class _Table:
    """Occurrences of the terms of each (language, source), and the documents of each language that hold a term."""

    def __init__(self, s: Settings, strings: bool):
        self.settings, self.strings = s, strings
        self.clear()

    def clear(self) -> None:
        self.groups, self.of, self.sizes, self.terms, self.held, self.bytes = {}, [], [], [], 0, 0

    @property
    def full(self) -> bool:
        return self.held > 2 * self.settings.entries or self.bytes > HELD

    def add(self, groups: Sequence[tuple[str, str]], raws: Sequence[bytes]) -> None:
        """The texts of some documents, and the (language, source) of each."""
        terms, sizes = split(raws, TERMS)
        self.of += [self.groups.setdefault(g, len(self.groups)) for g in groups]
        self.sizes.append(sizes)
        self.terms.append(terms)
        self.held, self.bytes = self.held + len(terms), self.bytes + terms.nbytes

    def batches(self):
        """Count rows of all groups; the first row of a term of a language also has its string and its documents."""
        if not self.held:
            return self.clear()
        texts = np.repeat(np.arange(len(self.of), dtype=np.int32), np.concatenate(self.sizes))
        found = pa.concat_arrays(self.terms).dictionary_encode()
        names, of = list(self.groups), np.array(self.of)
        self.clear()
        strings, codes = found.dictionary.cast(pa.string()), found.indices.to_numpy()
        digests = np.array([_digest(t, self.settings.digest_bits) for t in found.dictionary.to_pylist()], np.int64)
        # a pair of numbers is one number: the first times the number of terms, plus that of the term
        every = len(digests)
        langs = {}
        lang_of = np.array([langs.setdefault(lang, len(langs)) for lang, _ in names])

        def pairs(numbers: np.ndarray) -> np.ndarray:
            numbers *= every
            numbers += codes
            return numbers

        keys, n = _runs(pairs(of[texts]))
        group, term = np.divmod(keys, every)
        held, _ = _runs(pairs(texts.astype(np.int64)))
        _, df = _runs(lang_of[of[held // every]] * every + held % every)
        _, first = np.unique(lang_of[group] * every + term, return_index=True)
        documents = np.zeros(len(keys), np.int64)
        documents[first] = df
        lang_names, source_names = (pa.array(x, pa.string()) for x in zip(*names, strict=True))
        for low in range(0, len(keys), ROWS):
            some = slice(low, low + ROWS)
            others = documents[some] == 0
            yield pa.record_batch([lang_names.take(pa.array(group[some])), source_names.take(pa.array(group[some])),
                                   pa.array(digests[term[some]]),
                                   strings.take(pa.array(term[some], mask=None if self.strings else others)),
                                   pa.array(n[some]), pa.array(documents[some], mask=others)],
                                  ["lang", "source", "digest", "term", "n", "df"])


def counted(docs: DataFrame, s: Settings, strings: bool = False) -> DataFrame:
    """Rows of COUNTS; ``df`` is null but for one row of each term and language of a table, and so is ``term`` unless ``strings``."""
    attach(docs.sparkSession)

    def run(batches):
        table = _Table(s, strings)
        for b in batches:
            groups = list(zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), strict=True))
            at = 0
            for raws in blocks((x.as_py() for x in b.column("text").cast(pa.large_binary())), 4 * s.entries):
                table.add(groups[at:at + len(raws)], raws)
                at += len(raws)
                if table.full:
                    yield from table.batches()
        yield from table.batches()

    return docs.mapInArrow(run, COUNTS)


KEY = ["digest", "lang", "split"]


def kept_terms(docs: DataFrame, groups: DataFrame, few: bool, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(KEY, total, of: [(g, n)]) of every kept term, g the number of a group; and (digest, lang, low), the strings of digests."""
    rows = cut_lineage(counted(docs, s), "term-counts")
    strings = cut_lineage(rows.where("df IS NOT NULL").groupBy("digest", "lang").agg(
        F.min("term").alias("low"), F.max("term").alias("high"), F.sum("df").alias("df")), "term-strings")
    known = strings.where("low = high").select("digest", "lang", F.lit("").alias("split"), "df")
    counts = rows.select("digest", "lang", F.lit("").alias("split"), "source", "n")
    shared = strings.where("low <> high").select("digest", "lang")
    if not shared.isEmpty():
        again = counted(docs, s, strings=True).join(shared, ["digest", "lang"], "left_semi").withColumn("split", F.col("term"))
        again = cut_lineage(again, "shared-digests")
        known = known.unionByName(again.groupBy(KEY).agg(F.sum("df").alias("df")))
        counts = counts.join(shared, ["digest", "lang"], "left_anti").unionByName(again.select(counts.columns))
    known = known.where(F.col("df") >= s.min_documents).select(KEY)
    numbered = _with(counts, groups.select("lang", "source", "g"), ["lang", "source"], few).select(*KEY, "g", "n")
    kept = (numbered.join(known.hint("shuffle_hash"), KEY, "left_semi").groupBy(*KEY, "g").agg(F.sum("n").alias("n"))
            .groupBy(KEY).agg(F.sum("n").alias("total"), F.collect_list(F.struct("g", "n")).alias("of")))
    return cut_lineage(kept, "kept-terms"), strings


def share(count: str, size: str, kept: str) -> Column:
    """1 + floor(SCALE * (count + 1) / (size + kept)), by long division in steps of 1000, which stays inside 64 bits."""
    whole, rest, digits = F.lit(0).cast("long"), f"({count} + 1)", f"({size} + {kept})"
    for _ in range(3):
        whole = whole * 1000 + F.expr(f"({rest} * 1000) div {digits}")
        rest = f"(({rest} * 1000) % {digits})"
    return whole + 1


def _gap(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def audit(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources, and the terms a source has more of."""
    given = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups = cut_lineage(given.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("documents"))
                         .select("lang", "source", F.monotonically_increasing_id().alias("g")), "groups")
    few = groups.count() <= s.broadcast_rows
    kept, strings = kept_terms(given, groups, few, s)
    alone = cut_lineage(kept.select(F.explode("of").alias("x")).groupBy("x.g", "x.n").agg(F.count(F.lit(1)).alias("terms")), "histograms")
    sizes = alone.groupBy("g").agg(F.sum(F.col("terms") * F.col("n")).alias("size"), F.sum("terms").alias("own"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_size"))
    sizes = groups.join(sizes, "g", "left").join(langs, "lang", "left").fillna(0, ["size", "own", "kept", "lang_size"])
    sizes = cut_lineage(sizes, "group-sizes")
    out = _terms(kept, strings, sizes, few, s).unionByName(_pairs(kept, alone, sizes, few))
    return out.select("lang", "source", "part", "item", "value", "rank")


def _with(rows: DataFrame, small: DataFrame, on: list[str], few: bool) -> DataFrame:
    return rows.join(F.broadcast(small) if few else small, on)


def _terms(kept: DataFrame, strings: DataFrame, sizes: DataFrame, few: bool, s: Settings) -> DataFrame:
    rows = kept.select("digest", "split", "total", F.explode("of").alias("x")).select("digest", "split", "total", "x.g", "x.n")
    scored = (_with(rows, sizes, ["g"], few)
              .withColumn("p", share("n", "size", "kept")).withColumn("q", share("total", "lang_size", "kept"))
              .where("p > q").select("lang", "source", "digest", "split", _gap("p", "q").alias("value")))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    best = scored.withColumn("place", F.rank().over(by_value)).where(F.col("place") <= s.top).drop("place")
    named = best.join(strings.select("digest", "lang", "low"), ["digest", "lang"]).withColumn(
        "item", F.when(F.col("split") == "", F.col("low")).otherwise(F.col("split")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.top)
            .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def _pairs(kept: DataFrame, alone: DataFrame, sizes: DataFrame, few: bool) -> DataFrame:
    """Sum over all kept terms of the gap of every ordered pair (source, item).

    As if no term were shared, plus what differs for those that are: whole - without item - without source + without both.
    """
    left = sizes.select("lang", "source", "g", "size", "own", "kept")
    right = sizes.select("lang", *[F.col(c).alias(f"item_{c}") for c in ("source", "g", "size", "own")])
    pairs = _with(left, right, ["lang"], few).where("g <> item_g").withColumn("none", F.lit(0).cast("long"))
    some = F.col("kept") > 0
    pairs = pairs.withColumn("p0", F.when(some, share("none", "size", "kept"))).withColumn("q0", F.when(some, share("none", "item_size", "kept")))
    pairs = cut_lineage(pairs.withColumn("plain", F.when(some, _gap("p0", "q0"))).drop("none"), "source-pairs")
    on = ["g", "item_g"]

    def total(of: Column, name: str) -> Column:
        return F.sum(F.col("terms") * of).alias(name)

    only = (alone.join(pairs, "g").withColumn("p", share("n", "size", "kept")).groupBy(on).agg(total(_gap("p", "q0"), "only")))
    other = (alone.withColumnsRenamed({"g": "item_g", "n": "m"}).join(pairs, "item_g")
             .withColumn("q", share("m", "item_size", "kept")).groupBy(on).agg(total(_gap("p0", "q"), "other")))
    met = (kept.select("of", F.explode("of").alias("x")).select("x.g", "x.n", F.explode("of").alias("y"))
           .select("g", "n", F.col("y.g").alias("item_g"), F.col("y.n").alias("m")).where("g < item_g")
           .groupBy("g", "item_g", "n", "m").agg(F.count(F.lit(1)).alias("terms")))
    both = met.select("terms", F.explode(F.array(F.struct("g", "item_g", "n", "m"), F.struct(
        F.col("item_g").alias("g"), F.col("g").alias("item_g"), F.col("m").alias("n"), F.col("n").alias("m")))).alias("x")).select("terms", "x.*")
    both = (_with(both, pairs, on, pairs.count() <= 10 * Settings.broadcast_rows)
            .withColumn("p", share("n", "size", "kept")).withColumn("q", share("m", "item_size", "kept")).groupBy(on)
            .agg(total(_gap("p", "q"), "whole"), total(_gap("p", "q0"), "no_item"), total(_gap("p0", "q"), "no_source"),
                 F.sum("terms").alias("shared")))
    sums = pairs.join(only, on, "left").join(other, on, "left").join(both, on, "left").fillna(0)
    wide = {c: F.col(c).cast("decimal(20,0)") for c in ("only", "other", "whole", "no_item", "no_source", "plain")}
    neither = (F.col("kept") - F.col("own") - F.col("item_own") + F.col("shared")).cast("decimal(18,0)")
    value = wide["only"] + wide["other"] + wide["whole"] - wide["no_item"] - wide["no_source"] + neither * wide["plain"]
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (sums.select("lang", "source", F.lit("pair").alias("part"), F.col("item_source").alias("item"), value.cast("long").alias("value"))
            .withColumn("rank", F.row_number().over(order)))


SQL = f"""WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS kept, sum(total) AS lang_size FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
z AS (SELECT lang, source, sum(n) AS size FROM c GROUP BY ALL),
g AS (SELECT lang, source, coalesce(size, 0) AS size, coalesce(kept, 0) AS kept
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN z USING (lang, source) LEFT JOIN v USING (lang)),
p AS (SELECT g.lang, g.source, term, coalesce(n, 0) AS n, total,
        1 + ({SCALE}::HUGEINT * (coalesce(n, 0) + 1)) // (size + kept) AS p
      FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN q ON q.lang = a.lang AND q.source = a.source AND q.item = b.source),
m AS (SELECT lang, source, term AS item, p, 1 + ({SCALE}::HUGEINT * (total + 1)) // (lang_size + kept) AS q
      FROM p JOIN v USING (lang) WHERE n > 0),
y AS (SELECT lang, source, item, (p - q) * (p - q) // q AS value FROM m WHERE p > q)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM x
UNION ALL
SELECT lang, source, 'term', item, CAST(value AS BIGINT), rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM y)
WHERE rank <= 200"""
