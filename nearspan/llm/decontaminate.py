"""Benchmark decontamination with DataFrame functions only.

The windows of all test items (13 words; an item of fewer words is one window) form the set that is broadcast,
keyed by the longest word of each window. Documents are read once: their words are scanned in place, a word that
keys no window goes no further, and the window around one that does is compared word by word with the broadcast
window. So only verified hits leave the scan; no text is shuffled and no window of the corpus is built unless its
key word matched. The set is cut by the hash of window and item into blocks of about ``block`` windows, one
scan each, so what is broadcast has a fixed bound however large the benchmark is and however many items hold a window.

Words: A-Z are lower-cased, everything else stays; words are runs of digits, letters a-z and code points from
U+0080 on. The scan looks words up by their full lower case, which is coarser, and compares exactly afterwards.

Defined cases: null texts have no words and no hits; items without words have no window; a null item_id counts as
the item '' ; rows of equal doc_id and text get equal results, also when repeated or when doc_id is null; extra
columns are ignored by :func:`hits` and :func:`report` and kept by :func:`drop_contaminated`, :func:`cut_spans`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearspan.session import cut_lineage

WINDOW, BLOCK = 13, 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What is not in a word, one by one: such a class is one table lookup per character, ranges are a chain of tests.
BREAKS = "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum())
#: The same runs as the lower-case rule gives, found in texts that still have their capitals.
WORD, GAP = f"[^{BREAKS}]+", f"[{BREAKS}]*"


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def normal(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item, length, gram, anchor, offset): one row per item and window."""
    w = F.col("w")
    starts = F.sequence(F.lit(1), F.greatest(F.size(w) - width + 1, F.lit(1)))
    grams = (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                              words(normal(F.col("text"))).alias("w"))
             .filter(F.size(w) > 0)
             .select("item", F.explode(F.transform(starts, lambda i: F.slice(w, i, width))).alias("w")).distinct())
    longest = F.array_max(F.transform(w, lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("back"))))
    return (grams.withColumn("offset", -longest.back)
            .select("item", F.size(w).alias("length"), F.array_join(w, " ").alias("gram"), "offset",
                    F.lower(F.element_at(w, F.col("offset") + 1)).alias("anchor")))


def in_blocks(grams: DataFrame, block: int) -> tuple[DataFrame, int]:
    """The windows with their number of a block, and the number of blocks. Items of one window are dealt over all."""
    blocks = max(1, -(-grams.count() // block))
    return grams.withColumn("block", F.pmod(F.xxhash64("gram", "item"), F.lit(blocks))), blocks


def hits(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(doc_id, digest, item, start, length) of every verified occurrence; starts count words from 0."""
    grams, blocks = in_blocks(cut_lineage(windows(benchmark, width), "windows"), block)
    read = docs.select("doc_id", "text", words(F.col("text")).alias("w"))
    # outer: else the planner adds a filter on the number of words, and finds the words twice
    exploded = read.select("doc_id", "text", "w", F.posexplode_outer("w").alias("pos", "word"))
    start = F.col("pos") - F.col("offset")
    found = []
    for b in range(blocks):
        some = F.broadcast(grams.filter(F.col("block") == b))
        near = exploded.join(some, F.lower("word") == F.col("anchor")).filter(
            (start >= 0) & (start + F.col("length") <= F.size("w")))
        exact = normal(F.array_join(F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("length")), " "))
        found.append(near.filter(exact == F.col("gram"))
                     .select("doc_id", F.md5("text").alias("digest"), "item", start.alias("start"), "length"))
    return reduce(DataFrame.unionByName, found)


def summary(found: DataFrame) -> DataFrame:
    """(doc_id, digest, n_hit, n_items, items_sha256, hit): totals and hit word positions of documents with hits."""
    spans = F.collect_set(F.struct("start", "length"))
    by = found.groupBy("doc_id", "digest").agg(spans.alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
    hit = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s.start, s.start + s.length - 1))))
    return (by.withColumn("hit", hit)
            .select("doc_id", "digest", F.size("hit").cast("long").alias("n_hit"),
                    F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256)
                    .alias("items_sha256"), "hit"))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def report(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of documents."""
    found = summary(hits(docs, benchmark, width, block)).drop("hit").withColumnsRenamed(
        {"doc_id": "__id", "digest": "__digest"})
    rows = docs.select("doc_id", F.md5("text").alias("digest"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select("doc_id", "n_words", n_hit.alias("n_hit"),
                         F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                         F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                         contaminated(n_hit, F.col("n_words")).alias("contaminated"))


def _with_hits(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    keys = found.withColumnsRenamed({c: f"__{c}" for c in found.columns})
    return docs.join(keys, docs["doc_id"].eqNullSafe(F.col("__doc_id")) & (F.md5(docs["text"]) == F.col("__digest")), how)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """The rows of documents that are not contaminated, unchanged."""
    found = summary(hits(docs, benchmark, width, block)).drop("hit", "items_sha256", "n_items")
    lengths = docs.select("doc_id", "text").withColumn("digest", F.md5("text"))
    n_words = F.regexp_count(F.col("text"), F.lit(WORD))
    bad = (_with_hits(lengths.drop("digest"), found, "inner").filter(contaminated(F.col("__n_hit"), n_words))
           .select(F.col("__doc_id").alias("doc_id"), F.col("__digest").alias("digest")).distinct())
    return _with_hits(docs, bad, "left_anti")


def cut_spans(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """All rows of documents, hit words cut out of ``text`` together with what separates them from the word before."""
    found = summary(hits(docs, benchmark, width, block)).select("doc_id", "digest", "hit")
    pieces = F.regexp_extract_all("text", F.lit(GAP + WORD), F.lit(0))
    rest = F.regexp_extract("text", f"({GAP})$", 1)
    kept = F.array_join(F.filter(pieces, lambda _, i: ~F.array_contains("__hit", i)), "")
    clean = F.when(F.col("__hit").isNull(), F.col("text")).otherwise(F.concat(kept, rest))
    return (_with_hits(docs, found, "left").withColumn("text", clean).select(*docs.columns))


SQL = f"""WITH b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
g AS (SELECT DISTINCT item, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS gram, least(len(w), {WINDOW}) AS length
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, row_number() OVER () AS r,
        coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
      FROM documents),
n AS (SELECT DISTINCT length FROM g),
p AS (SELECT r, length, i, array_to_string(w[i:i + length - 1], ' ') AS gram
      FROM (SELECT r, w, length, unnest(range(1, len(w) - length + 2)) AS i FROM d, n WHERE len(w) >= length)),
h AS (SELECT r, p.length, i, item FROM p JOIN g USING (gram, length)),
x AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + length)) AS j FROM h) GROUP BY r),
y AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM d LEFT JOIN x USING (r) LEFT JOIN y USING (r)"""
