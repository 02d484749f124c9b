"""Removal of passages that occur earlier in the corpus, by a sampled, range-partitioned suffix sort.

A byte goes if a string of ``length`` (100) bytes that covers it also starts earlier: in a document of smaller id,
or earlier in the same document. Not every suffix of the corpus is sorted. Of every 100 bytes the start of the
24 bytes with the smallest hash is an *anchor*; equal strings have the same anchor, so every repeated string is
found at the suffixes that start at anchors, about one position in forty.

1. Texts are packed where they lie into blocks of a few megabytes; copies inside a block are stored once.
2. Anchors whose 24 bytes occur once in the corpus cannot be in a repeat. Each block tells a digest once, digests
   are counted, and only repeated anchors go on.
3. A repeated anchor becomes a suffix of 100 bytes with the 76 bytes before it. Splitters sampled from the blocks
   deal suffixes by their leading bytes into ranges; a range is sorted by Spark and read as a stream.
4. Inside a range, suffixes are ordered by a multikey quicksort (eight bytes are one character), those before the
   anchor likewise from right to left. The common prefixes of neighbours give, for every one of the 77 strings of
   100 bytes around an anchor, which rows hold the same string, and the first row by document and position keeps
   it. Equal leading bytes never lie on both sides of a splitter, so no string is compared across ranges.
5. Strings that lead very many suffixes (more than ``crowd``) are not gathered: their 77 strings are digested,
   the earliest holder of each is found by a pre-aggregated minimum and joined back.
6. Spans go back to their blocks, where the remaining bytes are joined.

Defined cases: null texts are empty; texts shorter than ``length`` lose nothing; a null doc_id is later than all
others; rows of equal doc_id are the same document if their texts are equal (they get equal results), else they
are ordered by a digest of the text. doc_id is an integer column. ``text`` in the result of :func:`strip_repeats` is
what is left (bytes cut out of the middle of a character are dropped); other columns pass through unchanged.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan.session import attach, bound_batches, cut_bucketed, cut_lineage


@dataclass(frozen=True)
class Settings:
    length: int = 100
    gram: int = 24
    block_bytes: int = 2 << 20
    chunk: int = 60_000
    crowd: int = 200_000
    sample_blocks: int = 64
    sample_anchors: int = 256


LAST = (1 << 63) - 1
#: Bytes and rows that are worked on at once: each has some ten numbers of 64 bits a byte meanwhile.
PIECE, ROWS = 1 << 17, 2_000
C1, C2, C3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


# ---- blocks and anchors

def anchors(buf: np.ndarray, ends: np.ndarray, s: Settings = Settings()) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors of texts that lie one after the other, and the digests of their 24 bytes."""
    n, none = len(buf), (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    if n < s.length:
        return none
    starts = np.concatenate([[0], ends[:-1]])
    change = np.zeros(n - s.length + 2, np.int32)
    whole = ends - starts >= s.length
    np.add.at(change, starts[whole], 1)
    np.add.at(change, ends[whole] - s.length + 1, -1)
    valid = np.cumsum(change[:-1], dtype=np.int32) > 0
    low = np.uint64((1 << max(24, n.bit_length())) - 1)
    found = [none]
    for start in range(0, len(valid), PIECE):
        use = valid[start:start + PIECE]
        if use.any():
            found.append(_minima(buf[start:start + len(use) + s.length - 1], start, use, low, s))
    at, h = (np.concatenate(x) for x in zip(*found, strict=True))
    at, first = np.unique(at, return_index=True)
    return at, h[first]


def _minima(buf: np.ndarray, start: int, use: np.ndarray, low: np.uint64, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of the used windows of a piece that begins at ``start``."""
    width = s.length - s.gram + 1
    with np.errstate(over="ignore"):
        x = buf.astype(np.uint64)
        for step in (1, 2, 4):
            x = x[:-step] | (x[step:] << np.uint64(8 * step))
        m = len(buf) - s.gram + 1
        h = x[:m] * C1 + x[8:8 + m] * C2 + x[16:16 + m] * C3
        h = (h ^ (h >> np.uint64(32))) * C2
        h ^= h >> np.uint64(29)
    v = (h & ~low) | np.arange(start, start + m, dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    if span < width:
        v = np.minimum(v[:span - width], v[width - span:])
    at = np.unique(v[use] & low).astype(np.int64)
    return at, h[at - start]


def contexts(buf: np.ndarray, ends: np.ndarray, at: np.ndarray, s: Settings = Settings()):
    """(left, right, bytes) around anchors: how many bytes of its text lie before (at most 76) and from it on (at most
    100), and these 176 bytes, zero outside the text."""
    text = np.searchsorted(ends, at, side="right")
    starts = np.concatenate([[0], ends[:-1]])
    before = s.length - s.gram
    left = np.minimum(at - starts[text], before)
    right = np.minimum(ends[text] - at, s.length)
    offset = np.arange(-before, s.length)
    around = np.zeros((len(at), len(offset)), np.uint8)
    for low in range(0, len(at), ROWS):
        some = slice(low, low + ROWS)
        inside = (offset >= -left[some, None]) & (offset < right[some, None])
        around[some] = np.where(inside, buf[np.clip(at[some, None] + offset, 0, len(buf) - 1)], 0)
    return text, left, right, around


@dataclass
class Block:
    """Distinct texts of some rows, their order keys, and which text each row has."""

    buf: np.ndarray
    ends: np.ndarray
    ids: np.ndarray
    ties: np.ndarray
    row_ids: np.ndarray
    row_text: np.ndarray

    @staticmethod
    def pack(ids: list, raws: list[bytes]) -> bytes:
        known: dict[bytes, int] = {}
        row_text = np.array([known.setdefault(r, len(known)) for r in raws], np.int64)
        row_ids = np.array([LAST if i is None else i for i in ids], np.int64)
        first = np.full(len(known), LAST, np.int64)
        np.minimum.at(first, row_text, row_ids)
        head = np.array([len(known), len(raws)], np.int64)
        size = np.array([len(r) for r in known], np.int64)
        ties = np.array([xxhash.xxh3_64_intdigest(r) >> 1 for r in known], np.int64)
        parts = [a.tobytes() for a in (head, np.cumsum(size), first, ties, row_ids, row_text)]
        return zstandard.ZstdCompressor(level=3).compress(b"".join([*parts, *known]))

    @classmethod
    def unpack(cls, packed: bytes) -> Block:
        raw = zstandard.ZstdDecompressor().decompress(packed)
        texts, rows = np.frombuffer(raw, np.int64, 2)
        at, out = 16, []
        for n in (texts, texts, texts, rows, rows):
            out.append(np.frombuffer(raw, np.int64, n, at))
            at += 8 * int(n)
        return cls(np.frombuffer(raw, np.uint8, offset=at), *out)


def _blocks(docs: DataFrame, s: Settings) -> DataFrame:
    """(block, packed, rest): rows in packs; rest holds the other columns as an Arrow stream."""
    given = docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").alias("__text"),
                        F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("__rest"))

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            raws = b.column("__text").cast(pa.large_binary())
            ids, low, size, texts = b.column("__id").to_pylist(), 0, 0, []
            for i in range(b.num_rows):
                texts.append(raws[i].as_py() or b"")
                size += len(texts[-1])
                if size >= s.block_bytes or i == b.num_rows - 1:
                    sink = pa.BufferOutputStream()
                    rest = pa.record_batch([b.column("__rest").slice(low, i + 1 - low), pa.compute.is_null(raws.slice(low, i + 1 - low))], ["rest", "null"])
                    with pa.ipc.new_stream(sink, rest.schema) as w:
                        w.write_batch(rest)
                    yield pa.record_batch([pa.array([(part << 32) | seq], pa.int64()),
                                           pa.array([Block.pack(ids[low:i + 1], texts)], pa.binary()),
                                           pa.array([zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())], pa.binary())],
                                          ["block", "packed", "rest"])
                    seq, low, size, texts = seq + 1, i + 1, 0, []

    return cut_bucketed(given.mapInArrow(run, "block long, packed binary, rest binary"), "block")


def _digests(blocks: DataFrame, s: Settings) -> DataFrame:
    """(block, h, times): the anchor digests of a block, each once; times is 2 if it occurs more than once in it."""

    def run(batches):
        for b in batches:
            for block, packed in zip(b.column("block").to_pylist(), b.column("packed"), strict=True):
                x = Block.unpack(packed.as_py())
                h, times = np.unique(anchors(x.buf, x.ends, s)[1], return_counts=True)
                yield pa.record_batch([pa.array(np.full(len(h), block)), pa.array(h.view(np.int64)),
                                       pa.array(np.minimum(times, 2).astype(np.int32))], ["block", "h", "times"])

    return blocks.select("block", "packed").mapInArrow(run, "block long, h long, times int")


def _splitters(blocks: DataFrame, parts: int, s: Settings) -> np.ndarray:
    """Sampled leading eight bytes that cut the suffixes into ``parts`` ranges; a bounded sample of blocks."""
    total = blocks.count()
    some = blocks if total <= s.sample_blocks else blocks.sample(False, s.sample_blocks / total, 3)

    def run(batches):
        for b in batches:
            for packed in b.column("packed"):
                x = Block.unpack(packed.as_py())
                at = anchors(x.buf, x.ends, s)[0]
                at = at[:: max(1, len(at) // s.sample_anchors)]
                lead = np.stack([x.buf[at + i] for i in range(8)], axis=1) if len(at) else np.zeros((0, 8), np.uint8)
                yield pa.record_batch([pa.array([np.ascontiguousarray(lead).tobytes()], pa.binary())], ["lead"])

    rows = some.select("packed").limit(2 * s.sample_blocks).mapInArrow(run, "lead binary").collect()
    leads = np.sort(np.frombuffer(b"".join(bytes(r["lead"]) for r in rows), ">u8").astype(np.uint64))
    if not len(leads):
        return leads
    return np.unique(leads[(np.arange(1, parts) * len(leads)) // parts])


# ---- sorting

def multikey_sort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of 64-bit characters, and the common leading bytes of neighbours in that order (first: 0).

    A multikey quicksort, all groups of a depth at once: rows are split by the character at a depth inside their
    group, and only groups that are still together go one character deeper.
    """
    n, width = words.shape
    order, lcp = np.arange(n), np.zeros(n, np.int64)
    live, group = np.arange(n), np.zeros(n, np.int64)
    for d in range(width):
        char = words[order[live], d]
        by = np.lexsort((char, group))
        order[live] = order[live][by]
        char = char[by]
        same_group = np.concatenate([[False], group[1:] == group[:-1]])
        same = same_group.copy()
        same[1:] &= char[1:] == char[:-1]
        cut = same_group & ~same
        where = np.flatnonzero(cut)
        lcp[live[where]] = 8 * d + _equal_bytes(char[where], char[where - 1])
        lcp[live[same]] = 8 * (d + 1)
        group = np.cumsum(~same)
        size = np.bincount(group)
        stay = size[group] > 1
        live, group = live[stay], group[stay]
        if not len(live):
            break
    return order, lcp


def _equal_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x, out = a ^ b, np.zeros(len(a), np.int64)
    for i in range(1, 8):
        out += (x >> np.uint64(64 - 8 * i)) == 0
    return out


def _characters(rows: np.ndarray) -> np.ndarray:
    n, width = rows.shape
    full = np.zeros((n, -(-width // 8) * 8), np.uint8)
    full[:, :width] = rows
    return full.view(">u8").astype(np.uint64)


def _classes(order: np.ndarray, lcp: np.ndarray, depth: int) -> np.ndarray:
    """Number of each row's class of equal leading ``depth`` bytes."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(lcp < depth) if depth else 0
    return out


def repeated(doc: np.ndarray, tie: np.ndarray, pos: np.ndarray, left: np.ndarray, right: np.ndarray, around: np.ndarray,
             s: Settings = Settings()) -> tuple[np.ndarray, np.ndarray]:
    """(before, after) per row: how far the strings that start earlier elsewhere reach around the anchor; -1, -1 if none.

    String a of a row starts a bytes before the anchor. Rows of equal (doc, tie, pos) are one place.
    """
    n, before = len(doc), s.length - s.gram
    most, least = np.full(n, -1), np.full(n, s.length)
    if n < 2:
        return most, np.full(n, -1)
    right_order, right_lcp = multikey_sort(_characters(around[:, before:]))
    left_order, left_lcp = multikey_sort(_characters(around[:, :before][:, ::-1]))
    rank = np.empty(n, np.int64)
    by_place = np.lexsort((pos, tie, doc))
    d, t, p = doc[by_place], tie[by_place], pos[by_place]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (p[1:] != p[:-1])])
    rank[by_place] = np.cumsum(new)
    for a in range(before + 1):
        rows = np.flatnonzero((left >= a) & (right >= s.length - a))
        if len(rows) < 2:
            continue
        key = _classes(right_order, right_lcp, s.length - a)[rows] * (n + 1) + _classes(left_order, left_lcp, a)[rows]
        kinds, inverse = np.unique(key, return_inverse=True)
        first = np.full(len(kinds), LAST, np.int64)
        np.minimum.at(first, inverse, rank[rows])
        later = rows[rank[rows] > first[inverse]]
        most[later] = a
        least[later] = np.minimum(least[later], a)
    return most, np.where(most < 0, -1, s.length - least)


# ---- jobs

_SUFFIX = ("part int, key binary, doc long, tie long, pos long, block long, text int, at long, left int, right int, "
           "around binary, before int, after int")


def _suffixes(blocks: DataFrame, wanted: DataFrame, splitters: np.ndarray, s: Settings) -> DataFrame:
    """Suffixes at the wanted anchors, with their range. Of equal surroundings in a block only the first goes on; the
    others are repeats already and are told with their reach (before, after)."""
    joined = blocks.select("block", "packed").join(wanted.hint("shuffle_hash"), "block")
    names = [x.split()[0] for x in _SUFFIX.split(", ")]
    half = s.length - s.gram

    def run(batches):
        for b in batches:
            for block, packed, hs in zip(b.column("block").to_pylist(), b.column("packed"), b.column("hs"), strict=True):
                x = Block.unpack(packed.as_py())
                at, h = anchors(x.buf, x.ends, s)
                keep = np.isin(h, hs.values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
                at = at[keep]
                for low in range(0, len(at), 50_000):
                    yield _rows(block, x, at[low:low + 50_000])

    def _rows(block: int, x: Block, at: np.ndarray) -> pa.RecordBatch:
        text, left, right, around = contexts(x.buf, x.ends, at, s)
        doc, tie = x.ids[text], x.ties[text]
        pos = at - np.concatenate([[0], x.ends[:-1]])[text]
        whole = np.concatenate([around, left[:, None].astype(np.uint8), right[:, None].astype(np.uint8)], axis=1)
        flat = np.ascontiguousarray(whole).view(np.dtype((np.void, whole.shape[1]))).ravel()
        order = np.lexsort((pos, tie, doc))
        _, first, inverse = np.unique(flat[order], return_index=True, return_inverse=True)
        head = np.empty(len(at), np.int64)
        head[order] = order[first[inverse]]
        known = head != np.arange(len(at))
        long = left + right >= s.length
        before, after = np.where(known & long, left, -1), np.where(known & long, right, -1)
        use = long
        known = known[use]
        lead = _characters(around[:, half:half + 8]).ravel()
        part = np.searchsorted(splitters, lead[use], side="right")
        blob = [None if k else r.tobytes() for k, r in zip(known, around[use], strict=True)]
        key = [None if k else r[half:half + s.gram].tobytes() for k, r in zip(known, around[use], strict=True)]
        return pa.record_batch([
            pa.array(part.astype(np.int32)), pa.array(key, pa.binary()), pa.array(doc[use]), pa.array(tie[use]), pa.array(pos[use]),
            pa.array(np.full(use.sum(), block)), pa.array(text[use].astype(np.int32)), pa.array(at[use]),
            pa.array(left[use].astype(np.int32)), pa.array(right[use].astype(np.int32)), pa.array(blob, pa.binary()),
            pa.array(before[use].astype(np.int32)), pa.array(after[use].astype(np.int32))], names)

    return joined.mapInArrow(run, _SUFFIX)


def _columns(batch: pa.RecordBatch, s: Settings) -> dict[str, np.ndarray]:
    out = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tie", "pos", "left", "right")}
    joined = b"".join(x.as_py() for x in batch.column("around"))
    out["around"] = np.frombuffer(joined, np.uint8).reshape(batch.num_rows, 2 * s.length - s.gram)
    return out


def _compare(suffixes: DataFrame, s: Settings) -> DataFrame:
    """Reach of every suffix inside its range; groups of more than ``crowd`` rows pass through undecided (before null)."""
    names = [x.split()[0] for x in _SUFFIX.split(", ")]

    def decide(rows: pa.RecordBatch) -> pa.RecordBatch:
        before, after = repeated(**_columns(rows, s), s=s)
        columns = {c: rows.column(c) for c in names}
        columns |= {"before": pa.array(before.astype(np.int32)), "after": pa.array(after.astype(np.int32)),
                    "around": pa.nulls(rows.num_rows, pa.binary()), "key": pa.nulls(rows.num_rows, pa.binary())}
        done = pa.record_batch([columns[c] for c in names], names)
        return done.filter(pa.compute.greater_equal(done.column("before"), 0))

    def undecided(rows: pa.RecordBatch) -> pa.RecordBatch:
        return rows.set_column(names.index("before"), "before", pa.nulls(rows.num_rows, pa.int32()))

    def run(batches):
        held: list[pa.RecordBatch] = []
        size, crowded = 0, None

        def joined() -> pa.RecordBatch:
            return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for b in batches:
            known = pa.compute.is_null(b.column("key"))
            told, b = b.filter(known), b.filter(pa.compute.invert(known))
            if told.num_rows:
                yield told
            if not b.num_rows:
                continue
            if crowded is not None:
                same = pa.compute.equal(b.column("key"), pa.scalar(crowded, pa.binary()))
                if pa.compute.any(same).as_py():
                    yield undecided(b.filter(same))
                    b = b.filter(pa.compute.invert(same))
                if not b.num_rows:
                    continue
                crowded = None
            held.append(b)
            size += b.num_rows
            if size < s.chunk:
                continue
            rows = joined()
            last = rows.column("key")[rows.num_rows - 1].as_py()
            tail = pa.compute.equal(rows.column("key"), pa.scalar(last, pa.binary()))
            end, rest = rows.filter(pa.compute.invert(tail)), rows.filter(tail)
            if end.num_rows:
                yield decide(end)
            held, size = [rest], rest.num_rows
            if size > s.crowd:
                yield undecided(rest)
                held, size, crowded = [], 0, last
        if held:
            yield decide(joined())

    return suffixes.mapInArrow(run, _SUFFIX)


def _crowds(rows: DataFrame, s: Settings) -> DataFrame:
    """Spans of suffixes whose leading bytes are shared by very many: by minima over digests of their strings."""
    half = s.length - s.gram

    def run(batches):
        for b in batches:
            for low in range(0, b.num_rows, 2_000):
                part = b.slice(low, 2_000)
                x = _columns(part, s)
                block, at = part.column("block").to_numpy(), part.column("at").to_numpy()
                text = part.column("text").to_numpy()
                for a in range(half + 1):
                    use = np.flatnonzero((x["left"] >= a) & (x["right"] >= s.length - a))
                    if not len(use):
                        continue
                    keys = [hashlib.blake2b(r.tobytes(), digest_size=16).digest() for r in x["around"][use, half - a:half - a + s.length]]
                    yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(x["doc"][use]), pa.array(x["tie"][use]),
                                           pa.array(x["pos"][use] - a), pa.array(block[use]), pa.array(text[use]), pa.array(at[use] - a)],
                                          ["key", "doc", "tie", "pos", "block", "text", "at"])

    strings = cut_lineage(rows.mapInArrow(run, "key binary, doc long, tie long, pos long, block long, text int, at long"), "strings")
    place = F.struct("doc", "tie", "pos")
    first = strings.groupBy("key").agg(F.min(place).alias("first"))
    return strings.join(first, "key").filter(place > F.col("first")).select(
        "block", "text", F.col("at").alias("low"), (F.col("at") + s.length).alias("high"))


def _spans(blocks: DataFrame, s: Settings) -> DataFrame:
    """(block, low, high): byte spans of blocks to be removed; they may overlap."""
    spark = blocks.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    digests = _digests(blocks, s)
    # a digest has one row per block at most, so no window here holds more rows than there are blocks
    told = digests.withColumn("n", F.sum("times").over(Window.partitionBy("h"))).filter("n > 1")
    wanted = told.groupBy("block").agg(F.collect_list("h").alias("hs"))
    suffixes = _suffixes(blocks, wanted, _splitters(blocks, parts, s), s)
    dealt = suffixes.repartitionById(parts, F.col("part")).sortWithinPartitions("key")
    found = cut_lineage(_compare(dealt, s), "spans")
    spans = found.filter("before >= 0").select("block", (F.col("at") - F.col("before")).alias("low"), (F.col("at") + F.col("after")).alias("high"))
    crowd = found.filter("before is null")
    if not crowd.isEmpty():
        spans = spans.union(_crowds(crowd, s).select("block", "low", "high"))
    return spans


def strip_repeats(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """All columns of documents with ``text`` stripped, and ``repeats``: a struct of n_bytes, n_removed, n_spans and
    kept_sha256 (of the remaining bytes, before broken characters are dropped). A column of that name in the documents
    stays, and the struct comes as ``repeats_`` then (with as many ``_`` as make it new)."""
    attach(docs.sparkSession)
    bound_batches(docs.sparkSession)
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError(f"doc_id must be an integer column, not {docs.schema['doc_id'].dataType.simpleString()}")
    name = "repeats"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    blocks = _blocks(docs, s)
    spans = _spans(blocks, s).groupBy("block").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))
    joined = blocks.join(spans.hint("shuffle_hash"), "block", "left")
    figures = "struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string>"
    rest = T.StructType([f for f in docs.schema.fields if f.name != "text"])
    schema = T.StructType([T.StructField("rest", rest), T.StructField("text", T.StringType()),
                           T.StructField("repeats", T._parse_datatype_string(figures))])

    def run(batches):
        for b in batches:
            for packed, other, lows, highs in zip(b.column("packed"), b.column("rest"), b.column("lows"), b.column("highs"), strict=True):
                x = Block.unpack(packed.as_py())
                gone = np.zeros(len(x.buf) + 1, np.int32)
                if lows.is_valid:
                    np.add.at(gone, lows.values.to_numpy(zero_copy_only=False), 1)
                    np.add.at(gone, highs.values.to_numpy(zero_copy_only=False), -1)
                gone = np.cumsum(gone[:-1]) > 0
                stream = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(other.as_py())).read_all().combine_chunks()
                yield _results(x, gone, stream)

    def _results(x: Block, gone: np.ndarray, stream: pa.Table) -> pa.RecordBatch:
        starts = np.concatenate([[0], x.ends[:-1]])
        own, texts, out = {}, [], []
        nulls = stream.column("null").to_pylist()
        for row, t in enumerate(x.row_text):
            # a copy of a text of a smaller id in the same block goes as a whole
            copy = x.row_ids[row] != x.ids[t] and x.ends[t] - starts[t] >= s.length
            if (t, copy) not in own:
                raw, cut = x.buf[starts[t]:x.ends[t]], gone[starts[t]:x.ends[t]]
                if copy:
                    cut = np.ones(len(raw), bool)
                kept = raw[~cut].tobytes()
                spans = int(cut[:1].sum() + (cut[1:] & ~cut[:-1]).sum())
                own[t, copy] = kept.decode("utf8", "ignore"), (len(raw), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest())
            text, figure = own[t, copy]
            texts.append(None if nulls[row] else text)
            out.append(figure)
        columns = list(zip(*out, strict=True))
        struct = pa.StructArray.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                                            ["n_bytes", "n_removed", "n_spans", "kept_sha256"])
        rest = stream.column("rest")
        return pa.record_batch([rest.chunk(0) if isinstance(rest, pa.ChunkedArray) else rest, pa.array(texts, pa.string()), struct],
                               ["rest", "text", "repeats"])

    done = joined.select("packed", "rest", "lows", "highs").mapInArrow(run, schema)
    return done.select(*[F.col("text") if c == "text" else F.col("rest")[c].alias(c) for c in docs.columns], F.col("repeats").alias(name))
