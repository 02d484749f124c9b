"""Distributed matching of a query table against a base table.

One entry point, :func:`match_tables`, serves every search operator (exact, partitioned, quantised,
bit-code, hashed). A search may be *grouped*: only pairs with equal group (inverted list, hash bucket)
are scored. Three physical paths, chosen by measured size:

``base``    the base side fits the broadcast limit: broadcast it, stream the queries. Ungrouped top-k
            needs no shuffle at all.
``query``   the query side fits: broadcast it, stream the base in place. Each task returns at most k rows
            per query.
``cells``   neither fits: both sides are cut into cells of bounded size by hash, hot groups into a grid
            of several cells, and the rows of a cell meet in one task. No pair rows are shuffled.

A large base first gives every query an upper bound of its k-th distance, from a sample, which keeps the
number of partial hits small in the last two paths. Results are whole in every path; sizes only decide
where the work is done.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearspan.errors import ConfigError
from nearspan.plans.kernels import Scorer, Side, TopK, Within, match
from nearspan.session import attach, cut_lineage

PARTITION_BYTES = 256 << 20
ROW_BYTES = 24  # id, group and slot of a row in a cell
SCAN_ROWS = 2048  # queries that pass a resident base together
MAX_BROADCAST_GROUPS = 500_000
MAX_LISTED_GROUPS = 20_000

HITS = "query_id long, vec_id long, distance double"
HIT_SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("distance", pa.float64())])
RANKED = HITS + ", rank int"
RANKED_SCHEMA = HIT_SCHEMA.append(pa.field("rank", pa.int32()))
COUNTS = "query_id long, n long"
COUNT_SCHEMA = pa.schema([("query_id", pa.int64()), ("n", pa.int64())])


@dataclass(frozen=True)
class Limits:
    """Size rules. All are about memory per task or driver; none changes a result."""

    broadcast_bytes: int = 64 << 20
    cell_bytes: int = 64 << 20
    place_bytes: int = 32 << 20
    sample_from_bytes: int = 16 << 30
    sample_share: float = 0.002
    path: str | None = None


@dataclass(frozen=True)
class Ask:
    """What is wanted of each query: the ``k`` best, or everything within ``radius`` (a key), or a count."""

    scorer: Scorer
    k: int | None = None
    radius: float | None = None
    counting: bool = False
    repeats: bool = False  # a pair may be met in more than one group

    def sink(self, slots: int, limit: np.ndarray | None = None):
        if self.k is not None:
            return TopK(slots, self.k, limit)
        return Within(slots, self.radius, self.counting)


def match_tables(
    base: DataFrame, queries: DataFrame, ask: Ask, *, base_vector: Column | str = "embedding",
    query_vector: Column | str = "embedding", group: str | None = None, width: int,
    limits: Limits = Limits(),
) -> DataFrame:
    """Rows ``(query_id, vec_id, distance)``, with ``rank`` for a top-k, or ``(query_id, n)``.

    ``query_id`` is unique in an ungrouped search; a grouped one has a query row per probed group.
    ``width`` is the stored size of one vector in bytes."""
    attach(base.sparkSession)
    extra = [F.col(group).cast("bigint").alias("grp")] if group else []
    b = base.select(F.col("vec_id").cast("bigint"), _vector(base_vector), *extra)
    q = queries.select(F.col("query_id").cast("bigint"), _vector(query_vector), *extra)

    return _match(b, q, ask, width, limits)


def _match(b: DataFrame, q: DataFrame, ask: Ask, width: int, limits: Limits) -> DataFrame:
    if "grp" in b.columns:
        b = _probed_only(b, q)
    path, n_base, n_query = _choose(b, q, ask, width, limits)
    if path == "base":
        found = _stream_queries(b, q, ask)
    else:
        bounds = _bounds(b, q, ask, n_base * width, width, limits)
        if path == "query":
            found = _stream_base(b, q, ask, bounds)
        else:
            found = _in_cells(b, q, ask, bounds, n_base, n_query, width, limits)

    if ask.counting:
        return found.groupBy("query_id").agg(F.sum("n").alias("n"))
    if ask.k is None or "rank" in found.columns:
        return found
    return top_k(found, ask.k, repeats=ask.repeats)


def top_k(hits: DataFrame, k: int, *, repeats: bool = False) -> DataFrame:
    """Rank 1..k per query, ties by ``vec_id``. Each task cuts to k before the shuffle. With ``repeats``
    equal hits count once."""
    w = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    if not repeats:
        return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    ranked = hits.withColumn("rank", F.dense_rank().over(w)).where(F.col("rank") <= k)
    return ranked.dropDuplicates(["query_id", "rank"])


def _vector(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).alias("v")


def _choose(b: DataFrame, q: DataFrame, ask: Ask, width: int, limits: Limits) -> tuple[str, int, int]:
    n_base, n_query = b.count(), q.count()
    if limits.path:
        return limits.path, n_base, n_query
    kept = 0 if ask.k is None else 48 * ask.k
    base_bytes, query_bytes = n_base * width, n_query * (width + kept)
    if base_bytes <= limits.broadcast_bytes and base_bytes <= query_bytes * 4:
        return "base", n_base, n_query
    if query_bytes <= limits.broadcast_bytes:
        return "query", n_base, n_query
    if base_bytes <= limits.broadcast_bytes:
        return "base", n_base, n_query
    return "cells", n_base, n_query


def _resident(df: DataFrame, id_name: str, load) -> Side:
    """Bring a side whose size was checked to the driver, to be broadcast."""
    table = df.toArrow()
    names = table.column_names
    ids = table.column(id_name).to_numpy()
    groups = table.column("grp").to_numpy() if "grp" in names else None
    if len(ids) == 0:
        return Side.of(ids, np.empty((0, 1)), groups)
    return Side.of(ids, load(table.column("v")), groups)


def _batch_side(batch, id_name: str, load, slots=None) -> Side:
    names = batch.schema.names
    groups = batch.column(names.index("grp")).to_numpy(zero_copy_only=False) if "grp" in names else None
    ids = batch.column(names.index(id_name)).to_numpy(zero_copy_only=False)
    return Side.of(ids, load(batch.column(names.index("v"))), groups, slots)


def _hits(query_ids: np.ndarray, rows) -> pa.RecordBatch:
    slots, ids, keys = rows
    return pa.record_batch(
        [pa.array(query_ids[slots]), pa.array(ids), pa.array(keys, pa.float64())], schema=HIT_SCHEMA
    )


def _run(ask: Ask, queries: Side, base: Side, sink, query_ids: np.ndarray):
    """Match two sides into the sink; hits of a radius search leave as soon as they pile up."""
    for _ in match(ask.scorer, queries, base, sink):
        if sink.overflowing:
            yield _hits(query_ids, sink.rows())


def _rest(sink, query_ids: np.ndarray) -> pa.RecordBatch:
    """What a sink still holds."""
    if sink.counts is None:
        return _hits(query_ids, sink.rows())
    some = np.flatnonzero(sink.counts)
    return pa.record_batch(
        [pa.array(query_ids[some]), pa.array(sink.counts[some])], schema=COUNT_SCHEMA
    )


def _stream_queries(b: DataFrame, q: DataFrame, ask: Ask) -> DataFrame:
    held = b.sparkSession.sparkContext.broadcast(_resident(b, "vec_id", ask.scorer.load_base))
    complete = ask.k is not None and "grp" not in q.columns

    def scan(batches):
        base = held.value
        for batch in batches:
            for low in range(0, batch.num_rows if len(base.ids) else 0, SCAN_ROWS):
                some = batch.slice(low, SCAN_ROWS)
                query_ids = some.column(0).to_numpy(zero_copy_only=False)
                queries = _batch_side(some, "query_id", ask.scorer.load_query)
                sink = ask.sink(len(query_ids))
                yield from _run(ask, queries, base, sink, query_ids)
                yield _with_rank(sink, query_ids) if complete else _rest(sink, query_ids)

    return q.mapInArrow(scan, RANKED if complete else COUNTS if ask.counting else HITS)


def _with_rank(sink: TopK, query_ids: np.ndarray) -> pa.RecordBatch:
    """A query row saw the whole base in one task, so its sink holds the answer in order."""
    slots, ids, keys = sink.rows()
    first = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]]) if len(slots) else np.empty(0, int)
    rank = np.arange(len(slots)) - np.repeat(first, np.diff(np.r_[first, len(slots)])) + 1
    return pa.record_batch(
        [pa.array(query_ids[slots]), pa.array(ids), pa.array(keys, pa.float64()),
         pa.array(rank, pa.int32())], schema=RANKED_SCHEMA
    )


def _stream_base(b: DataFrame, q: DataFrame, ask: Ask, bounds: DataFrame | None) -> DataFrame:
    side = _resident(q, "query_id", ask.scorer.load_query)
    names, slots = np.unique(side.ids, return_inverse=True)
    side, limit = replace(side, slots=slots.ravel()), None
    if bounds is not None:
        known = bounds.toArrow()  # one number per resident query
        limit = np.full(len(names), np.inf)
        limit[np.searchsorted(names, known.column("query_id").to_numpy())] = known.column("bound").to_numpy()
    held = b.sparkSession.sparkContext.broadcast((side, names, limit))

    def scan(batches):
        queries, query_ids, start = held.value
        if len(query_ids) == 0:
            return
        sink = ask.sink(len(query_ids), start)
        for batch in batches:
            if batch.num_rows:
                base = _batch_side(batch, "vec_id", ask.scorer.load_base)
                yield from _run(ask, queries, base, sink, query_ids)
        yield _rest(sink, query_ids)

    return b.mapInArrow(scan, COUNTS if ask.counting else HITS)


def _bounds(b: DataFrame, q: DataFrame, ask: Ask, base_bytes: int, width: int,
            limits: Limits) -> DataFrame | None:
    """``(query_id, bound)``: upper bound of each query's k-th key, from a share of the base.

    The k-th best of any subset cannot be better than the true k-th, so tasks may skip everything above
    it. Without it a base in P pieces returns P*k rows per query; with it about k/share in total.
    """
    if ask.k is None or base_bytes < limits.sample_from_bytes:
        return None
    slots = b.sparkSession.sparkContext.defaultParallelism
    part = b.sample(False, limits.sample_share, 17).repartition(slots)
    found = _match(part, q, ask, width, replace(limits, path=None, sample_from_bytes=1 << 62))
    return found.where(F.col("rank") == ask.k).select("query_id", F.col("distance").alias("bound"))


def _in_cells(b: DataFrame, q: DataFrame, ask: Ask, bounds: DataFrame | None, n_base: int, n_query: int,
              width: int, limits: Limits) -> DataFrame:
    kept = 0 if ask.k is None else 48 * ask.k
    cell_rows = max(1, limits.cell_bytes // (width + ROW_BYTES))
    query_rows = max(1, limits.cell_bytes // (width + ROW_BYTES + kept))
    if "grp" not in b.columns:
        b, q = b.withColumn("grp", F.lit(0).cast("bigint")), q.withColumn("grp", F.lit(0).cast("bigint"))
        ungrouped = True
    else:
        ungrouped = False
    bundles = max(1, math.ceil(n_base / cell_rows), math.ceil(n_query / query_rows))
    if ungrouped:
        cut_b, cut_q = math.ceil(n_base / cell_rows) or 1, math.ceil(n_query / query_rows) or 1
        hot = None
    else:
        hot = _hot_groups(b, q, cell_rows, query_rows)
        cut_b = cut_q = None

    if bounds is not None:
        q = q.join(bounds, "query_id", "left")
    else:
        q = q.withColumn("bound", F.lit(None).cast("double"))
    left = _cells(b, "vec_id", hot, "cut_b", "cut_q", cut_b, cut_q, bundles, own_first=False)
    right = _cells(q, "query_id", hot, "cut_q", "cut_b", cut_q, cut_b, bundles, own_first=True)
    keys = ("cell", "cell_q", "cell_b")
    n_cells = cut_b * cut_q if ungrouped else bundles + _count_cells(hot)
    both = left.select(*keys, "grp", "vec_id", F.col("v").alias("base_v")).unionByName(
        right.select(*keys, "grp", "query_id", "bound", F.col("v").alias("query_v")), allowMissingColumns=True
    )
    parts = n_cells * limits.cell_bytes // PARTITION_BYTES
    if parts > int(b.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        both = both.repartition(parts, *keys)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = pa.Table.from_batches(list(batches))
        lhs = cell.filter(pc.is_valid(cell.column("vec_id")))
        rhs = cell.filter(pc.is_valid(cell.column("query_id")))
        if lhs.num_rows and rhs.num_rows:
            base = Side.of(lhs.column("vec_id").to_numpy(), ask.scorer.load_base(lhs.column("base_v")),
                           lhs.column("grp").to_numpy())
            del cell, lhs  # the vectors are in the side
            step = SCAN_ROWS if ungrouped else rhs.num_rows  # in groups a query may have several rows, which share a sink
            for low in range(0, rhs.num_rows, step):
                some = rhs.slice(low, step)
                names, slots = np.unique(some.column("query_id").to_numpy(), return_inverse=True)
                queries = Side.of(some.column("query_id").to_numpy(),
                                  ask.scorer.load_query(some.column("query_v")),
                                  some.column("grp").to_numpy(), slots.ravel())
                limit = np.full(len(names), np.inf)
                np.minimum.at(limit, slots.ravel(), pc.fill_null(some.column("bound"), np.inf).to_numpy())
                sink = ask.sink(len(names), limit)
                yield from _run(ask, queries, base, sink, names)
                yield _rest(sink, names)

    return both.groupBy(*keys).applyInArrow(score, COUNTS if ask.counting else HITS)


def _probed_only(b: DataFrame, q: DataFrame) -> DataFrame:
    """Only base rows of groups that some query asks for: in every path, also for the sample of the bounds.

    Up to MAX_LISTED_GROUPS groups become a list, which reaches the scan of a table saved by list as a partition
    filter. More of them are a semi-join, broadcast or shuffled as their number allows.
    """
    asked = cut_lineage(q.select("grp").distinct())
    known = asked.limit(MAX_LISTED_GROUPS + 1).collect()
    if len(known) <= MAX_LISTED_GROUPS:
        return b.where(F.col("grp").isin([r.grp for r in known]))
    small = asked.count() <= MAX_BROADCAST_GROUPS
    return b.join(F.broadcast(asked) if small else asked, "grp", "left_semi")


def _hot_groups(b: DataFrame, q: DataFrame, cell_rows: int, query_rows: int) -> DataFrame:
    """Groups too large for one cell, with the number of cuts of each side.

    At most rows/cell_rows groups per side can be hot, so this table is small by construction. It is
    written once: both sides must see the same cuts.
    """
    nb = b.groupBy("grp").count().where(F.col("count") > cell_rows)
    nq = q.groupBy("grp").count().where(F.col("count") > query_rows)
    return cut_lineage(
        nb.select("grp", F.ceil(F.col("count") / cell_rows).cast("int").alias("cut_b"))
        .join(nq.select("grp", F.ceil(F.col("count") / query_rows).cast("int").alias("cut_q")),
              "grp", "full_outer")
        .select("grp", F.coalesce("cut_b", F.lit(1)).alias("cut_b"),
                F.coalesce("cut_q", F.lit(1)).alias("cut_q"))
    )


def _cells(df: DataFrame, id_name: str, hot: DataFrame | None, own: str, other: str, own_cut: int | None,
           other_cut: int | None, bundles: int, own_first: bool) -> DataFrame:
    """Add cell keys: each row gets its own cut by hash and one copy per cut of the other side."""
    if hot is None:
        cell = F.lit(0).cast("bigint")
        own_n, other_n = F.lit(own_cut), F.lit(other_cut)
    else:
        small = hot.count() <= MAX_BROADCAST_GROUPS
        df = df.join(F.broadcast(hot) if small else hot, "grp", "left")
        is_hot = F.col(own).isNotNull()
        # hot groups have cells of their own (negative numbers), the others share bundles
        cell = F.when(is_hot, -1 - F.pmod(F.xxhash64("grp"), F.lit((1 << 62) - 1))).otherwise(
            F.pmod(F.xxhash64("grp"), F.lit(bundles)))
        own_n, other_n = F.coalesce(own, F.lit(1)), F.coalesce(other, F.lit(1))
    mine = F.pmod(F.xxhash64(id_name), own_n).cast("int")
    copies = F.sequence(F.lit(0), other_n - 1)
    own_key, other_key = ("cell_q", "cell_b") if own_first else ("cell_b", "cell_q")
    extra = ["bound"] if own_first else []
    return df.select(
        id_name, "v", "grp", *extra, cell.cast("bigint").alias("cell"), mine.alias(own_key),
        F.explode(copies).alias(other_key),
    )


def _count_cells(hot: DataFrame) -> int:
    return hot.agg(F.sum(F.col("cut_b").cast("bigint") * F.col("cut_q"))).first()[0] or 0


def keyed(metric: str, column: str = "distance") -> Column:
    """Reported value of a key: inner products change sign back."""
    return -F.col(column) if metric in ("ip", "adc_ip") else F.col(column)


def check_k(k: int) -> None:
    if isinstance(k, bool) or not isinstance(k, int) or k <= 0:
        raise ConfigError(f"k must be a positive integer, got {k!r}")
