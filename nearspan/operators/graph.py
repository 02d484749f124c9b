"""Graph search over float vectors or bit codes.

The graph is a table: each distinct vector is a node with at most ``2 * degree`` neighbours, chosen from its nearest
nodes and those that name it so that they lie in different directions (``plans.walk.choose_edges``). Every node lies in
the list of its nearest centre, and a search walks inside tasks: where the graph fits the broadcast limit over all of it,
else place by place: lists that lie side by side are one block of bounded size, queries go to the places of their nearest
centres, and what their beams touch beyond these is followed in one second round. So a search has a fixed number of
exchanges, however far its beams move. Lists and places are a layout; edges do not depend on them. New vectors are linked into a graph by :func:`insert`, which writes only the nodes it
touches. Equal vectors share one node and come back as single rows at the end, so copies neither crowd the beam nor meet
in one group.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nearspan.errors import ConfigError
from nearspan.operators import ivf
from nearspan.operators.exact import ranked
from nearspan.plans.descent import neighbour_edges
from nearspan.plans.kernels import matrix, packed
from nearspan.plans.search import Limits, check_k, top_k
from nearspan.plans.walk import Block, choose_edges, pair_keys
from nearspan.session import attach, cut_bucketed, cut_lineage
from nearspan.sources import tables

BUILD_ROUNDS = 3
ENTRY_LISTS = 4
HOT_QUERIES = 25_000
PLACE_CODE = 1 << 31
STEPS = "query_id long, vec_id long, distance double, place int, starts array<bigint>"


@dataclass(frozen=True)
class Graph:
    """``nodes(vec_id, <vector>, list_id, neighbours, places)`` (places: the lists of the neighbours),
    ``entries(list_id, vec_id)``, ``copies(node_id, vec_id)`` (None if all rows differ)."""

    nodes: DataFrame
    entries: DataFrame
    copies: DataFrame | None
    coarse: ivf.CoarseModel
    degree: int

    @property
    def metric(self) -> str:
        return self.coarse.metric

    @property
    def width(self) -> int:
        """Bytes of a stored vector."""
        return self.coarse.centres.shape[1] * (1 if self.metric == "hamming" else 8)


def build(base: DataFrame, *, dims: int, metric: str = "l2", degree: int = 16, pool: int = 200, spread: bool = True,
          method: str | None = None, limits: Limits = Limits()) -> Graph:
    """``pool`` is the wanted size of a list. ``method`` is how edges are found (``plans.descent``): ``exact`` or
    ``descent``, by size if not given. Without ``spread`` a node keeps its nearest candidates."""
    if degree <= 0 or pool <= 0:
        raise ConfigError("degree and pool must be positive integers")
    column = "code" if metric == "hamming" else "embedding"
    points, copies = _distinct(base, column)
    width = dims // 8 if metric == "hamming" else 8 * dims
    nlist = max(1, min(points.count() // pool, limits.broadcast_bytes // width))
    coarse = ivf.train(points, nlist, rounds=BUILD_ROUNDS, metric=metric)
    assigned = cut_lineage(ivf.assign(points, coarse), "nodes")
    edges = neighbour_edges(points, column, metric, 2 * degree, width, limits, method)
    linked = _link(assigned, _both_ways(edges, 2 * degree), assigned, metric, 2 * degree, spread, width, limits)
    nodes = cut_bucketed(linked, "list_id")
    return Graph(nodes, _entries(nodes, coarse), copies, coarse, degree)


def _distinct(base: DataFrame, column: str) -> tuple[DataFrame, DataFrame | None]:
    """Distinct vectors ``(vec_id, <vector>)`` under their smallest id, and the rows that share one."""
    distinct = cut_lineage(base.groupBy(column).agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("n")), "distinct")
    shared = distinct.where(F.col("n") > 1).select(F.col("vec_id").alias("node_id"), column)
    copies = None if shared.isEmpty() else cut_lineage(base.join(shared, column).select("node_id", "vec_id"), "copies")
    return distinct.select("vec_id", column), copies


def _both_ways(edges: DataFrame, most: int) -> DataFrame:
    """``(src, dst)`` of all edges, and of the nearest ``most`` turned ones of each node."""
    ways = F.array(F.struct(F.col("src").alias("a"), F.col("dst").alias("b"), F.lit(0).alias("way")),
                   F.struct(F.col("dst").alias("a"), F.col("src").alias("b"), F.lit(1).alias("way")))
    both = edges.select("distance", F.explode(ways).alias("e")).select("distance", "e.*")
    near = Window.partitionBy("a", "way").orderBy("distance", "b")
    few = both.withColumn("place", F.row_number().over(near)).where(F.col("place") <= most)
    return few.select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct()


def _link(nodes: DataFrame, candidates: DataFrame, ends: DataFrame, metric: str, degree: int, spread: bool, width: int,
          limits: Limits) -> DataFrame:
    """``nodes`` with the neighbours chosen from ``candidates(src, dst)``; ``ends`` holds vector and list of every ``dst``. Where
    the ends fit the broadcast limit only ids are shuffled, else the vectors of the candidates are."""
    attach(nodes.sparkSession)
    column = "code" if metric == "hamming" else "embedding"
    held, offer = None, F.col("dst")
    if ends.count() * width <= limits.broadcast_bytes:
        held = nodes.sparkSession.sparkContext.broadcast(_ends(ends, column))
    else:
        far = ends.select(F.col("vec_id").alias("dst"), F.struct(F.col("vec_id").alias("id"), "list_id", F.col(column).alias("v")).alias("end"))
        candidates, offer = candidates.join(far, "dst"), F.col("end")
    offered = candidates.groupBy(F.col("src").alias("vec_id")).agg(F.collect_list(offer).alias("ends"))
    rows = nodes.select("vec_id", column, "list_id").join(offered, "vec_id", "left")
    kind = dict(rows.dtypes)

    def choose(batches):
        for b in batches:
            for low in range(0, b.num_rows, 256):
                part = b.slice(low, 256)
                yield _chosen(part, metric, degree, spread, None if held is None else held.value)

    return rows.mapInArrow(choose, f"vec_id long, {column} {kind[column]}, list_id int, neighbours array<bigint>, places array<int>")


def _ends(ends: DataFrame, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, lists and vectors of a table whose size was checked, ordered by id."""
    table = ends.select("vec_id", "list_id", column).toArrow()
    ids = table.column("vec_id").to_numpy()
    order = np.argsort(ids)
    return ids[order], table.column("list_id").to_numpy()[order], matrix(table.column(column))[order]


def _chosen(part: pa.RecordBatch, metric: str, degree: int, spread: bool,
            held: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> pa.RecordBatch:
    x = matrix(part.column(1))
    lists = part.column(3)
    size = np.array([len(s) if s.is_valid else 0 for s in lists], np.int64)
    flat = lists.flatten()
    m, n = max(int(size.max(initial=0)), 1), part.num_rows
    real = np.arange(m)[None] < size[:, None]
    ids, places = np.zeros((n, m), np.int64), np.zeros((n, m), np.int32)
    ends = np.zeros((n, m, x.shape[1]), x.dtype)
    if len(flat) and held is not None:
        ids[real] = flat.to_numpy()
        at = np.searchsorted(held[0], ids[real])
        places[real], ends[real] = held[1][at], held[2][at]
    elif len(flat):
        ids[real], places[real] = flat.field("id").to_numpy(), flat.field("list_id").to_numpy()
        ends[real] = matrix(flat.field("v"))
    if metric == "hamming":
        x, ends = packed(x), packed(ends.reshape(n * m, -1)).reshape(n, m, -1)
    kept = choose_edges(metric, x, ends, ids, real, degree, spread)
    offsets = pa.array(np.r_[0, kept.sum(axis=1).cumsum()], pa.int32())
    return pa.record_batch([part.column(0), part.column(1), part.column(2), pa.ListArray.from_arrays(offsets, pa.array(ids[kept])),
                            pa.ListArray.from_arrays(offsets, pa.array(places[kept]))],
                           [*part.schema.names[:3], "neighbours", "places"])


def insert(graph: Graph, rows: DataFrame, *, ef: int = 100, spread: bool = True, limits: Limits = Limits()) -> Graph:
    """The graph with new rows ``(vec_id, <vector>)``: a search finds the neighbours of each new node, edges go both ways, and
    nodes with too many choose again. Only new and touched nodes are written; all other rows stay where they are."""
    metric, column, most = graph.metric, graph.coarse.column, 2 * graph.degree
    points, copies = _distinct(rows.select("vec_id", column), column)
    known = cut_lineage(points.join(graph.nodes.select(F.col("vec_id").alias("node_id"), column), column).select("node_id", "vec_id"), "copies")
    copies = _more_copies(graph.copies, copies, known)
    fresh = cut_lineage(ivf.assign(points.join(known.select("vec_id"), "vec_id", "left_anti"), graph.coarse), "nodes")
    if fresh.isEmpty():
        return replace(graph, copies=copies)

    asked = fresh.select(F.col("vec_id").alias("query_id"), column)
    found = _beams(graph, asked, max(ef, most), most, limits).select(F.col("query_id").alias("src"), F.col("vec_id").alias("dst"))
    among = _both_ways(neighbour_edges(fresh.select("vec_id", column), column, metric, most, graph.width, limits), most)
    ends = graph.nodes.select("vec_id", column, "list_id").unionByName(fresh)
    linked = cut_lineage(_link(fresh, found.union(among).distinct(), ends, metric, most, spread, graph.width, limits), "nodes")

    back = linked.select(F.explode("neighbours").alias("src"), F.col("vec_id").alias("dst")).join(
        fresh.select(F.col("vec_id").alias("src")), "src", "left_anti")
    touched = graph.nodes.join(back.select(F.col("src").alias("vec_id")).distinct(), "vec_id", "left_semi")
    offered = touched.select(F.col("vec_id").alias("src"), F.explode("neighbours").alias("dst")).union(back).distinct()
    changed = cut_lineage(_link(touched, offered, ends, metric, most, spread, graph.width, limits).unionByName(linked), "nodes")
    nodes = graph.nodes.join(changed.select("vec_id"), "vec_id", "left_anti").unionByName(changed)
    lists = cut_lineage(changed.select("list_id").distinct(), "lists")
    begun = _entries(nodes.join(lists, "list_id", "left_semi"), graph.coarse)
    entries = cut_lineage(graph.entries.join(lists, "list_id", "left_anti").unionByName(begun), "entries")
    return replace(graph, nodes=nodes, entries=entries, copies=copies)


def _more_copies(old: DataFrame | None, new: DataFrame | None, known: DataFrame) -> DataFrame | None:
    """Copies of a graph after new rows: ``new`` groups among them, ``known(node_id, vec_id)`` those that equal an old node. A
    node is in its own group, as in a graph built at once."""
    parts = [] if old is None else [old]
    if new is not None:
        moved = new.join(known.select(F.col("vec_id").alias("first"), F.col("node_id").alias("kept")), new.node_id == F.col("first"), "left")
        parts.append(moved.select(F.coalesce("kept", "node_id").alias("node_id"), "vec_id"))
    if not known.isEmpty():
        parts += [known, known.select("node_id", F.col("node_id").alias("vec_id"))]
    if not parts:
        return None
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return cut_lineage(whole.distinct(), "copies")


def save(graph: Graph, path: str, mode: str = "errorifexists") -> None:
    """Write the tables of a graph and its centres below one folder."""
    none = graph.nodes.sparkSession.createDataFrame([], "node_id long, vec_id long")
    for name, table in (("nodes", graph.nodes), ("entries", graph.entries), ("copies", none if graph.copies is None else graph.copies)):
        table.write.mode(mode).parquet(f"{path}/{name}")
    tables.save_model(graph.nodes.sparkSession, graph.coarse, f"{path}/coarse", mode)


def load(spark: SparkSession, path: str, metric: str, degree: int) -> Graph:
    """The graph as it was saved; its nodes are stored in buckets of their lists again."""
    read = {name: spark.read.parquet(f"{path}/{name}") for name in ("nodes", "entries", "copies")}
    coarse = tables.load_model(spark, ivf.CoarseModel, f"{path}/coarse", metric=metric)
    copies = None if read["copies"].isEmpty() else read["copies"]
    return Graph(cut_bucketed(read["nodes"], "list_id"), read["entries"], copies, coarse, degree)


def _entries(nodes: DataFrame, coarse: ivf.CoarseModel) -> DataFrame:
    """``(list_id, vec_id)``: where walks begin in a list. The node nearest to the centre, then, as long as some node cannot be
    reached from those inside the list, the nearest of these; so a walk can come to every node of a list."""
    attach(nodes.sparkSession)
    held = nodes.sparkSession.sparkContext.broadcast(coarse)

    def begin(key, table):
        m, place = held.value, key[0].as_py()
        block = _block(m.metric, table, m.column, place)
        centre = m.centres[place:place + 1]
        centre = packed(np.ascontiguousarray(centre)) if m.metric == "hamming" else centre
        near = pair_keys(m.metric, block.data, np.repeat(centre, len(block.ids), axis=0))
        reached, chosen = np.zeros(len(block.ids), bool), []
        for node in np.lexsort((block.ids, near)).tolist():
            if reached[node]:
                continue
            chosen.append(int(block.ids[node]))
            front = np.array([node])
            while len(front):
                reached[front] = True
                ends = block.inner[front]
                front = np.unique(ends[ends >= 0])
                front = front[~reached[front]]
        return pa.table({"list_id": pa.array([place] * len(chosen), pa.int32()), "vec_id": pa.array(chosen, pa.int64())})

    return cut_lineage(nodes.groupBy("list_id").applyInArrow(begin, "list_id int, vec_id long"), "entries")


def search(graph: Graph, queries: DataFrame, k: int, *, ef: int = 50, limits: Limits = Limits()) -> DataFrame:
    """Top-k per query by beam walks of width ``max(ef, k)``."""
    check_k(k)
    hits = _beams(graph, queries, max(ef, k), k, limits)
    if graph.copies is not None:
        hits = _with_copies(graph, hits, k)
    out = ranked(hits, graph.metric)
    return out.withColumn("distance", F.col("distance").cast("int")) if graph.metric == "hamming" else out


def _beams(graph: Graph, queries: DataFrame, ef: int, k: int, limits: Limits) -> DataFrame:
    """``(query_id, rank, vec_id, distance)``: the k best nodes of every beam."""
    attach(queries.sparkSession)
    asked = queries.select(F.col("query_id").cast("bigint").alias("query_id"), F.col(graph.coarse.column).alias("v"))
    n = graph.nodes.count()
    size = n * _node_bytes(graph)
    if limits.path == "base" or (limits.path is None and size <= limits.broadcast_bytes):
        return _walk_whole(graph, asked, ef, k)
    return top_k(_walk_places(graph, asked, ef, min(k, ef), n, limits), k)


def _node_bytes(graph: Graph) -> int:
    """Bytes of a node in a block: its id, its vector and the positions of its neighbours (four bytes each)."""
    return 8 + graph.width + 8 * graph.degree


def _block(metric: str, table: pa.Table, column: str, here: int | None, of_list: np.ndarray | None = None) -> Block:
    """``here`` is the list that the nodes are of, or with ``of_list`` (the place of every list) their place."""
    neighbours = table.column("neighbours").combine_chunks()
    counts, ends, lists = np.diff(neighbours.offsets.to_numpy()), neighbours.flatten().to_numpy(), None
    if here is not None:
        lists = table.column("places").combine_chunks().flatten().to_numpy()
        lists = lists if of_list is None else of_list[lists]
    return Block.of(metric, table.column("vec_id").to_numpy(), matrix(table.column(column)), counts, ends, lists, here)


def _whole(graph: Graph) -> Block | None:
    """The graph, whose size was checked, as one block (None if it is empty). Neighbours become positions in tasks, so the driver holds little more
    than the block: it is filled batch by batch."""
    column, rows = graph.coarse.column, graph.nodes.select("vec_id", graph.coarse.column, "neighbours")
    ids = np.sort(rows.select("vec_id").toArrow().column(0).to_numpy())
    if not len(ids):
        return None
    most = max(rows.agg(F.max(F.size("neighbours"))).first()[0] or 0, 1)
    known = graph.nodes.sparkSession.sparkContext.broadcast(ids)

    def place(batches):
        for b in batches:
            ends, count = b.column(2).flatten().to_numpy(), pc.list_value_length(b.column(2)).to_numpy()
            inner = np.full((b.num_rows, most), -1, np.int32)
            spot = np.minimum(np.searchsorted(known.value, ends), len(known.value) - 1)
            inner[np.arange(most) < count[:, None]] = np.where(known.value[spot] == ends, spot, -1)
            yield pa.record_batch([b.column(0), b.column(1), pa.array([r.tobytes() for r in inner], pa.binary())], ["vec_id", column, "inner"])

    table = rows.mapInArrow(place, f"vec_id long, {column} {dict(rows.dtypes)[column]}, inner binary").toArrow()
    known.destroy()
    at, data, inner = np.empty(len(ids), np.int64), None, np.empty((len(ids), most), np.int32)
    at[np.argsort(table.column(0).to_numpy(), kind="stable")] = np.arange(len(ids))
    for b in table.to_batches():
        spot, at = at[:b.num_rows], at[b.num_rows:]
        part = packed(matrix(b.column(1))) if graph.metric == "hamming" else matrix(b.column(1))
        data = np.empty((len(ids), part.shape[1]), part.dtype) if data is None else data
        data[spot], inner[spot] = part, matrix(b.column(2)).view(np.int32)
    none = np.empty(0, np.int64)
    return Block(graph.metric, ids, data, inner, (none, none, np.empty(0, np.int32)))


def _walk_whole(graph: Graph, asked: DataFrame, ef: int, k: int) -> DataFrame:
    """The graph in every task; queries stay where they are and are ranked there."""
    starts = np.unique(graph.entries.select("vec_id").toArrow().column(0).to_numpy())
    block = _whole(graph)
    held = asked.sparkSession.sparkContext.broadcast(None if block is None else (block, starts))

    def scan(batches):
        if held.value is None:
            return
        block, begin = held.value
        at = np.searchsorted(block.ids, begin)
        for b in batches:
            for low in range(0, b.num_rows, 512):
                part = b.slice(low, 512)
                ids = part.column(0).to_numpy()
                x = matrix(part.column(1))
                for slot, node, key in block.walk(x, None, at, ef, k):
                    first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]][:len(slot)])
                    rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)])) + 1
                    yield pa.record_batch([pa.array(ids[slot], pa.int64()), pa.array(block.ids[node], pa.int64()), pa.array(key, pa.float64()),
                                           pa.array(rank, pa.int32())], ["query_id", "vec_id", "distance", "rank"])

    return asked.mapInArrow(scan, "query_id long, vec_id long, distance double, rank int")


def _places(graph: Graph, most: int) -> np.ndarray:
    """The place of every list. Lists whose centres lie side by side share a place of up to ``most`` nodes, which one task
    walks as one block; a larger list has a place of its own. Both tables here are as long as the model."""
    sizes = graph.nodes.groupBy("list_id").agg(F.count(F.lit(1)).alias("n")).toArrow()
    n = np.zeros(graph.coarse.nlist, np.int64)
    n[sizes.column("list_id").to_numpy()] = sizes.column("n").to_numpy()
    centres = graph.coarse.centres
    x = np.unpackbits(centres, axis=1).astype(np.float64) if graph.metric == "hamming" else centres
    out, rest, place = np.zeros(len(n), np.int32), [np.arange(len(n))], 0
    while rest:
        part = rest.pop()
        if len(part) == 1 or n[part].sum() <= most:
            out[part], place = place, place + 1
            continue
        gap = x[part] - x[part].mean(axis=0)
        along = gap @ np.linalg.eigh(gap.T @ gap)[1][:, -1]
        part = part[np.argsort(along, kind="stable")]
        total = n[part].cumsum()
        cut = min(max(int(np.searchsorted(total, total[-1] / 2)), 1), len(part) - 1)
        rest += [part[:cut], part[cut:]]
    return out


def _walk_places(graph: Graph, asked: DataFrame, ef: int, k: int, n: int, limits: Limits) -> DataFrame:
    """Two rounds: the places of the nearest centres, from the entries of their lists, then the places that beams touched
    beyond them. Beams with room for every node go through every place, from all entries, in one round."""
    of_list = _places(graph, max(1, limits.place_bytes // _node_bytes(graph)))
    routed = cut_lineage(_routed(graph, asked, of_list, everywhere=ef >= n), "asked")
    if ef >= n:
        return _round(graph, routed, of_list, ef, k, False).select("query_id", "vec_id", "distance")
    first = cut_lineage(_round(graph, routed, of_list, ef, k, True), "beams")
    exits = first.where("distance IS NULL").groupBy("query_id", "place").agg(F.array_distinct(F.flatten(F.collect_list("starts"))).alias("starts"))
    again = exits.join(asked, "query_id").select(
        "query_id", "v", "place", F.lit(None).cast("array<int>").alias("lists"), F.lit(None).cast("array<int>").alias("went"), "starts")
    second = _round(graph, cut_lineage(again, "asked"), of_list, ef, k, False)
    return first.unionByName(second).where("distance IS NOT NULL").select("query_id", "vec_id", "distance")


def _routed(graph: Graph, asked: DataFrame, of_list: np.ndarray, everywhere: bool) -> DataFrame:
    """``asked(query_id, v)`` once per place: with the lists to begin at there (null: all of them) and all places it goes to."""
    held = asked.sparkSession.sparkContext.broadcast((graph.coarse, of_list))

    def route(batches):
        m, places = held.value
        for b in batches:
            if not b.num_rows:
                continue
            if everywhere:
                there = np.unique(places)
                row, place, lists = np.repeat(np.arange(b.num_rows), len(there)), np.tile(there, b.num_rows), None
            else:
                row, place, lists = ivf.nearest_places(m, matrix(b.column(1)), ENTRY_LISTS, places)
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            end = np.r_[first[1:], len(row)]
            own = np.searchsorted(first, np.arange(len(row)), "right") - 1
            span = np.repeat(first[own] - np.r_[0, (end - first)[own].cumsum()[:-1]], (end - first)[own]) + np.arange((end - first)[own].sum())
            went = pa.nulls(len(row), pa.list_(pa.int32())) if everywhere else pa.ListArray.from_arrays(
                pa.array(np.r_[0, (end - first)[own].cumsum()], pa.int32()), pa.array(place[span], pa.int32()))
            yield pa.record_batch([b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(place, pa.int32()),
                                   pa.nulls(len(row), pa.list_(pa.int32())) if lists is None else lists, went,
                                   pa.nulls(len(row), pa.list_(pa.int64()))], ["query_id", "v", "place", "lists", "went", "starts"])

    kind = dict(asked.dtypes)["v"]
    return asked.mapInArrow(route, f"query_id long, v {kind}, place int, lists array<int>, went array<int>, starts array<bigint>")


def _round(graph: Graph, asked: DataFrame, of_list: np.ndarray, ef: int, k: int, onward: bool) -> DataFrame:
    """Rows of STEPS: the ``k`` best of the beams of ``asked`` inside their places, and ``onward`` for each place that edges
    lead to and the query does not go to, where they end (without a distance). A place that very many queries ask for is
    copied, so that they are dealt over several tasks."""
    metric, column, spark = graph.metric, graph.coarse.column, asked.sparkSession
    held_places = spark.sparkContext.broadcast(of_list)
    table = F.broadcast(spark.createDataFrame(pa.table({"list_id": pa.array(np.arange(len(of_list)), pa.int32()), "place": pa.array(of_list, pa.int32())})))
    begins = graph.entries.select("list_id", "vec_id", F.lit(True).alias("begins")).distinct()
    cuts = asked.groupBy("place").agg(F.ceil(F.count(F.lit(1)) / HOT_QUERIES).cast("int").alias("cuts"))
    cuts = F.broadcast(cut_lineage(cuts, "cuts"))
    nodes = (graph.nodes.join(begins, ["list_id", "vec_id"], "left").join(table, "list_id").join(cuts, "place")
             .withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).drop("cuts"))
    asked = asked.join(cuts, "place").withColumn("cut", F.pmod(F.xxhash64("query_id"), F.col("cuts")).cast("int")).drop("cuts")

    def walk(key, held, wanted):
        out = [_steps([], [], [], None)]
        if held.num_rows and wanted.num_rows:
            places, here = held_places.value, key[0].as_py()
            block = _block(metric, held, column, here, places)
            ids, x = wanted.column("query_id").to_numpy(), matrix(wanted.column("v"))
            slots, starts = _begun(block, held, wanted)
            for slot, node, near in block.walk(x, slots, starts, ef, None if onward else k):
                first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]][:len(slot)])
                best = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)])) < k
                out.append(_steps(ids[slot[best]], block.ids[node[best]], near[best], None))
                if onward:
                    out.append(_onward(block, slot, node, ids, wanted.column("went")))
        return pa.Table.from_batches(out)

    return nodes.groupBy("place", "cut").cogroup(asked.groupBy("place", "cut")).applyInArrow(walk, STEPS)


def _begun(block: Block, held: pa.Table, wanted: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, position) where walks begin: at given nodes, or at the entries of given lists, or at all entries."""
    given = wanted.column("starts").combine_chunks()
    if given.null_count == 0:
        slots = np.repeat(np.arange(len(given)), np.diff(given.offsets.to_numpy()))
        return slots, np.searchsorted(block.ids, given.flatten().to_numpy())
    entry = held.filter(pc.is_valid(held.column("begins")))
    at, of = np.searchsorted(block.ids, entry.column("vec_id").to_numpy()), entry.column("list_id").to_numpy()
    lists = wanted.column("lists").combine_chunks()
    if lists.null_count:
        at = np.sort(at)
        return np.repeat(np.arange(len(lists)), len(at)), np.tile(at, len(lists))
    order = np.argsort(of, kind="stable")
    at, of, asked = at[order], of[order], lists.flatten().to_numpy()
    low, high = np.searchsorted(of, asked), np.searchsorted(of, asked, "right")
    size, slots = high - low, np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    return np.repeat(slots, size), at[np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())]


def _onward(block: Block, slot: np.ndarray, node: np.ndarray, ids: np.ndarray, went: pa.ChunkedArray) -> pa.RecordBatch:
    """One row per query and place that it does not go to yet: the ends of the edges that lead there."""
    who, end, place = block.exits(slot, node)
    went = went.combine_chunks()
    gone = np.repeat(np.arange(len(went)), np.diff(went.offsets.to_numpy())) * PLACE_CODE + went.flatten().to_numpy()
    new = ~np.isin(who * PLACE_CODE + place, gone)
    pairs = np.unique(np.stack([who[new], place[new], end[new]], axis=1), axis=0)
    first = np.flatnonzero(np.r_[True, (pairs[1:, :2] != pairs[:-1, :2]).any(axis=1)][:len(pairs)])
    starts = pa.ListArray.from_arrays(pa.array(np.r_[first, len(pairs)], pa.int32()), pa.array(pairs[:, 2], pa.int64()))
    return _steps(ids[pairs[first, 0]], None, None, (pairs[first, 1], starts))


def _steps(query, node, key, there) -> pa.RecordBatch:
    n = len(query)
    return pa.record_batch([pa.array(query, pa.int64()), pa.nulls(n, pa.int64()) if node is None else pa.array(node, pa.int64()),
                            pa.nulls(n, pa.float64()) if key is None else pa.array(key, pa.float64()),
                            pa.nulls(n, pa.int32()) if there is None else pa.array(there[0], pa.int32()),
                            pa.nulls(n, pa.list_(pa.int64())) if there is None else there[1]],
                           ["query_id", "vec_id", "distance", "place", "starts"])


def _with_copies(graph: Graph, hits: DataFrame, k: int) -> DataFrame:
    """Replace each node by the rows that share its vector; at most the k smallest ids can count."""
    few = top_k(graph.copies.select(F.col("node_id").alias("query_id"), "vec_id", F.lit(0.0).alias("distance")), k)
    few = few.select(F.col("query_id").alias("node_id"), F.col("vec_id").alias("copy_id"))
    rows = hits.drop("rank").join(few, hits.vec_id == few.node_id, "left").select(
        "query_id", F.coalesce("copy_id", "vec_id").alias("vec_id"), "distance")
    return top_k(rows, k)
