"""Nearest-neighbour edges of a table with itself: an exact join where it is the cheaper way, else NN-descent.

NN-descent keeps the ``reach`` best edges of every node and improves them in rounds: a node's neighbours and those that
name it are compared with one another, at least one edge of each compared pair being new since the round before. A round
joins sampled edges with the vectors of their ends, compares inside tasks, and sends back only pairs that are nearer
than the worst edge of their end. It stops when a round changes few edges. No number of lists or centres is involved.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearspan.plans.kernels import Scorer, best_rows, matrix, packed
from nearspan.plans.search import Ask, Limits, match_tables, top_k
from nearspan.plans.walk import pair_keys
from nearspan.session import attach, cut_lineage, spread

MAX_ROUNDS = 12
STOP_SHARE = 0.002
EXACT_ROWS = 2_000_000  # NN-descent took 39 ms of CPU for each of 10,256 vectors in five rounds, the exact join 11 ns a pair
EDGES = "src long, dst long, distance double"


def neighbour_edges(points: DataFrame, column: str, metric: str, reach: int, width: int, limits: Limits = Limits(),
                    method: str | None = None) -> DataFrame:
    """``(src, dst, distance)`` with up to ``reach`` edges per point ``(vec_id, <vector>)``; distances are keys."""
    attach(points.sparkSession)
    if method is None:
        n = points.count()
        method = "exact" if n * width <= limits.broadcast_bytes or n <= EXACT_ROWS else "descent"
    if method == "descent":
        return descend(points, column, metric, reach)
    hits = match_tables(points, spread(points).withColumnRenamed("vec_id", "query_id"), Ask(Scorer(metric), k=reach + 1),
                        base_vector=column, query_vector=column, width=width, limits=limits)
    hits = hits.where("query_id <> vec_id").select(F.col("query_id").alias("src"), F.col("vec_id").alias("dst"), "distance")
    return _nearest(hits, reach)


def _nearest(edges: DataFrame, reach: int) -> DataFrame:
    renamed = edges.withColumnsRenamed({"src": "query_id", "dst": "vec_id"})
    return top_k(renamed, reach).drop("rank").withColumnsRenamed({"query_id": "src", "vec_id": "dst"})


def _load(metric: str, column: pa.Array) -> np.ndarray:
    rows = matrix(column)
    return packed(rows) if metric == "hamming" else rows


def _batch(src, dst, key) -> pa.RecordBatch:
    return pa.record_batch([pa.array(src, pa.int64()), pa.array(dst, pa.int64()), pa.array(key, pa.float64())], ["src", "dst", "distance"])


def _first_edges(points: DataFrame, column: str, metric: str, reach: int) -> DataFrame:
    """Edges inside small groups drawn by a hash of the id; every node is in two of them, so that groups hang together."""
    groups = max(1, points.count() // (reach + 1))
    draws = F.array(*[F.struct(F.lit(i).alias("draw"), F.pmod(F.xxhash64("vec_id", F.lit(i)), F.lit(groups)).alias("part")) for i in (1, 2)])
    drawn = points.select("vec_id", F.col(column).alias("v"), F.explode(draws).alias("of")).select("vec_id", "v", "of.draw", "of.part")

    def compare(table: pa.Table) -> pa.Table:
        ids, x = table.column("vec_id").to_numpy(), _load(metric, table.column("v"))
        a, b = np.nonzero(~np.eye(len(ids), dtype=bool))
        key = pair_keys(metric, x[a], x[b])
        keep = best_rows(a, ids[b], key, reach)
        return pa.Table.from_batches([_batch(ids[a[keep]], ids[b[keep]], key[keep])])

    found = drawn.groupBy("draw", "part").applyInArrow(compare, EDGES)
    return _nearest(found.groupBy("src", "dst").agg(F.min("distance").alias("distance")), reach)


def descend(points: DataFrame, column: str, metric: str, reach: int, *, rounds: int = MAX_ROUNDS) -> DataFrame:
    """Edges by NN-descent."""
    attach(points.sparkSession)
    n = points.count()
    vectors = points.select(F.col("vec_id").alias("dst"), F.col(column).alias("v"))
    edges = cut_lineage(_first_edges(points, column, metric, reach).withColumn("new", F.lit(True)), "edges")
    for turn in range(rounds):
        worst = edges.groupBy("src").agg(F.max("distance").alias("worst"), F.count(F.lit(1)).alias("n"))
        worst = worst.select(F.col("src").alias("dst"), F.when(F.col("n") >= reach, F.col("worst")).otherwise(F.lit(float("inf"))).alias("worst"))
        around = edges.select("src", "dst", "new").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "new"))
        around = around.groupBy("src", "dst").agg(F.max("new").alias("new"))
        order = Window.partitionBy("src", "new").orderBy(F.xxhash64("src", "dst", F.lit(turn)), "dst")
        few = around.withColumn("place", F.row_number().over(order)).where(F.col("place") <= reach).select("src", "dst", "new")
        held = few.join(vectors, "dst").join(worst, "dst", "left").fillna(float("inf"), ["worst"])

        def compare(table: pa.Table) -> pa.Table:
            ids, x = table.column("dst").to_numpy(), _load(metric, table.column("v"))
            new, far = table.column("new").to_numpy(), table.column("worst").to_numpy()
            a, b = np.nonzero((new[:, None] | new[None, :]) & ~np.eye(len(ids), dtype=bool))
            key = pair_keys(metric, x[a], x[b])
            near = key < far[a]
            a, b, key = a[near], b[near], key[near]
            keep = best_rows(a, ids[b], key, reach)
            return pa.Table.from_batches([_batch(ids[a[keep]], ids[b[keep]], key[keep])])

        found = held.groupBy("src").applyInArrow(compare, EDGES).select("*", F.lit(True).alias("new"))
        both = edges.withColumn("new", F.lit(False)).unionByName(found)
        both = both.groupBy("src", "dst").agg(F.min("distance").alias("distance"), F.min("new").alias("new"))
        edges = cut_lineage(_nearest(both, reach), "edges")
        if edges.where("new").count() <= STOP_SHARE * n * reach:
            break
    return edges.drop("new")
