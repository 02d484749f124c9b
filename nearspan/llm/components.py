"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearspan.session import attach, cut_lineage

#: So many edges (some 10 MB) are finished in one task; the count is taken before.
ALONE = 200_000


def components(edges: DataFrame, alone: int = ALONE) -> DataFrame:
    """(node, root) of every node of the undirected edges (a, b); the root is the smallest node of the component.

    While there are more than ``alone`` edges, a round maps every node to the smallest of itself and its neighbours and
    contracts: edges and labels are rewritten to the mapped nodes and loops vanish. Rounds write their tables to the
    shared folder. Minima are combined before they are shuffled, so a node with very many neighbours is no heavy key.
    The last ``alone`` edges are united in one task. Both ways give the same roots.
    """
    attach(edges.sparkSession)
    live = cut_lineage(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels = None
    while live.count() > alone:
        if labels is None:
            both = live.select("a").union(live.select("b")).distinct()
            labels = both.select(F.col("a").alias("node"), F.col("a").alias("root"))
        ends = live.select(F.col("a").alias("n"), F.col("b").alias("m")).union(live.select("b", "a"))
        to = cut_lineage(ends.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("to")), "hooks")
        labels = cut_lineage(_moved(labels, to), "labels")
        first = live.join(to, live.a == to.n).select(F.col("to").alias("x"), "b")
        moved = first.join(to, first.b == to.n).select("x", F.col("to").alias("y"))
        live = cut_lineage(moved.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                           .distinct(), "edges")
    rest = _united(live)
    return rest if labels is None else _moved(labels, rest.toDF("n", "to"))


def _moved(labels: DataFrame, to: DataFrame) -> DataFrame:
    return labels.join(to, labels.root == to.n, "left").select("node", F.coalesce("to", "root").alias("root"))


def _united(edges: DataFrame) -> DataFrame:
    """(node, root) of a bounded edge table, in one task."""
    def run(batches):
        parent: dict = {}

        def find(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                parent.setdefault(a, a)
                parent.setdefault(b, b)
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
        nodes = list(parent)
        yield pa.record_batch([pa.array(nodes, kind), pa.array([find(n) for n in nodes], kind)], ["node", "root"])

    name = dict(edges.dtypes)["a"]
    kind = {"binary": pa.binary(), "bigint": pa.int64(), "string": pa.string(), "int": pa.int32()}[name]
    return cut_lineage(edges.coalesce(1).mapInArrow(run, f"node {name}, root {name}"), "labels")
