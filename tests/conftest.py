import os
import sys

import numpy as np
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def make(spark):
    """Vector table from a list of vectors; ids are positions."""
    def run(rows, name="vec_id", kind="array<double>"):
        return spark.createDataFrame(
            [(i, [float(x) for x in v]) for i, v in enumerate(rows)], f"{name} long, embedding {kind}")
    return run


@pytest.fixture(scope="session")
def make_codes(spark):
    def run(hexes, name="vec_id"):
        return spark.createDataFrame(
            [(i, bytearray.fromhex(h)) for i, h in enumerate(hexes)], f"{name} long, code binary")
    return run


@pytest.fixture(scope="session")
def formula():
    """Deterministic 8-wide vectors."""
    def run(n, start=0):
        return [[((((i + 3) * (j + 5)) % 17) + j) / 23 for j in range(8)] for i in range(start, start + n)]
    return run


@pytest.fixture(scope="session")
def randoms():
    def run(n, dims, seed=1):
        return np.random.default_rng(seed).standard_normal((n, dims))
    return run


def brute(queries, base, k, metric="l2"):
    """{query: [ids]} by definition, ties by id."""
    out = {}
    for i, q in enumerate(queries):
        d = ((base - q) ** 2).sum(axis=1) if metric == "l2" else -(base * q).sum(axis=1)
        out[i] = list(np.lexsort((np.arange(len(base)), d))[:k])
    return out


def ids_of(hits):
    """{query: [ids by rank]} of a result table."""
    out = {}
    for r in hits.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out
