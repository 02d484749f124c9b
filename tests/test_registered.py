"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as registered
from tools_check import TABLES, comparable

VECTOR = registered.vector_queries()
SQL = {name: sql for name, sql in registered.oracle_sql().items() if name in VECTOR}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_statement_has_a_query():
    assert set(SQL) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    got, want = comparable(registered.queries()[name](spark, SF).toPandas()), comparable(con.execute(SQL[name]).fetchdf())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want) > 0
    for c in got:
        assert got[c].dtype == want[c].dtype, c
        assert got[c].astype(str).tolist() == want[c].astype(str).tolist(), c


@pytest.mark.parametrize("name", sorted(set(VECTOR) - set(SQL)))
def test_query_without_sql_gives_whole_results(spark, name):
    rows = registered.queries()[name](spark, SF)
    n = registered.embeddings(spark, SF).count()
    if "recall" in rows.columns:
        found = rows.orderBy("ef").collect()
        assert all(r.queries == n for r in found) and found[-1].recall > 0.95
        assert [r.recall for r in found] == sorted(r.recall for r in found)
        return
    assert rows.select("query_id").distinct().count() == n
    assert rows.count() == n * registered.K
    assert rows.groupBy("query_id").agg({"vec_id": "count"}).count() == n


def test_entry(spark):
    assert registered.entry(spark).columns == ["query_id", "rank", "vec_id", "distance"]
