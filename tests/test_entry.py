"""Driver contract and a Spark-vs-DuckDB oracle sweep at sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
from ridgeline.plans.catalog import load_all  # noqa: E402

#: every query of the library that has an oracle
SAMPLE = [name for name, q in load_all().items() if q.sql]


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and set(df.columns) == {"n", "mse", "mae", "rmse", "r2"}


def test_registry_shapes():
    import __spark_entry__ as E
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 60


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle_matches(spark, duck, name):
    import __spark_entry__ as E
    from check import canon
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert canon(df.columns, srows) == canon(res.columns, res.fetchall())
