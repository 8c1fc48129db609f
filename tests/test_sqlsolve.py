"""The SQL solver of the one-vs-all oracles against the library's Newton fit and closed statements."""

import numpy as np
import pytest

from ridgeline.operators import logistic
from ridgeline.plans import sqlsolve

duckdb = pytest.importorskip("duckdb")


def rows(seed, n, separable):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 3)) * [1.0, 5.0, 0.2] + [0.0, 7.0, -1.0]
    X[:, 1] = 7.0 if seed == 3 else X[:, 1]         # a constant position
    z = X[:, 0] + 0.5 * (X[:, 2] + 1.0) * 5
    y = (z + (0 if separable else 1.5) * rng.normal(size=n) > 0).astype(int)
    return [(i, int(y[i]), [float(v) for v in X[i]]) for i in range(n)]


def solved(data, lambdas):
    con = duckdb.connect()
    con.execute("CREATE TABLE src (vec_id BIGINT, label INTEGER, e DOUBLE[])")
    con.executemany("INSERT INTO src VALUES (?, ?, ?)", data)
    sql = ("WITH RECURSIVE pool AS (SELECT 0 AS s, vec_id, label, e, true AS train FROM src), "
           + sqlsolve.fit_ctes([0, 1], lambdas) + " SELECT lam, k, theta, cost, slope, apart FROM best ORDER BY lam, k")
    return con.sql(sql).fetchall()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_sql_minimiser_is_the_library_fit(spark, seed):
    data = rows(seed, 120, False)
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>").repartition(3)
    lambdas = [0.0, 0.1, 10.0]
    fit = logistic.fit_one_vs_all(df, "embedding", "label", [0, 1], lambdas)
    for lam, k, theta, cost, slope, apart in solved(data, lambdas):
        li = lambdas.index(lam)
        assert slope <= sqlsolve.STATIONARY and not apart and fit.converged[0, li, k]
        assert cost == pytest.approx(fit.cost[0, li, k], abs=1e-8)
        assert theta == pytest.approx(fit.theta[0, li, k].tolist(), abs=1e-4)


def test_classes_that_are_apart_have_no_minimiser_without_a_penalty(spark):
    data = rows(4, 60, True)
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>")
    fit = logistic.fit_one_vs_all(df, "embedding", "label", [0, 1], [0.0, 1.0])
    got = solved(data, [0.0, 1.0])
    assert [g[5] for g in got] == [True, True, False, False]
    assert fit.separated[0].tolist() == [[True, True], [False, False]]
    assert [g[4] <= sqlsolve.STATIONARY for g in got[2:]] == [True, True]
