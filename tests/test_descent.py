"""Runs of local steps against a pass for each step; prefix sums that know their next row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeline.operators import evaluate, logistic, rank


def _rows(seed=0, n=600, k=4):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, k)) * [1, 5, 0.1, 2]
    y = (rng.random(n) < 1 / (1 + np.exp(-(X @ [1, -0.3, 4, 0.5] + 0.4)))).astype(float)
    return X, y


@pytest.mark.parametrize("lr,steps,l2", [(0.1, 700, 0.0), (0.5, 2000, 0.0), (1.0, 300, 3.0), (0.5, 1, 0.0), (0.5, 0, 0.0)])
def test_local_steps_are_the_same_descent(lr, steps, l2):
    X, y = _rows()
    X = (X - X.mean(axis=0)) / X.std(axis=0)
    blocks, passes = [(X[:200], y[:200]), (X[200:], y[200:])], []

    def sums(width, partial):
        passes.append(1)
        return sum((partial(b) for b in blocks), np.zeros(width))
    plain = logistic._descend(logistic._GD(4, lr, steps, None, 100, l2), sums)
    plain_passes = len(passes)
    passes.clear()
    fast = logistic._descend_locally(logistic._GD(4, lr, steps, None, 100, l2), sums)
    assert abs(plain.w - fast.w).max() < 1e-7 and abs(plain.b - fast.b) < 1e-7 and plain.it == fast.it == steps
    assert [i for i, _ in plain.hist] == [i for i, _ in fast.hist]
    assert all(abs(a - b) < 1e-8 for (_, a), (_, b) in zip(plain.hist, fast.hist, strict=True))
    if steps >= 300:
        assert len(passes) < plain_passes / 4


def test_a_run_that_is_too_long_is_taken_back(monkeypatch):
    X, y = _rows(3)
    blocks = [(X, y)]
    sums = lambda width, partial: sum((partial(b) for b in blocks), np.zeros(width))
    plain = logistic._descend(logistic._GD(4, 0.05, 150, None, 10, 0.0), sums)
    real, tried = logistic._LocalLoss.at, []
    monkeypatch.setattr(logistic._LocalLoss, "at", lambda self, theta: tried.append(1) or real(self, theta))
    fast = logistic._descend_locally(logistic._GD(4, 0.05, 150, None, 10, 0.0), sums)
    assert abs(plain.w - fast.w).max() < 1e-7 and len(tried) >= 150         # unscaled columns: some runs fail


def test_the_partitions_do_not_matter(spark, monkeypatch):
    X, y = _rows(1)
    df = spark.createDataFrame([(*map(float, x), int(t)) for x, t in zip(X, y, strict=True)], "a double, b double, c double, d double, t int")
    cols = ["a", "b", "c", "d"]
    one = logistic.fit_logistic_gd(df, cols, "t", 0.5, 400)
    monkeypatch.setattr(logistic, "right_sized", lambda d, rows, size: d.repartition(8))
    eight = logistic.fit_logistic_gd(df, cols, "t", 0.5, 400)
    slow = logistic.fit_logistic_gd(df, cols, "t", 0.5, 40, tol=0.0)            # a tolerance: a pass for each step
    fast = logistic.fit_logistic_gd(df, cols, "t", 0.5, 40)
    assert abs(one.weights - eight.weights).max() < 1e-8 and abs(slow.weights - fast.weights).max() < 1e-8


def test_derivatives_by_differences():
    X, y = _rows(2, 50, 4)
    local, theta = logistic._LocalLoss(4), np.array([0.1, -0.2, 0.05, 0.3, 0.0])
    local.centre(theta, local.partial(theta)[1]((X, y)))
    for step in (1e-3, 1e-2):
        d = np.array([1, -1, 0.5, 2, -0.3]) * step
        exact = logistic._LocalLoss(4)
        exact.centre(theta + d, exact.partial(theta + d)[1]((X, y)))
        cost, g = local.at(theta + d)
        scale = (abs(d).sum() * 12) ** 4
        assert abs(cost - exact.cost) < 50 * scale and abs(g - exact.g).max() < 500 * scale


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_prefix_sums_know_totals_and_the_next_row(spark, parts):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rng = np.random.default_rng(parts)
        v = rng.integers(0, 5, 40).astype(float)
        df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "i long, v double").repartition(5)
        out = rank.prefix_sums(df, ["i"], ["v"], num_partitions=parts, next_cols=["v"])
        rows = sorted(out.collect())
        assert [r.v_cum for r in rows] == np.cumsum(v).tolist() and {r.v_total for r in rows} == {v.sum()}
        assert [r.v_next for r in rows] == [*v[1:].tolist(), None]
        assert rank.prefix_sums(df.limit(0), ["i"], ["v"], next_cols=["v"]).collect() == []
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_roc_reads_its_ordered_scores_once(spark):
    df = spark.range(500).selectExpr("id % 2 as t", "cast(id % 83 as double) / 83 as s")
    plan = evaluate.roc_points(df, "t", "s")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1 and "SortMergeJoin" not in plan
    q = evaluate.qq_points(df.withColumn("id", F.monotonically_increasing_id()), "s", ["id"])
    assert q.count() == 500 and evaluate.qq_points(df.limit(0).withColumn("id", F.lit(1)), "s", ["id"]).count() == 0


def test_what_the_polynomial_lacks_is_carried_on():
    rng = np.random.default_rng(5)
    X = np.exp(1.3 * rng.normal(size=(4000, 4)))                 # long tails: large higher derivatives
    y = (rng.random(4000) < 1 / (1 + np.exp(-(X @ [1, -0.7, 0.3, -0.5])))).astype(float)
    X, passes = (X - X.mean(axis=0)) / X.std(axis=0), []

    def sums(width, partial):
        passes.append(1)
        return partial((X, y))
    plain = logistic._descend(logistic._GD(4, 0.5, 2000, None, 100, 0.0), sums)
    passes.clear()
    fast = logistic._descend_locally(logistic._GD(4, 0.5, 2000, None, 100, 0.0), sums)
    assert abs(plain.w - fast.w).max() < 1e-7 and abs(plain.b - fast.b) < 1e-7
    assert len(passes) < 120                                     # 179 by the polynomial alone


def test_a_large_iteration_input_is_spread_over_the_cores(spark):
    cores, rows = spark.sparkContext.defaultParallelism, 5 * logistic.ITER_TASK_ROWS
    for parts in (1, 3, 40):
        df = spark.range(0, rows, 1, parts)
        assert logistic.right_sized(df, rows, 72).rdd.getNumPartitions() == min(cores, 5)
        assert logistic.right_sized(df, 100, 72).rdd.getNumPartitions() == 1
    big = 50 * logistic.ITER_PARTITION_BYTES // 72
    assert logistic.right_sized(spark.range(10), big, 72).rdd.getNumPartitions() >= 50
