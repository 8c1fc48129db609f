"""Rows at ranks of a digest order without ordering the table."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ridgeline.operators import directory, linear
from ridgeline.operators.moments import moments


def md5(x):
    return hashlib.md5(str(x).encode()).hexdigest()


def in_order(ids):
    return sorted(ids, key=lambda i: (md5(i), i))


@pytest.mark.parametrize("bucket,digits", [(64, 4), (2, 1), (1, 2)])
def test_rows_at_ranks(spark, monkeypatch, bucket, digits):
    """One level, and a second one where buckets are crowded."""
    monkeypatch.setattr(directory, "BUCKET", bucket)
    monkeypatch.setattr(directory, "DIGITS", digits)
    ids = list(range(2000))
    want = in_order(ids)
    df = spark.createDataFrame([(i, i * 0.5) for i in ids], "id long, v double").withColumn("h", F.md5(F.col("id").cast("string")))
    ranks = random.Random(1).sample(range(1, 2001), 300) + [1, 2000, 2001, 0]
    got = {r["rank"]: (r.id, r.v) for r in directory.rows_at(df, "h", ["id"], ranks, 2000).collect()}
    assert got == {r: (want[r - 1], want[r - 1] * 0.5) for r in ranks if 1 <= r <= 2000}


def test_a_repeated_row_is_counted_not_ordered(spark):
    ids = [7] * 900 + list(range(100, 200)) + [8, 8]
    want = in_order(ids)
    df = spark.createDataFrame([(i, float(i)) for i in ids], "id long, v double").withColumn("h", F.md5(F.col("id").cast("string")))
    out = directory.rows_at(df, "h", ["id"], range(1, len(ids) + 1, 7), len(ids))
    assert {r["rank"]: r.id for r in out.collect()} == {r: want[r - 1] for r in range(1, len(ids) + 1, 7)}
    none = directory.rows_at(df.limit(0), "h", ["id"], [1, 2], 0)
    assert none.collect() == [] and none.columns == ["id", "v", "h", "rank"]


def test_sampled_descent_orders_only_what_it_draws(spark, monkeypatch):
    """No range exchange; what is written is a row for each draw, not the table."""
    df = spark.range(20_000).selectExpr("id", "cast(id % 97 as double) as x", "cast(id % 13 as double) + id % 97 as y")
    mom = moments(df, ["x", "y"])
    seen = []
    real = directory.rows_at
    monkeypatch.setattr(linear, "rows_at", lambda *a: seen.append(real(*a)) or seen[-1])
    drawn = linear.sampled_rows(df, ["x"], "y", ["id"], mom, max_iter=20, batch_size=8, seed=3)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert drawn.count() <= 20 * 8 + 20
    want = sorted(range(20_000), key=lambda i: (md5(f"{i}-perm-3"), i))
    assert all(r.id == want[r["rank"] - 1] for r in drawn.collect())
    for method in ("stochastic", "mini_batch"):
        fits = [linear.fit_sampled_gd(df, ["x"], "y", ["id"], method, max_iter=20, batch_size=8, seed=3, mom=mom, drawn=d)
                for d in (drawn, None)]
        assert fits[0].history == fits[1].history and abs(fits[0].weights - fits[1].weights).max() < 1e-12
