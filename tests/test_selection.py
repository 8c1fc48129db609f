"""Boundary selection: exact ranks and quantiles without a sort of the rows."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from ridgeline.operators import draws, prep, rank, split


@pytest.fixture(params=[20_000, 50])
def in_order(request, monkeypatch):
    monkeypatch.setattr(rank, "IN_ORDER", request.param)
    monkeypatch.setattr(rank, "SELECT_BINS", 16)


def columns():
    rng = np.random.default_rng(0)
    yield rng.normal(size=900)
    yield rng.standard_cauchy(size=900) * 1e6                                 # outliers
    yield np.concatenate([np.full(600, 3.0), rng.normal(size=300)])           # a value of most rows
    yield rng.integers(0, 3, 900).astype(float)
    yield np.concatenate([[-np.inf, np.inf, 1e308, -1e308], rng.normal(size=500)])
    yield np.array([4.0])


def test_order_statistics(spark, in_order):
    for x in columns():
        df = spark.createDataFrame([(1, float(v)) for v in x] + [(1, None), (1, float("nan"))], "g int, v double")
        s, n = np.sort(x), len(x)
        ranks = sorted({1, n, (n + 1) // 2, max(1, n // 7), min(n, 13)})
        targets = spark.createDataFrame([(1, r) for r in [*ranks, 0, n + 1]], "g int, rank long")
        got = {r["rank"]: (r["value"], r["below"], r["equal"]) for r in rank.order_statistics(df, "v", targets, ["g"]).collect()}
        assert sorted(got) == ranks
        for r in ranks:
            assert got[r] == (s[r - 1], int((s < s[r - 1]).sum()), int((s == s[r - 1]).sum()))


def test_grouped_quantiles(spark, in_order):
    rng = np.random.default_rng(1)
    groups = {"hot": rng.normal(size=700), "flat": np.full(90, 2.5), None: rng.normal(size=60), "one": np.array([1.0])}
    df = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in x] + [("nothing", None)], "g string, v double")
    qs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.q): r.value for r in rank.exact_quantiles(df, "v", qs, ["g"]).collect()}
    assert set(got) == {(g, q) for g in groups for q in qs}
    for g, x in groups.items():
        assert np.allclose([got[g, q] for q in qs], np.quantile(x, qs))


def test_splits_have_exact_sizes_and_no_row_is_moved(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 as k", "id * 2 as v")
    two = split.exact_split(df, ["id"], 0.123, 7)
    assert {r.split: r["count"] for r in two.groupBy("split").count().collect()} == {"test": 123, "train": 877}
    three = split.three_way_split(df, ["id"], 0.15, 0.176, 7)
    assert {r.split: r["count"] for r in three.groupBy("split").count().collect()} == {"test": 150, "val": 150, "train": 700}
    for out in (two, three, prep.inject_missing(df, ["id"], ["v"], 0.1, 7)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan
    part = split.stratified_split(df, ["id"], "k", 0.2, 7)
    got = {(r.k, r.split): r["count"] for r in part.groupBy("k", "split").count().collect()}
    assert sum(n for (_, s), n in got.items() if s == "test") == 200 and got[0, "test"] == 67
    assert "rangepartitioning" not in part._jdf.queryExecution().executedPlan().toString()


def test_split_with_repeated_keys(spark):
    df = spark.createDataFrame([(i // 4, i) for i in range(40)], "id long, v long")
    n = {r.split: r["count"] for r in split.exact_split(df, ["id"], 0.25, 3).groupBy("split").count().collect()}
    assert n["test"] == 12                      # rows with equal ids fall on one side
    assert split.exact_split(df.limit(0), ["id"], 0.2, 3).count() == 0
    assert {r.split for r in split.exact_split(df, ["id"], 0.0, 3).collect()} == {"train"}


def _draws(ids, seed):
    from ridgeline.functions.columns import hash_uniform_py
    return [hash_uniform_py(f"{i}-{seed}") for i in ids]


@pytest.mark.parametrize("most,bins", [(400_000, 4096), (40, 8)])
def test_cuts_of_draws_by_class(spark, monkeypatch, most, bins):
    """Analytic brackets, and the scans that go on where they hold too much, against sorting."""
    monkeypatch.setattr(draws, "MAX_DRAWS", most)
    monkeypatch.setattr(draws, "BINS", bins)
    rng = np.random.default_rng(3)
    ids = list(range(900)) + [7] * 500 + [11] * 2             # an id of a third of all rows
    label = ["a" if i % 3 else None for i in range(700)] + ["b"] * (len(ids) - 700)
    order = rng.permutation(len(ids))
    df = spark.createDataFrame([(ids[i], label[i]) for i in order], "id long, k string")
    sizes = split.class_sizes(df, "k")
    assert sizes == {c: label.count(c) for c in ("a", "b", None)}
    ranks = {c: [0, 1, n // 5, n // 2, n, n + 1] for c, n in sizes.items()}
    got = draws.hash_cuts(df, ["id"], 5, ranks, sizes, "k")
    for c, n in sizes.items():
        u = sorted(_draws([i for i, k in zip(ids, label, strict=True) if k == c], 5))
        assert sorted(got[c]) == sorted({r for r in ranks[c] if 1 <= r <= n})
        for r, cut in got[c].items():
            assert cut == draws.Cut(r, u[r - 1], sum(x < u[r - 1] for x in u), u.count(u[r - 1]))


def _scans(spark, monkeypatch, run):
    """How many scans :func:`draws.cuts` makes in ``run``."""
    seen = []
    real = draws._merged
    monkeypatch.setattr(draws, "_merged", lambda s: seen.append(1) or real(s))
    run()
    monkeypatch.setattr(draws, "_merged", real)
    return len(seen)


def test_one_scan_finds_the_draws(spark, monkeypatch):
    df = spark.range(300_000).selectExpr("id", "id % 3 as k")
    assert _scans(spark, monkeypatch, lambda: split.three_way_split(df, ["id"])) == 1
    assert _scans(spark, monkeypatch, lambda: split.fraction_subsets(df, ["id"], "k")) == 3      # classes of one scan
    big = spark.range(300_000).selectExpr("cast(pmod(id * 7919, 300007) as double) as v")
    found = {}
    assert _scans(spark, monkeypatch, lambda: found.update(rank.column_quantiles(big, ["v"], [0.5, 0.9]))) == 1
    v = np.array([(i * 7919) % 300_007 for i in range(300_000)], float)
    assert found["v"] == [np.quantile(v, 0.5), np.quantile(v, 0.9)]


def test_sketched_quantiles_with_hot_values_and_many_bins(spark, monkeypatch):
    monkeypatch.setattr(draws, "SMALL_CLASS", 100)
    monkeypatch.setattr(draws, "MAX_DRAWS", 30)
    monkeypatch.setattr(draws, "BINS", 16)
    qs = [0.0, 0.1, 0.5, 0.77, 1.0]
    cols = list(columns())
    for x in cols:
        df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "v double")
        got = {r.q: r.value for r in rank.exact_quantiles(df, "v", qs).collect()}
        s = np.sort(x)
        for q in qs:
            h = (len(s) - 1) * q
            want = s[int(h)] + (h - int(h)) * (s[int(np.ceil(h))] - s[int(h)])
            assert got[q] == want or (np.isnan(got[q]) and np.isnan(want))


def test_column_quantiles_of_many_and_empty_columns(spark, monkeypatch):
    monkeypatch.setattr(rank, "LITERAL_GROUPS", 3)
    df = spark.createDataFrame([(float(i), 2.0 * i, None, i % 2, -1.0 * i) for i in range(51)], "a double, b double, c double, d int, e double")
    got = rank.column_quantiles(df, ["a", "b", "c", "d", "e"], [0.5])
    assert got == {"a": [25.0], "b": [50.0], "d": [0.0], "e": [-25.0]}
    many = df.withColumn("g", F.col("a").cast("int") % 7)              # more groups than literals: the table form
    q = {r.g: r.value for r in rank.exact_quantiles(many, "b", [0.5], ["g"]).collect()}
    assert q == {g: float(np.median([2.0 * i for i in range(51) if i % 7 == g])) for g in range(7)}
    assert prep.medians(df.limit(0), ["a"]) == {}


def test_fraction_subsets_are_nested_prefixes_without_a_sort(spark):
    df = spark.range(1000).selectExpr("id", "if(id % 10 < 6, 'x', if(id % 10 = 9, null, 'y')) as k", "id as _u", "id as member0")
    fractions = (0.1, 0.5, 0.9)
    out = split.fraction_subsets(df, ["id"], "k", fractions, 11)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Join" not in plan
    assert out.columns == [*df.columns, "member"]
    rows = out.collect()
    for k in ("x", "y", None):
        own = sorted((u, r.id, r.member) for r, u in zip(rows, _draws([r.id for r in rows], 11), strict=True) if r.k == k)
        for i, f in enumerate(fractions):
            inside = [m[i] for _, _, m in own]
            assert inside == sorted(inside, reverse=True)                      # a prefix of the order
    sizes = split.class_sizes(df, "k")
    for i, f in enumerate(fractions):
        want = split.quotas(sizes, f, "floor")
        assert sum(want.values()) == int(1000 * f)
        assert {k: sum(r.member[i] for r in rows if r.k == k) for k in sizes} == want


def test_stratified_split_with_many_classes_and_ties(spark, monkeypatch):
    df = spark.createDataFrame([(i // 3, i, i % 5) for i in range(300)], "id long, v long, k int")
    few = {(r.k, r.split): r["count"] for r in split.stratified_split(df, ["id"], "k", 0.3, 4).groupBy("k", "split").count().collect()}
    monkeypatch.setattr(split, "LITERAL_CLASSES", 2)
    many = {(r.k, r.split): r["count"] for r in split.stratified_split(df, ["id"], "k", 0.3, 4).groupBy("k", "split").count().collect()}
    assert few == many and sum(n for (_, s), n in few.items() if s == "test") == 90
