"""Operators against brute-force NumPy/pandas on small hand-made frames."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ridgeline.operators import evaluate, linear, logistic, prep, profile, rank, split
from ridgeline.operators.moments import moments
from ridgeline.operators.score import argmax_class, threshold_class, vector_scores
from ridgeline.sources import io


def _frame(spark, n=400, k=3, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, k)) * [1.0, 10.0, 0.1][:k] + [5.0, 1000.0, -2.0][:k]
    y = X @ np.array([1.5, -0.02, 3.0][:k]) + rng.normal(scale=0.5, size=n) + 7.0
    pdf = pd.DataFrame(X, columns=[f"x{i}" for i in range(k)])
    pdf["y"] = y
    pdf["id"] = np.arange(n)
    return spark.createDataFrame(pdf), X, y


# ---------------------------------------------------------------- scans
def test_comment_scan_rules(spark, tmp_path):
    lines = ["# leading comment", "", "   area, rooms ,price  ", "  80.5, 2, 300 # inline, with comma",
             "#whole line", "   ", "90,3,abc", "100, 1 ,  410.25"]
    p = tmp_path / "h.txt"
    p.write_text("\n".join(lines) + "\n")
    df = io.scan_comment_csv(spark, str(p), ["area", "rooms", "price"], header="area,rooms,price")
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [(80.5, 2.0, 300.0), (90.0, 3.0, None), (100.0, 1.0, 410.25)]


def test_label_from_text_null_is_zero(spark):
    df = spark.createDataFrame([("tested_positive",), ("tested_negative",), (None,), ("POSitive",)], "c string")
    got = [r["label"] for r in io.label_from_text(df, "c", "pos").collect()]
    assert got == [1, 0, 0, 1]


def test_calendar_monday_is_one(spark):
    df = spark.createDataFrame([("2023-01-02",), ("2023-01-08",), ("2023-12-30",)], "d string")
    got = [(r["month"], r["weekday"]) for r in prep.calendar(df, "d").collect()]
    assert got == [(1, 1), (1, 7), (12, 6)]


# ---------------------------------------------------------------- rank and splits
def test_global_rank_exact_with_hot_group(spark):
    # one group holds most rows: ranks must still be 1..n_g without gaps or repeats
    pdf = pd.DataFrame({"g": [0] * 900 + [1] * 90 + [2] * 10, "v": np.random.default_rng(1).normal(size=1000),
                        "id": np.arange(1000)})
    df = spark.createDataFrame(pdf)
    r = rank.global_rank(df, ["v", "id"], group_by=["g"], rank_col="r").toPandas()
    for g, part in r.groupby("g"):
        want = part.sort_values(["v", "id"])["r"].to_numpy()
        assert list(want) == list(range(1, len(part) + 1))


def test_prefix_sums(spark):
    pdf = pd.DataFrame({"k": np.arange(200)[::-1], "v": np.arange(200, dtype=float)})
    out = rank.prefix_sums(spark.createDataFrame(pdf), ["k"], ["v"]).toPandas().sort_values("k")
    assert np.allclose(out["v_cum"].to_numpy(), np.cumsum(pdf.sort_values("k")["v"].to_numpy()))


def test_exact_and_stratified_sizes(spark):
    df, _, _ = _frame(spark, n=397)
    df = df.withColumn("c", (F.col("id") % 3).cast("int"))
    ex = split.exact_split(df, ["id"], 0.2).groupBy("split").count().toPandas().set_index("split")["count"]
    assert ex["test"] == 80 and ex["train"] == 317
    st = split.stratified_split(df, ["id"], "c", 0.2).toPandas()
    test = st[st.split == "test"]
    assert len(test) == 80
    assert set(test.groupby("c").size()) <= {26, 27}
    tw = split.three_way_split(df, ["id"], 0.15, 0.176).groupBy("split").count().toPandas().set_index("split")["count"]
    assert tw["test"] == 60 and tw["val"] == int(np.ceil((397 - 60) * 0.176))


# ---------------------------------------------------------------- moments, GD, ridge
def test_moments_match_numpy(spark):
    df, X, y = _frame(spark)
    m = moments(df, ["x0", "x1", "x2", "y"])
    A = np.column_stack([X, y])
    assert np.allclose(m.mean, A.mean(0))
    assert np.allclose(m.cov, np.cov(A.T, bias=True))


def test_batch_gd_on_moments_equals_row_descent(spark):
    df, X, y = _frame(spark)
    feats = ["x0", "x1", "x2"]
    model = linear.fit_batch_gd(df, feats, "y", lr=0.05, max_iter=200, init="zeros", record_every=50)
    Z = (X - X.mean(0)) / X.std(0)
    yz = (y - y.mean()) / y.std()
    w, b = np.zeros(3), 0.0
    for _ in range(200):
        r = Z @ w + b - yz
        w, b = w - 0.05 * Z.T @ r / len(y), b - 0.05 * r.mean()
    assert np.allclose(model.weights, w, atol=1e-10) and abs(model.bias - b) < 1e-10
    last = 0.5 * np.mean((Z @ w + b - yz) ** 2)
    assert model.history[-1][0] == 150 and model.history[-1][1] >= last


def test_ridge_matches_closed_form(spark):
    df, X, y = _frame(spark)
    mom = moments(df, ["x0", "x1", "x2", "y"])
    fit = linear.ridge_solve(mom, ["x0", "x1", "x2"], "y", 10.0)
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + 10.0 * np.eye(3), Xc.T @ yc)
    assert np.allclose(fit.weights, w) and fit.intercept == pytest.approx(y.mean() - X.mean(0) @ w)


# ---------------------------------------------------------------- logistic
def test_logistic_gd_matches_numpy(spark):
    df, X, y = _frame(spark, n=300)
    thr = float(np.median(y))
    df = df.withColumn("t", (F.col("y") > thr).cast("int"))
    t = (y > thr).astype(float)
    m = logistic.fit_logistic_gd(df, ["x0", "x1", "x2"], "t", lr=0.5, max_iter=15, record_every=5)
    Z = (X - X.mean(0)) / X.std(0)
    w, b = np.zeros(3), 0.0
    for _ in range(15):
        p = 1 / (1 + np.exp(-(Z @ w + b)))
        w, b = w - 0.5 * Z.T @ (p - t) / len(t), b - 0.5 * (p - t).mean()
    assert np.allclose(m.weights, w, atol=1e-10) and m.bias == pytest.approx(b, abs=1e-10)
    assert [i for i, _ in m.history] == [0, 5, 10]


def test_one_vs_all_gd_step_matches_numpy(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(120, 4))
    lab = rng.integers(0, 3, size=120)
    df = spark.createDataFrame([(int(i), [float(v) for v in X[i]], int(lab[i])) for i in range(120)],
                               "id long, v array<double>, label int")
    fit = logistic.fit_one_vs_all(df, "v", "label", [0, 1, 2], [0.5], solver="gd", lr=1.0, max_iter=3)
    Z = np.hstack([np.ones((120, 1)), (X - X.mean(0)) / X.std(0)])
    th = np.zeros((3, 5))
    for _ in range(3):
        P = 1 / (1 + np.exp(-(Z @ th.T)))
        Y = (lab[:, None] == np.arange(3)[None, :]).astype(float)
        g = (P - Y).T @ Z / 120
        g[:, 1:] += 0.5 / 120 * th[:, 1:]
        th = th - g
    assert np.allclose(fit.theta[0, 0], th, atol=1e-12)


def test_argmax_first_on_ties_and_threshold(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([2.0, 1.0, 2.0],)], "s array<double>")
    assert [r[0] for r in df.select(argmax_class(F.col("s"))).collect()] == [1, 0]
    p = spark.createDataFrame([(0.5,), (0.4999,)], "p double")
    assert [r[0] for r in p.select(threshold_class(F.col("p"))).collect()] == [1, 0]


def test_vector_scores_fold_scaler(spark):
    theta = np.array([[0.5, 1.0, -2.0], [-1.0, 0.3, 0.7]])
    mean, scale = np.array([1.0, 2.0]), np.array([2.0, 0.5])
    df = spark.createDataFrame([([3.0, 1.0],)], "v array<double>")
    got = df.select(vector_scores("v", theta, mean, scale).alias("s")).collect()[0]["s"]
    z = (np.array([3.0, 1.0]) - mean) / scale
    assert np.allclose(got, theta[:, 0] + theta[:, 1:] @ z)


# ---------------------------------------------------------------- evaluation
def test_roc_auc_against_brute_force(spark):
    rng = np.random.default_rng(5)
    s = np.round(rng.normal(size=300), 1)      # many ties
    t = (rng.random(300) < 1 / (1 + np.exp(-2 * s))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"s": s, "t": t}))
    auc = evaluate.auc(df, "t", "s").collect()[0]["auc"]
    pos, neg = s[t == 1], s[t == 0]
    brute = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert auc == pytest.approx(brute, abs=1e-12)
    pts = evaluate.roc_points(df, "t", "s").orderBy("point").toPandas()
    assert (pts.fpr.iloc[0], pts.tpr.iloc[0]) == (0.0, 0.0) and (pts.fpr.iloc[-1], pts.tpr.iloc[-1]) == (1.0, 1.0)
    assert np.trapezoid(pts.tpr, pts.fpr) == pytest.approx(brute, abs=1e-12)


def test_confusion_fills_zero_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (2, 2)], "label int, prediction int")
    cm = {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion(df, "label", "prediction", [0, 1, 2]).collect()}
    assert len(cm) == 9 and cm[(0, 1)] == 1 and cm[(1, 1)] == 0


# ---------------------------------------------------------------- profiling
def test_histogram_right_edge_and_constant(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 10]], "x double")
    h = profile.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["n"] for r in h] == [2, 2, 0, 0, 1]
    c = profile.histogram(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x", 3).orderBy("bin").collect()
    assert [r["n"] for r in c] == [2, 0, 0]


def test_band_rates_sum_to_one_and_gap(spark):
    pdf = pd.DataFrame({"age": [19, 25, 30, 45, 50, 61], "lab": [0, 1, 1, 0, 1, 0]})
    bands = (("20-30", 20, 30), ("30-40", 30, 40), ("40-50", 40, 50), (">=50", 50, None))
    r = profile.rate_by_band(spark.createDataFrame(pdf), "lab", {"age": ("age", bands)}).toPandas()
    assert r.n.sum() == 5                                     # age 19 is in no band
    assert np.allclose(r.groupby("band").share.sum(), 1.0)


def test_box_stats_whiskers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in vals], "g string, x double")
    b = profile.box_stats(df, "g", "x").collect()[0]
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    assert (b["q1"], b["q3"]) == (q1, q3) and b["whisker_hi"] == 4.0 and b["n_outliers"] == 1


def test_inject_missing_counts(spark):
    df, _, _ = _frame(spark, n=500)
    out = prep.inject_missing(df, ["id"], ["x0", "x1", "x2"], 0.02).toPandas()
    assert out[["x0", "x1", "x2"]].isna().sum().sum() == 10
    assert out["y"].isna().sum() == 0 and out[["x0", "x1", "x2"]].isna().sum(axis=1).max() == 1


def _numpy_newton_ova(Z, lab, classes, lam, iters=50):
    m, n1 = Z.shape
    D = np.ones(n1)
    D[0] = 0.0
    out = []
    for c in classes:
        y = (lab == c).astype(float)
        th = np.zeros(n1)
        for _ in range(iters):
            p = 1 / (1 + np.exp(-(Z @ th)))
            g = Z.T @ (p - y) / m + lam / m * D * th
            H = (Z * (p * (1 - p))[:, None]).T @ Z / m + np.diag(lam / m * D)
            th = th - np.linalg.solve(H, g)
        out.append(th)
    return np.array(out)


def test_one_vs_all_newton_matches_numpy(spark):
    rng = np.random.default_rng(12)
    X = rng.normal(size=(150, 3))
    lab = rng.integers(0, 3, size=150)
    X[:, 0] += lab                     # some signal, not separable
    df = spark.createDataFrame([(int(i), [float(v) for v in X[i]], int(lab[i])) for i in range(150)],
                               "id long, v array<double>, label int")
    fit = logistic.fit_one_vs_all(df, "v", "label", [0, 1, 2], [1.0], solver="newton", max_iter=50)
    Z = np.hstack([np.ones((150, 1)), (X - X.mean(0)) / X.std(0)])
    want = _numpy_newton_ova(Z, lab, [0, 1, 2], 1.0)
    assert np.allclose(fit.theta[0, 0], want, atol=1e-6)
    assert fit.converged.all()


def test_logistic_newton_l2_matches_mllib(spark):
    df, X, y = _frame(spark, n=300, seed=4)
    df = df.withColumn("t", (F.col("y") > float(np.median(y))).cast("int"))
    nt = logistic.fit_logistic_newton(df, ["x0", "x1", "x2"], "t", l2=1.0, max_iter=30)
    lib = logistic.fit_logistic_mllib(df, ["x0", "x1", "x2"], "t", C=1.0, mean=nt.x_mean, scale=nt.x_scale)
    assert np.allclose(nt.weights, lib.weights, atol=1e-4) and abs(nt.bias - lib.bias) < 1e-4


def test_diabetes_edge_rows(spark):
    from ridgeline.plans import jobs
    rows = [(19.0, 0.0, 100.0, "tested_positive"), (30.0, 25.0, 126.0, "tested_negative"),
            (40.0, 30.0, 99.0, None), (50.0, 24.9, 125.9, "tested_positive")]
    raw = spark.createDataFrame([(0.0, g, 0.0, 0.0, 0.0, b, 0.0, a, c) for a, b, g, c in rows],
                                "preg double, plas double, pres double, skin double, insu double, mass double, "
                                "pedi double, age double, class string")
    df = jobs.diabetes_prepare(raw)
    assert [r["Outcome"] for r in df.orderBy("Age").collect()] == [1, 0, 0, 1]      # null class → 0
    r = profile.rate_by_band(df, "Outcome", jobs.RISK_BANDS).toPandas()
    age = r[r.dimension == "age"]
    assert age.n.sum() == 3                                                         # age 19: no band
    assert set(age.band) == {"30-40", "40-50", ">=50"}
    bmi = dict(r[r.dimension == "bmi"].groupby("band").n.sum())
    assert bmi == {"<25": 2, "25-30": 1, ">=30": 1}                                 # BMI 0 counts as a value
    glu = dict(r[r.dimension == "glucose"].groupby("band").n.sum())
    assert glu == {"<100": 1, "100-126": 2, ">=126": 1}


def test_constant_position_and_missing_class(spark):
    rng = np.random.default_rng(13)
    X = rng.normal(size=(90, 3))
    X[:, 1] = 7.0                                   # a constant pixel: sd 0 → scale 1
    lab = np.repeat([0, 1, 2], 30)
    df = spark.createDataFrame([(int(i), [float(v) for v in X[i]], int(lab[i])) for i in range(90)],
                               "id long, v array<double>, label int")
    sc = logistic.vector_scaler(df, "v")
    assert sc.scale[0, 1] == 1.0 and sc.mean[0, 1] == 7.0
    fit = logistic.fit_one_vs_all(df, "v", "label", [0, 1, 2], [0.1], solver="gd", max_iter=2)
    assert np.isfinite(fit.theta).all() and np.allclose(fit.theta[0, 0, :, 2], 0.0)   # z of the constant is 0
    test = spark.createDataFrame([(0, 0), (1, 1)], "label int, prediction int")     # class 2 absent from test
    rep = {r["class"]: r for r in evaluate.class_report(evaluate.confusion(test, "label", "prediction", [0, 1, 2])).collect()}
    assert rep["2"]["support"] == 0 and rep["2"]["precision"] == 0.0 and rep["2"]["f1"] == 0.0


def test_matrix_sink_round_trip_and_run_record(spark, tmp_path):
    cells = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("b", "y", 5)], "r string, c string, n long")
    wide = io.matrix_wide(cells, "r", "c", "n", ["x", "y", "z"])
    path = io.write_report(wide, str(tmp_path / "m"))
    back = io.read_report(spark, path, wide.schema)
    long = {(r["r"], r["col"]): r["n"] for r in io.matrix_long(back, "r", ["x", "y", "z"]).collect()}
    assert long == {("a", "x"): 2, ("a", "y"): 1, ("a", "z"): 0, ("b", "x"): 0, ("b", "y"): 5, ("b", "z"): 0}
    rec = io.run_summary(spark, {"n_train": 3, "weights": [0.5, -1.0], "metrics": {"r2": 0.9}}).collect()[0]
    assert rec["n_train"] == 3 and rec["weights"] == [0.5, -1.0] and rec["metrics"]["r2"] == 0.9


def test_first_groups_and_mean_sd(spark):
    df = spark.createDataFrame([(g, float(v)) for g in range(15) for v in (g, g + 2.0)], "g int, v double")
    assert [r["g"] for r in profile.first_groups(df, "g", 10).collect()] == list(range(10))
    st = profile.mean_sd(df, ["v"]).collect()[0]
    vals = np.array([v for g in range(15) for v in (g, g + 2.0)])
    assert st["mean"] == pytest.approx(vals.mean()) and st["sd"] == pytest.approx(vals.std())
