"""Input → output pairs published with the reference runs, replayed through our
operators.  The inputs are small enough to state here as fixed values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeline.operators import evaluate, explain, linear

# The published 10×10 digit confusion matrix (rows = truth).
DIGIT_CM = [[35, 0, 1, 0, 0, 0, 0, 0, 0, 0], [0, 31, 0, 1, 1, 0, 0, 0, 3, 0], [0, 0, 35, 0, 0, 0, 0, 0, 0, 0],
            [0, 0, 1, 36, 0, 0, 0, 0, 0, 0], [0, 0, 0, 0, 36, 0, 0, 0, 0, 0], [0, 0, 0, 0, 0, 37, 0, 0, 0, 0],
            [0, 0, 0, 0, 0, 0, 35, 0, 1, 0], [0, 0, 0, 0, 1, 0, 0, 35, 0, 0], [0, 2, 0, 0, 0, 0, 0, 0, 33, 0],
            [0, 0, 0, 0, 0, 0, 0, 2, 1, 33]]
# Published sales test truth and predictions (9 rows) and metrics.
SALES_Y = [386, 158, 395, 221, 217, 348, 158, 162, 382]
SALES_P = [376.22535137710605, 143.77659704910087, 397.7349923839582, 227.39913372296635, 228.93872122732253,
           350.87123153922045, 159.26754997326725, 157.46555882558462, 407.1409133452593]
SALES_MSE, SALES_RMSE, SALES_R2 = 127.92093795308227, 11.310213877424347, 0.9871608292452577
# Published batch-GD costs every 100 iterations and their rates.
BATCH_COSTS = [0.4364952065894767, 0.015449992173993591, 0.012862123617917439, 0.010850915064645117,
               0.009245946039470683, 0.007961496103813826, 0.006930782738131719, 0.006101560128985554,
               0.005432804136815861, 0.004892193054004769]
BATCH_RATES = [3.341168896945958, 0.18332165804345646, 0.17003742457698756, 0.16006422473100024,
               0.1495682545187318, 0.13864417888693392, 0.1274282587202471, 0.11608908105958715,
               0.10481473601656877]
# Published house weights and importance shares (%).
HOUSE_FEATURES = ["area", "room_num", "living_room_num", "floor", "distance_subway"]
HOUSE_W = [0.5070083134778322, 0.22450207945299835, 0.09136816126325076, 0.18191068282861378, -0.03279589163989455]
HOUSE_SHARE = [48.864261781715, 21.63697929464097, 8.805847225376205, 17.532121249953747, 3.160790448314086]
HOUSE_ORDER = ["area", "room_num", "floor", "living_room_num", "distance_subway"]
# Published validation R² by λ and the chosen λ.
LAMBDAS = [0.01, 0.1, 1, 10, 100]
LAMBDA_R2 = [0.954326816410687, 0.9629497054161298, 0.9677821293071024, 0.9393337785376111, 0.9268850016112846]
# Published normal quantiles of the 130-point Q-Q plot (first, 66th, last).
QQ_OSM = {1: -2.554454788833813, 66: 0.009614033249517538, 130: 2.554454788833813}


def _cm_df(spark):
    rows = [(i, j, n) for i, r in enumerate(DIGIT_CM) for j, n in enumerate(r)]
    return spark.createDataFrame(rows, "label int, prediction int, n long")


def test_class_report_matches_published(spark):
    rep = {r["class"]: r for r in evaluate.class_report(_cm_df(spark)).collect()}
    assert rep["accuracy"]["f1"] == pytest.approx(346 / 360)          # .9611
    assert round(rep["macro avg"]["f1"], 2) == 0.96
    assert round(rep["1"]["precision"], 2) == 0.94 and round(rep["1"]["recall"], 2) == 0.86
    assert round(rep["8"]["precision"], 2) == 0.87 and round(rep["8"]["f1"], 2) == 0.90
    assert rep["9"]["support"] == 36 and rep["weighted avg"]["support"] == 360


def test_confusable_pairs_published(spark):
    pairs = evaluate.confusable_pairs(_cm_df(spark)).orderBy(F.col("n").desc(), "class_a", "class_b").collect()
    assert (pairs[0]["class_a"], pairs[0]["class_b"], pairs[0]["n"]) == (1, 8, 5)
    assert (pairs[1]["class_a"], pairs[1]["class_b"], pairs[1]["n"]) == (7, 9, 2)


def test_regression_metrics_published(spark):
    df = spark.createDataFrame([(float(y), p) for y, p in zip(SALES_Y, SALES_P)], "y double, p double")
    m = evaluate.regression_metrics(df, "y", "p").collect()[0]
    assert m["mse"] == pytest.approx(SALES_MSE, rel=1e-12)
    assert m["rmse"] == pytest.approx(SALES_RMSE, rel=1e-12)
    assert m["r2"] == pytest.approx(SALES_R2, rel=1e-12)


def test_convergence_rates_published(spark):
    h = spark.createDataFrame([("batch", i * 100, c) for i, c in enumerate(BATCH_COSTS)],
                              "method string, iteration int, cost double")
    r = [x["rate"] for x in linear.convergence_rates(h).orderBy("iteration").collect()][1:]
    assert r == pytest.approx(BATCH_RATES, rel=1e-12)


def test_importance_shares_published(spark):
    imp = explain.importance(explain.coefficient_table(spark, HOUSE_FEATURES, HOUSE_W)).orderBy("rank").collect()
    assert [r["feature"] for r in imp] == HOUSE_ORDER
    got = {r["feature"]: r["share_pct"] for r in imp}
    assert [got[f] for f in HOUSE_FEATURES] == pytest.approx(HOUSE_SHARE, rel=1e-12)
    assert {r["feature"]: r["sign"] for r in imp}["distance_subway"] == "negative"


def test_lambda_pick_published():
    assert LAMBDAS[linear.best_position(LAMBDA_R2)] == 1
    assert linear.best_position([0.5, 0.5, float("nan")]) == 0          # ties keep the first, NaN never wins


def test_qq_quantiles_published(spark):
    df = spark.createDataFrame([(i, float(i) * 0.5 - 3.0) for i in range(130)], "id long, v double")
    q = {r["i"]: r["osm"] for r in evaluate.qq_points(df, "v", ["id"]).collect()}
    for i, v in QQ_OSM.items():
        assert q[i] == pytest.approx(v, abs=1e-12)
    assert len(q) == 130 and not any(math.isnan(x) for x in q.values())
    assert np.all(np.diff([q[i] for i in range(1, 131)]) > 0)
