"""Registered scoring, evaluation and interpretation queries.

The queries score with models fitted by the library on the test tables (house
batch GD, best-λ ridge, logistic GD, one-vs-all GD); the oracles re-fit the same
model in DuckDB (recursive CTEs) and evaluate it there.  ROC and AUC score the
labelled documents with a text measure (digit share), ties included.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.columns import inv_norm_sql
from ..operators import evaluate, explain, linear, logistic, profile
from ..operators.score import argmax_class, decision_grid, threshold_class
from . import sqlgen
from .catalog import memo, query, rnd, sig
from .q_linear import HOUSE_EVAL_SQL, ITERS, _house_gd_ctes, _pred_sql, _sales_ctes, house_fit, ridge_results
from .q_logistic import (CLASSES, OVA_LAMBDA, _logit_ctes, digit_split, logit_fit, LOGIT_ITERS, TEST_FRAC,
                         SEED)
from .q_profile import _bin_sql, _hist_sql
from .tasks import (DOC_FEATURES, DOC_TARGET, HOUSE_ID, HOUSE_TARGET, PATIENT_SQL, SALES_FEATURES,
                    SALES_TARGET, VEC_ID, patient_like)

assert HOUSE_EVAL_SQL  # the flagship metrics query (F1) lives in q_linear

# ---------------------------------------------------------------- house test predictions
_IDS = ", ".join(HOUSE_ID)
_HPRED = (_house_gd_ctes() + f", fin AS (SELECT w, b FROM gd WHERE it = {ITERS}), "
          f"pred AS MATERIALIZED (SELECT {_IDS}, {HOUSE_TARGET} AS y, {_pred_sql()} AS p FROM tagged, fin, mom "
          "WHERE split = 'test'), rs AS (SELECT *, y - p AS resid FROM pred)")


def house_test(spark, sf_dir):
    """Test rows of the house-like table with the batch-GD prediction in target units."""
    tagged, model = house_fit(spark, sf_dir)
    return tagged.where(F.col("split") == "test").withColumn("pred", model.predict_expr())


@query("predict_linear", ops=("E1", "E2", "B8"), sql=(
    _HPRED + f" SELECT {_IDS}, " + sqlgen.rnd("p", 2) + " AS prediction FROM pred"))
def predict_linear(spark, sf_dir):
    """X·w+b on raw features with both scalers folded into the weights (one codegen
    expression), back in target units."""
    t = house_test(spark, sf_dir)
    return t.select(*HOUSE_ID, rnd("pred", 2).alias("prediction"))


@query("residuals", ops=("F2",), sql=(
    _HPRED + f" SELECT {_IDS}, " + sqlgen.rnd("resid", 2) + " AS residual, "
    + sqlgen.rnd("abs(resid / y) * 100.0", 4) + " AS rel_error_pct FROM rs"))
def residuals(spark, sf_dir):
    """Residual and relative error % per test row (null where the truth is 0)."""
    r = evaluate.residuals(house_test(spark, sf_dir), HOUSE_TARGET, "pred")
    return r.select(*HOUSE_ID, rnd("residual", 2).alias("residual"), rnd("rel_error_pct", 4).alias("rel_error_pct"))


@query("prediction_range", ops=("F3",), sql=(
    _HPRED + " SELECT " + sqlgen.rnd("min(y)", 2) + " AS y_min, " + sqlgen.rnd("max(y)", 2) + " AS y_max, "
    + sqlgen.rnd("min(p)", 2) + " AS pred_min, " + sqlgen.rnd("max(p)", 2) + " AS pred_max FROM pred"))
def prediction_range(spark, sf_dir):
    """Min and max of truth and prediction on the test rows."""
    r = evaluate.prediction_range(house_test(spark, sf_dir), HOUSE_TARGET, "pred")
    return r.select(*[rnd(c, 2).alias(c) for c in ("y_min", "y_max", "pred_min", "pred_max")])


@query("residual_hist", ops=("F4", "C7"), sql=_HPRED + ", " + _hist_sql("rs", "resid", 30)[len("WITH "):])
def residual_hist(spark, sf_dir):
    """30-bin histogram of the test residuals."""
    r = evaluate.residuals(house_test(spark, sf_dir), HOUSE_TARGET, "pred")
    h = profile.histogram(r, "residual", 30)
    return h.select("bin", rnd("edge_lo", 4).alias("edge_lo"), rnd("edge_hi", 4).alias("edge_hi"), "n")


_QQ = (_HPRED + f", o AS (SELECT row_number() OVER (ORDER BY resid, {_IDS}) AS i, resid, count(*) OVER () AS n FROM rs), "
       "q AS (SELECT i, CASE WHEN i = n THEN pow(0.5, 1.0 / n::DOUBLE) WHEN i = 1 THEN 1.0 - pow(0.5, 1.0 / n::DOUBLE) "
       "ELSE (i::DOUBLE - 0.3175::DOUBLE) / (n::DOUBLE + 0.365::DOUBLE) END AS m_i, resid AS osr FROM o), "
       f"qq AS (SELECT i, m_i, {inv_norm_sql('m_i')} AS osm, osr FROM q)")


@query("qq_points", ops=("F6",), sql=(
    _QQ + " SELECT i, " + sqlgen.rnd("osm", 6) + " AS osm, " + sqlgen.rnd("osr", 2) + " AS osr FROM qq"))
def qq_points(spark, sf_dir):
    """Normal Q-Q points of the test residuals: distributed rank, Filliben medians,
    inverse normal CDF as a column expression."""
    r = evaluate.residuals(house_test(spark, sf_dir), HOUSE_TARGET, "pred")
    q = evaluate.qq_points(r, "residual", HOUSE_ID)
    return q.select(F.col("i").cast("long").alias("i"), rnd("osm", 6).alias("osm"), rnd("osr", 2).alias("osr"))


@query("qq_line", ops=("F6",), sql=(
    _QQ + " SELECT " + sqlgen.rnd("regr_slope(osr, osm)", 4) + " AS slope, " + sqlgen.rnd("regr_intercept(osr, osm)", 4)
    + " AS intercept, " + sqlgen.rnd("corr(osr, osm)", 6) + " AS r FROM qq"))
def qq_line(spark, sf_dir):
    """Least-squares line through the Q-Q points and its correlation."""
    r = evaluate.residuals(house_test(spark, sf_dir), HOUSE_TARGET, "pred")
    ln = evaluate.qq_line(evaluate.qq_points(r, "residual", HOUSE_ID))
    return ln.select(rnd("slope", 4).alias("slope"), rnd("intercept", 4).alias("intercept"), rnd("r", 6).alias("r"))


# ---------------------------------------------------------------- sales: best ridge model
_SB = (_sales_ctes() + ", bw AS MATERIALIZED (SELECT w, b FROM fit WHERE pos = (SELECT pos FROM best)), "
       "co AS MATERIALIZED (SELECT unnest([" + ", ".join(f"'{c}'" for c in SALES_FEATURES) + "]) AS feature, "
       f"unnest(range(0, {len(SALES_FEATURES)})) AS idx, unnest(w) AS weight FROM bw), "
       "st AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, m{i} AS mean, sqrt(c{i}_{i}) AS sd FROM m"
                                      for i, c in enumerate(SALES_FEATURES)) + ")")


def best_ridge(spark, sf_dir):
    tagged, moms, sweep = ridge_results(spark, sf_dir)
    best = next(r for r in sweep if r["is_best"])
    return tagged, best


def _sales_stats(spark, sf_dir):
    tagged, _ = best_ridge(spark, sf_dir)
    return profile.mean_sd(tagged.where(F.col("split") == "train"), SALES_FEATURES)


@query("trainval_residuals", ops=("F5", "B16", "F4"), sql=(
    _SB + ", tv AS (SELECT revenue - (bw.b + list_dot_product(bw.w, [" + ", ".join(SALES_FEATURES)
    + "]::DOUBLE[])) AS resid FROM tagged, bw WHERE split IN ('train', 'val')), "
    "rr AS (SELECT min(resid) AS lo, max(resid) AS hi FROM tv), "
    "cc AS (SELECT " + _bin_sql("resid", "lo", "hi", 20) + " AS bin, count(*) AS n FROM tv, rr GROUP BY 1) "
    "SELECT b.bin::INTEGER AS bin, coalesce(cc.n, 0)::BIGINT AS n FROM range(1, 21) b(bin) LEFT JOIN cc ON cc.bin = b.bin"))
def trainval_residuals(spark, sf_dir):
    """Residuals of the best-λ ridge model on train ∪ validation days: 20-bin counts."""
    tagged, best = best_ridge(spark, sf_dir)
    expr = F.lit(float(best["intercept"]))
    for c, w in zip(SALES_FEATURES, best["weights"]):
        expr = expr + F.col(c) * F.lit(float(w))
    tv = tagged.where(F.col("split").isin("train", "val")).withColumn("pred", expr)
    r = evaluate.residuals(tv, SALES_TARGET, "pred")
    return profile.histogram(r, "residual", 20).select("bin", "n")


def _coef(spark, sf_dir):
    _, best = best_ridge(spark, sf_dir)
    return explain.coefficient_table(spark, SALES_FEATURES, best["weights"])


@query("importance", ops=("G1", "G2"), sql=(
    _SB + " SELECT feature, " + sqlgen.sig("weight", 6) + " AS weight, "
    + sqlgen.rnd("abs(weight) / sum(abs(weight)) OVER () * 100.0", 4) + " AS share_pct, "
    "row_number() OVER (ORDER BY abs(weight) DESC, idx) AS rank, "
    "CASE WHEN weight > 0 THEN 'positive' ELSE 'negative' END AS sign FROM co"))
def importance(spark, sf_dir):
    """|w| share % and rank of the best ridge model's coefficients, with sign text."""
    i = explain.importance(_coef(spark, sf_dir))
    return i.select("feature", sig("weight", 6).alias("weight"), rnd("share_pct", 4).alias("share_pct"),
                    F.col("rank").cast("long").alias("rank"), "sign")


@query("effects", ops=("G3", "C12"), sql=(
    _SB + " SELECT feature, " + sqlgen.sig("mean", 8) + " AS mean, " + sqlgen.sig("weight * mean", 6)
    + " AS effect_at_mean FROM co JOIN st USING (feature)"))
def effects(spark, sf_dir):
    """Effect at the mean w·mean(x) with the training means."""
    e = explain.effects(_coef(spark, sf_dir), _sales_stats(spark, sf_dir))
    return e.select("feature", sig("mean", 8).alias("mean"), sig("effect_at_mean", 6).alias("effect_at_mean"))


@query("sensitivity", ops=("G4", "C12"), sql=(
    _SB + ", se AS (SELECT feature, idx, abs(weight) * sd AS sensitivity FROM co JOIN st USING (feature)) "
    "SELECT feature, " + sqlgen.sig("sensitivity", 6) + " AS sensitivity, "
    "row_number() OVER (ORDER BY sensitivity DESC, idx) AS rank FROM se"))
def sensitivity(spark, sf_dir):
    """|w|·sd_pop(x) per feature and its rank (its own order, not the weight order)."""
    s = explain.sensitivity(_coef(spark, sf_dir), _sales_stats(spark, sf_dir))
    return s.select("feature", sig("sensitivity", 6).alias("sensitivity"), F.col("rank").cast("long").alias("rank"))


# The unit and wording of each sales-like feature's impact line
# (feature, unit, unit text, word when the impact is positive, word otherwise),
# and the advice lines (feature, fires when the weight is positive?, text).
RULES = (("price", 1.0, "per unit of average price", "rises", "falls"),
         ("discount", 0.01, "per discount point", "rises", "falls"),
         ("quantity", 1.0, "per item sold", "rises", "falls"),
         ("n_lines", 1.0, "per order line", "rises", "falls"),
         ("holiday", 1.0, "on weekend days against weekdays", "is higher", "is lower"),
         ("month", 1.0, "per later month", "rises", "falls"),
         ("weekday", 1.0, "per later weekday", "rises", "falls"))
ADVICE = (("discount", True, "discounts lift revenue: keep promotions running"),
          ("price", False, "higher prices cut revenue: review the pricing"),
          ("holiday", True, "weekend revenue is higher: schedule campaigns on weekends"),
          ("quantity", True, "volume drives revenue: widen reach"))


def _values_sql(rows):
    def lit(v):
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, float):
            return f"{v!r}::DOUBLE"
        return "'" + str(v).replace("'", "''") + "'"
    return "VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


@query("rules", ops=("G6",), sql=(
    _SB + f", ru(feature, unit, unit_text, up_text, down_text) AS ({_values_sql(RULES)}), "
    f"ad(feature, when_positive, text) AS ({_values_sql(ADVICE)}) "
    "SELECT 'impact' AS kind, feature, printf('%s: target %s by %.2f %s', feature, "
    "CASE WHEN weight * unit > 0 THEN up_text ELSE down_text END, abs(weight * unit), unit_text) AS text "
    "FROM co JOIN ru USING (feature) UNION ALL "
    "SELECT 'advice', feature, text FROM co JOIN ad USING (feature) "
    "WHERE CASE WHEN when_positive THEN weight > 0 ELSE weight < 0 END"))
def rules(spark, sf_dir):
    """Business rule table: impact of one unit of each feature as text, plus the
    advice lines whose sign condition holds (rule tables broadcast-joined)."""
    coef = _coef(spark, sf_dir)
    ru = spark.createDataFrame(list(RULES), "feature string, unit double, unit_text string, up_text string, down_text string")
    ad = spark.createDataFrame(list(ADVICE), "feature string, when_positive boolean, text string")
    imp = explain.unit_impacts(coef, ru).select(F.lit("impact").alias("kind"), "feature", "text")
    adv = explain.recommendations(coef, ad).select(F.lit("advice").alias("kind"), "feature", "text")
    return imp.unionByName(adv)


# ---------------------------------------------------------------- binary: probabilities, grid, ROC
_XS_SQL = ", ".join(f"({c} - m{i}) / s{i}" for i, c in enumerate(DOC_FEATURES))
_LP = (_logit_ctes() + f", fin AS (SELECT w, b FROM gd WHERE it = {LOGIT_ITERS}), "
       f"za AS MATERIALIZED (SELECT doc_id, split, quality, [{_XS_SQL}]::DOUBLE[] AS x FROM tagged, sc)")


@query("predict_proba", ops=("E3", "E4", "E5"), sql=(
    _LP + ", pp AS (SELECT doc_id, 1.0 / (1.0 + exp(-(b + list_dot_product(w, x)))) AS p FROM za, fin WHERE split = 'test') "
    "SELECT doc_id, " + sqlgen.rnd("p", 6) + " AS probability, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS prediction FROM pp"))
def predict_proba(spark, sf_dir):
    """σ(X·w+b) and the class at p ≥ .5 for every test document."""
    tagged, m = logit_fit(spark, sf_dir)
    t = tagged.where(F.col("split") == "test").withColumn("p", m.proba_expr())
    return t.select("doc_id", rnd("p", 6).alias("probability"), threshold_class(F.col("p"), 0.5).alias("prediction"))


_GRID = (
    _LP + ", wi AS (SELECT unnest(w) AS wv, unnest(range(1, " + str(len(DOC_FEATURES) + 1)
    + ")) AS idx FROM fin), top AS (SELECT idx, wv, row_number() OVER (ORDER BY abs(wv) DESC, idx) AS r FROM wi), "
    "t1 AS (SELECT idx AS i1, wv AS w1 FROM top WHERE r = 1), t2 AS (SELECT idx AS i2, wv AS w2 FROM top WHERE r = 2), "
    "rg AS (SELECT min(x[i1]) AS lo1, max(x[i1]) AS hi1, min(x[i2]) AS lo2, max(x[i2]) AS hi2 FROM za, t1, t2), "
    "ga AS (SELECT unnest(range(0, ceil(((hi1 + 0.5::DOUBLE) - (lo1 - 0.5::DOUBLE)) / 0.02::DOUBLE)::BIGINT)) AS i FROM rg), "
    "gb AS (SELECT unnest(range(0, ceil(((hi2 + 0.5::DOUBLE) - (lo2 - 0.5::DOUBLE)) / 0.02::DOUBLE)::BIGINT)) AS j FROM rg), "
    "g AS (SELECT i, j, (lo1 - 0.5::DOUBLE) + i::DOUBLE * 0.02::DOUBLE AS x1, (lo2 - 0.5::DOUBLE) + j::DOUBLE * 0.02::DOUBLE AS x2 "
    "FROM rg, ga, gb), "
    "gp AS (SELECT i, j, CASE WHEN 1.0 / (1.0 + exp(-(b + x1 * w1 + x2 * w2))) >= 0.5 THEN 1 ELSE 0 END AS prediction "
    "FROM g, t1, t2, fin) ")


def _decision_cells(spark, sf_dir):
    tagged, m = logit_fit(spark, sf_dir)
    order = sorted(range(len(DOC_FEATURES)), key=lambda i: (-abs(m.weights[i]), i))
    i1, i2 = order[0], order[1]
    std = tagged.select(*[((F.col(DOC_FEATURES[i]) - F.lit(float(m.x_mean[i]))) / F.lit(float(m.x_scale[i]))).alias(n)
                          for i, n in ((i1, "s1"), (i2, "s2"))])
    return decision_grid(std, "s1", "s2", m.weights[i1], m.weights[i2], m.bias)


@query("decision_surface", ops=("E7",), sql=_GRID + "SELECT i::INTEGER AS i, j::INTEGER AS j, prediction FROM gp")
def decision_surface(spark, sf_dir):
    """The cells of the decision surface themselves: grid position and class."""
    return _decision_cells(spark, sf_dir).select("i", "j", "prediction")


@query("decision_grid", ops=("E7", "G1"), sql=_GRID + "SELECT prediction, count(*) AS n_cells FROM gp GROUP BY 1")
def decision_grid_query(spark, sf_dir):
    """Decision surface over the two largest-|w| standardised features (step .02,
    ±.5 margin, other features at 0): number of grid cells per predicted class."""
    g = _decision_cells(spark, sf_dir)
    return g.groupBy("prediction").agg(F.count(F.lit(1)).alias("n_cells"))


_ROC_BASE = (f"WITH pl AS ({PATIENT_SQL}), "
             "s AS (SELECT digit_share AS s, sum(quality)::DOUBLE AS pos, sum(1 - quality)::DOUBLE AS neg FROM pl GROUP BY 1), "
             "c AS (SELECT s, pos, neg, sum(pos) OVER (ORDER BY s DESC) AS tps, sum(neg) OVER (ORDER BY s DESC) AS fps, "
             "row_number() OVER (ORDER BY s DESC) AS k FROM s)")


@query("roc_points", ops=("F10",), sql=(
    _ROC_BASE + ", n AS (SELECT *, lead(pos) OVER (ORDER BY k) AS pn, lead(neg) OVER (ORDER BY k) AS nn, "
    "max(k) OVER () AS kmax, max(tps) OVER () AS tp_all, max(fps) OVER () AS fp_all FROM c) "
    "SELECT 0::BIGINT AS point, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr UNION ALL "
    "SELECT k, " + sqlgen.rnd("fps / fp_all", 9) + ", " + sqlgen.rnd("tps / tp_all", 9)
    + " FROM n WHERE k = 1 OR k = kmax OR pn <> pos OR nn <> neg"))
def roc_points(spark, sf_dir):
    """ROC of the digit share as a quality score over all labelled documents: one
    point per distinct score (ties grouped), collinear points dropped, (0,0) first."""
    d = patient_like(spark, sf_dir)
    r = evaluate.roc_points(d, DOC_TARGET, "digit_share")
    return r.select(F.col("point").cast("long").alias("point"), rnd("fpr", 9).alias("fpr"), rnd("tpr", 9).alias("tpr"))


@query("auc", ops=("F11",), sql=(
    _ROC_BASE + " SELECT " + sqlgen.rnd("sum(neg * (2 * tps - pos)) / (2 * sum(pos) * sum(neg))", 9) + " AS auc FROM c"))
def auc(spark, sf_dir):
    """Trapezoid area under that ROC."""
    a = evaluate.auc(patient_like(spark, sf_dir), DOC_TARGET, "digit_share")
    return a.select(rnd("auc", 9).alias("auc"))


# ---------------------------------------------------------------- multi-class by one-vs-all GD
OVA_GD_LR, OVA_GD_ITERS = 1.0, 100


def ova_gd_fit(spark, sf_dir):
    def build():
        tagged = digit_split(spark, sf_dir).persist()
        train = tagged.where(F.col("split") == "train")
        fit = logistic.fit_one_vs_all(train, "embedding", "label", CLASSES, [OVA_LAMBDA], solver="gd",
                                      lr=OVA_GD_LR, max_iter=OVA_GD_ITERS)
        return tagged, fit
    return memo(spark, ("ova_gd", sf_dir), build)


def _ova_gd_sql():
    from ..functions.columns import hash_uniform_sql
    u = hash_uniform_sql(VEC_ID, SEED)
    n1 = 65  # 64 embedding positions (fixed by the table) + bias
    g = ", ".join(f"sum((p - y) * x[{j}])" for j in range(1, n1 + 1))
    return (
        "WITH RECURSIVE e AS MATERIALIZED (SELECT vec_id, label, embedding FROM embeddings), "
        + sqlgen.stratified_ctes("e", VEC_ID, "label", TEST_FRAC, u) + ", "
        "ex AS (SELECT unnest(embedding)::DOUBLE AS v, unnest(range(1, len(embedding) + 1)) AS pos FROM tagged WHERE split = 'train'), "
        "stv AS MATERIALIZED (SELECT list(mu ORDER BY pos) AS mu, list(sd ORDER BY pos) AS sd FROM ("
        "SELECT pos, avg(v) AS mu, CASE WHEN stddev_pop(v) > 0 THEN stddev_pop(v) ELSE 1.0 END AS sd FROM ex GROUP BY pos)), "
        "z AS MATERIALIZED (SELECT vec_id, label, split, list_prepend(1.0::DOUBLE, list_transform(embedding, "
        "lambda v, i: (v::DOUBLE - stv.mu[i]) / stv.sd[i])) AS x FROM tagged, stv), "
        "cls AS (SELECT unnest(range(0, 10)) AS k), "
        f"gd(it, k, th, cost) AS (SELECT 0, k, list_transform(range(0, {n1}), lambda j: 0.0::DOUBLE), NULL::DOUBLE FROM cls "
        f"UNION ALL SELECT it + 1, k, list_transform(th, lambda t, j: t - {OVA_GD_LR!r} * (g[j] / m "
        f"+ CASE WHEN j > 1 THEN {OVA_LAMBDA!r} / m * t ELSE 0.0 END)), "
        f"ce / m + {OVA_LAMBDA!r} / (2.0 * m) * list_sum(list_transform(list_slice(th, 2, {n1}), lambda t: t * t)) FROM ("
        f"SELECT it, k, th, count(*)::DOUBLE AS m, [{g}]::DOUBLE[] AS g, "
        "sum(-(y * ln(p + 1e-15) + (1.0 - y) * ln(1.0 - p + 1e-15))) AS ce FROM ("
        "SELECT gd.it, gd.k, gd.th, z.x, CASE WHEN z.label = gd.k THEN 1.0 ELSE 0.0 END AS y, "
        "1.0 / (1.0 + exp(-list_dot_product(gd.th, z.x))) AS p FROM gd, z "
        f"WHERE z.split = 'train' AND gd.it < {OVA_GD_ITERS}) GROUP BY it, k, th)), "
        f"fin AS (SELECT k, th FROM gd WHERE it = {OVA_GD_ITERS}), "
        "sc AS (SELECT z.vec_id, z.label, z.split, fin.k, list_dot_product(fin.th, z.x) AS s FROM z, fin), "
        "pr AS (SELECT vec_id, label, split, k AS prediction FROM ("
        "SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, k) AS r FROM sc) WHERE r = 1), "
        "te AS (SELECT * FROM pr WHERE split = 'test'), "
        "cells AS (SELECT a.k AS label, c.k AS prediction FROM cls a, cls c), "
        "cm AS (SELECT cells.label, cells.prediction, count(te.vec_id)::BIGINT AS n FROM cells LEFT JOIN te "
        "ON te.label = cells.label AND te.prediction = cells.prediction GROUP BY 1, 2)"
    )


def _ova_test(spark, sf_dir):
    tagged, fit = ova_gd_fit(spark, sf_dir)
    s = logistic.ova_scores("embedding", fit.theta[0, 0], fit.scaler.mean[0], fit.scaler.scale[0])
    return tagged.where(F.col("split") == "test").withColumn("prediction", argmax_class(s))


def _ova_cm(spark, sf_dir):
    return evaluate.confusion(_ova_test(spark, sf_dir), "label", "prediction", classes=CLASSES)


@query("ova_gd", ops=("D16", "D17", "B9"), sql=(
    _ova_gd_sql() + " SELECT k::INTEGER AS class, " + sqlgen.rnd("cost", 9) + " AS cost, "
    + sqlgen.rnd("list_sum(th)", 6) + " AS theta_sum FROM gd WHERE it = " + str(OVA_GD_ITERS)))
def ova_gd(spark, sf_dir):
    """Ten one-vs-all L2 logistic models (λ=.1) advanced together by 100 gradient
    steps (one block-kernel pass each): L2 cost before the last step and final Σθ
    per class."""
    _, fit = ova_gd_fit(spark, sf_dir)
    cost = fit.history[OVA_GD_ITERS - 1][1]  # J at the start of the last step
    rows = [(c, float(cost[k]), float(np.sum(fit.theta[0, 0, k]))) for k, c in enumerate(CLASSES)]
    return spark.createDataFrame(rows, "class int, cost double, theta_sum double") \
                .select("class", rnd("cost", 9).alias("cost"), rnd("theta_sum", 6).alias("theta_sum"))


@query("predict_multiclass", ops=("E6",), sql=(
    _ova_gd_sql() + " SELECT vec_id, prediction::INTEGER AS prediction FROM te"))
def predict_multiclass(spark, sf_dir):
    """Argmax over the ten class scores (first class on ties) for every test vector."""
    return _ova_test(spark, sf_dir).select("vec_id", "prediction")


@query("confusion", ops=("F7",), sql=(
    _ova_gd_sql() + " SELECT label::INTEGER AS label, prediction::INTEGER AS prediction, n FROM cm"))
def confusion(spark, sf_dir):
    """10×10 confusion cells (zeros included) on the test split."""
    return _ova_cm(spark, sf_dir)


@query("accuracy", ops=("F8",), sql=(
    _ova_gd_sql() + " SELECT " + sqlgen.rnd("avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END)", 9)
    + " AS accuracy, count(*) AS n FROM te"))
def accuracy(spark, sf_dir):
    """Test accuracy of the one-vs-all GD model."""
    a = evaluate.accuracy(_ova_test(spark, sf_dir), "label", "prediction")
    return a.select(rnd("accuracy", 9).alias("accuracy"), F.col("n").cast("long").alias("n"))


@query("class_report", ops=("F9",), sql=_ova_gd_sql() + sqlgen.report_sql())
def class_report(spark, sf_dir):
    """Per-class precision, recall, F1, support; accuracy, macro and weighted averages."""
    rep = evaluate.class_report(_ova_cm(spark, sf_dir))
    return rep.select("class", rnd("precision", 6).alias("precision"), rnd("recall", 6).alias("recall"),
                      rnd("f1", 6).alias("f1"), "support")


@query("confusable_pairs", ops=("F13",), sql=(
    _ova_gd_sql() + " SELECT least(label, prediction)::INTEGER AS class_a, greatest(label, prediction)::INTEGER AS class_b, "
    "sum(n)::BIGINT AS n FROM cm WHERE label <> prediction GROUP BY 1, 2 HAVING sum(n) > 0"))
def confusable_pairs(spark, sf_dir):
    """Unordered class pairs with their symmetric off-diagonal counts."""
    p = evaluate.confusable_pairs(_ova_cm(spark, sf_dir))
    return p.select("class_a", "class_b", F.col("n").cast("long").alias("n"))


@query("weight_map", ops=("G5",), sql=(
    _ova_gd_sql() + " SELECT k::INTEGER AS class, (i // 8)::INTEGER AS row, (i % 8)::INTEGER AS col, "
    + sqlgen.rnd("th[i + 2]", 6) + " AS weight FROM fin, range(0, 64) t(i)"))
def weight_map(spark, sf_dir):
    """θ without bias of every one-vs-all class as a d×d grid (d = ⌊√n⌋):
    (class, row, col, weight) by ``posexplode`` of the coefficient rows."""
    _, fit = ova_gd_fit(spark, sf_dir)
    theta = fit.theta[0, 0]
    coef = spark.createDataFrame([(c, [float(v) for v in theta[k, 1:]]) for k, c in enumerate(CLASSES)],
                                 "class int, w array<double>")
    d = int(np.sqrt(theta.shape[1] - 1))
    e = coef.select("class", F.posexplode("w").alias("i", "weight")).where(F.col("i") < d * d)
    return e.select("class", (F.col("i") / d).cast("int").alias("row"), (F.col("i") % d).cast("int").alias("col"),
                    rnd("weight", 6).alias("weight"))


@query("misclassified_sample", ops=("F12",), sql=(
    _ova_gd_sql() + " SELECT te.vec_id, te.label::INTEGER AS label, te.prediction::INTEGER AS prediction, e.embedding "
    "FROM te JOIN e USING (vec_id) WHERE te.label <> te.prediction "
    f"ORDER BY md5(concat_ws('-', te.vec_id, '{SEED}')), te.vec_id LIMIT 10"))
def misclassified_sample(spark, sf_dir):
    """Up to 10 misclassified test vectors in md5 order (TakeOrdered, no full sort),
    with their unscaled values."""
    test = _ova_test(spark, sf_dir)
    return evaluate.misclassified_sample(test, "label", "prediction", VEC_ID, 10, SEED) \
                   .select("vec_id", "label", "prediction", "embedding")


# ---------------------------------------------------------------- ridge details on the sales table


@query("ridge_fit", ops=("D9",), sql=(
    _sales_ctes() + ", f1 AS (SELECT w, b FROM fit WHERE lam = 1.0) SELECT feature, " + sqlgen.sig("weight", 6)
    + " AS weight FROM (SELECT unnest([" + ", ".join(f"'{c}'" for c in SALES_FEATURES)
    + ", 'intercept']) AS feature, unnest(list_append(w, b)) AS weight FROM f1)"))
def ridge_fit(spark, sf_dir):
    """Ridge at λ=1: minimise RSS + λ‖w‖² on unscaled features, free intercept,
    solved from the training moments."""
    _, moms, _ = ridge_results(spark, sf_dir)
    fit = linear.ridge_solve(moms["train"], SALES_FEATURES, SALES_TARGET, 1.0)
    rows = [(f, float(w)) for f, w in zip(SALES_FEATURES, fit.weights)] + [("intercept", float(fit.intercept))]
    return spark.createDataFrame(rows, "feature string, weight double").select("feature", sig("weight", 6).alias("weight"))


@query("ridge_complexity", ops=("D11",), sql=(
    _sales_ctes() + " SELECT ev.lam AS lambda, " + sqlgen.sig("list_sum(list_transform(fit.w, lambda x: abs(x)))", 6)
    + " AS complexity, " + sqlgen.rnd("ev.r2", 6) + " AS r2 FROM ev JOIN fit USING (pos) WHERE ev.split = 'val'"))
def ridge_complexity(spark, sf_dir):
    """Model complexity Σ|w| against validation R² for every λ (array aggregate on
    the sweep table)."""
    _, _, sweep = ridge_results(spark, sf_dir)
    d = spark.createDataFrame([(r["lambda"], r["weights"], r["r2"]) for r in sweep],
                              "lambda double, weights array<double>, r2 double")
    cx = F.aggregate(F.transform("weights", lambda x: F.abs(x)), F.lit(0.0), lambda acc, x: acc + x)
    return d.select("lambda", sig(cx, 6).alias("complexity"), rnd("r2", 6).alias("r2"))


@query("regression_metrics", ops=("F1", "E1"), sql=(
    _SB + ", te AS (SELECT revenue AS y, bw.b + list_dot_product(bw.w, [" + ", ".join(SALES_FEATURES)
    + "]::DOUBLE[]) AS p FROM tagged, bw WHERE split = 'test') SELECT count(*) AS n, " + sqlgen.sig("avg((y - p) * (y - p))", 8)
    + " AS mse, " + sqlgen.sig("avg(abs(y - p))", 8) + " AS mae, " + sqlgen.sig("sqrt(avg((y - p) * (y - p)))", 8)
    + " AS rmse, " + sqlgen.rnd("1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))", 6) + " AS r2 FROM te"))
def regression_metrics(spark, sf_dir):
    """MSE, MAE, RMSE, R² of the best-λ ridge model over the scored test rows (one
    aggregate over the rows, not the moment shortcut)."""
    tagged, best = best_ridge(spark, sf_dir)
    expr = F.lit(float(best["intercept"]))
    for c, w in zip(SALES_FEATURES, best["weights"]):
        expr = expr + F.col(c) * F.lit(float(w))
    m = evaluate.regression_metrics(tagged.where(F.col("split") == "test").withColumn("pred", expr), SALES_TARGET, "pred")
    return m.select(F.col("n").cast("long").alias("n"), sig("mse", 8).alias("mse"), sig("mae", 8).alias("mae"),
                    sig("rmse", 8).alias("rmse"), rnd("r2", 6).alias("r2"))
