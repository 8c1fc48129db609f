"""The four end-to-end modelling jobs (house price, product sales, diabetes-like
binary, digit-like multi-class), each a sequence of library operators whose
intermediate tables are written by Spark's writers below ``out_dir``.

Inputs are DataFrames with the reference's schemas (see FIXTURES.md); the
``*_from_*`` helpers build them from files.  Row-sized work stays in Spark; the
driver only holds moments and coefficients.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import evaluate, explain, linear, logistic, prep, profile, split
from ..operators.moments import moments, moments_by_split
from ..operators.score import accuracy_of_models, argmax_class, decision_grid
from ..sources import io

# Feature lists and source names of the four tasks.
HOUSE_FEATURES = ["area", "room_num", "living_room_num", "floor", "distance_subway"]
SALES_FEATURES = ["price", "promotion", "ad_spend", "user_rating", "holiday", "month", "weekday"]
DIABETES_RENAME = {"preg": "Pregnancies", "plas": "Glucose", "pres": "BloodPressure", "skin": "SkinThickness",
                   "insu": "Insulin", "mass": "BMI", "pedi": "DiabetesPedigreeFunction", "age": "Age"}
DIABETES_FEATURES = list(DIABETES_RENAME.values())
# The risk bands (lo ≤ x < hi) of the binary task.
RISK_BANDS = {"age": ("Age", (("20-30", 20, 30), ("30-40", 30, 40), ("40-50", 40, 50), (">=50", 50, None))),
              "bmi": ("BMI", (("<25", None, 25), ("25-30", 25, 30), (">=30", 30, None))),
              "glucose": ("Glucose", (("<100", None, 100), ("100-126", 100, 126), (">=126", 126, None)))}

DENSITY_FEATURES = ("Pregnancies", "BloodPressure", "Insulin", "DiabetesPedigreeFunction")
# Unit and wording of each sales feature's impact line (feature, unit, unit text,
# word when the impact is positive, word otherwise), and the advice lines (feature, fires when
# the weight is positive?, text).
SALES_RULES = (("price", 1.0, "for each unit of price", "rises", "falls"),
               ("promotion", 1.0, "in a promotion against none", "is higher", "is lower"),
               ("ad_spend", 1.0, "for each unit of advertising", "rises", "falls"),
               ("user_rating", 0.1, "for a tenth of a rating point", "rises", "falls"),
               ("holiday", 1.0, "on holidays against working days", "is higher", "is lower"),
               ("month", 1.0, "for each later month", "rises", "falls"),
               ("weekday", 1.0, "for each later weekday", "rises", "falls"))
SALES_ADVICE = (("promotion", True, "run promotions more often"),
                ("ad_spend", True, "advertising pays: tune how it is spent"),
                ("price", False, "price holds sales down: review it"),
                ("holiday", True, "put promotions and advertising on holidays"),
                ("user_rating", True, "work on quality and service: ratings lift sales"))


def _with_id(df: DataFrame, id_cols: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    """Rows need a stable key for hash draws; without one, a content hash is used
    (identical rows then share their draws)."""
    if id_cols:
        return df, list(id_cols)
    return df.withColumn("row_key", F.xxhash64(*[F.col(c) for c in df.columns])), ["row_key"]


def _write(df: DataFrame, out_dir: str, name: str) -> None:
    io.write_report(df, f"{out_dir.rstrip('/')}/{name}")


# ---------------------------------------------------------------- house


def house_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """A1 + A3: comment-tolerant scan of the house table."""
    return io.scan_comment_csv(spark, path, HOUSE_FEATURES + ["price"])


def house_job(spark: SparkSession, df: DataFrame, out_dir: str, id_cols: Sequence[str] | None = None,
              missing_rate: float = 0.02, area_max: float = 200.0, lr: float = 0.01, iters: int = 1000,
              seed=42, impute_scope: str = "all") -> dict:
    """House price task.  ``impute_scope='all'`` fits the medians on the whole table
    as the reference does (a leak into the test rows); ``'train'`` fits them on the
    training split only."""
    feats, target = HOUSE_FEATURES, "price"
    df, ids = _with_id(df, id_cols)
    df, loaded = io.audited(df, "loaded")       # A7: counted by the jobs that read them anyway
    # profile of the raw table
    _write(profile.summary_stats(df, target), out_dir, "profile/summary")
    _write(profile.quantiles(df, target), out_dir, "profile/price_quantiles")
    _write(profile.quantiles(df, "area"), out_dir, "profile/area_quantiles")
    _write(profile.correlation_matrix(df, feats + [target]), out_dir, "profile/correlation")
    _write(profile.target_correlation(df, feats, target), out_dir, "profile/target_correlation")
    df = df.persist()       # the raw table is read by every profile
    _write(profile.histogram(df, target, 30), out_dir, "profile/price_hist")
    _write(profile.histogram(df, "area", 30), out_dir, "profile/area_hist")
    for f in ("area", "distance_subway", "floor", "room_num"):
        _write(profile.binned_2d(df.dropna(subset=[f, target]), f, target), out_dir, f"profile/{f}_price_bins")
    _write(profile.box_outliers(df, "room_num", target), out_dir, "profile/outliers_by_rooms")
    _write(profile.box_stats(df, "room_num", target), out_dir, "profile/box_by_rooms")
    floors = profile.first_groups(df, "floor", 10)
    _write(profile.box_stats(df.join(F.broadcast(floors), "floor", "left_semi"), "floor", target), out_dir,
           "profile/box_by_floor")
    # clean (B2–B4), then split to exact sizes and fit
    dirty = prep.inject_missing(df, ids, feats, missing_rate, seed)
    if impute_scope == "all":
        clean = prep.outlier_filter(prep.impute(dirty, prep.medians(dirty, feats + [target])), "area", area_max)
        clean, cleaned = io.audited(clean, "cleaned")
        tagged = split.exact_split(clean, ids, 0.2, seed).persist()
    else:       # medians of training rows only: the sides are drawn first, by the same hash
        tagged = split.hash_split(dirty, ids, 0.2, seed)
        values = prep.medians(tagged.where(F.col("split") == "train"), feats + [target])
        tagged, cleaned = io.audited(prep.outlier_filter(prep.impute(tagged, values), "area", area_max), "cleaned")
        tagged = tagged.persist()
    train = tagged.where(F.col("split") == "train")
    mom = moments(train, feats + [target])
    fits = {"batch": linear.fit_batch_gd(train, feats, target, lr=lr, max_iter=iters, seed=seed, mom=mom)}
    drawn = linear.sampled_rows(train, feats, target, ids, mom, max_iter=iters, seed=seed)
    for method in ("stochastic", "mini_batch"):
        fits[method] = linear.fit_sampled_gd(train, feats, target, ids, method=method, lr=lr, max_iter=iters,
                                             seed=seed, mom=mom, drawn=drawn)
    hist = spark.createDataFrame([(m, int(i), float(c)) for m, f in fits.items() for i, c in f.history],
                                 "method string, iteration int, cost double")
    _write(linear.convergence_rates(hist), out_dir, "training/history")
    model = fits["batch"]
    # score and evaluate
    test = evaluate.residuals(tagged.where(F.col("split") == "test").withColumn("pred", model.predict_expr()),
                              target, "pred").persist()
    metrics = evaluate.regression_metrics(test, target, "pred")
    _write(metrics, out_dir, "evaluation/metrics")
    _write(test.select(*ids, target, "pred", "residual", "rel_error_pct"), out_dir, "evaluation/predictions")
    _write(evaluate.prediction_range(test, target, "pred"), out_dir, "evaluation/range")
    for col in (target, "pred", "residual", "rel_error_pct"):
        _write(profile.histogram(test, col, 30), out_dir, f"evaluation/{col}_hist")
    qq = evaluate.qq_points(test, "residual", ids)
    _write(qq, out_dir, "evaluation/qq_points")
    _write(evaluate.qq_line(qq), out_dir, "evaluation/qq_line")
    # explain (G1, G2) and the run record (A10)
    _write(explain.importance(explain.coefficient_table(spark, feats, model.weights)), out_dir, "features/importance")
    m = metrics.collect()[0].asDict()
    stages = [("loaded", int(loaded.get["rows"])), ("cleaned", int(cleaned.get["rows"])), ("train", mom.n), ("test", int(m["n"]))]
    _write(spark.createDataFrame(stages, "stage string, rows long"), out_dir, "training/row_audit")
    summary = {"n_train": mom.n, "n_test": int(m["n"]), "features": feats, "weights": [float(w) for w in model.weights],
               "bias": float(model.bias), "metrics": {k: float(m[k]) for k in ("mse", "mae", "rmse", "r2")}}
    _write(io.run_summary(spark, summary), out_dir, "training/summary")
    for cached in (test, tagged, df):
        cached.unpersist()
    return summary


# ---------------------------------------------------------------- sales


def sales_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """A2 + B5: headered CSV, date → month and ISO weekday."""
    schema = T.StructType([T.StructField("date", T.StringType())] +
                          [T.StructField(c, T.DoubleType()) for c in ("price", "promotion", "ad_spend", "user_rating",
                                                                       "holiday", "sales")])
    return prep.calendar(io.scan_header_csv(spark, path, schema), "date") \
               .withColumn("month", F.col("month").cast("double")).withColumn("weekday", F.col("weekday").cast("double"))


def sales_job(spark: SparkSession, df: DataFrame, out_dir: str, id_cols: Sequence[str] = ("date",),
              lambdas=(0.01, 0.1, 1.0, 10.0, 100.0), seed=42,
              features: Sequence[str] = SALES_FEATURES, target: str = "sales") -> dict:
    feats = list(features)
    _write(profile.correlation_matrix(df, feats + [target]), out_dir, "profile/correlation")
    _write(profile.target_correlation(df, feats, target), out_dir, "profile/target_correlation")
    if {"promotion", "ad_spend"} <= set(feats):
        _write(profile.box_stats(df, "promotion", target), out_dir, "profile/box_by_promotion")
        _write(profile.binned_2d(df, "ad_spend", target), out_dir, "profile/ad_sales_bins")
    tagged = split.three_way_split(df, list(id_cols), 0.15, 0.176, seed, exact=True).persist()
    moms = moments_by_split(tagged, feats + [target], "split", ["train", "val", "test"])
    sweep = linear.ridge_sweep(moms["train"], moms["val"], feats, target, lambdas)
    sw = spark.createDataFrame([(r["lambda"], r["r2"], r["rmse"], r["intercept"], r["complexity"], r["weights"],
                                 r["is_best"]) for r in sweep],
                               "lambda double, r2 double, rmse double, intercept double, complexity double, "
                               "weights array<double>, is_best boolean")
    _write(sw, out_dir, "training/lambda_sweep")
    path = spark.createDataFrame([(r["lambda"], f, float(w)) for r in sweep for f, w in zip(feats, r["weights"])],
                                 "lambda double, feature string, weight double")
    _write(path, out_dir, "training/weight_path")
    best = next(r for r in sweep if r["is_best"])
    test_m = linear.split_metrics(moms["test"], feats, target, np.array(best["weights"]), best["intercept"])
    coef = explain.coefficient_table(spark, feats, best["weights"])
    stats = profile.mean_sd(tagged.where(F.col("split") == "train"), feats)
    _write(explain.importance(coef), out_dir, "features/importance")
    _write(explain.sensitivity(coef, stats), out_dir, "features/sensitivity")
    _write(explain.effects(coef, stats), out_dir, "features/effects")
    ru = spark.createDataFrame(list(SALES_RULES), "feature string, unit double, unit_text string, up_text string, down_text string")
    ad = spark.createDataFrame(list(SALES_ADVICE), "feature string, when_positive boolean, text string")
    _write(explain.unit_impacts(coef, ru), out_dir, "features/impacts")
    _write(explain.recommendations(coef, ad), out_dir, "features/advice")
    expr = F.lit(float(best["intercept"]))
    for c, w in zip(feats, best["weights"]):
        expr = expr + F.col(c) * F.lit(float(w))
    scored = evaluate.residuals(tagged.withColumn("pred", expr), target, "pred")
    _write(profile.histogram(scored.where(F.col("split").isin("train", "val")), "residual", 20), out_dir,
           "evaluation/trainval_residual_hist")
    test = scored.where(F.col("split") == "test")
    _write(test.select(*id_cols, target, "pred", "residual", "rel_error_pct"), out_dir, "evaluation/predictions")
    for col in ("residual", "rel_error_pct"):
        _write(profile.histogram(test, col, 20), out_dir, f"evaluation/test_{col}_hist")
    qq = evaluate.qq_points(test, "residual", list(id_cols))
    _write(qq, out_dir, "evaluation/qq_points")
    _write(evaluate.qq_line(qq), out_dir, "evaluation/qq_line")
    summary = {"n_train": moms["train"].n, "n_val": moms["val"].n, "n_test": moms["test"].n, "features": feats,
               "best_lambda": best["lambda"], "lambdas": list(lambdas),
               "metrics": {"mse": test_m["mse"], "rmse": test_m["rmse"], "r2": test_m["r2"]}}
    _write(io.run_summary(spark, summary), out_dir, "training/summary")
    tagged.unpersist()
    return summary


# ---------------------------------------------------------------- diabetes-like binary


def diabetes_prepare(df: DataFrame) -> DataFrame:
    """A4 + A5: source names renamed, class text → Outcome 0/1."""
    out = io.rename(df, DIABETES_RENAME)
    if "class" in out.columns:
        out = io.label_from_text(out, "class", "pos", "Outcome").drop("class")
    return out.select(*[F.col(c).cast("double") for c in DIABETES_FEATURES], F.col("Outcome").cast("int"),
                      *[c for c in out.columns if c not in DIABETES_FEATURES + ["Outcome"]])


def diabetes_job(spark: SparkSession, df: DataFrame, out_dir: str, id_cols: Sequence[str] | None = None,
                 lr: float = 0.5, iters: int = 2000, seed=42, features: Sequence[str] = DIABETES_FEATURES,
                 label: str = "Outcome", bands: dict | None = RISK_BANDS) -> dict:
    feats = list(features)
    df, ids = _with_id(df, id_cols)
    _write(profile.class_balance(df, label), out_dir, "profile/class_balance")
    if bands:
        _write(profile.rate_by_band(df, label, bands), out_dir, "profile/risk_by_band")
    _write(profile.correlation_matrix(df, feats + [label]), out_dir, "profile/correlation")
    for f in [f for f in DENSITY_FEATURES if f in df.columns] or feats[:4]:
        _write(profile.kde_by_class(df, f, label), out_dir, f"profile/density_{f}")
    if "Age" in df.columns:
        _write(profile.kde_by_class(df, "Age", None), out_dir, "profile/density_age_all")
        _write(profile.histogram(df, "Age", profile.auto_bins(df, "Age")), out_dir, "profile/age_hist")
    if {"Glucose", "BMI"} <= set(df.columns):
        _write(profile.box_stats(df, label, "Glucose"), out_dir, "profile/glucose_box")
        _write(profile.binned_2d(df, "Glucose", "BMI", by=[label]), out_dir, "profile/glucose_bmi_bins")
    tagged = split.stratified_split(df, ids, label, 0.2, seed).persist()
    train, test = tagged.where(F.col("split") == "train"), tagged.where(F.col("split") == "test")
    model = logistic.fit_logistic_gd(train, feats, label, lr=lr, max_iter=iters)
    _write(spark.createDataFrame([(int(i), float(c)) for i, c in model.history], "iteration int, cost double"),
           out_dir, "training/history")
    scored = test.withColumn("probability", model.proba_expr()).withColumn("prediction", model.class_expr(0.5))
    cm = evaluate.confusion(scored, label, "prediction", [0, 1])
    _write(cm, out_dir, "evaluation/confusion")
    _write(evaluate.roc_points(scored, label, "probability"), out_dir, "evaluation/roc")
    auc = evaluate.auc(scored, label, "probability").collect()[0]["auc"]
    acc = evaluate.accuracy(scored, label, "prediction").collect()[0]["accuracy"]
    lib = logistic.fit_logistic_mllib(train, feats, label, C=1.0, mean=model.x_mean, scale=model.x_scale)
    lib_acc = evaluate.accuracy(test.withColumn("prediction", lib.class_expr(0.5)), label, "prediction") \
                      .collect()[0]["accuracy"]
    _write(explain.importance(explain.coefficient_table(spark, feats, model.weights)), out_dir, "features/importance")
    # decision surface over the two heaviest features, the others at their mean
    i1, i2 = sorted(range(len(feats)), key=lambda i: (-abs(model.weights[i]), i))[:2]
    std = tagged.select(*[((F.col(feats[i]).cast("double") - float(model.x_mean[i])) / float(model.x_scale[i])).alias(n)
                          for i, n in ((i1, "x1"), (i2, "x2"))])
    _write(decision_grid(std, "x1", "x2", model.weights[i1], model.weights[i2], model.bias), out_dir, "evaluation/decision_surface")
    summary = {"features": feats, "weights": [float(w) for w in model.weights], "bias": float(model.bias),
               "accuracy": float(acc), "library_accuracy": float(lib_acc), "auc": float(auc),
               "final_cost": float(model.history[-1][1]) if model.history else None}
    _write(io.run_summary(spark, summary), out_dir, "training/summary")
    tagged.unpersist()
    return summary


# ---------------------------------------------------------------- digits-like multi-class


def digits_job(spark: SparkSession, df: DataFrame, out_dir: str, vec_col: str = "features", label: str = "label",
               id_cols: Sequence[str] | None = None, lam: float = 0.1, classes: Sequence[int] = tuple(range(10)),
               lambdas=(0.0, 0.01, 0.1, 1.0, 10.0), fractions=(0.1, 0.3, 0.5, 0.7, 0.9), seed=42) -> dict:
    df, ids = _with_id(df, id_cols)
    _write(io.vector_profile(df, vec_col), out_dir, "profile/vectors")
    tagged = split.stratified_split(df, ids, label, 0.2, seed).persist()
    train, test = tagged.where(F.col("split") == "train"), tagged.where(F.col("split") == "test")
    grid = sorted(set(lambdas) | {lam})
    fit = logistic.fit_one_vs_all(train, vec_col, label, classes, grid)
    li = grid.index(lam)
    theta = fit.theta[0, li]
    scores = logistic.ova_scores(vec_col, theta, fit.scaler.mean[0], fit.scaler.scale[0])
    scored = test.withColumn("prediction", argmax_class(scores)).persist()
    cm = evaluate.confusion(scored, label, "prediction", classes)
    _write(cm, out_dir, "evaluation/confusion")
    _write(evaluate.class_report(cm), out_dir, "evaluation/class_report")
    _write(evaluate.confusable_pairs(cm), out_dir, "evaluation/confusable_pairs")
    _write(evaluate.misclassified_sample(scored, label, "prediction", ids, 10, seed), out_dir, "evaluation/misclassified")
    d = int(np.sqrt(theta.shape[1] - 1))
    wm = spark.createDataFrame([(int(c), i // d, i % d, float(theta[k, 1 + i])) for k, c in enumerate(classes)
                                for i in range(d * d)], "class int, row int, col int, weight double")
    _write(wm, out_dir, "features/weight_map")
    scores = [logistic.ova_scores(vec_col, fit.theta[0, j], fit.scaler.mean[0], fit.scaler.scale[0]) for j in range(len(grid))]
    by_lambda = accuracy_of_models(tagged, label, [(float(l), s, F.col("split")) for l, s in zip(grid, scores)])
    _write(by_lambda.select(F.col("model").alias("lambda"), "split", "accuracy"), out_dir, "training/lambda")
    sub = split.fraction_subsets(df, ids, label, fractions, seed).persist()
    curve = logistic.fit_one_vs_all(sub, vec_col, label, classes, [lam], member_col="member", n_subsets=len(fractions))
    models = [(float(f), logistic.ova_scores(vec_col, curve.theta[i, 0], curve.scaler.mean[i], curve.scaler.scale[i]),
               F.when(F.col("member")[i], "train").otherwise("test")) for i, f in enumerate(fractions)]
    _write(accuracy_of_models(sub, label, models).select(F.col("model").alias("fraction"), "split", "accuracy"),
           out_dir, "training/learning_curve")
    acc = evaluate.accuracy(scored, label, "prediction").collect()[0]["accuracy"]
    summary = {"lambda": lam, "accuracy": float(acc), "classes": [int(c) for c in classes]}
    _write(io.run_summary(spark, summary), out_dir, "training/summary")
    for cached in (scored, sub, tagged):
        cached.unpersist()
    return summary
