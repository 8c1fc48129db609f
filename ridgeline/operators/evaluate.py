"""Evaluation (F1–F13): metrics in one aggregate, global-order figures through the
distributed rank / prefix-sum primitive, class tables from K² confusion cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import inv_norm_expr
from .rank import global_rank, prefix_sums


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """MSE, MAE, RMSE, R² in one pass.  Zero-variance target: R² = 1 if the
    residuals are all 0, else 0."""
    r = F.col(label).cast("double") - F.col(pred).cast("double")
    a = df.agg(F.count(F.lit(1)).alias("n"), F.avg(r * r).alias("mse"), F.avg(F.abs(r)).alias("mae"),
               F.sum(r * r).alias("_rss"), (F.var_pop(F.col(label).cast("double")) * F.count(F.lit(1))).alias("_tss"))
    r2 = (F.when(F.col("_tss") > 0, F.lit(1.0) - F.col("_rss") / F.col("_tss"))
           .when(F.col("_rss") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return a.select("n", "mse", "mae", F.sqrt("mse").alias("rmse"), r2.alias("r2"))


def residuals(df: DataFrame, label: str, pred: str) -> DataFrame:
    """residual y − ŷ and relative error |resid / y|·100 (null when y = 0)."""
    resid = F.col(label).cast("double") - F.col(pred).cast("double")
    return (df.withColumn("residual", resid)
              .withColumn("rel_error_pct", F.abs(F.try_divide(F.col("residual"), F.col(label).cast("double"))) * 100.0))


def prediction_range(df: DataFrame, label: str, pred: str) -> DataFrame:
    """min and max of truth and prediction."""
    return df.agg(F.min(label).alias("y_min"), F.max(label).alias("y_max"),
                  F.min(pred).alias("pred_min"), F.max(pred).alias("pred_max"))


def qq_points(df: DataFrame, value: str, id_cols: Sequence[str]) -> DataFrame:
    """ordered values against normal quantiles of Filliben's order-statistic
    medians: m_n = .5^(1/n), m_1 = 1 − m_n, m_i = (i − .3175)/(n + .365).  Null values
    have no rank and are left out."""
    df = df.select(*id_cols, value).where(F.col(value).isNotNull())
    ranked = global_rank(df, [value, *id_cols], rank_col="i", size_col="n")
    n = F.col("n")
    last = F.pow(F.lit(0.5), 1.0 / n)
    m = (F.when(F.col("i") == n, last)
          .when(F.col("i") == 1, 1.0 - last)
          .otherwise((F.col("i") - 0.3175) / (n + 0.365)))
    return ranked.select("i", m.alias("m_i"), F.col(value).cast("double").alias("osr")) \
                 .withColumn("osm", inv_norm_expr("m_i"))


def qq_line(points: DataFrame) -> DataFrame:
    """F6 line: least-squares slope/intercept of osr on osm and correlation r."""
    return points.agg(F.regr_slope("osr", "osm").alias("slope"),
                      F.regr_intercept("osr", "osm").alias("intercept"),
                      F.corr("osr", "osm").alias("r"))


def confusion(df: DataFrame, label: str, pred: str, classes: Sequence[int] | None = None) -> DataFrame:
    """long confusion table (label, prediction, n), zeros included, over ``classes``
    (default: none beforehand) and every value that occurs; the cells add up to the
    rows.  Nulls are counted in cells with a null label or prediction.

    One aggregate by (label, prediction); the zeros come from the K² pairs of the
    K class values (a result-sized table)."""
    got = (df.groupBy(F.col(label).cast("int").alias("label"), F.col(pred).cast("int").alias("prediction"))
             .agg(F.count(F.lit(1)).alias("n")))
    spark = df.sparkSession
    given = spark.createDataFrame([(int(c),) for c in classes or ()], "c int")
    seen = given.unionByName(got.select(F.explode(F.array("label", "prediction")).alias("c"))).where("c is not null").distinct()
    # all class values in one row, taken twice: K² cells
    values = seen.agg(F.sort_array(F.collect_set("c")).alias("v"))
    cells = values.select(F.explode("v").alias("label"), "v").select("label", F.explode("v").alias("prediction"))
    zero = cells.withColumn("n", F.lit(0).cast("long"))
    return zero.unionByName(got).groupBy("label", "prediction").agg(F.sum("n").alias("n"))


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    """F8."""
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"))


def class_report(cm: DataFrame) -> DataFrame:
    """per-class precision, recall, F1, support; then accuracy, macro and
    weighted averages.  0/0 → 0.  Input: long confusion cells (K² rows)."""
    sup = cm.groupBy("label").agg(F.sum("n").alias("support"),
                                  F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp"))
    pred = cm.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("predicted"))
    per = sup.join(pred, on="label", how="full").na.fill(0)
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted").cast("double")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    per = per.withColumn("precision", p).withColumn("recall", r)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
                    F.lit(0.0))
    per = per.withColumn("f1", f1)
    rows = per.select(F.col("label").cast("string").alias("class"), "precision", "recall", "f1",
                      F.col("support").cast("long"))
    tot = per.agg(F.sum("support").alias("s"), F.sum("tp").alias("tp"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                  (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                  (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    acc = (F.col("tp") / F.col("s")).cast("double")
    summary = tot.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), acc.alias("f1"), F.col("s").cast("long").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("s").cast("long").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"), F.col("wr").alias("recall"),
                 F.col("wf").alias("f1"), F.col("s").cast("long").alias("support")),
    )).alias("r")).select("r.*")
    return rows.unionByName(summary)


def confusable_pairs(cm: DataFrame) -> DataFrame:
    """symmetric off-diagonal counts per unordered class pair, largest first."""
    off = cm.where(F.col("label") != F.col("prediction"))
    return (off.groupBy(F.least("label", "prediction").alias("class_a"),
                        F.greatest("label", "prediction").alias("class_b"))
               .agg(F.sum("n").alias("n"))
               .where(F.col("n") > 0))


def _score(score: str, bins: int | None):
    """The score itself, or (``bins``) its bin ⌊s·bins⌋/bins for scores in [0, 1]:
    a bounded number of ROC points on very large tables."""
    s = F.col(score).cast("double")
    return (F.floor(s * F.lit(float(bins))) / F.lit(float(bins))) if bins else s


def roc_points(df: DataFrame, label: str, score: str, bins: int | None = None) -> DataFrame:
    """one point per distinct score (descending); a point is dropped when both
    second differences of the cumulative counts are 0 (first/last kept); (0,0) is
    put in front afterwards.  Columns: point (order), fpr, tpr; a rate whose class
    does not occur is null.  Rows without a score or label are left out."""
    df = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    g = df.groupBy(_score(score, bins).alias("s")).agg(
        F.sum(F.col(label).cast("double")).alias("pos"),
        F.sum(F.lit(1.0) - F.col(label).cast("double")).alias("neg"),
        F.lit(1.0).alias("one"))
    cum = prefix_sums(g, [F.col("s").desc()], ["pos", "neg", "one"], next_cols=["pos", "neg"])
    # the last point has no next one
    turns = F.coalesce((F.col("pos_next") != F.col("pos")) | (F.col("neg_next") != F.col("neg")), F.lit(True))
    pts = cum.where((F.col("one_cum") == 1) | turns).select(
        F.col("one_cum").cast("long").alias("k"), F.try_divide("neg_cum", "neg_total").alias("fpr"),
        F.try_divide("pos_cum", "pos_total").alias("tpr"))
    origin = pts.sparkSession.createDataFrame([(0, 0.0, 0.0)], "k long, fpr double, tpr double")
    return origin.unionByName(pts).withColumnRenamed("k", "point")


def auc(df: DataFrame, label: str, score: str, bins: int | None = None) -> DataFrame:
    """trapezoid area under the ROC, from per-distinct-score counts and their
    prefix sums: Σ neg_i·(2·tps_i − pos_i) / (2·P·N); null if a class does not occur.
    Rows without a score or label are left out."""
    df = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    g = df.groupBy(_score(score, bins).alias("s")).agg(
        F.sum(F.col(label).cast("double")).alias("pos"),
        F.sum(F.lit(1.0) - F.col(label).cast("double")).alias("neg"))
    cum = prefix_sums(g, [F.col("s").desc()], ["pos", "neg"])
    return cum.agg(F.try_divide(F.sum(F.col("neg") * (2 * F.col("pos_cum") - F.col("pos"))),
                                2 * F.sum("pos") * F.sum("neg")).alias("auc"))


def misclassified_sample(df: DataFrame, label: str, pred: str, id_cols: Sequence[str], k: int = 10,
                         seed=42) -> DataFrame:
    """up to k rows with y ≠ ŷ, picked by md5 order (TakeOrdered, no full sort)."""
    h = F.md5(F.concat_ws("-", *[F.col(c) for c in id_cols], F.lit(str(seed))))
    return (df.where(F.col(label) != F.col(pred)).withColumn("_pick", h)
              .orderBy("_pick", *id_cols).limit(k).drop("_pick"))
