"""Scoring as column expressions (E1–E7): whole-stage codegen, no Python."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import sigmoid


def threshold_class(p: Column, threshold: float = 0.5) -> Column:
    """E5: 1 when p ≥ threshold (MLlib predicts 0 at p == threshold; this does not)."""
    return (p >= F.lit(threshold)).cast("int")


def vector_scores(vec_col: str, theta: np.ndarray, mean=None, scale=None) -> Column:
    """E6 scores: array of K linear scores θ_k0 + Σ_j θ_kj·(x_j − μ_j)/s_j over an
    array column; the scaler is folded into the coefficients once."""
    theta = np.asarray(theta, dtype=float)
    b = theta[:, 0].copy()
    W = theta[:, 1:].copy()
    if mean is not None:
        s = np.asarray(scale, dtype=float)
        mu = np.asarray(mean, dtype=float)
        W = W / s
        b = b - W @ mu
    x = F.col(vec_col)
    scores = []
    for k in range(theta.shape[0]):
        wk = F.array(*[F.lit(float(v)) for v in W[k]])
        dot = F.aggregate(F.zip_with(x, wk, lambda a, c: a.cast("double") * c), F.lit(0.0), lambda acc, v: acc + v)
        scores.append(dot + F.lit(float(b[k])))
    return F.array(*scores)


def argmax_class(scores: Column) -> Column:
    """First index of the maximum score (ties → lowest class).  Argmax on z, not
    σ(z), because σ saturates to exactly 1.0 and makes false ties."""
    return (F.array_position(scores, F.array_max(scores)) - F.lit(1)).cast("int")


def accuracy_of_models(df: DataFrame, label: str, models) -> DataFrame:
    """Accuracy of several models in one scan: ``models`` are (name, scores column, side
    column); a row gives one (model, split, hit) for each, then one aggregate.
    Columns: model, split, accuracy, n."""
    hits = F.array(*[F.struct(F.lit(name).alias("model"), side.alias("split"),
                              (F.col(label) == argmax_class(scores)).cast("double").alias("hit"))
                     for name, scores, side in models])
    return (df.select(F.explode(hits).alias("h")).groupBy("h.model", "h.split")
              .agg(F.avg("h.hit").alias("accuracy"), F.count(F.lit(1)).alias("n")))


def decision_grid(df: DataFrame, f1: str, f2: str, w1: float, w2: float, bias: float,
                  step: float = 0.02, margin: float = 0.5, threshold: float = 0.5) -> DataFrame:
    """Class of every cell of a regular grid over two standardised features
    (others at their mean, 0): x = (min − margin) + i·step for i < ⌈(max − min + 2·margin)/step⌉,
    as ``arange`` counts.  The grid size depends on the feature range and step only;
    the cells are a distributed range of numbers, cell = i·n₂ + j."""
    lo1, hi1, lo2, hi2 = df.agg(F.min(f1), F.max(f1), F.min(f2), F.max(f2)).first()
    spark = df.sparkSession
    if lo1 is None or lo2 is None:
        cells, n2 = spark.range(0), 1
        lo1 = lo2 = 0.0
    else:
        n1, n2 = (math.ceil(((hi + margin) - (lo - margin)) / step) for lo, hi in ((lo1, hi1), (lo2, hi2)))
        cells = spark.range(0, n1 * n2)
    g = cells.select(F.expr(f"id div {n2}").cast("int").alias("i"), (F.col("id") % n2).cast("int").alias("j"))
    g = g.select("i", "j", (F.lit(lo1 - margin) + F.col("i").cast("double") * step).alias(f1),
                 (F.lit(lo2 - margin) + F.col("j").cast("double") * step).alias(f2))
    z = F.lit(float(bias)) + F.col(f1) * F.lit(float(w1)) + F.col(f2) * F.lit(float(w2))
    return g.withColumn("prediction", threshold_class(sigmoid(z), threshold))
