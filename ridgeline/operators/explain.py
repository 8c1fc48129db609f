"""Coefficient interpretation.

The coefficient table has one row per feature, so every step here is a small
DataFrame job; statistics of the rows (means, sds) come from one aggregate over
the training table and are joined on ``feature`` (both sides are feature-sized,
so the joins are broadcast).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def coefficient_table(spark: SparkSession, features: Sequence[str], weights: Sequence[float]) -> DataFrame:
    """(feature, idx, weight) from a fitted model's coefficient array."""
    rows = [(f, i, float(w)) for i, (f, w) in enumerate(zip(features, weights))]
    return spark.createDataFrame(rows, "feature string, idx int, weight double")


def importance(coef: DataFrame) -> DataFrame:
    """|w|, share of Σ|w| in %, rank by |w| descending (ties by position),
    sign text."""
    whole = Window.partitionBy()  # feature-sized table
    rank = Window.orderBy(F.abs("weight").desc(), F.col("idx"))
    return (coef.withColumn("abs_weight", F.abs("weight"))
                .withColumn("share_pct", F.col("abs_weight") / F.sum("abs_weight").over(whole) * 100.0)
                .withColumn("rank", F.row_number().over(rank))
                .withColumn("sign", F.when(F.col("weight") > 0, "positive").otherwise("negative")))


def effects(coef: DataFrame, stats: DataFrame) -> DataFrame:
    """Effect at the mean w·mean(x); ``stats`` = (feature, mean, sd)."""
    return coef.join(F.broadcast(stats), on="feature", how="inner") \
               .withColumn("effect_at_mean", F.col("weight") * F.col("mean"))


def sensitivity(coef: DataFrame, stats: DataFrame) -> DataFrame:
    """|w|·sd_pop(x) and its rank (ties by position)."""
    rank = Window.orderBy(F.col("sensitivity").desc(), F.col("idx"))
    return (coef.join(F.broadcast(stats), on="feature", how="inner")
                .withColumn("sensitivity", F.abs("weight") * F.col("sd"))
                .withColumn("rank", F.row_number().over(rank)))


def unit_impacts(coef: DataFrame, rules: DataFrame) -> DataFrame:
    """G6 first part: per-feature impact w·unit as text.  ``rules`` =
    (feature, unit double, unit_text, up_text, down_text)."""
    j = coef.join(F.broadcast(rules), on="feature", how="inner")
    impact = F.col("weight") * F.col("unit")
    word = F.when(impact > 0, F.col("up_text")).otherwise(F.col("down_text"))
    return j.select("feature", "idx", "weight", impact.alias("impact"),
                    F.format_string("%s: target %s by %.2f %s", F.col("feature"), word, F.abs(impact),
                                    F.col("unit_text")).alias("text"))


def recommendations(coef: DataFrame, advice: DataFrame) -> DataFrame:
    """G6 second part: advice rows whose condition on the sign of a feature's weight
    holds.  ``advice`` = (feature, when_positive boolean, text)."""
    j = coef.join(F.broadcast(advice), on="feature", how="inner")
    hit = F.when(F.col("when_positive"), F.col("weight") > 0).otherwise(F.col("weight") < 0)
    return j.where(hit).select("feature", "text")
