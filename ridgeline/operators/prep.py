"""Cleaning and feature preparation.

Row-wise steps are column expressions (codegen); statistics are single
aggregates.  Random choices are md5 hash draws of the row key, so the same rows
are hit on every run, on every partitioning and after executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_uniform
from .draws import unused
from .rank import column_quantiles
from .split import first_in_hash_order, with_hash


def inject_missing(df: DataFrame, id_cols: Sequence[str], features: Sequence[str], rate: float = 0.02,
                   seed=42, exact: bool = True) -> DataFrame:
    """B2 (MCAR): in int(m·rate) distinct rows, one feature (never the target) set to
    null.  Rows: first in md5(id‖seed) order (``exact``; two scans, see :mod:`draws`) or hash
    draw < rate (scale mode, no selection).  Column: ⌊n·md5(id‖'col'‖seed)⌋."""
    features = list(features)
    u, at = unused(df.columns, "_u"), unused(df.columns, "_column")
    if exact:
        m = df.count()
        (hit,) = first_in_hash_order(df, id_cols, seed, F.col(u), m, [int(m * rate)])
    else:
        hit = F.col(u) < F.lit(rate)
    # the second digest is computed for the rows that are hit only
    column = F.floor(hash_uniform(list(id_cols) + [F.lit("col")], seed) * F.lit(len(features))).cast("int")
    marked = with_hash(df, id_cols, seed, u).withColumn(at, F.when(hit, column).otherwise(-1))
    exprs = []
    for c in df.columns:
        if c in features:
            blank = F.col(at) == F.lit(features.index(c))
            exprs.append(F.when(blank, F.lit(None).cast("double")).otherwise(F.col(c).cast("double")).alias(c))
        else:
            exprs.append(F.col(c))
    return marked.select(*exprs)


def medians(df: DataFrame, cols: Sequence[str], exact: bool = True) -> dict[str, float]:
    """B3 statistics: median of every column (exact linear interpolation, in two
    scans for all columns, or ``percentile_approx`` sketches with ``exact=False``)."""
    cols = list(cols)
    if not exact:
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, 10000).alias(c) for c in cols]).collect()[0]
        return {c: float(row[c]) for c in cols if row[c] is not None}
    return {c: v[0] for c, v in column_quantiles(df, cols, [0.5]).items()}


def impute(df: DataFrame, values: dict[str, float]) -> DataFrame:
    """B3 apply: nulls replaced by the fitted values."""
    return df.fillna(values)


def outlier_filter(df: DataFrame, col: str, threshold: float) -> DataFrame:
    """Keep rows with col ≤ threshold (a plain predicate: pushed to the scan)."""
    return df.where(F.col(col) <= F.lit(threshold))


def calendar(df: DataFrame, date_col: str) -> DataFrame:
    """Month 1–12 and weekday 1–7 with Monday = 1 (``weekday`` is 0-based from
    Monday; ``dayofweek`` would start on Sunday)."""
    d = F.to_date(F.col(date_col))
    return df.withColumn("month", F.month(d)).withColumn("weekday", F.weekday(d) + F.lit(1))


def standardize_exprs(cols: Sequence[str], mean: Sequence[float], scale: Sequence[float],
                      suffix: str = "") -> list[Column]:
    """(x − mean)/scale with fitted constants (scale already has 0 → 1)."""
    return [((F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s))).alias(c + suffix)
            for c, m, s in zip(cols, mean, scale)]


def inverse_expr(col: str, mean: float, scale: float) -> Column:
    """Back to target units."""
    return F.col(col) * F.lit(float(scale)) + F.lit(float(mean))
