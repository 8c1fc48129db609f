"""Profiling aggregates (C1–C12): each is one or two aggregate jobs with
map-side partial aggregation; only group-sized results leave the executors."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .moments import vector_moments
from .rank import column_quantiles, exact_quantiles


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Count and share per class (share over the K-row result)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def band_expr(col: str, bands: Sequence[tuple]) -> Column:
    """First matching band name; bands are (name, lo or None, hi or None) with
    lo ≤ x < hi.  Values in no band (and nulls) give null."""
    expr = None
    for name, lo, hi in bands:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col(col) >= F.lit(lo))
        if hi is not None:
            cond = cond & (F.col(col) < F.lit(hi))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def rate_by_band(df: DataFrame, label: str, dimensions: dict[str, tuple[str, Sequence[tuple]]]) -> DataFrame:
    """Class shares inside every band of several dimensions in ONE pass:
    each row emits (dimension, band) pairs, then one groupBy.  Classes absent
    from a band have no row."""
    pairs = F.array(*[F.struct(F.lit(dim).alias("dimension"), band_expr(col, bands).alias("band"))
                      for dim, (col, bands) in dimensions.items()])
    e = df.select(F.col(label).alias("label"), F.explode(pairs).alias("p")) \
          .select("label", "p.dimension", "p.band").where(F.col("band").isNotNull())
    g = e.groupBy("dimension", "band", "label").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("dimension", "band")))


def summary_stats(df: DataFrame, col: str, exact: bool = True) -> DataFrame:
    """Count, mean, median, sample sd, min, max.  The exact median is bracketed by a
    sketch and decided by one scan of the bracket; ``exact=False`` uses the sketch alone."""
    x = F.col(col).cast("double")
    if exact:
        got = column_quantiles(df, [col], [0.5]).get(col)
        median = F.lit(got[0] if got else None).cast("double")
    else:
        median = F.percentile_approx(x, 0.5, 10000)
    return df.agg(F.count(x).alias("n"), F.avg(x).alias("mean"), median.alias("median"), F.stddev_samp(x).alias("sd"),
                  F.min(x).alias("min"), F.max(x).alias("max"))


def quantiles(df: DataFrame, col: str, qs: Sequence[float] = (0.25, 0.5, 0.75, 0.9, 0.95),
              exact: bool = True) -> DataFrame:
    """C4: linear-interpolation quantiles: exact in two scans (a sketch brackets the ranks, the
    rows inside the brackets decide), or ``percentile_approx`` (the sketch alone, one pass)
    when ``exact=False``."""
    if exact:
        return exact_quantiles(df, col, qs).select("q", "value")
    x = F.col(col).cast("double")
    arr = F.array(*[F.lit(float(q)) for q in qs])
    r = df.agg(F.percentile_approx(x, arr, 10000).alias("v"))
    return r.select(F.posexplode("v").alias("i", "value")) \
            .select(F.element_at(arr, F.col("i") + 1).alias("q"), "value")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every pair in one aggregate (pairwise-complete), mirrored,
    unit diagonal."""
    cols = list(cols)
    exprs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r_{i}_{j}")
             for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
    row = df.agg(*exprs)
    cells = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            v = F.lit(1.0) if i == j else F.col(f"r_{min(i, j)}_{max(i, j)}")
            cells.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), v.alias("r")))
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def vector_correlation(df: DataFrame, vec_col: str) -> DataFrame:
    """C5 for wide tables: Pearson r of every pair of positions of an array column
    (a, b, r), unit diagonal; r is null for a constant position."""
    m = vector_moments(df, vec_col)
    sd = m.sd
    with np.errstate(divide="ignore", invalid="ignore"):
        r = m.cov / np.outer(sd, sd)
    cells = [(i, j, 1.0 if i == j else (float(r[i, j]) if np.isfinite(r[i, j]) else None))
             for i in range(len(sd)) for j in range(len(sd))]
    return df.sparkSession.createDataFrame(cells, "a int, b int, r double")


def target_correlation(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """R with the target, direction, strength (|r| > .5 strong, > .3 medium,
    else weak), a text line, and the rank by |r| descending."""
    exprs = [F.corr(F.col(f).cast("double"), F.col(target).cast("double")).alias(f"r{i}") for i, f in enumerate(features)]
    row = df.agg(*exprs)
    cells = [F.struct(F.lit(f).alias("feature"), F.col(f"r{i}").alias("r")) for i, f in enumerate(features)]
    t = row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    direction = F.when(F.col("r") > 0, "positive").otherwise("negative")
    strength = F.when(F.abs("r") > 0.5, "strong").when(F.abs("r") > 0.3, "medium").otherwise("weak")
    t = t.withColumn("direction", direction).withColumn("strength", strength)
    t = t.withColumn("description", F.format_string("%s: %s (%s), r=%.3f", F.col("feature"), F.col("direction"),
                                                    F.col("strength"), F.col("r")))
    return t.withColumn("rank", F.row_number().over(Window.orderBy(F.abs("r").desc(), F.col("feature"))))


def bin_expr(x: Column, lo: Column, hi: Column, k: int) -> Column:
    """Equal-width bin 1..k; the right edge falls in bin k; lo == hi → bin 1."""
    raw = F.floor((x - lo) * F.lit(float(k)) / (hi - lo)) + F.lit(1)
    return F.when(hi == lo, F.lit(1)).otherwise(F.least(raw, F.lit(k))).cast("int")


def histogram(df: DataFrame, col: str, k: int = 30) -> DataFrame:
    """Equal-width histogram with empty bins filled (k-row bin table).
    The range is two driver scalars; the binning is a literal expression."""
    x = F.col(col).cast("double")
    lo, hi = df.agg(F.min(x), F.max(x)).collect()[0]
    lo_c, hi_c = F.lit(lo).cast("double"), F.lit(hi).cast("double")
    counts = df.groupBy(bin_expr(x, lo_c, hi_c, k).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    bins = spark.range(1, k + 1).select(F.col("id").cast("int").alias("bin"))
    w = (hi_c - lo_c) / F.lit(float(k))
    return (bins.join(counts, on="bin", how="left")
                .select("bin", (lo_c + (F.col("bin") - 1) * w).alias("edge_lo"),
                        (lo_c + F.col("bin") * w).alias("edge_hi"),
                        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def binned_2d(df: DataFrame, xcol: str, ycol: str, k: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """C11: scatter as 2-D binned counts (non-empty cells), for each value of ``by``
    on common bins; size k², not rows."""
    x, y = F.col(xcol).cast("double"), F.col(ycol).cast("double")
    xl, xh, yl, yh = df.agg(F.min(x), F.max(x), F.min(y), F.max(y)).collect()[0]
    L = lambda v: F.lit(v).cast("double")
    return df.groupBy(*by, bin_expr(x, L(xl), L(xh), k).alias("bx"),
                      bin_expr(y, L(yl), L(yh), k).alias("by")).agg(F.count(F.lit(1)).alias("n"))


def box_stats(df: DataFrame, group: str, col: str) -> DataFrame:
    """Quartiles, whiskers (extreme points within 1.5·IQR) and outlier count per
    group: exact grouped quartiles in two scans (a hot group is only counted), a join of
    the per-group limits (one row per group) back to the rows, and one more aggregate.
    Null values are left out."""
    x = F.col(col).cast("double")
    df = df.where(x.isNotNull())
    ql = exact_quantiles(df, col, [0.25, 0.5, 0.75], group_by=[group])
    q = ql.groupBy(group).agg(*[F.max(F.when(F.col("q") == v, F.col("value"))).alias(n)
                                for v, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lim = q.select(group, (F.col("q1") - 1.5 * F.col("iqr")).alias("lo_f"), (F.col("q3") + 1.5 * F.col("iqr")).alias("hi_f"))
    # one row per group: AQE turns this into a broadcast join when it is small
    j = df.select(group, x.alias("x")).join(lim, on=group, how="inner")
    inside = (F.col("x") >= F.col("lo_f")) & (F.col("x") <= F.col("hi_f"))
    w = j.groupBy(group).agg(F.min(F.when(inside, F.col("x"))).alias("whisker_lo"),
                             F.max(F.when(inside, F.col("x"))).alias("whisker_hi"),
                             F.sum(F.when(inside, 0).otherwise(1)).alias("n_outliers"),
                             F.count(F.lit(1)).alias("n"))
    return q.join(w, on=group, how="inner")


def box_outliers(df: DataFrame, group: str, col: str) -> DataFrame:
    """The rows outside their group's fences (1.5·IQR beyond the quartiles)."""
    x = F.col(col).cast("double")
    lim = box_stats(df, group, col).select(F.col(group).alias("_group"), (F.col("q1") - 1.5 * F.col("iqr")).alias("_lo"),
                                           (F.col("q3") + 1.5 * F.col("iqr")).alias("_hi"))
    far = (x < F.col("_lo")) | (x > F.col("_hi"))
    return df.join(lim, F.col(group) == F.col("_group")).where(far).select(*df.columns)


def first_groups(df: DataFrame, group: str, k: int = 10) -> DataFrame:
    """The k smallest distinct group values (TakeOrdered after a distinct)."""
    return df.select(group).distinct().orderBy(group).limit(k)


def mean_sd(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population sd per column, one aggregate."""
    exprs = []
    for c in cols:
        exprs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
    row = df.agg(*exprs)
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("sd")) for c in cols]
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def kde_by_class(df: DataFrame, col: str, label: str | None, grid: int = 200) -> DataFrame:
    """Gaussian kernel density of each class (``label=None``: one overall curve,
    label 'all') on ``grid`` points from three bandwidths below its smallest value to
    three above its largest.

    Bandwidth: Scott, sd·n^(−1/5), per class; curves are scaled by the class share.
    Rows are counted in bins of an eighth of their class's bandwidth (one groupBy,
    map-side combine), and a grid point takes the bins within nine bandwidths: the
    binning error does not grow with the rows.  The bins are as many as the class
    has values apart, at most range / (h/8).  Work after the groupBy is bins × grid
    points in reach, independent of the number of rows.  A class with fewer than two
    rows, or without spread, has no density and gives no curve; nulls are left out.
    """
    x = F.col(col).cast("double")
    lab = F.col(label) if label else F.lit("all")
    b = df.select(lab.alias("label"), x.alias("x")).where(F.col("x").isNotNull())
    per = b.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
                                 F.min("x").alias("lo"), F.max("x").alias("hi"))
    per = per.withColumn("m", F.sum("n").over(Window.partitionBy()))       # one row a class
    per = per.where(F.col("sd") > 0).withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    width = F.col("h") / 8
    bins = (b.join(per.select("label", "lo", "h"), "label").select("label", F.floor((F.col("x") - F.col("lo")) / width).alias("bin"))
            .groupBy("label", "bin").agg(F.count(F.lit(1)).alias("c")))
    t = bins.join(per, "label")
    centre = F.col("lo") + (F.col("bin") + 0.5) * width
    start, end = F.col("lo") - 3 * F.col("h"), F.col("hi") + 3 * F.col("h")
    step = (end - start) / F.lit(float(grid - 1))
    first = F.greatest(F.lit(0), F.ceil((centre - 9 * F.col("h") - start) / step).cast("int"))
    last = F.least(F.lit(grid - 1), F.floor((centre + 9 * F.col("h") - start) / step).cast("int"))
    near = t.where(first <= last).select("label", "c", centre.alias("centre"), "h", start.alias("start"), step.alias("step"),
                                         F.explode(F.sequence(first, last)).alias("g"))
    u = (F.col("start") + F.col("g") * F.col("step") - F.col("centre")) / F.col("h")
    sums = near.groupBy("label", "g").agg(F.sum(F.col("c") * F.exp(-0.5 * u * u)).alias("s"))
    # every class has all its grid points, also those that no bin reaches
    points = per.select("label", "n", "m", "h", start.alias("start"), step.alias("step"),
                        F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("g"))
    share = F.coalesce("s", F.lit(0.0)) / (F.col("h") * F.lit((2 * 3.141592653589793) ** 0.5)) / F.col("m")
    return points.join(sums, ["label", "g"], "left").select(
        "label", "g", (F.col("start") + F.col("g") * F.col("step")).alias("x"), share.alias("density"))


def auto_bins(df: DataFrame, col: str) -> int:
    """Number of equal bins by the larger of Sturges' and Freedman-Diaconis' rule
    (at least 1); the quartiles are exact."""
    x = F.col(col).cast("double")
    n, lo, hi = df.agg(F.count(x), F.min(x), F.max(x)).first()
    if not n or lo == hi:
        return 1
    q = {r.q: r.value for r in exact_quantiles(df.where(x.isNotNull()), col, [0.25, 0.75]).collect()}
    sturges = (hi - lo) / (math.log2(n) + 1)
    fd = 2 * (q[0.75] - q[0.25]) / n ** (1 / 3)
    return max(1, math.ceil((hi - lo) / (min(sturges, fd) if fd > 0 else sturges)))
