"""Moment matrices (§4.3-1): one aggregate job, coefficient-sized result.

``covar_pop``/``avg`` are Spark's merge-stable (Welford-style) aggregates, so
no raw Σx² cancellation occurs even when means are in the thousands.  Partial
aggregation runs map-side; only one small row per group crosses the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Moments:
    cols: list[str]
    n: int
    mean: np.ndarray          # (k,)
    cov: np.ndarray           # (k, k) population covariance

    @property
    def sd(self) -> np.ndarray:
        return np.sqrt(np.maximum(np.diag(self.cov), 0.0))

    @property
    def scale(self) -> np.ndarray:
        """Population sd with 0 replaced by 1 (a constant column standardises to 0)."""
        sd = self.sd
        return np.where(sd > 0, sd, 1.0)

    def corr_like(self) -> np.ndarray:
        """Moment matrix of the standardised columns: E[z_i z_j]."""
        s = self.scale
        return self.cov / np.outer(s, s)

    def index(self, c: str) -> int:
        return self.cols.index(c)


def _agg_exprs(cols: Sequence[str], cond=None):
    def v(c):
        x = F.col(c).cast("double")
        return x if cond is None else F.when(cond, x)
    exprs = [F.count(F.lit(1) if cond is None else F.when(cond, F.lit(1))).alias("_n")]
    exprs += [F.avg(v(c)).alias(f"_m{i}") for i, c in enumerate(cols)]
    for i in range(len(cols)):
        for j in range(i, len(cols)):
            exprs.append(F.covar_pop(v(cols[i]), v(cols[j])).alias(f"_c{i}_{j}"))
    return exprs


def _from_row(cols, row, prefix="") -> Moments:
    k = len(cols)
    n = int(row[prefix + "_n"] or 0)
    mean = np.array([row[f"{prefix}_m{i}"] if row[f"{prefix}_m{i}"] is not None else np.nan
                     for i in range(k)], dtype=float)
    cov = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            v = row[f"{prefix}_c{i}_{j}"]
            cov[i, j] = cov[j, i] = np.nan if v is None else v
    return Moments(list(cols), n, mean, cov)


def complete_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a number in every one of ``cols``: all moments are then of the same rows."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).cast("double").isNotNull() for c in cols]))


def moments(df: DataFrame, cols: Sequence[str]) -> Moments:
    """Count, means and population covariance of ``cols`` over the rows that are complete in them."""
    row = complete_rows(df, cols).agg(*_agg_exprs(cols)).collect()[0]
    return _from_row(list(cols), row)


def moments_by_split(df: DataFrame, cols: Sequence[str], split_col: str,
                     splits: Sequence[str]) -> dict[str, Moments]:
    """Moments of several splits of one tagged table in a single pass (complete rows)."""
    cols = list(cols)
    names = ["_n"] + [f"_m{i}" for i in range(len(cols))] + \
            [f"_c{i}_{j}" for i in range(len(cols)) for j in range(i, len(cols))]
    named = []
    for s in splits:
        exprs = _agg_exprs(cols, F.col(split_col) == F.lit(s))
        named += [e.alias(f"{s}{nm}") for e, nm in zip(exprs, names)]
    row = complete_rows(df, cols).agg(*named).collect()[0]
    return {s: _from_row(cols, row, prefix=s) for s in splits}


def vector_moments(df: DataFrame, vec_col: str) -> Moments:
    """Moments of every position of an array column: the path for wide tables.

    Two passes: the means, then the centred XᵀX, a matrix product for each Arrow
    batch, added up in a tree on the executors.  What a task holds is k² numbers; the
    expression path of :func:`moments` would plan k(k+1)/2 aggregates.  Rows with a
    null vector or a null in it are left out; vectors must have one length.
    """
    whole = F.col(vec_col).isNotNull() & ~F.exists(vec_col, lambda v: v.cast("double").isNull())
    rows = df.where(whole).select(F.col(vec_col).cast("array<double>").alias("v"))
    means = rows.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"), F.count(F.lit(1)).alias("n")).collect()
    k = len(means)
    mean = np.array([r.m for r in sorted(means, key=lambda r: r.i)], dtype=float)
    if len({r.n for r in means}) > 1:
        raise ValueError("the vectors differ in length")

    def products(batches):
        total = np.zeros((k, k))
        for b in batches:
            x = np.stack(b["v"].to_numpy()) - mean if len(b) else np.zeros((0, k))
            total += x.T @ x
        yield pd.DataFrame({"c": [total.ravel().tobytes()]})

    blocks = rows.mapInPandas(products, "c binary").rdd.map(lambda r: np.frombuffer(r[0]))
    total = blocks.treeReduce(lambda a, b: a + b) if k else np.zeros(0)
    n = int(means[0].n) if k else 0
    return Moments([str(i) for i in range(k)], n, mean, total.reshape(k, k) / max(n, 1))
