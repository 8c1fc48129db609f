"""Linear regression fits.

Batch GD, ridge and every cost/R² figure are functions of a handful of moments,
so each fit is ONE aggregate job over the rows; the iterations then run on a
(k+1)² matrix on the driver and are exact (the loss is quadratic).  Stochastic
and mini-batch GD need the rows of each draw: the draws form a table of
(iteration, rank) pairs whose size is bounded by iterations × batch.  A rank directory
finds the rows at these ranks of the hash permutation without ordering the others, and they are
reduced to per-iteration moments in one job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import hash_uniform, normal_init
from ..session import ensure_checkpoint_dir
from .directory import rows_at
from .moments import Moments, moments

# Draw tables up to this many rows are broadcast; larger ones shuffle-join.
DRAW_BROADCAST_ROWS = 5_000_000


@dataclass
class LinearModel:
    """Weights on standardised features/target plus the scaler that produced them."""
    features: list[str]
    target: str
    weights: np.ndarray           # standardised scale
    bias: float
    x_mean: np.ndarray
    x_scale: np.ndarray
    y_mean: float = 0.0
    y_scale: float = 1.0
    method: str = "batch"
    history: list[tuple[int, float]] = field(default_factory=list)

    def raw_coefficients(self) -> tuple[np.ndarray, float]:
        """Fold both scalers into the weights (E2/B8): ŷ_raw = b_raw + Σ w_raw·x_raw."""
        w_raw = self.y_scale * self.weights / self.x_scale
        b_raw = self.y_mean + self.y_scale * (self.bias - float(np.sum(self.weights * self.x_mean / self.x_scale)))
        return w_raw, b_raw

    def predict_expr(self) -> Column:
        """Prediction in target units as one whole-stage-codegen expression."""
        w_raw, b_raw = self.raw_coefficients()
        expr = F.lit(float(b_raw))
        for c, w in zip(self.features, w_raw):
            expr = expr + F.col(c).cast("double") * F.lit(float(w))
        return expr

    def standardized_predict_expr(self) -> Column:
        """Prediction on the standardised target scale (the reference's ``predict``)."""
        expr = F.lit(float(self.bias))
        for c, w, mu, s in zip(self.features, self.weights, self.x_mean, self.x_scale):
            expr = expr + (F.col(c).cast("double") - F.lit(float(mu))) / F.lit(float(s)) * F.lit(float(w))
        return expr


def standardized_system(m: Moments, features: Sequence[str], target: str):
    """E[z zᵀ] of the features and E[z·y_z] with the target, both standardised."""
    C = m.corr_like()
    fi = [m.index(f) for f in features]
    ti = m.index(target)
    return C[np.ix_(fi, fi)], C[fi, ti], C[ti, ti]


def init_weights(n: int, init: str = "normal", seed=42) -> np.ndarray:
    """Seeded N(0,1)·0.01 start (md5 Box-Muller) or zeros; bias starts at 0."""
    if init == "zeros":
        return np.zeros(n)
    return np.array(normal_init(n, seed=seed, scale=0.01))


def _cost(C, c, cyy, w, b) -> float:
    """D2 half-MSE on standardised data from moments: ½(wᵀCw − 2cᵀw + b² + E[y²])."""
    return 0.5 * (w @ C @ w - 2.0 * c @ w + b * b + cyy)


def batch_gd_on_moments(C, c, cyy, lr=0.01, max_iter=1000, w0=None, record_every=100):
    """D3 + D6: batch GD replayed exactly on the moment matrix (means of z are 0)."""
    w = np.array(w0, dtype=float) if w0 is not None else np.zeros(len(c))
    b = 0.0
    hist = []
    for it in range(max_iter):
        dw = C @ w - c
        db = b
        w = w - lr * dw
        b = b - lr * db
        if it % record_every == 0:
            hist.append((it, float(_cost(C, c, cyy, w, b))))
    return w, b, hist


def _scalers(m: Moments, features, target):
    fi = [m.index(f) for f in features]
    ti = m.index(target)
    return m.mean[fi], m.scale[fi], float(m.mean[ti]), float(m.scale[ti])


def fit_batch_gd(train: DataFrame, features: Sequence[str], target: str, lr=0.01, max_iter=1000,
                 init="normal", seed=42, record_every=100, mom: Moments | None = None) -> LinearModel:
    """Standardise X and y on ``train``, then batch gradient descent (one Spark job)."""
    features = list(features)
    mom = mom or moments(train, features + [target])
    C, c, cyy = standardized_system(mom, features, target)
    w0 = init_weights(len(features), init, seed)
    w, b, hist = batch_gd_on_moments(C, c, cyy, lr, max_iter, w0, record_every)
    xm, xs, ym, ys = _scalers(mom, features, target)
    return LinearModel(features, target, w, b, xm, xs, ym, ys, "batch", hist)


def draw_table(spark: SparkSession, m: int, max_iter: int, batch_size: int, method: str,
               seed=42) -> DataFrame:
    """(iteration, rank) pairs of every draw; size = iterations × batch, not data.

    stochastic: one rank per iteration, uniform with replacement.
    mini_batch: ``batch_size`` consecutive ranks (mod m) of the hash permutation
    from a uniform start, so rows inside a batch are distinct.
    Start of iteration t = floor(m · md5-uniform(method-t-seed)).
    """
    it = spark.range(max_iter).select(F.col("id").cast("int").alias("iteration"))
    start = F.floor(hash_uniform([F.lit(method), F.col("iteration")], seed) * F.lit(m)).cast("long")
    it = it.withColumn("_start", start)
    if method == "stochastic":
        return it.select("iteration", (F.col("_start") + 1).alias("rank"))
    j = F.explode(F.sequence(F.lit(0), F.lit(batch_size - 1)))
    return (it.select("iteration", "_start", j.alias("_j"))
              .select("iteration", (F.pmod(F.col("_start") + F.col("_j"), F.lit(m)) + 1).cast("long").alias("rank")))


def per_iteration_moments(drawn: DataFrame, zcols: Sequence[str], ycol: str,
                          draws: DataFrame) -> dict[int, tuple]:
    """Σzzᵀ, Σz, Σz·y, Σy, count per iteration over the drawn rows (one job)."""
    n_draws = draws.count()
    right = F.broadcast(draws) if n_draws <= DRAW_BROADCAST_ROWS else draws
    j = drawn.join(right, on="rank", how="inner")
    k = len(zcols)
    exprs = [F.count(F.lit(1)).alias("cnt"), F.sum(ycol).alias("sy")]
    exprs += [F.sum(c).alias(f"s{i}") for i, c in enumerate(zcols)]
    exprs += [F.sum(F.col(c) * F.col(ycol)).alias(f"sy{i}") for i, c in enumerate(zcols)]
    exprs += [F.sum(F.col(zcols[a]) * F.col(zcols[b])).alias(f"s{a}_{b}")
              for a in range(k) for b in range(a, k)]
    out = {}
    for r in j.groupBy("iteration").agg(*exprs).collect():
        Sxx = np.zeros((k, k))
        for a in range(k):
            for b in range(a, k):
                Sxx[a, b] = Sxx[b, a] = r[f"s{a}_{b}"]
        Sx = np.array([r[f"s{i}"] for i in range(k)])
        Sxy = np.array([r[f"sy{i}"] for i in range(k)])
        out[r["iteration"]] = (Sxx, Sx, Sxy, float(r["sy"]), int(r["cnt"]))
    return out


def _batch_size(method: str, batch_size: int | None, m: int) -> int:
    return min(batch_size or 32, m) if method == "mini_batch" else 1


def sampled_rows(train: DataFrame, features: Sequence[str], target: str, id_cols: Sequence[str], mom: Moments,
                 methods: Sequence[str] = ("stochastic", "mini_batch"), max_iter=1000, batch_size=None, seed=42) -> DataFrame:
    """The standardised training rows that the ``methods`` draw, with their rank in md5(id‖perm‖seed) order (the hash
    permutation every draw refers to); shareable between fits.  At most iterations × batch rows, written once."""
    features = list(features)
    spark = train.sparkSession
    ranks: set[int] = set()
    for method in methods:
        draws = draw_table(spark, mom.n, max_iter, _batch_size(method, batch_size, mom.n), method, seed)
        ranks |= {r["rank"] for r in draws.select("rank").distinct().collect()}
    xm, xs, ym, ys = _scalers(mom, features, target)
    h = F.md5(F.concat_ws("-", *[F.col(c) for c in id_cols], F.lit(f"perm-{seed}")))
    z = train.select(h.alias("_h"), *id_cols,
                     *[((F.col(f).cast("double") - F.lit(float(mu))) / F.lit(float(s))).alias(f"_z{i}")
                       for i, (f, mu, s) in enumerate(zip(features, xm, xs))],
                     ((F.col(target).cast("double") - F.lit(ym)) / F.lit(ys)).alias("_zy"))
    ensure_checkpoint_dir(spark)
    return rows_at(z, "_h", list(id_cols), ranks, mom.n).checkpoint(eager=True)


def fit_sampled_gd(train: DataFrame, features: Sequence[str], target: str, id_cols: Sequence[str],
                   method="mini_batch", lr=0.01, max_iter=1000, batch_size=None, init="normal",
                   seed=42, record_every=100, mom: Moments | None = None,
                   drawn: DataFrame | None = None) -> LinearModel:
    """Stochastic or mini-batch GD with hash-permutation draws.

    The drawn rows are found by their ranks in md5(id, seed) order (pass ``drawn`` from
    :func:`sampled_rows`, made with the same iterations, batch and seed, to share them between fits), the draws are joined by
    rank, and the updates are replayed on the driver from the per-iteration
    moments.  Loss history uses the full-train moments (D6).
    """
    features = list(features)
    spark = train.sparkSession
    mom = mom or moments(train, features + [target])
    C, c, cyy = standardized_system(mom, features, target)
    xm, xs, ym, ys = _scalers(mom, features, target)
    m = mom.n
    batch = _batch_size(method, batch_size, m)
    if drawn is None:
        drawn = sampled_rows(train, features, target, id_cols, mom, [method], max_iter, batch, seed)
    draws = draw_table(spark, m, max_iter, batch, method, seed)
    per_it = per_iteration_moments(drawn, [f"_z{i}" for i in range(len(features))], "_zy", draws)
    w = init_weights(len(features), init, seed)
    b = 0.0
    hist = []
    for t in range(max_iter):
        Sxx, Sx, Sxy, Sy, cnt = per_it[t]
        scale = 1.0 if method == "stochastic" else 1.0 / cnt
        dw = scale * (Sxx @ w + Sx * b - Sxy)
        db = scale * (Sx @ w + cnt * b - Sy)
        w = w - lr * dw
        b = b - lr * db
        if t % record_every == 0:
            hist.append((t, float(_cost(C, c, cyy, w, b))))
    return LinearModel(features, target, w, b, xm, xs, ym, ys, method, hist)


# ---------------------------------------------------------------- ridge

@dataclass
class RidgeFit:
    alpha: float
    weights: np.ndarray
    intercept: float


def ridge_solve(train: Moments, features: Sequence[str], target: str, alpha: float) -> RidgeFit:
    """Minimise RSS + α‖w‖², intercept free, on unscaled features.

    Centred normal equations (m·Σ_xx + αI) w = m·σ_xy, intercept ȳ − x̄ᵀw.
    """
    fi = [train.index(f) for f in features]
    ti = train.index(target)
    G = train.n * train.cov[np.ix_(fi, fi)]
    cxy = train.n * train.cov[fi, ti]
    w = np.linalg.solve(G + alpha * np.eye(len(fi)), cxy)
    b = float(train.mean[ti] - train.mean[fi] @ w)
    return RidgeFit(float(alpha), w, b)


def split_metrics(mom: Moments, features, target, w, b) -> dict:
    """RSS, R², RMSE of a linear model on a split, from that split's moments."""
    fi = [mom.index(f) for f in features]
    ti = mom.index(target)
    S = mom.cov[np.ix_(fi, fi)]
    sxy = mom.cov[fi, ti]
    vy = mom.cov[ti, ti]
    bias_gap = mom.mean[ti] - b - mom.mean[fi] @ w
    mse = vy + bias_gap ** 2 + w @ S @ w - 2.0 * w @ sxy
    mse = max(float(mse), 0.0)
    if vy > 0:
        r2 = 1.0 - mse / vy
    else:
        r2 = 1.0 if mse == 0 else 0.0
    return {"mse": mse, "rmse": float(np.sqrt(mse)), "r2": float(r2), "n": mom.n}


def ridge_sweep(train: Moments, val: Moments, features, target,
                lambdas=(0.01, 0.1, 1, 10, 100)) -> list[dict]:
    """Every λ from the same two moment sets; best = strictly greatest R²
    (ties keep the first listed, NaN never wins)."""
    rows = []
    for pos, lam in enumerate(lambdas):
        fit = ridge_solve(train, features, target, lam)
        met = split_metrics(val, features, target, fit.weights, fit.intercept)
        rows.append({"position": pos, "lambda": float(lam), "r2": met["r2"], "rmse": met["rmse"],
                     "intercept": fit.intercept, "weights": [float(x) for x in fit.weights],
                     "complexity": float(np.sum(np.abs(fit.weights)))})
    best = best_position([r["r2"] for r in rows])
    for r in rows:
        r["is_best"] = r["position"] == best
    return rows


def best_position(scores) -> int | None:
    """D10 pick: strictly greater score wins, so ties keep the first; NaN never wins."""
    best, best_v = None, -np.inf
    for pos, v in enumerate(scores):
        if v is not None and not np.isnan(v) and v > best_v:
            best, best_v = pos, v
    return best


def convergence_rates(history: DataFrame) -> DataFrame:
    """−Δln(cost) between recorded points of each method's loss history
    (method, iteration, cost); the first point of a method has none (null)."""
    from pyspark.sql import Window
    w = Window.partitionBy("method").orderBy("iteration")
    return history.withColumn("rate", -(F.log("cost") - F.lag(F.log("cost")).over(w)))
