"""Logistic models.

Binary: gradient descent (the reference's solver, one single-stage pass per
iteration over the cached standardised rows) and Newton/IRLS (a weighted moment
matrix per pass, a handful of passes), plus MLlib's L-BFGS as the library
cross-check.  Multi-class one-vs-all: every class, every λ and every training
subset are fitted together; one pass over the rows computes the gradients (and
Hessians) of all of them at once.  The rows are converted once (through Arrow)
into cached NumPy blocks; each pass is a ``treeAggregate`` of per-block NumPy
partials, merged on the executors, so the driver only holds coefficient-sized
sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import copy
import pickle

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import sigmoid
from .moments import moments

EPS = 1e-15  # inside both logs of the cross-entropy, as the reference does


# ---------------------------------------------------------------- binary


@dataclass
class LogisticModel:
    features: list[str]
    weights: np.ndarray            # on standardised features
    bias: float
    x_mean: np.ndarray
    x_scale: np.ndarray
    history: list[tuple[int, float]] = field(default_factory=list)
    iterations: int = 0
    converged: bool = False
    solver: str = "gd"

    def raw_coefficients(self) -> tuple[np.ndarray, float]:
        """Scaler folded into the weights: z = b_raw + Σ w_raw·x_raw."""
        w_raw = self.weights / self.x_scale
        return w_raw, float(self.bias - np.sum(w_raw * self.x_mean))

    def logit_expr(self) -> Column:
        w_raw, b_raw = self.raw_coefficients()
        expr = F.lit(b_raw)
        for c, w in zip(self.features, w_raw):
            expr = expr + F.col(c).cast("double") * F.lit(float(w))
        return expr

    def proba_expr(self) -> Column:
        return sigmoid(self.logit_expr())

    def class_expr(self, threshold: float = 0.5) -> Column:
        return (self.proba_expr() >= F.lit(threshold)).cast("int")


def standardized(df: DataFrame, features: Sequence[str], label: str, mean, scale) -> DataFrame:
    """Rows reduced to standardised features z0.. and a double label ``y``."""
    return df.select(*[((F.col(f).cast("double") - F.lit(float(m))) / F.lit(float(s))).alias(f"z{i}")
                       for i, (f, m, s) in enumerate(zip(features, mean, scale))],
                     F.col(label).cast("double").alias("y"))


# Iterative solvers pay a per-task cost on every pass: rows below ITER_TASK_ROWS are not worth
# a task of their own, so tiny inputs are packed into few partitions.  Above that a pass's time is its rows,
# which every core gets a share of; a partition holds ITER_PARTITION_BYTES at most.
ITER_PARTITION_BYTES = 64 << 20
ITER_TASK_ROWS = 1 << 14


def right_sized(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """The (standardised) iteration input in as many partitions as its rows keep busy: one
    for a small input, one a core for a larger one, more where a partition would grow too big."""
    spread = min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ITER_TASK_ROWS))
    want = max(1, spread, -(-rows * row_bytes // ITER_PARTITION_BYTES))
    return df if want == df.rdd.getNumPartitions() else df.repartition(want)


def _scaler(train: DataFrame, features: Sequence[str]):
    mom = moments(train, list(features))
    return mom.mean, mom.scale, mom.n


class _GD:
    """Gradient-descent state and update rule (driver side, coefficient-sized)."""

    def __init__(self, k, lr, max_iter, tol, record_every, l2):
        self.k, self.lr, self.max_iter, self.tol, self.rec, self.l2 = k, lr, max_iter, tol, record_every, l2
        self.w, self.b, self.hist, self.prev, self.converged, self.it = np.zeros(k), 0.0, [], None, False, 0

    def step(self, it, m, g_b, ce, g) -> bool:
        """Consume the sums of pass ``it`` (at w_it); return True when finished."""
        self.it = it
        cost = ce / m + self.l2 / (2 * m) * float(self.w @ self.w)
        if it >= 1 and (it - 1) % self.rec == 0:
            self.hist.append((it - 1, cost))
        if self.tol is not None and self.prev is not None and abs(self.prev - cost) < self.tol:
            self.converged = True
            return True
        if it == self.max_iter:
            return True
        self.prev = cost
        self.b -= self.lr * g_b / m
        self.w = self.w - self.lr * (g / m + self.l2 / m * self.w)
        return False


def numpy_blocks(df: DataFrame, build) -> RDD:
    """The rows of ``df`` as cached NumPy blocks, one per Arrow batch (``build(pdf)``
    → arrays), converted once through Arrow.  Iterative solvers then run each pass
    as ``treeAggregate`` over the blocks: per-partition NumPy, partial sums merged
    on the executors in a tree, no SQL planning or row conversion per pass.  Lost
    blocks are rebuilt from the (deterministic) lineage."""
    def run(batches):
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"blk": [pickle.dumps(build(pdf), protocol=5)]})
    return (df.mapInPandas(run, "blk binary").rdd.map(lambda r: pickle.loads(r[0]))
              .persist(StorageLevel.MEMORY_AND_DISK))


#: Numbers that the partitions' partial sums may hold together to be added up without a stage for the tree (8 MiB).
FLAT_SUM = 1 << 20


def tree_sum(blocks: RDD, width: int, partial) -> np.ndarray:
    """Σ over blocks of ``partial(block)`` (a length-``width`` array), reduced in a
    tree on the executors; only the total reaches the driver, or one partial sum a partition
    where these are small.  How many partitions
    the blocks are in (see :func:`right_sized`) changes the plan, not the sum."""
    def seq(acc, blk):
        acc += partial(blk)
        return acc
    depth = 1 if blocks.getNumPartitions() * width <= FLAT_SUM else 2
    return blocks.treeAggregate(np.zeros(width), seq, lambda x, y: x + y, depth=depth)


def _binary_blocks(z: DataFrame, k: int) -> RDD:
    cols = [f"z{i}" for i in range(k)]
    return numpy_blocks(z, lambda pdf: (pdf[cols].to_numpy(np.float64), pdf["y"].to_numpy(np.float64)))


def _binary_partial(k: int, w, b: float, hessian: bool = False):
    """(width, block → sums) of one pass at (w, b)."""
    w = np.asarray(w, dtype=np.float64)
    width = 3 + k + ((k + 1) ** 2 if hessian else 0)

    def partial(blk):
        X, y = blk
        out = np.zeros(width)
        p = 1.0 / (1.0 + np.exp(-(X @ w + b)))
        r = p - y
        out[0] = len(y)
        out[1] = r.sum()
        out[2] = (-(y * np.log(p + EPS) + (1.0 - y) * np.log(1.0 - p + EPS))).sum()
        out[3:3 + k] = r @ X
        if hessian:
            X1 = np.hstack([np.ones((len(y), 1)), X])
            out[3 + k:] = ((X1 * (p * (1.0 - p))[:, None]).T @ X1).ravel()
        return out

    return width, partial


def binary_pass(blocks: RDD, k: int, w, b: float, hessian: bool = False) -> dict:
    """One pass at (w, b): m, Σ(p−y), Σ CE, Σ(p−y)z and optionally
    Σ p(1−p)[1,z][1,z]ᵀ over all blocks."""
    tot = tree_sum(blocks, *_binary_partial(k, w, b, hessian))
    m = int(tot[0])
    res = {"m": m, "g": np.concatenate([[tot[1]], tot[3:3 + k]]), "cost": float(tot[2]) / max(m, 1)}
    if hessian:
        res["H"] = tot[3 + k:].reshape(k + 1, k + 1)
    return res


def _descend(gd: _GD, sums) -> _GD:
    """All iterations, a pass for each; ``sums(width, partial)`` adds a partial up over the rows."""
    for it in range(gd.max_iter + 1):
        tot = sums(*_binary_partial(gd.k, gd.w, gd.b))
        if gd.step(it, int(tot[0]), tot[1], tot[2], tot[3:3 + gd.k]):
            break
    return gd


#: Largest difference between the gradient of the local polynomial and the exact one (per row) at the end of a run of
#: local steps; a run that misses it is taken back and made shorter.
LOCAL_ERROR = 1e-9
#: Columns (with the intercept) up to which a pass brings the fourth derivatives.
LOCAL_COLUMNS = 16
#: Earlier points of the descent that the polynomial's remainder is carried on from.
LOCAL_PAST = 3
_PASS_ROWS = 4096


class _LocalLoss:
    """Σ cross-entropy around a point: its first four derivatives there, and the polynomial they make.

    Third and fourth derivatives are held for pairs of columns i <= j, as (pairs, columns) and (pairs, pairs).
    """

    def __init__(self, k: int):
        self.n = k + 1
        self.i, self.j = np.triu_indices(self.n)
        self.twice = np.where(self.i == self.j, 1.0, 2.0)
        self.sizes = [1, 1, self.n, len(self.i), len(self.i) * self.n, len(self.i) ** 2]
        self.width = sum(self.sizes)

    def partial(self, theta: np.ndarray):
        """block → count, loss and derivatives at ``theta`` (intercept first)."""
        i, j, n = self.i, self.j, self.n

        def run(blk):
            out = np.zeros(self.width)
            for at in range(0, len(blk[1]), _PASS_ROWS):
                y = blk[1][at:at + _PASS_ROWS]
                X = np.column_stack([np.ones(len(y)), blk[0][at:at + _PASS_ROWS]])
                p = 1.0 / (1.0 + np.exp(-(X @ theta)))
                two = p * (1.0 - p)
                pairs = X[:, i] * X[:, j]
                out += np.concatenate([
                    [len(y), (-(y * np.log(p + EPS) + (1.0 - y) * np.log(1.0 - p + EPS))).sum()], (p - y) @ X, two @ pairs,
                    ((pairs * (two * (1.0 - 2.0 * p))[:, None]).T @ X).ravel(),
                    ((pairs * (two * (1.0 - 6.0 * two))[:, None]).T @ pairs).ravel()])
            return out
        assert n == len(theta)
        return self.width, run

    def centre(self, theta: np.ndarray, tot: np.ndarray) -> None:
        m, cost, g, h, t3, t4 = np.split(tot, np.cumsum(self.sizes)[:-1])
        self.theta, self.m, self.cost, self.g = theta.copy(), int(m[0]), float(cost[0]), g
        self.h = self._square(h)
        self.t3, self.t4 = t3.reshape(-1, self.n), t4.reshape(len(self.i), -1)

    def _square(self, pairs: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, self.n))
        out[self.i, self.j] = out[self.j, self.i] = pairs
        return out

    def at(self, theta: np.ndarray) -> tuple[float, np.ndarray]:
        """(loss, gradient) of the polynomial."""
        d = theta - self.theta
        two = self.twice * d[self.i] * d[self.j]
        hd, third, fourth = self.h @ d, two @ self.t3, self.t4 @ two
        cost = self.cost + self.g @ d + hd @ d / 2 + third @ d / 6 + two @ fourth / 24
        return float(cost), self.g + hd + third / 2 + self._square(fourth) @ d / 6


def _remainder(local: _LocalLoss, past: list[tuple[int, np.ndarray, np.ndarray]]):
    """steps → what the polynomial's gradient lacks so many steps on.

    ``past`` holds earlier points of the descent: steps from here (negative), point, exact gradient.  Along the descent
    the remainder is t⁴ times a smooth function of the steps t; the polynomial through the
    past points stands for that.
    """
    if not past:
        return lambda t: 0.0
    steps = np.array([t for t, _, _ in past], dtype=float)
    scale, powers = np.abs(steps).max(), np.arange(4, 4 + len(past))
    lack = np.array([g - local.at(theta)[1] for _, theta, g in past])
    coef = np.linalg.solve((steps / scale)[:, None] ** powers, lack)
    return lambda t: (t / scale) ** powers @ coef


def _descend_locally(gd: _GD, sums) -> _GD:
    """The same iterations with several steps a pass.

    A pass brings the loss's first four derivatives at w, whose polynomial gives the gradients of the
    next steps on the driver; the first of them is exact.  What the polynomial lacks at the points of the last
    passes, where the exact gradients are known, is carried on along the descent (:func:`_remainder`).
    The pass at the end of a run
    compares the polynomial's gradient with the exact one there, where it is farthest off: the run
    stands if they differ by at most :data:`LOCAL_ERROR` a row, else it is taken back and made shorter.
    Runs grow as the descent slows down.  Each pass's cost is exact, and is what the history holds
    where it falls on a recorded step; the other steps' costs are the polynomial's.
    """
    local, run, it, past = _LocalLoss(gd.k), 1, 0, []
    theta = lambda: np.append(gd.b, gd.w)
    local.centre(theta(), sums(*local.partial(theta())))
    while True:
        saved = copy.deepcopy(gd)
        run = min(run, gd.max_iter - it)
        lack = _remainder(local, [(at - it, point, g) for at, point, g in past])
        cost, g = local.cost, local.g
        done = False
        for step in range(max(run, 1)):
            if gd.step(it + step, local.m, g[0], cost, g[1:]):
                done = True
                break
            cost, g = local.at(theta())
            g = g + lack(step + 1)
        if done:
            return gd
        here, guess = theta(), g
        tot = sums(*local.partial(here))
        error = float(np.abs(tot[2:2 + local.n] - guess).max()) / max(local.m, 1)
        factor = 0.9 * (LOCAL_ERROR / max(error, LOCAL_ERROR / 1e4)) ** (1 / (4 + len(past)))       # the order of what is left
        if error > LOCAL_ERROR and run > 1:
            gd.__dict__.update(saved.__dict__)
            run = max(1, min(run - 1, int(run * factor)))
            continue
        past = [*past, (it, local.theta, local.g)][-LOCAL_PAST:]
        local.centre(here, tot)
        it += run
        run = max(run + 1, int(run * min(factor, 4.0))) if factor > 1 else max(1, int(run * factor))


def _gd_passes(blocks: RDD, gd: _GD) -> _GD:
    """The descent over the blocks: runs of local steps, or a pass for each step where a tolerance must see every
    exact cost or the columns are too many for fourth derivatives."""
    descend = _descend if gd.tol is not None or gd.k + 1 > LOCAL_COLUMNS else _descend_locally
    return descend(gd, lambda width, partial: tree_sum(blocks, width, partial))


def fit_logistic_gd(train: DataFrame, features: Sequence[str], label: str, lr: float = 0.1,
                    max_iter: int = 1000, tol: float | None = None, record_every: int = 100,
                    l2: float = 0.0) -> LogisticModel:
    """Gradient descent from zero on standardised features (scaler fitted on
    ``train``).  Passes over the cached NumPy blocks of the standardised rows are
    tree-reduced; each serves a run of steps (:func:`_descend_locally`), whatever the
    number of partitions.  Step t sees ∇J(w_t) and J(w_t), so the loss after update t is
    read at step t+1 (D6 convention).  ``tol`` (a pass for each step) stops when |ΔJ| < tol; ``l2`` adds λ/2m‖w‖² (bias free).  For long runs
    on big tables prefer :func:`fit_logistic_newton` (a handful of passes)."""
    features = list(features)
    k = len(features)
    mean, scale, m = _scaler(train, features)
    gd = _GD(k, lr, max_iter, tol, record_every, l2)
    blocks = _binary_blocks(right_sized(standardized(train, features, label, mean, scale), m, 8 * (k + 1)), k)
    try:
        gd = _gd_passes(blocks, gd)
    finally:
        blocks.unpersist()
    return LogisticModel(features, gd.w, gd.b, mean, scale, gd.hist, gd.it, gd.converged, "gd")


def fit_logistic_newton(train: DataFrame, features: Sequence[str], label: str, l2: float = 0.0,
                        max_iter: int = 25, tol: float = 1e-10) -> LogisticModel:
    """Newton/IRLS for the same loss (optionally λ/2m‖w‖²): each pass is one
    :func:`binary_pass` returning the gradient and the weighted moment matrix.  Steps that raise the loss are halved; separable
    data (no finite optimum) ends at ``max_iter`` with ``converged=False``."""
    features = list(features)
    k = len(features)
    mean, scale, m = _scaler(train, features)
    blocks = _binary_blocks(right_sized(standardized(train, features, label, mean, scale), m, 8 * (k + 1)), k)
    theta = np.zeros(k + 1)
    D = np.eye(k + 1)
    D[0, 0] = 0.0
    prev_cost, prev_theta, step, converged, hist = None, None, None, False, []
    it = 0
    try:
        for it in range(max_iter):
            st = binary_pass(blocks, k, theta[1:], theta[0], True)
            m = st["m"]
            cost = st["cost"] + l2 / (2 * m) * float(theta[1:] @ theta[1:])
            hist.append((it, cost))
            if prev_cost is not None and cost > prev_cost + 1e-15 and step is not None:
                step = step / 2.0
                theta = prev_theta - step
                continue
            if prev_cost is not None and abs(prev_cost - cost) < tol:
                converged = True
                break
            g = st["g"] / m + l2 / m * (D @ theta)
            H = st["H"] / m + l2 / m * D
            step = np.linalg.lstsq(H + 1e-12 * np.eye(k + 1), g, rcond=None)[0]
            prev_cost, prev_theta = cost, theta
            theta = theta - step
        if not converged and prev_theta is not None:
            # the last step's loss is not known yet: keep it only if it did not raise the loss
            st = binary_pass(blocks, k, theta[1:], theta[0])
            if st["cost"] + l2 / (2 * st["m"]) * float(theta[1:] @ theta[1:]) > prev_cost:
                theta = prev_theta
    finally:
        blocks.unpersist()
    return LogisticModel(features, theta[1:], float(theta[0]), mean, scale, hist, it + 1, converged, "newton")


def fit_logistic_mllib(train: DataFrame, features: Sequence[str], label: str, C: float = 1.0,
                       mean=None, scale=None, max_iter: int = 100):
    """The library reference point (C=1, i.e. λ=1 on the summed loss): MLlib
    L-BFGS with regParam = 1/(C·m) on the standardised features."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    features = list(features)
    if mean is None:
        mean, scale, _ = _scaler(train, features)
    z = standardized(train, features, label, mean, scale)
    m = z.count()
    vec = VectorAssembler(inputCols=[f"z{i}" for i in range(len(features))], outputCol="fv").transform(z)
    lr = LogisticRegression(featuresCol="fv", labelCol="y", regParam=1.0 / (C * m), elasticNetParam=0.0,
                            standardization=False, fitIntercept=True, maxIter=max_iter, tol=1e-10)
    fit = lr.fit(vec)
    return LogisticModel(features, fit.coefficients.toArray(), float(fit.intercept), np.asarray(mean),
                         np.asarray(scale), [], max_iter, True, "mllib")


# ---------------------------------------------------------------- multi-class block kernel


@dataclass
class VectorScaler:
    """Per-position mean and population sd (sd 0 → 1) of an array column, per subset."""
    mean: np.ndarray   # (S, n)
    scale: np.ndarray  # (S, n)


def vector_scaler(df: DataFrame, vec_col: str, member_col: str | None = None, n_subsets: int = 1) -> VectorScaler:
    """Mean/sd of every array position (one job).  Each task emits one partial row
    per (subset, position) after map-side combining; no row-sized data moves."""
    x = df.select(F.posexplode(vec_col).alias("pos", "v"),
                  *( [F.col(member_col)] if member_col else []))
    if member_col:
        x = x.select("pos", "v", F.posexplode(member_col).alias("s", "in")).where(F.col("in"))
    else:
        x = x.withColumn("s", F.lit(0))
    g = (x.groupBy("s", "pos").agg(F.avg(F.col("v").cast("double")).alias("mu"),
                                   F.stddev_pop(F.col("v").cast("double")).alias("sd"))
          .collect())
    n = max(r["pos"] for r in g) + 1
    mean = np.zeros((n_subsets, n))
    sd = np.ones((n_subsets, n))
    for r in g:
        mean[r["s"], r["pos"]] = r["mu"]
        sd[r["s"], r["pos"]] = r["sd"] if r["sd"] and r["sd"] > 0 else 1.0
    return VectorScaler(mean, sd)


def _ova_blocks(data: DataFrame, vec_col: str, label_col: str, member_col: str | None) -> RDD:
    def build(pdf):
        X = np.stack(pdf[vec_col].to_numpy()).astype(np.float64)
        y = pdf[label_col].to_numpy()
        memb = np.stack(pdf[member_col].to_numpy()).astype(bool) if member_col else np.ones((len(pdf), 1), bool)
        return X, y, memb
    return numpy_blocks(data.select(vec_col, label_col, *([member_col] if member_col else [])), build)


def block_pass(blocks: RDD, model_subset, model_class, theta, scaler: VectorScaler, hessian: bool):
    """One pass: data-term count, cross-entropy, gradient (and Hessian) of every
    model, each subset standardised with its own scaler; per-block NumPy, tree-
    reduced.  Partial width per model: 2 + (n+1) [+ (n+1)²]."""
    theta = np.asarray(theta, dtype=float)
    model_subset, model_class = np.asarray(model_subset), np.asarray(model_class)
    M, n1 = theta.shape
    width = 2 + n1 + (n1 * n1 if hessian else 0)

    def partial(blk):
        X, y, memb = blk
        acc = np.zeros((M, width))
        for s in np.unique(model_subset):
            rows = memb[:, s]
            if not rows.any():
                continue
            Xs = (X[rows] - scaler.mean[s]) / scaler.scale[s]
            X1 = np.hstack([np.ones((Xs.shape[0], 1)), Xs])
            js = np.where(model_subset == s)[0]
            P = 1.0 / (1.0 + np.exp(-(X1 @ theta[js].T)))                 # (rows, models)
            Y = (y[rows][:, None] == model_class[js][None, :]).astype(np.float64)
            acc[js, 0] += X1.shape[0]
            acc[js, 1] += -(Y * np.log(P + EPS) + (1 - Y) * np.log(1 - P + EPS)).sum(axis=0)
            acc[js, 2:2 + n1] += (P - Y).T @ X1
            if hessian:
                V = P * (1 - P)
                for c, j in enumerate(js):
                    acc[j, 2 + n1:] += ((X1 * V[:, c:c + 1]).T @ X1).ravel()
        return acc.ravel()

    tot = tree_sum(blocks, M * width, partial).reshape(M, width)
    out = {"m": tot[:, 0], "ce": tot[:, 1], "g": tot[:, 2:2 + n1]}
    if hessian:
        out["H"] = tot[:, 2 + n1:].reshape(-1, n1, n1)
    return out


@dataclass
class OvaFit:
    classes: list[int]
    lambdas: list[float]
    n_subsets: int
    theta: np.ndarray          # (S, L, K, n+1) on standardised features, bias first
    scaler: VectorScaler
    cost: np.ndarray           # (S, L, K)
    iterations: int
    converged: np.ndarray      # (S, L, K)
    separated: np.ndarray      # (S, L, K): the loss fell below ``separable_cost``, no finite minimiser
    history: list = field(default_factory=list)


def _models(S, L, K):
    grid = np.array([(s, l, k) for s in range(S) for l in range(L) for k in range(K)])
    return grid[:, 0], grid[:, 1], grid[:, 2]


def fit_one_vs_all(data: DataFrame, vec_col: str, label_col: str, classes: Sequence[int],
                   lambdas: Sequence[float] = (0.1,), member_col: str | None = None, n_subsets: int = 1,
                   solver: str = "newton", max_iter: int = 100, lr: float = 1.0, tol: float = 1e-10,
                   scaler: VectorScaler | None = None, separable_cost: float = 1e-6) -> OvaFit:
    """L2 logistic cost J = mean CE + λ/2m‖θ₁..‖² per (subset, λ, class),
    all models advanced together, one pass per iteration.

    ``solver='newton'``: damped Newton (per-model step halving when J rises; a model
    stops as ``converged`` when |ΔJ| < tol, or as ``separated`` when J <
    ``separable_cost``: its classes are apart and the unpenalised loss has no finite
    minimiser; a model still open at ``max_iter`` is neither, and a last step that
    raised J is taken back);
    ``solver='gd'``: plain gradient descent with rate ``lr`` for ``max_iter`` steps.
    ``member_col``: array<boolean> of subset membership (B13 learning-curve prefixes);
    each subset gets its own scaler."""
    classes = [int(c) for c in classes]
    S, L, K = n_subsets, len(lambdas), len(classes)
    data = data.select(vec_col, label_col, *([member_col] if member_col else []))
    first = data.select(F.size(vec_col).alias("n")).agg(F.count(F.lit(1)).alias("m"), F.max("n").alias("n")).collect()[0]
    data = right_sized(data, int(first["m"] or 0), 8 * (int(first["n"] or 0) + 2 + S))
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    blocks = _ova_blocks(data, vec_col, label_col, member_col)
    try:
        if scaler is None:
            scaler = vector_scaler(data, vec_col, member_col, S)
        n = scaler.mean.shape[1]
        ms, ml, mk = _models(S, L, K)
        mclass = np.array(classes)[mk]
        lam = np.array(lambdas, dtype=float)[ml]
        M = len(ms)
        theta = np.zeros((M, n + 1))
        D = np.ones(n + 1)
        D[0] = 0.0
        prev_cost = np.full(M, np.inf)
        prev_theta = theta.copy()
        step = np.zeros_like(theta)
        done = np.zeros(M, dtype=bool)
        apart = np.zeros(M, dtype=bool)
        hist = []
        it = 0
        cost = np.zeros(M)
        for it in range(max_iter + 1):
            st = block_pass(blocks, ms, mclass, theta, scaler, solver == "newton")
            m = np.maximum(st["m"], 1.0)
            cost = st["ce"] / m + lam / (2 * m) * np.sum(theta[:, 1:] ** 2, axis=1)
            hist.append((it, cost.copy()))
            if it == max_iter:
                worse = cost > prev_cost + 1e-15 if solver == "newton" else np.zeros(M, dtype=bool)
                theta = np.where(worse[:, None], prev_theta, theta)
                cost = np.where(worse, prev_cost, cost)
                break
            g = st["g"] / m[:, None] + (lam / m)[:, None] * theta * D
            if solver == "gd":
                theta = theta - lr * g
                continue
            new_theta = theta.copy()
            for j in range(M):
                if done[j]:
                    continue
                if cost[j] > prev_cost[j] + 1e-15:
                    step[j] /= 2.0
                    new_theta[j] = prev_theta[j] - step[j]
                    if np.max(np.abs(step[j])) < 1e-12:
                        new_theta[j] = prev_theta[j]
                        done[j] = True
                    continue
                if abs(prev_cost[j] - cost[j]) < tol or cost[j] < separable_cost:
                    done[j], apart[j] = True, abs(prev_cost[j] - cost[j]) >= tol
                    continue
                H = st["H"][j] / m[j] + np.diag(lam[j] / m[j] * D)
                step[j] = np.linalg.lstsq(H + 1e-12 * np.eye(n + 1), g[j], rcond=None)[0]
                prev_cost[j], prev_theta[j] = cost[j], theta[j]
                new_theta[j] = theta[j] - step[j]
            theta = new_theta
            if done.all():
                break
        shape = (S, L, K)
        return OvaFit(classes, [float(x) for x in lambdas], S, theta.reshape(S, L, K, n + 1), scaler,
                      cost.reshape(shape), it, (done & ~apart).reshape(shape), apart.reshape(shape), hist)
    finally:
        blocks.unpersist()
        data.unpersist()


def ova_scores(vec_col: str, theta: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> Column:
    """K linear scores per row, scaler folded into θ once (E6 input)."""
    from .score import vector_scores
    return vector_scores(vec_col, theta, mean, scale)
