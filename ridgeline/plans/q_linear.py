"""Registered linear-regression queries (D1–D12, E1–E2, F1 on fits)."""

from __future__ import annotations


import numpy as np

from pyspark.sql import functions as F

from ..functions.columns import hash_uniform_sql, normal_init_sql
from ..operators import evaluate, linear, split
from ..operators.moments import moments
from . import sqlgen
from .catalog import memo, query, rnd
from .tasks import (HOUSE_FEATURES, HOUSE_ID, HOUSE_SQL, HOUSE_TARGET, house_like)

LR, ITERS, SEED, TEST_FRAC = 0.01, 1000, 42, 0.2


def house_split(spark, sf_dir):
    return split.hash_split(house_like(spark, sf_dir), HOUSE_ID, TEST_FRAC, SEED)


def house_fit(spark, sf_dir):
    def build():
        tagged = house_split(spark, sf_dir)  # narrow md5 predicate over a pruned scan: recomputed, not cached
        train = tagged.where(F.col("split") == "train")
        model = linear.fit_batch_gd(train, HOUSE_FEATURES, HOUSE_TARGET, lr=LR, max_iter=ITERS, seed=SEED)
        return tagged, model
    return memo(spark, ("house", sf_dir), build)


# ---------------------------------------------------------------- SQL pieces
_U = hash_uniform_sql(HOUSE_ID, SEED)
_COLS = HOUSE_FEATURES + [HOUSE_TARGET]
_K = len(HOUSE_FEATURES)


def _house_gd_ctes(iters=ITERS):
    return (
        f"WITH RECURSIVE base AS MATERIALIZED ({HOUSE_SQL}), "
        f"tagged AS MATERIALIZED (SELECT *, CASE WHEN {_U} < {TEST_FRAC} THEN 'test' ELSE 'train' END AS split FROM base), "
        f"mom AS MATERIALIZED (SELECT {sqlgen.moments_select(_COLS)} FROM tagged WHERE split = 'train'), "
        f"sys AS MATERIALIZED (SELECT {sqlgen.std_system(_K, _K)} FROM mom), "
        f"{sqlgen.batch_gd_cte('sys', normal_init_sql(_K, SEED), LR, iters)}"
    )


def _pred_sql(wcol="w", bcol="b"):
    t = _K
    terms = " + ".join(f"{wcol}[{i + 1}] * ({c} - m{i}) / {sqlgen.scale_expr(i)}" for i, c in enumerate(HOUSE_FEATURES))
    return f"(m{t} + {sqlgen.scale_expr(t)} * ({bcol} + {terms}))"


HOUSE_EVAL_SQL = (
    _house_gd_ctes() + ", "
    f"fin AS (SELECT w, b FROM gd WHERE it = {ITERS}), "
    f"pred AS (SELECT net_price AS y, {_pred_sql()} AS p FROM tagged, fin, mom WHERE split = 'test') "
    "SELECT count(*) AS n, "
    f"{sqlgen.rnd('avg((y - p) * (y - p))', 2)} AS mse, {sqlgen.rnd('avg(abs(y - p))', 4)} AS mae, "
    f"{sqlgen.rnd('sqrt(avg((y - p) * (y - p)))', 4)} AS rmse, "
    f"{sqlgen.rnd('1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))', 6)} AS r2 FROM pred"
)


@query("house_gd_eval", ops=("B1", "B6", "B7", "B8", "B10", "D1", "D2", "D3", "E1", "E2", "F1"),
       sql=HOUSE_EVAL_SQL)
def house_gd_eval(spark, sf_dir):
    """Flagship: lineitem⋈part → hash split → standardise on train → batch GD
    (lr .01, 1000 it.) on the moment matrix → score test rows → MSE/MAE/RMSE/R²."""
    tagged, model = house_fit(spark, sf_dir)
    test = tagged.where(F.col("split") == "test").withColumn("pred", model.predict_expr())
    m = evaluate.regression_metrics(test, HOUSE_TARGET, "pred")
    return m.select("n", rnd("mse", 2).alias("mse"), rnd("mae", 4).alias("mae"),
                    rnd("rmse", 4).alias("rmse"), rnd("r2", 6).alias("r2"))


# ---------------------------------------------------------------- weights, history, rates
def _weights_df(spark, model, features):
    rows = [(f, float(w)) for f, w in zip(features, model.weights)] + [("bias", float(model.bias))]
    return spark.createDataFrame(rows, "feature string, weight double")


def _weights_sql(final_cte: str) -> str:
    feats = ", ".join(f"'{f}'" for f in HOUSE_FEATURES)
    return (f"SELECT f.feature, {sqlgen.rnd('f.weight', 6)} AS weight FROM ("
            f"SELECT unnest([{feats}, 'bias']) AS feature, unnest(list_append(w, b)) AS weight FROM {final_cte}) f")


@query("gd_batch", ops=("B9", "D1", "D3"),
       sql=_house_gd_ctes() + f", fin AS (SELECT w, b FROM gd WHERE it = {ITERS}) " + _weights_sql("fin"))
def gd_batch(spark, sf_dir):
    """Batch GD weights (standardised scale) and bias on the house-like table."""
    _, model = house_fit(spark, sf_dir)
    return _weights_df(spark, model, HOUSE_FEATURES).select("feature", rnd("weight", 6).alias("weight"))


def _history_sql(method_label: str, gd_cte: str = "gd", sys_cte: str = "sys") -> str:
    return (f"SELECT '{method_label}' AS method, (it - 1)::INTEGER AS iteration, "
            f"{sqlgen.rnd(sqlgen.gd_cost_expr(), 9)} AS cost FROM {gd_cte}, {sys_cte} "
            f"WHERE it >= 1 AND (it - 1) % 100 = 0")


def _history_df(spark, model, label):
    rows = [(label, int(i), float(c)) for i, c in model.history]
    return spark.createDataFrame(rows, "method string, iteration int, cost double")


@query("gd_history", ops=("D2", "D6"), sql=_house_gd_ctes() + " " + _history_sql("batch"))
def gd_history(spark, sf_dir):
    """Loss every 100 iterations, after that iteration's update, on the full train set."""
    _, model = house_fit(spark, sf_dir)
    return _history_df(spark, model, "batch").select("method", "iteration", rnd("cost", 9).alias("cost"))


@query("gd_convergence", ops=("D7",), sql=(
    _house_gd_ctes() + ", h AS (" + _history_sql("batch").replace(f"{sqlgen.rnd(sqlgen.gd_cost_expr(), 9)}", sqlgen.gd_cost_expr()) + ") "
    "SELECT method, iteration, " + sqlgen.rnd("-(ln(cost) - lag(ln(cost)) OVER (PARTITION BY method ORDER BY iteration))", 6)
    + " AS rate FROM h"))
def gd_convergence(spark, sf_dir):
    """Convergence rate −Δln(cost) between recorded points (first point: null)."""
    _, model = house_fit(spark, sf_dir)
    h = linear.convergence_rates(_history_df(spark, model, "batch"))
    return h.select("method", "iteration", rnd("rate", 6).alias("rate"))


# ---------------------------------------------------------------- stochastic / mini-batch
SGD_ITERS, MB = 1000, 32


def _sampled_fit(spark, sf_dir, method):
    tagged = house_split(spark, sf_dir)
    train = tagged.where(F.col("split") == "train")
    mom = moments(train, HOUSE_FEATURES + [HOUSE_TARGET])
    return linear.fit_sampled_gd(train, HOUSE_FEATURES, HOUSE_TARGET, HOUSE_ID, method=method, lr=LR,
                                 max_iter=SGD_ITERS, batch_size=MB if method == "mini_batch" else None,
                                 seed=SEED, mom=mom), mom


def _sampled_ctes(method: str, name: str) -> str:
    """CTEs rk_<name>, pm_<name>, gd_<name> for stochastic / mini-batch descent."""
    k = _K
    z = ", ".join(f"({c} - m{i}) / {sqlgen.scale_expr(i)} AS z{i}" for i, c in enumerate(HOUSE_FEATURES))
    zy = f"({HOUSE_TARGET} - m{k}) / {sqlgen.scale_expr(k)} AS zy"
    ids = ", ".join(f"{c}::VARCHAR" for c in HOUSE_ID)
    perm = f"md5(concat_ws('-', {ids}, 'perm-{SEED}'))"
    rk = (f"rk_{name} AS MATERIALIZED (SELECT row_number() OVER (ORDER BY {perm}, {', '.join(HOUSE_ID)}) AS rank, {z}, {zy} "
          f"FROM tagged, mom WHERE split = 'train')")
    start = f"floor(mom.n * {hash_uniform_sql(['''\'''' + method + '''\'''', 'it::VARCHAR'], SEED)})::BIGINT"
    if method == "stochastic":
        dr = f"dr_{name} AS (SELECT it AS iteration, {start} + 1 AS rank FROM range({SGD_ITERS}) t(it), mom)"
    else:
        b = MB
        dr = (f"dr_{name} AS (SELECT it AS iteration, (({start} + j) % mom.n) + 1 AS rank "
              f"FROM range({SGD_ITERS}) t(it), range({b}) s(j), mom WHERE j < mom.n)")
    sxx = "[" + ", ".join("[" + ", ".join(f"sum(z{a} * z{b})" for b in range(k)) + "]" for a in range(k)) + "]"
    sx = "[" + ", ".join(f"sum(z{a})" for a in range(k)) + "]"
    sxy = "[" + ", ".join(f"sum(z{a} * zy)" for a in range(k)) + "]"
    pm = (f"pm_{name} AS MATERIALIZED (SELECT iteration, count(*)::DOUBLE AS cnt, sum(zy) AS sy, {sxx}::DOUBLE[][] AS Sxx, "
          f"{sx}::DOUBLE[] AS Sx, {sxy}::DOUBLE[] AS Sxy FROM rk_{name} JOIN dr_{name} USING (rank) GROUP BY iteration)")
    sc = "1.0" if method == "stochastic" else "(1.0 / cnt)"
    gd = (f"gd_{name}(it, w, b) AS (SELECT 0, {normal_init_sql(k, SEED)}::DOUBLE[], 0.0::DOUBLE UNION ALL "
          f"SELECT it + 1, list_transform(w, lambda wi, i: wi - {LR!r} * {sc} * "
          f"(list_dot_product(Sxx[i], w) + Sx[i] * b - Sxy[i])), "
          f"b - {LR!r} * {sc} * (list_dot_product(Sx, w) + cnt * b - sy) "
          f"FROM gd_{name} JOIN pm_{name} ON pm_{name}.iteration = gd_{name}.it WHERE it < {SGD_ITERS})")
    return ", ".join([rk, dr, pm, gd])


def _sampled_weights_sql(method, name):
    return (_house_gd_ctes() + ", " + _sampled_ctes(method, name) +
            f", fin AS (SELECT w, b FROM gd_{name} WHERE it = {SGD_ITERS}) " + _weights_sql("fin"))


@query("gd_stochastic", ops=("D4", "D1"), sql=_sampled_weights_sql("stochastic", "s"))
def gd_stochastic(spark, sf_dir):
    """Stochastic GD: one hash-drawn train row per iteration (with replacement)."""
    model, _ = _sampled_fit(spark, sf_dir, "stochastic")
    return _weights_df(spark, model, HOUSE_FEATURES).select("feature", rnd("weight", 6).alias("weight"))


@query("gd_minibatch", ops=("D5", "D1"), sql=_sampled_weights_sql("mini_batch", "mb"))
def gd_minibatch(spark, sf_dir):
    """Mini-batch GD: 32 distinct consecutive rows of the hash permutation per iteration."""
    model, _ = _sampled_fit(spark, sf_dir, "mini_batch")
    return _weights_df(spark, model, HOUSE_FEATURES).select("feature", rnd("weight", 6).alias("weight"))


@query("gd_compare", ops=("D8", "D6"), sql=(
    _house_gd_ctes() + ", " + _sampled_ctes("stochastic", "s") + ", " + _sampled_ctes("mini_batch", "mb") + " "
    + _history_sql("batch") + " UNION ALL " + _history_sql("stochastic", "gd_s") + " UNION ALL "
    + _history_sql("mini_batch", "gd_mb")))
def gd_compare(spark, sf_dir):
    """Loss histories of batch, stochastic and mini-batch GD on identical data and start."""
    tagged = house_split(spark, sf_dir)
    train = tagged.where(F.col("split") == "train")
    mom = moments(train, HOUSE_FEATURES + [HOUSE_TARGET])
    b = linear.fit_batch_gd(train, HOUSE_FEATURES, HOUSE_TARGET, lr=LR, max_iter=ITERS, seed=SEED, mom=mom)
    out = _history_df(spark, b, "batch")
    drawn = linear.sampled_rows(train, HOUSE_FEATURES, HOUSE_TARGET, HOUSE_ID, mom, max_iter=SGD_ITERS, batch_size=MB, seed=SEED)
    for method in ("stochastic", "mini_batch"):
        m = linear.fit_sampled_gd(train, HOUSE_FEATURES, HOUSE_TARGET, HOUSE_ID, method=method, lr=LR,
                                  max_iter=SGD_ITERS, batch_size=MB if method == "mini_batch" else None,
                                  seed=SEED, mom=mom, drawn=drawn)
        out = out.unionByName(_history_df(spark, m, method))
    return out.select("method", "iteration", rnd("cost", 9).alias("cost"))


# ---------------------------------------------------------------- ridge on the daily sales table
from ..operators.moments import moments_by_split  # noqa: E402
from .tasks import SALES_FEATURES, SALES_ID, SALES_SQL, SALES_TARGET, sales_like  # noqa: E402

LAMBDAS = (0.01, 0.1, 1.0, 10.0, 100.0)
_SCOLS = SALES_FEATURES + [SALES_TARGET]
_SK = len(SALES_FEATURES)


def sales_split(spark, sf_dir):
    """70/15/15 exact three-way split of the days by hash rank."""
    return split.three_way_split(sales_like(spark, sf_dir), SALES_ID, 0.15, 0.176, SEED, exact=True).cache()


def ridge_results(spark, sf_dir):
    def build():
        tagged = sales_split(spark, sf_dir)
        moms = moments_by_split(tagged, _SCOLS, "split", ["train", "val", "test"])
        sweep = linear.ridge_sweep(moms["train"], moms["val"], SALES_FEATURES, SALES_TARGET, LAMBDAS)
        return tagged, moms, sweep
    return memo(spark, ("ridge", sf_dir), build)


def _sales_ctes():
    m = "CAST(m.n AS DOUBLE)"
    u = hash_uniform_sql(["day::VARCHAR"], SEED)
    rows = []
    for i in range(_SK):
        cells = [f"{m} * c{min(i, j)}_{max(i, j)}" + (" + l.lam" if i == j else "") for j in range(_SK)]
        cells.append(f"{m} * c{i}_{_SK}")
        rows.append("[" + ", ".join(cells) + "]")
    M = "[" + ", ".join(rows) + "]::DOUBLE[][]"
    n = _SK
    lam_vals = ", ".join(f"({i}, {v!r}::DOUBLE)" for i, v in enumerate(LAMBDAS))
    return (
        f"WITH RECURSIVE base AS MATERIALIZED ({SALES_SQL}), "
        f"rk AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY {u}, day) AS r, count(*) OVER () AS m FROM base), "
        f"tagged AS MATERIALIZED (SELECT *, CASE WHEN r <= ceil(m * 0.15) THEN 'test' "
        f"WHEN r <= ceil(m * 0.15) + ceil((m - ceil(m * 0.15)) * 0.176) THEN 'val' ELSE 'train' END AS split FROM rk), "
        f"m AS MATERIALIZED (SELECT {sqlgen.moments_select(_SCOLS)} FROM tagged WHERE split = 'train'), "
        f"lams(pos, lam) AS (VALUES {lam_vals}), "
        f"ge(pos, lam, k, M) AS (SELECT l.pos, l.lam, 0, {M} FROM m, lams l UNION ALL "
        f"SELECT pos, lam, k + 1, list_transform(M, lambda row, i: CASE WHEN i = k + 1 "
        f"THEN list_transform(row, lambda v: v / M[k + 1][k + 1]) "
        f"ELSE list_transform(row, lambda v, j: v - row[k + 1] / M[k + 1][k + 1] * M[k + 1][j]) END) "
        f"FROM ge WHERE k < {n}), "
        f"sol AS MATERIALIZED (SELECT pos, lam, list_transform(M, lambda row: row[{n + 1}]) AS w FROM ge WHERE k = {n}), "
        f"fit AS MATERIALIZED (SELECT pos, lam, w, m{_SK} - list_dot_product(w, [{', '.join(f'm{i}' for i in range(_SK))}]::DOUBLE[]) AS b "
        f"FROM sol, m), "
        f"pv AS (SELECT pos, lam, revenue AS y, b + list_dot_product(w, [{', '.join(SALES_FEATURES)}]::DOUBLE[]) AS p, split "
        f"FROM fit, tagged), "
        f"ev AS MATERIALIZED (SELECT pos, lam, split, 1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2, "
        f"sqrt(avg((y - p) * (y - p))) AS rmse, avg((y - p) * (y - p)) AS mse FROM pv GROUP BY pos, lam, split), "
        f"best AS (SELECT pos FROM ev WHERE split = 'val' AND NOT isnan(r2) ORDER BY r2 DESC, pos LIMIT 1)"
    )


def _sweep_df(spark, sweep):
    rows = [(r["position"], r["lambda"], r["r2"], r["rmse"], r["intercept"], r["complexity"], r["weights"])
            for r in sweep]
    return spark.createDataFrame(rows, "position int, lambda double, r2 double, rmse double, intercept double, "
                                       "complexity double, weights array<double>")


@query("ridge_sweep", ops=("B5", "B12", "D9", "D10", "D11"), sql=(
    _sales_ctes() + " SELECT ev.lam AS lambda, " + sqlgen.rnd("ev.r2", 6) + " AS r2, " + sqlgen.sig("ev.rmse", 8)
    + " AS rmse, " + sqlgen.sig("fit.b", 6) + " AS intercept, "
    + sqlgen.sig("list_sum(list_transform(fit.w, lambda x: abs(x)))", 6) + " AS complexity "
    "FROM ev JOIN fit USING (pos) WHERE ev.split = 'val'"))
def ridge_sweep(spark, sf_dir):
    """Ridge (α on RSS, unscaled features, free intercept) for λ ∈ {.01,.1,1,10,100}:
    validation R², RMSE, intercept and Σ|w| from two moment sets (one job)."""
    _, _, sweep = ridge_results(spark, sf_dir)
    d = _sweep_df(spark, sweep)
    return d.select("lambda", rnd("r2", 6).alias("r2"), sig_("rmse", 8).alias("rmse"),
                    sig_("intercept", 6).alias("intercept"), sig_("complexity", 6).alias("complexity"))


@query("ridge_path", ops=("D12",), sql=(
    _sales_ctes() + " SELECT lam AS lambda, f.feature, " + sqlgen.sig("f.weight", 6) + " AS weight, "
    + sqlgen.sig("abs(f.weight)", 6) + " AS abs_weight FROM (SELECT lam, unnest([" + ", ".join(f"'{c}'" for c in SALES_FEATURES)
    + "]) AS feature, unnest(w) AS weight FROM fit) f"))
def ridge_path(spark, sf_dir):
    """Weight path over λ, signed and absolute (posexplode of the sweep table)."""
    _, _, sweep = ridge_results(spark, sf_dir)
    d = _sweep_df(spark, sweep)
    names = F.array(*[F.lit(c) for c in SALES_FEATURES])
    e = d.select("lambda", F.posexplode("weights").alias("i", "weight"))
    return e.select("lambda", F.element_at(names, F.col("i") + 1).alias("feature"),
                    sig_("weight", 6).alias("weight"), sig_(F.abs(F.col("weight")), 6).alias("abs_weight"))


@query("ridge_best", ops=("D10", "F1", "A10"), sql=(
    _sales_ctes() + " SELECT ev.lam AS lambda, " + sqlgen.rnd("ev.r2", 6) + " AS test_r2, "
    + sqlgen.sig("ev.rmse", 8) + " AS test_rmse, " + sqlgen.sig("ev.mse", 8) + " AS test_mse, "
    "(SELECT count(*) FROM tagged WHERE split = 'train') AS n_train, (SELECT count(*) FROM tagged WHERE split = 'val') AS n_val, "
    "(SELECT count(*) FROM tagged WHERE split = 'test') AS n_test FROM ev WHERE ev.split = 'test' AND ev.pos = (SELECT pos FROM best)"))
def ridge_best(spark, sf_dir):
    """Best λ on validation (strictly greatest R², first on ties), evaluated on test."""
    tagged, moms, sweep = ridge_results(spark, sf_dir)
    best = next(r for r in sweep if r["is_best"])
    met = linear.split_metrics(moms["test"], SALES_FEATURES, SALES_TARGET, np.array(best["weights"]),
                               best["intercept"])
    row = [(best["lambda"], met["r2"], met["rmse"], met["mse"], moms["train"].n, moms["val"].n, moms["test"].n)]
    d = spark.createDataFrame(row, "lambda double, r2 double, rmse double, mse double, n_train long, n_val long, n_test long")
    return d.select("lambda", rnd("r2", 6).alias("test_r2"), sig_("rmse", 8).alias("test_rmse"),
                    sig_("mse", 8).alias("test_mse"), "n_train", "n_val", "n_test")


def sig_(c, d):
    from .catalog import sig
    return sig(c, d)
