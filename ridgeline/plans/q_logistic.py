"""Registered logistic queries: binary GD (D13–D15) on documents ⋈ labels and
one-vs-all by damped Newton (D18–D20, E6, F7–F9) on the embeddings table.
The SQL of the one-vs-all queries finds the minimisers by gradient steps of its own (``sqlsolve``)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.columns import hash_uniform_sql
from ..operators import evaluate, logistic, split
from ..operators.score import accuracy_of_models, argmax_class
from . import sqlgen, sqlsolve
from .catalog import memo, query, rnd
from .tasks import DOC_FEATURES, DOC_ID, DOC_TARGET, PATIENT_SQL, VEC_ID, digit_like, patient_like

SEED, TEST_FRAC = 42, 0.2
# Rate and number of iterations of the logistic descent (each one Spark
# pass), loss recorded every 100.
LOGIT_LR, LOGIT_ITERS, LOGIT_REC = 0.5, 2000, 100
_K = len(DOC_FEATURES)


def patient_split(spark, sf_dir):
    return split.stratified_split(patient_like(spark, sf_dir), DOC_ID, DOC_TARGET, TEST_FRAC, SEED)


def logit_fit(spark, sf_dir):
    def build():
        tagged = patient_split(spark, sf_dir).persist()
        train = tagged.where(F.col("split") == "train")
        model = logistic.fit_logistic_gd(train, DOC_FEATURES, DOC_TARGET, lr=LOGIT_LR, max_iter=LOGIT_ITERS,
                                         record_every=LOGIT_REC)
        return tagged, model
    return memo(spark, ("logit", sf_dir), build)


# ---------------------------------------------------------------- SQL twin
_UDOC = hash_uniform_sql(DOC_ID, SEED)


def _logit_ctes(l2=0.0, iters=None):
    """CTEs up to ``gd``: the recursion of the descent, with an optional penalty λ/2m‖w‖²."""
    iters = LOGIT_ITERS if iters is None else iters
    shrink = f" - {LOGIT_LR!r} * {l2!r} / m * wi" if l2 else ""
    xs = ", ".join(f"({c} - m{i}) / s{i}" for i, c in enumerate(DOC_FEATURES))
    g = ", ".join(f"sum((p - y) * x[{i + 1}])" for i in range(_K))
    zeros = ", ".join("0.0" for _ in range(_K))
    return (
        f"WITH RECURSIVE base AS MATERIALIZED ({PATIENT_SQL}), "
        + sqlgen.stratified_ctes("base", DOC_ID, DOC_TARGET, TEST_FRAC, _UDOC) + ", "
        f"sc AS MATERIALIZED (SELECT {sqlgen.scaler_select(DOC_FEATURES)} FROM tagged WHERE split = 'train'), "
        f"z AS MATERIALIZED (SELECT [{xs}]::DOUBLE[] AS x, quality::DOUBLE AS y FROM tagged, sc WHERE split = 'train'), "
        f"gd(it, w, b, cost) AS (SELECT 0, [{zeros}]::DOUBLE[], 0.0::DOUBLE, NULL::DOUBLE UNION ALL "
        f"SELECT it + 1, list_transform(w, lambda wi, i: wi - {LOGIT_LR!r} * g[i] / m{shrink}), b - {LOGIT_LR!r} * gb / m, ce / m FROM ("
        f"SELECT it, w, b, count(*)::DOUBLE AS m, sum(p - y) AS gb, [{g}]::DOUBLE[] AS g, "
        f"sum(-(y * ln(p + 1e-15) + (1.0 - y) * ln(1.0 - p + 1e-15))) AS ce FROM ("
        f"SELECT gd.it, gd.w, gd.b, z.x, z.y, 1.0 / (1.0 + exp(-(gd.b + list_dot_product(gd.w, z.x)))) AS p "
        f"FROM gd, z WHERE gd.it <= {iters}) GROUP BY it, w, b))"
    )


@query("logit_gd", ops=("B11", "B6", "B7", "D13", "D14"), sql=(
    _logit_ctes() + ", fin AS (SELECT w, b FROM gd WHERE it = " + str(LOGIT_ITERS) + ") "
    "SELECT f.feature, " + sqlgen.rnd("f.weight", 6) + " AS weight FROM (SELECT unnest(["
    + ", ".join(f"'{c}'" for c in DOC_FEATURES) + ", 'bias']) AS feature, unnest(list_append(w, b)) AS weight FROM fin) f"))
def logit_gd(spark, sf_dir):
    """Binary logistic regression by gradient descent from zero (lr .5) on the
    standardised text measures of the stratified training split."""
    _, m = logit_fit(spark, sf_dir)
    rows = [(f, float(w)) for f, w in zip(DOC_FEATURES, m.weights)] + [("bias", float(m.bias))]
    return spark.createDataFrame(rows, "feature string, weight double").select("feature", rnd("weight", 6).alias("weight"))


@query("logit_cost", ops=("D13", "D6"), sql=(
    _logit_ctes() + " SELECT (it - 2)::INTEGER AS iteration, " + sqlgen.rnd("cost", 9)
    + f" AS cost FROM gd WHERE it >= 2 AND (it - 2) % {LOGIT_REC} = 0"))
def logit_cost(spark, sf_dir):
    """Cross-entropy (ε=1e-15) on the training split after every 100th update."""
    _, m = logit_fit(spark, sf_dir)
    return spark.createDataFrame([(int(i), float(c)) for i, c in m.history], "iteration int, cost double") \
                .select("iteration", rnd("cost", 9).alias("cost"))


def _logit_test_sql(l2=0.0, iters=None):
    iters = LOGIT_ITERS if iters is None else iters
    xs = " + ".join(f"w[{i + 1}] * ({c} - m{i}) / s{i}" for i, c in enumerate(DOC_FEATURES))
    return (_logit_ctes(l2, iters) + f", fin AS (SELECT w, b FROM gd WHERE it = {iters}), "
            f"pr AS (SELECT quality AS label, CASE WHEN 1.0 / (1.0 + exp(-(b + {xs}))) >= 0.5 THEN 1 ELSE 0 END AS prediction "
            f"FROM tagged, sc, fin WHERE split = 'test')")


@query("logit_confusion", ops=("E3", "E4", "E5", "F7"), sql=(
    _logit_test_sql() + ", cells AS (SELECT l.c AS label, p.c AS prediction FROM (VALUES (0), (1)) l(c), (VALUES (0), (1)) p(c)) "
    "SELECT cells.label::INTEGER AS label, cells.prediction::INTEGER AS prediction, count(pr.label)::BIGINT AS n "
    "FROM cells LEFT JOIN pr ON pr.label = cells.label AND pr.prediction = cells.prediction GROUP BY 1, 2"))
def logit_confusion(spark, sf_dir):
    """Test-split confusion cells of σ(X·w+b) ≥ .5 (scaler folded into the weights)."""
    tagged, m = logit_fit(spark, sf_dir)
    test = tagged.where(F.col("split") == "test").withColumn("prediction", m.class_expr(0.5))
    return evaluate.confusion(test, DOC_TARGET, "prediction", classes=[0, 1])


@query("logit_accuracy", ops=("F8",), sql=(
    _logit_test_sql() + " SELECT " + sqlgen.rnd("avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END)", 9)
    + " AS accuracy, count(*) AS n FROM pr"))
def logit_accuracy(spark, sf_dir):
    """Test accuracy of the GD model."""
    tagged, m = logit_fit(spark, sf_dir)
    test = tagged.where(F.col("split") == "test").withColumn("prediction", m.class_expr(0.5))
    a = evaluate.accuracy(test, DOC_TARGET, "prediction")
    return a.select(rnd("accuracy", 9).alias("accuracy"), F.col("n").cast("long").alias("n"))


def _accuracy_sql(names, l2=0.0, iters=None):
    rows = ", ".join(f"('{n}')" for n in names)
    return ("SELECT solver, accuracy, n_train FROM (" + _logit_test_sql(l2, iters) + " SELECT "
            + sqlgen.rnd("avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END)", 6)
            + " AS accuracy, (SELECT count(*) FROM tagged WHERE split = 'train') AS n_train FROM pr), "
            + f"(VALUES {rows}) v(solver)")


# the penalised loss has one minimiser: the descent run long enough reaches both solvers' fit
@query("logit_vs_mllib", ops=("D15", "F8"), sql=(
    _accuracy_sql(["gd"]) + " UNION ALL " + _accuracy_sql(["mllib_lbfgs_C1", "newton_C1"], 1.0, 20_000)))
def logit_vs_mllib(spark, sf_dir):
    """Own GD accuracy next to the library solver (C=1 → MLlib L-BFGS with
    regParam 1/m) and Newton with the same penalty, on the same test rows."""
    tagged, gd = logit_fit(spark, sf_dir)
    train = tagged.where(F.col("split") == "train")
    test = tagged.where(F.col("split") == "test")
    lib = logistic.fit_logistic_mllib(train, DOC_FEATURES, DOC_TARGET, C=1.0, mean=gd.x_mean, scale=gd.x_scale)
    m = train.count()
    nt = logistic.fit_logistic_newton(train, DOC_FEATURES, DOC_TARGET, l2=1.0, max_iter=25)
    out = None
    for name, model in (("gd", gd), ("mllib_lbfgs_C1", lib), ("newton_C1", nt)):
        a = evaluate.accuracy(test.withColumn("prediction", model.class_expr(0.5)), DOC_TARGET, "prediction")
        a = a.select(F.lit(name).alias("solver"), rnd("accuracy", 6).alias("accuracy"), F.lit(m).cast("long").alias("n_train"))
        out = a if out is None else out.unionByName(a)
    return out


# ---------------------------------------------------------------- one-vs-all on embeddings
CLASSES = list(range(10))
OVA_LAMBDA = 0.1
OVA_MAX_ITER = 100
OVA_LAMBDAS = (0.0, 0.01, 0.1, 1.0, 10.0)
FRACTIONS = (0.1, 0.3, 0.5, 0.7, 0.9)


def digit_split(spark, sf_dir):
    return split.stratified_split(digit_like(spark, sf_dir), VEC_ID, "label", TEST_FRAC, SEED)


def ova_models(spark, sf_dir):
    """λ-grid one-vs-all fit (all classes × all λ in the same passes)."""
    def build():
        tagged = digit_split(spark, sf_dir).persist()
        train = tagged.where(F.col("split") == "train")
        fit = logistic.fit_one_vs_all(train, "embedding", "label", CLASSES, OVA_LAMBDAS, max_iter=OVA_MAX_ITER)
        return tagged, fit
    return memo(spark, ("ova", sf_dir), build)


def _scored(df, fit, li):
    theta = fit.theta[0, li]
    s = logistic.ova_scores("embedding", theta, fit.scaler.mean[0], fit.scaler.scale[0])
    return df.withColumn("prediction", argmax_class(s))


# ---------------------------------------------------------------- SQL twin
_UVEC = hash_uniform_sql(VEC_ID, SEED)
_VEC_SQL = "WITH RECURSIVE base AS MATERIALIZED (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings), "


def _ova_ctes(lambdas):
    """CTEs up to the fits and scores of the stratified split, one model for each λ and class."""
    return (_VEC_SQL + sqlgen.stratified_ctes("base", VEC_ID, "label", TEST_FRAC, _UVEC)
            + ", pool AS (SELECT 0 AS s, vec_id, label, e, split = 'train' AS train FROM tagged), "
            + sqlsolve.fit_ctes(CLASSES, lambdas) + ", " + sqlsolve.score_ctes())


def _curve_ctes():
    """The same for the nested fractions: subset i learns from its own rows."""
    tagged = ", ".join(sqlgen.stratified_ctes("base", VEC_ID, "label", f, _UVEC, out=f"t{i}", total="floor", prefix=f"f{i}_")
                       for i, f in enumerate(FRACTIONS))
    pool = " UNION ALL ".join(f"SELECT {i} AS s, vec_id, label, e, split = 'test' AS train FROM t{i}" for i in range(len(FRACTIONS)))
    return (_VEC_SQL + tagged + f", pool AS MATERIALIZED ({pool}), " + sqlsolve.fit_ctes(CLASSES, [OVA_LAMBDA]) + ", "
            + sqlsolve.score_ctes())


_SIDE = "CASE WHEN train THEN 'train' ELSE 'test' END AS split"
_HIT = sqlgen.rnd("avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END)", 6) + " AS accuracy"


@query("ova_fit", ops=("B9", "D16", "D17", "D18"), sql=(
    _ova_ctes([OVA_LAMBDA]) + " SELECT k::INTEGER AS class, " + sqlgen.rnd("cost", 6) + " AS cost, "
    + sqlgen.rnd("sqrt(list_dot_product(theta, theta))", 4) + f" AS theta_norm, slope <= {sqlsolve.STATIONARY!r} AS converged FROM best"))
def ova_fit(spark, sf_dir):
    """One-vs-all L2 logistic (λ=.1) by damped Newton: per class the final cost,
    ‖θ‖ and whether the step rule converged (false also where the class is separated)."""
    _, fit = ova_models(spark, sf_dir)
    li = OVA_LAMBDAS.index(OVA_LAMBDA)
    rows = [(c, float(fit.cost[0, li, k]), float(np.linalg.norm(fit.theta[0, li, k])), bool(fit.converged[0, li, k]))
            for k, c in enumerate(CLASSES)]
    return spark.createDataFrame(rows, "class int, cost double, theta_norm double, converged boolean") \
                .select("class", rnd("cost", 6).alias("cost"), rnd("theta_norm", 4).alias("theta_norm"), "converged")


@query("ova_predict", ops=("E6", "F7", "F8", "F9", "F13"), sql=(
    _ova_ctes([OVA_LAMBDA]) + ", cm AS (SELECT a.k AS label, c.k AS prediction, count(vec_id)::BIGINT AS n FROM best a CROSS JOIN best c "
    "LEFT JOIN (SELECT * FROM scored WHERE NOT train) t ON t.label = a.k AND t.prediction = c.k GROUP BY 1, 2)" + sqlgen.report_sql()))
def ova_predict(spark, sf_dir):
    """Argmax class on the test split (λ=.1): class report rows (precision, recall,
    F1, support, accuracy, macro and weighted averages)."""
    tagged, fit = ova_models(spark, sf_dir)
    test = _scored(tagged.where(F.col("split") == "test"), fit, OVA_LAMBDAS.index(OVA_LAMBDA))
    cm = evaluate.confusion(test, "label", "prediction", classes=CLASSES)
    rep = evaluate.class_report(cm)
    return rep.select("class", rnd("precision", 6).alias("precision"), rnd("recall", 6).alias("recall"),
                      rnd("f1", 6).alias("f1"), "support")


@query("ova_lambda", ops=("D19", "F8"), sql=(
    _ova_ctes(OVA_LAMBDAS) + f' SELECT lam AS "lambda", {_SIDE}, {_HIT} FROM scored GROUP BY lam, train'))
def ova_lambda(spark, sf_dir):
    """Train and test accuracy for λ ∈ {0, .01, .1, 1, 10}: all 50 models fitted in
    the same passes and scored in one scan."""
    tagged, fit = ova_models(spark, sf_dir)
    models = [(float(lam), logistic.ova_scores("embedding", fit.theta[0, li], fit.scaler.mean[0], fit.scaler.scale[0]), F.col("split"))
              for li, lam in enumerate(OVA_LAMBDAS)]
    a = accuracy_of_models(tagged, "label", models)
    return a.select(F.col("model").alias("lambda"), "split", rnd("accuracy", 6).alias("accuracy"))


@query("learning_curve", ops=("B13", "D20"), sql=(
    _curve_ctes() + " SELECT (CASE s " + " ".join(f"WHEN {i} THEN {f!r}" for i, f in enumerate(FRACTIONS))
    + f" END)::DOUBLE AS fraction, {_SIDE}, {_HIT}, count(*)::BIGINT AS n FROM scored GROUP BY s, train"))
def learning_curve(spark, sf_dir):
    """Accuracy on the training subset and on its complement for stratified
    training fractions .1–.9; a scaler per subset; five fits in the same passes, scored in one scan."""
    def build():
        sub = split.fraction_subsets(digit_like(spark, sf_dir), VEC_ID, "label", FRACTIONS, SEED)
        member = F.col("member")
        sub = sub.withColumn("member", member).persist()
        fit = logistic.fit_one_vs_all(sub, "embedding", "label", CLASSES, [OVA_LAMBDA], member_col="member",
                                      n_subsets=len(FRACTIONS), max_iter=OVA_MAX_ITER)
        return sub, fit
    sub, fit = memo(spark, ("curve", sf_dir), build)
    models = [(float(f), logistic.ova_scores("embedding", fit.theta[i, 0], fit.scaler.mean[i], fit.scaler.scale[i]),
               F.when(F.col("member")[i], F.lit("train")).otherwise(F.lit("test"))) for i, f in enumerate(FRACTIONS)]
    a = accuracy_of_models(sub, "label", models)
    return a.select(F.col("model").alias("fraction"), "split", rnd("accuracy", 6).alias("accuracy"), "n")
