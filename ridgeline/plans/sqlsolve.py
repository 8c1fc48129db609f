"""One-vs-all fits in DuckDB text: the minimiser of the penalised loss, found by another
method than the library's (accelerated gradient steps instead of Newton) and proved by its
gradient, or, where classes are apart and nothing is penalised, by a line that parts them.

A fit is stated by CTEs over ``pool(s, vec_id, label, e, train)``: subset, row, label, vector and
whether the row is learned from.
"""

from __future__ import annotations

from collections.abc import Sequence

#: A gradient this small (largest component of the mean loss) proves the minimiser.
STATIONARY = 1e-9
MAX_STEPS = 20_000


def fit_ctes(classes: Sequence[int], lambdas: Sequence[float]) -> str:
    """CTEs ``z`` (standardised rows, 1 in front) and ``best(s, lam, k, theta, cost, slope, apart)``.

    Steps are 1/L long, L a row-sum bound of the curvature; the momentum starts again
    whenever it points uphill.  ``slope`` is the largest gradient component at ``theta``;
    ``apart`` says that ``theta`` parts class k from the rest, so that without a penalty
    no minimiser exists."""
    ks = ", ".join(f"({int(k)})" for k in classes)
    ls = ", ".join(f"({float(x)!r}::DOUBLE)" for x in lambdas)
    dot = "list_dot_product"
    return (
        "cell AS (SELECT s, unnest(e) AS v, generate_subscripts(e, 1) AS pos FROM pool WHERE train), "
        "sc AS MATERIALIZED (SELECT s, list(mu ORDER BY pos) AS mu, list(sd ORDER BY pos) AS sd FROM (SELECT s, pos, avg(v) AS mu, "
        "CASE WHEN stddev_pop(v) > 0 THEN stddev_pop(v) ELSE 1.0 END AS sd FROM cell GROUP BY s, pos) GROUP BY s), "
        "z AS MATERIALIZED (SELECT s, vec_id, label, train, "
        "list_prepend(1.0::DOUBLE, list_transform(e, lambda v, i: (v - mu[i]) / sd[i])) AS x FROM pool JOIN sc USING (s)), "
        "zcell AS (SELECT s, vec_id, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM z WHERE train), "
        "zcol AS MATERIALIZED (SELECT s, pos, list(v ORDER BY vec_id) AS c FROM zcell GROUP BY s, pos), "
        f"bound AS (SELECT s, max(total) AS top FROM (SELECT a.s, a.pos, sum(abs({dot}(a.c, b.c))) AS total "
        "FROM zcol a JOIN zcol b ON a.s = b.s GROUP BY a.s, a.pos) GROUP BY s), "
        "mat AS MATERIALIZED (SELECT s, xs, ys, cs, len(ys)::DOUBLE AS m, 0.25 * top / len(ys) AS curve FROM "
        "(SELECT s, list(x ORDER BY vec_id) AS xs, list(label ORDER BY vec_id) AS ys FROM z WHERE train GROUP BY s) "
        "JOIN (SELECT s, list(c ORDER BY pos) AS cs FROM zcol GROUP BY s) USING (s) JOIN bound USING (s)), "
        # here: the point where the gradient is taken; theta: the step before it
        "walk(s, lam, k, it, here, theta, t, slope, apart) AS ("
        "SELECT s, lam, k, 0, list_transform(cs, lambda c: 0.0::DOUBLE), list_transform(cs, lambda c: 0.0::DOUBLE), 1.0::DOUBLE, "
        f"1.0::DOUBLE, false FROM mat, (VALUES {ls}) l(lam), (VALUES {ks}) c(k) UNION ALL "
        "SELECT s, lam, k, it + 1, CASE WHEN up THEN nxt ELSE list_transform(nxt, lambda v, i: v + (t - 1.0) / tn * (v - theta[i])) END, "
        "nxt, CASE WHEN up THEN 1.0 ELSE tn END, slope, apart FROM ("
        f"SELECT *, {dot}(g, list_transform(nxt, lambda v, i: v - theta[i])) > 0 AS up, (1.0 + sqrt(1.0 + 4.0 * t * t)) / 2.0 AS tn, "
        "list_max(list_transform(g, lambda v: abs(v))) AS slope FROM ("
        "SELECT *, list_transform(here, lambda v, i: v - g[i] / (curve + lam / m)) AS nxt FROM ("
        f"SELECT *, list_transform(cs, lambda c, i: {dot}(c, d) / m + CASE WHEN i > 1 THEN lam / m * here[i] ELSE 0.0 END) AS g, "
        "lam = 0 AND list_max(list_transform(d, lambda v: abs(v))) < 0.5 AS apart FROM ("
        "SELECT w.s, w.lam, w.k, w.it, w.here, w.theta, w.t, mat.cs, mat.m, mat.curve, list_transform(mat.xs, lambda x, i: "
        f"1.0 / (1.0 + exp(-{dot}(w.here, x))) - CASE WHEN mat.ys[i] = w.k THEN 1.0 ELSE 0.0 END) AS d "
        f"FROM walk w JOIN mat ON w.s = mat.s WHERE w.it < {MAX_STEPS} AND NOT w.apart AND w.slope > {STATIONARY!r}))))), "
        "fin AS (SELECT s, lam, k, arg_max(theta, it) AS theta, arg_max(slope, it) AS slope, arg_max(apart, it) AS apart "
        "FROM walk GROUP BY s, lam, k), "
        "best AS MATERIALIZED (SELECT f.s, f.lam, f.k, any_value(f.theta) AS theta, any_value(f.slope) AS slope, any_value(f.apart) AS apart, "
        "avg(-ln(CASE WHEN z.label = f.k THEN 1.0 / (1.0 + exp(-zz)) ELSE 1.0 / (1.0 + exp(zz)) END + 1e-15)) "
        "+ any_value(f.lam * (list_dot_product(f.theta, f.theta) - f.theta[1] * f.theta[1])) / (2.0 * count(*)) AS cost "
        f"FROM fin f JOIN (SELECT * FROM z WHERE train) z ON f.s = z.s, LATERAL (SELECT {dot}(f.theta, z.x) AS zz) GROUP BY f.s, f.lam, f.k)"
    )


def score_ctes() -> str:
    """CTE ``scored(s, lam, vec_id, label, train, prediction)``: the class of the largest score, smaller class in a tie."""
    return ("scored AS (SELECT s, lam, vec_id, any_value(label) AS label, any_value(train) AS train, "
            "first(k ORDER BY score DESC, k) AS prediction FROM (SELECT z.s, best.lam, z.vec_id, z.label, z.train, best.k, "
            "list_dot_product(best.theta, z.x) AS score FROM z JOIN best ON z.s = best.s) GROUP BY s, lam, vec_id)")
