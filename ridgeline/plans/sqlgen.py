"""DuckDB text builders for the oracles: the same maths as the Spark jobs,
expressed independently in SQL over the raw tables."""

from __future__ import annotations

from collections.abc import Sequence


def moments_select(cols: Sequence[str], where: str | None = None) -> str:
    """Select list (aggregates) giving n, m{i}, c{i}_{j} like ``operators.moments``."""
    def v(c):
        return f"CASE WHEN {where} THEN {c} END" if where else c
    parts = [f"count({'CASE WHEN ' + where + ' THEN 1 END' if where else '*'}) AS n"]
    parts += [f"avg({v(c)}) AS m{i}" for i, c in enumerate(cols)]
    for i in range(len(cols)):
        for j in range(i, len(cols)):
            parts.append(f"covar_pop({v(cols[i])}, {v(cols[j])}) AS c{i}_{j}")
    return ", ".join(parts)


def _c(i, j):
    return f"c{min(i, j)}_{max(i, j)}"


def scale_expr(i: int) -> str:
    return f"(CASE WHEN c{i}_{i} > 0 THEN sqrt(c{i}_{i}) ELSE 1.0 END)"


def std_system(nfeat: int, target_idx: int) -> str:
    """Select list of C (standardised feature moments), cv (with target), cyy."""
    rows = []
    for i in range(nfeat):
        rows.append("[" + ", ".join(f"{_c(i, j)} / ({scale_expr(i)} * {scale_expr(j)})" for j in range(nfeat)) + "]")
    C = "[" + ", ".join(rows) + "]::DOUBLE[][]"
    t = target_idx
    cv = "[" + ", ".join(f"{_c(i, t)} / ({scale_expr(i)} * {scale_expr(t)})" for i in range(nfeat)) + "]::DOUBLE[]"
    cyy = f"{_c(t, t)} / ({scale_expr(t)} * {scale_expr(t)})"
    return f"{C} AS C, {cv} AS cv, {cyy} AS cyy"


def batch_gd_cte(sys_cte: str, init_list: str, lr: float, iters: int, record_every: int = 100) -> str:
    """Recursive CTE ``gd(it, w, b)``: w ← w − lr(Cw − c), b ← b − lr·b; row it holds
    the parameters after ``it`` updates."""
    return (f"gd(it, w, b) AS (SELECT 0, {init_list}::DOUBLE[], 0.0::DOUBLE "
            f"UNION ALL SELECT it + 1, list_transform(w, lambda wi, i: wi - {lr!r} * "
            f"(list_dot_product(C[i], w) - cv[i])), b - {lr!r} * b FROM gd, {sys_cte} WHERE it < {iters})")


def gd_cost_expr() -> str:
    """½(wᵀCw − 2cᵀw + b² + cyy) with columns w, b, C, cv, cyy in scope."""
    return ("0.5 * (list_dot_product(w, list_transform(C, lambda row: list_dot_product(row, w))) "
            "- 2.0 * list_dot_product(cv, w) + b * b + cyy)")


def rnd(expr: str, d: int) -> str:
    """Round and normalise −0.0 to 0.0."""
    return f"(round({expr}, {d}) + 0.0)"


def sig(expr: str, d: int = 6) -> str:
    """Significant-digit rounding, twin of ``catalog.sig``."""
    e = f"(floor(log10(abs({expr}))) - {d - 1})::INTEGER"
    return (f"(CASE WHEN ({expr}) = 0 THEN 0.0 WHEN {e} < 0 "
            f"THEN round(({expr}) * pow(10.0, -{e})) / pow(10.0, -{e}) "
            f"ELSE round(({expr}) / pow(10.0, {e})) * pow(10.0, {e}) END + 0.0)")


def stratified_ctes(base: str, id_cols: Sequence[str], label: str, frac: float, u_expr: str,
                    out: str = "tagged", total: str = "ceil", prefix: str = "") -> str:
    """CTEs giving ``out`` = ``base`` plus split ∈ {test, train}: per-class quotas
    summing to ceil(m·f) (or floor) by largest remainder, rank in hash order inside
    the class; the quota's side is 'test' (for fraction subsets read it as 'train')."""
    ids = ", ".join(id_cols)
    p = prefix
    return (
        f"{p}cnt AS (SELECT {label} AS lbl, count(*) AS n_class FROM {base} GROUP BY 1), "
        f"{p}tot AS (SELECT sum(n_class)::BIGINT AS m, {total}(sum(n_class)::DOUBLE * {frac!r})::BIGINT AS t FROM {p}cnt), "
        f"{p}sh AS (SELECT lbl, n_class * t / m AS share, floor(n_class * t / m) AS base, t FROM {p}cnt, {p}tot), "
        f"{p}qt AS (SELECT lbl, base + CASE WHEN row_number() OVER (ORDER BY share - base DESC, lbl) "
        f"<= t - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM {p}sh), "
        f"{p}rk AS (SELECT b.*, row_number() OVER (PARTITION BY {label} ORDER BY {u_expr}, {ids}) AS cr FROM {base} b), "
        f"{out} AS MATERIALIZED (SELECT {p}rk.*, CASE WHEN cr <= quota THEN 'test' ELSE 'train' END AS split "
        f"FROM {p}rk JOIN {p}qt ON {p}rk.{label} = {p}qt.lbl)"
    )


def scaler_select(cols: Sequence[str]) -> str:
    """avg and population sd (0 → 1) of each column: m{i}, s{i}."""
    return ", ".join(f"avg({c}) AS m{i}, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1.0 END AS s{i}"
                     for i, c in enumerate(cols))


def report_sql() -> str:
    """Rows of the class report from a CTE ``cm(label, prediction, n)`` of all cells."""
    p = "coalesce(tp::DOUBLE / nullif(predicted, 0), 0.0)"
    r = "coalesce(tp::DOUBLE / nullif(support, 0), 0.0)"
    return (
        ", per AS (SELECT l.label, l.support, l.tp, coalesce(p.predicted, 0) AS predicted FROM "
        "(SELECT label, sum(n) AS support, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM cm GROUP BY label) l "
        "LEFT JOIN (SELECT prediction, sum(n) AS predicted FROM cm GROUP BY prediction) p ON p.prediction = l.label), "
        f"pr2 AS (SELECT label, support, tp, {p} AS precision, {r} AS recall FROM per), "
        "f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM pr2) "
        "SELECT label::VARCHAR AS class, " + rnd("precision", 6) + " AS precision, " + rnd("recall", 6)
        + " AS recall, " + rnd("f1", 6) + " AS f1, support::BIGINT AS support FROM f UNION ALL "
        "SELECT 'accuracy', NULL, NULL, " + rnd("sum(tp)::DOUBLE / sum(support)", 6) + ", sum(support)::BIGINT FROM f UNION ALL "
        "SELECT 'macro avg', " + rnd("avg(precision)", 6) + ", " + rnd("avg(recall)", 6) + ", "
        + rnd("avg(f1)", 6) + ", sum(support)::BIGINT FROM f UNION ALL "
        "SELECT 'weighted avg', " + rnd("sum(precision * support) / sum(support)", 6) + ", "
        + rnd("sum(recall * support) / sum(support)", 6) + ", " + rnd("sum(f1 * support) / sum(support)", 6)
        + ", sum(support)::BIGINT FROM f"
    )
