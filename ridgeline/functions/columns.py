"""Reusable column expressions.

Randomness is replaced everywhere by md5 hash order: a row's draw is a pure
function of its key and a seed, so results are reproducible across runs,
partitionings, executor losses and engines (DuckDB has the same md5).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# 15 hex digits = 60 bits of the md5 digest, mapped to [0, 1).
HASH_SCALE = float(2 ** 60)


def _key(cols: Sequence[str | Column], seed) -> Column:
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.concat_ws("-", *parts, F.lit(str(seed)))


def hash_uniform(cols: Sequence[str | Column], seed=42) -> Column:
    """Uniform [0,1) draw from md5(key-…-seed); no shuffle, stable per row."""
    hexpart = F.substring(F.md5(_key(cols, seed)), 1, 15)
    return F.conv(hexpart, 16, 10).cast("bigint").cast("double") / F.lit(HASH_SCALE)


def hash_uniform_sql(cols: Sequence[str], seed=42) -> str:
    """DuckDB text of :func:`hash_uniform` (same digest, same bits)."""
    key = "concat_ws('-', " + ", ".join(list(cols) + [f"'{seed}'"]) + ")"
    return f"(('0x' || substr(md5({key}), 1, 15))::BIGINT::DOUBLE / {HASH_SCALE!r})"


def hash_uniform_py(key: str) -> float:
    """Driver-side twin of the same draw (coefficient-sized use only)."""
    return int(hashlib.md5(key.encode()).hexdigest()[:15], 16) / HASH_SCALE


def normal_init(n: int, seed=42, scale: float = 0.01) -> list[float]:
    """Seeded start vector N(0,1)·scale by Box-Muller over md5 draws."""
    out = []
    for i in range(1, n + 1):
        u1 = hash_uniform_py(f"init-{i}-a-{seed}")
        u2 = hash_uniform_py(f"init-{i}-b-{seed}")
        out.append(scale * math.sqrt(-2.0 * math.log(1.0 - u1)) * math.cos(2.0 * math.pi * u2))
    return out


def normal_init_sql(n: int, seed=42, scale: float = 0.01) -> str:
    """DuckDB list expression computing :func:`normal_init` from the digest."""
    def u(part):
        return (f"(('0x' || substr(md5('init-' || i::VARCHAR || '-{part}-{seed}'), 1, 15))"
                f"::BIGINT::DOUBLE / {HASH_SCALE!r})")
    return (f"list_transform(range(1, {n + 1}), lambda i: {scale!r} * sqrt(-2.0 * ln(1.0 - {u('a')}))"
            f" * cos(2.0 * pi() * {u('b')}))")


def sigmoid(z: Column) -> Column:
    """1/(1+e^-z); exp overflow gives exactly 0 or 1, as in the reference."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def linear_expr(cols: Sequence[str], weights: Sequence[float], bias: float = 0.0) -> Column:
    """b + Σ w_i·x_i as one codegen-friendly expression (weights as literals)."""
    expr = F.lit(float(bias))
    for c, w in zip(cols, weights):
        expr = expr + F.col(c) * F.lit(float(w))
    return expr


# Coefficients of the AS241 (Wichura 1988) rational approximation
# to the inverse standard normal CDF, the algorithm behind Python's
# statistics.NormalDist.inv_cdf.  Highest power first.
_AS241_CENTRAL_NUM = [2509.0809287301226727, 33430.575583588128105, 67265.770927008700853,
                      45921.953931549871457, 13731.693765509461125, 1971.5909503065514427,
                      133.14166789178437745, 3.387132872796366608]
_AS241_CENTRAL_DEN = [5226.495278852854561, 28729.085735721942674, 39307.89580009271061,
                      21213.794301586595867, 5394.1960214247511077, 687.1870074920579083,
                      42.313330701600911252, 1.0]
_AS241_MID_NUM = [7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177,
                  1.27045825245236838258, 3.64784832476320460504, 5.7694972214606914055,
                  4.6303378461565452959, 1.42343711074968357734]
_AS241_MID_DEN = [1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966,
                  0.14810397642748007459, 0.68976733498510000455, 1.6763848301838038494,
                  2.05319162663775882187, 1.0]
_AS241_TAIL_NUM = [2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386,
                   0.026532189526576123093, 0.29656057182850489123, 1.7848265399172913358,
                   5.4637849111641143699, 6.6579046435011037772]
_AS241_TAIL_DEN = [2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5,
                   7.868691311456132591e-4, 0.0148753612908506148525, 0.13692988092273580531,
                   0.59983220655588793769, 1.0]


def _horner(coefs, r: str) -> str:
    expr = repr(coefs[0])
    for c in coefs[1:]:
        expr = f"({expr} * {r} + {c!r})"
    return expr


def inv_norm_sql(p: str) -> str:
    """Inverse standard normal CDF of SQL expression ``p`` as portable SQL text
    (valid in Spark SQL and DuckDB).  0 < p < 1."""
    q = f"(({p}) - 0.5)"
    rc = f"(0.180625 - {q} * {q})"
    central = f"({q} * {_horner(_AS241_CENTRAL_NUM, rc)} / {_horner(_AS241_CENTRAL_DEN, rc)})"
    rr = f"sqrt(-ln(CASE WHEN {q} <= 0.0 THEN ({p}) ELSE 1.0 - ({p}) END))"
    rm = f"({rr} - 1.6)"
    rt = f"({rr} - 5.0)"
    mid = f"({_horner(_AS241_MID_NUM, rm)} / {_horner(_AS241_MID_DEN, rm)})"
    tail = f"({_horner(_AS241_TAIL_NUM, rt)} / {_horner(_AS241_TAIL_DEN, rt)})"
    signed = f"(CASE WHEN {rr} <= 5.0 THEN {mid} ELSE {tail} END)"
    return (f"(CASE WHEN abs({q}) <= 0.425 THEN {central} "
            f"WHEN {q} < 0.0 THEN -{signed} ELSE {signed} END)")


def inv_norm_expr(p: str) -> Column:
    """Spark column for the inverse normal CDF of column/expression ``p``."""
    return F.expr(inv_norm_sql(p))
