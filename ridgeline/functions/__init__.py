"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from .columns import (  # noqa: F401
    hash_uniform, hash_uniform_sql, sigmoid, inv_norm_expr, inv_norm_sql,
    linear_expr, normal_init, normal_init_sql,
)
