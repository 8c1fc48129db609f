"""Registry of the queries exposed through ``__spark_entry__``.

Each entry: a Spark builder ``fn(spark, sf_dir) -> DataFrame`` and, where SQL
can state it, a DuckDB oracle over the same tables.  Floating outputs are
rounded to digits well above cross-engine summation noise; every column is
aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Query:
    name: str
    fn: Callable
    sql: str | None
    ops: tuple
    doc: str


QUERIES: dict[str, Query] = {}


def query(name: str, ops: tuple, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = Query(name, fn, sql, ops, (fn.__doc__ or "").strip())
        return fn
    return deco


def rnd(c, d: int) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), d) + F.lit(0.0)


def load_all():
    """Import the modules that register queries."""
    from . import q_linear, q_logistic, q_prep, q_profile, q_eval  # noqa: F401
    return QUERIES


def sig(c, d: int = 6) -> Column:
    """Round to ``d`` significant digits (scale-free; same IEEE steps as :func:`sig_sql`)."""
    x = F.col(c) if isinstance(c, str) else c
    x = x.cast("double")
    e = (F.floor(F.log10(F.abs(x))) - F.lit(d - 1)).cast("int")
    up = F.round(x * F.pow(F.lit(10.0), -e)) / F.pow(F.lit(10.0), -e)
    down = F.round(x / F.pow(F.lit(10.0), e)) * F.pow(F.lit(10.0), e)
    return F.when(x == 0, F.lit(0.0)).when(e < 0, up).otherwise(down) + F.lit(0.0)


_MEMO: dict = {}


def _files(spark, folder: str) -> tuple:
    """Name, size and time of every entry of the input folder, by Spark's own file system layer."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path)))


def memo(spark, key: tuple, build: Callable):
    """A fit shared by the queries of one session: ``key`` is (name, input folder).

    It is built anew when the folder's files change; what an outdated fit had cached
    is released.
    """
    k = (spark.sparkContext.applicationId,) + tuple(key)
    files = _files(spark, key[1])
    if k in _MEMO and _MEMO[k][0] != files:
        forget(k)
    if k not in _MEMO:
        _MEMO[k] = (files, build())
    return _MEMO[k][1]


def forget(k=None) -> None:
    """Drops one shared fit (default: all) and the tables it cached."""
    for name in [k] if k is not None else list(_MEMO):
        built = _MEMO.pop(name)[1]
        for part in built if isinstance(built, tuple) else (built,):
            if isinstance(part, DataFrame):
                part.unpersist()
