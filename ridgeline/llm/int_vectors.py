"""Integer vectors out of an embedding column, and exact sums of them over all tasks.

A component x becomes ``floor(scale * x)``.  Numbers below 2^26 are int64 arrays, whose
squared distances cannot overflow; a chunk that holds a larger one uses Python integers
(object arrays), so results are exact whatever the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NARROW = 1 << 26
LONG_MAX = (1 << 63) - 1
#: Sums travel as five pieces of 40 bits, which cannot overflow in any number of tasks below 2^23.
LIMB, LIMBS = 40, 5
#: ``scale * x`` from here on counts as not finite.
FAR = 2.0 ** 150

SUMS = "item long, at long, " + ", ".join(f"l{i} long" for i in range(LIMBS))


def read(col: pa.Array, scale: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers of the vectors that are kept, their integers as float64, which holds them exactly).

    Null vectors and vectors with a null or non-finite component are left out, and so are
    those that do not have ``dims`` components.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    valid = col.is_valid().to_numpy(zero_copy_only=False)
    offsets = np.asarray(col.offsets.to_numpy(), np.int64)
    values = col.values.to_numpy(zero_copy_only=False).astype(np.float64)
    rows = np.flatnonzero(valid & (np.diff(offsets) == dims))
    x = values[offsets[rows][:, None] + np.arange(dims)]
    with np.errstate(over="ignore", invalid="ignore"):
        x = x * scale
        kept = (np.abs(x) < FAR).all(axis=1)        # NaN compares false
    return rows[kept], np.floor(x[kept])


def whole(x: np.ndarray) -> np.ndarray:
    """Integral numbers (float64 or Python integers) as int64, or as Python integers if one is large."""
    if not x.size or np.abs(x).max() < NARROW:
        return x.astype(np.int64)
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


def same_kind(*arrays: np.ndarray) -> list[np.ndarray]:
    """All as int64, or all as Python integers if one has them or is too large to be squared."""
    if any(a.dtype == object or (a.size and np.abs(a).max() >= NARROW) for a in arrays):
        return [a.astype(object) for a in arrays]
    return list(arrays)


def as_long(values: np.ndarray) -> pa.Array:
    """Non-negative integers as longs; a number that no long can hold becomes the largest one."""
    if values.dtype == object:
        values = np.array([min(int(v), LONG_MAX) for v in values], np.int64)
    return pa.array(values, pa.int64())


def emit_sums(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (item, at, limbs) of a task's table of Python integers, for :func:`total_sums`."""
    item, at = np.nonzero(table)
    values = table[item, at]
    columns = [pa.array(item, pa.int64()), pa.array(at, pa.int64())]
    for i in range(LIMBS):
        piece = [(int(v) >> (LIMB * i)) & ((1 << LIMB) - 1) if i < LIMBS - 1 else int(v) >> (LIMB * i) for v in values]
        columns.append(pa.array(piece, pa.int64()))
    yield pa.RecordBatch.from_arrays(columns, names=["item", "at"] + [f"l{i}" for i in range(LIMBS)])


def total_sums(rows: DataFrame, items: int, width: int) -> np.ndarray:
    """The tables of all tasks added up: ``items`` x ``width`` Python integers on the driver."""
    out = np.zeros((items, width), object)
    for r in rows.groupBy("item", "at").agg(*[F.sum(f"l{i}").alias(f"l{i}") for i in range(LIMBS)]).collect():
        out[r["item"], r["at"]] = sum(r[f"l{i}"] << (LIMB * i) for i in range(LIMBS))
    return out


def long_sum(column: str) -> Column:
    """Sum of a column of non-negative longs; the largest long if it is more than that."""
    total = F.sum(F.col(column).cast("decimal(19,0)"))
    return F.least(total, F.lit(LONG_MAX).cast("decimal(29,0)")).cast("long")
