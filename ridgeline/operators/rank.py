"""Distributed global rank and prefix sums (§4.3-2).

A ``Window.orderBy`` without a partition key drags every row into one task;
instead rows are range-partitioned on the full sort key (ties broken by unique
id columns, so a value holding a third of all rows is still split over many
partitions), sorted inside each partition, and numbered locally.  One small
table of per-partition counts (one row per partition and group) gives each
partition its offset.  The range-partitioned data is checkpointed to the
shared checkpoint folder, so the count pass and the numbering pass see the same
rows even when executors are lost.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .draws import sketched_quantiles

_PID, _MID = "_rl_pid", "_rl_mid"
# Offset tables up to this many rows are broadcast (one row per partition and group).
OFFSETS_BROADCAST_ROWS = 1_000_000


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _range_parted(df: DataFrame, key: Sequence[Column], num_partitions: int | None) -> DataFrame:
    """Range-partitioned, locally sorted and numbered rows, written once to the
    shared checkpoint folder: the count pass and the numbering pass then read the
    same partitions, and a lost executor cannot re-draw range bounds or reorder
    rows (which a recomputed shuffle could)."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    # without an explicit count, AQE sizes the range partitions from the data
    # (adjacent ranges are merged, so the global order is kept)
    parted = df.repartitionByRange(num_partitions, *key) if num_partitions else df.repartitionByRange(*key)
    return (parted
              .sortWithinPartitions(*key)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_MID, F.monotonically_increasing_id())
              .checkpoint(eager=True))


def global_rank(df: DataFrame, order_by: Sequence, group_by: Sequence[str] = (),
                rank_col: str = "rank", num_partitions: int | None = None, size_col: str | None = None) -> DataFrame:
    """Add ``rank_col`` = 1..n_g in ``order_by`` order inside each ``group_by`` group, and n_g as ``size_col``.

    ``order_by`` must be a total order (end it with unique id columns).
    Columns may be names or ``F.col(..).desc()`` style expressions.
    """
    group_by = list(group_by)
    key = _cols(group_by) + _cols(order_by)
    parted = _range_parted(df, key, num_partitions)
    counts = (parted.groupBy(_PID, *group_by)
                    .agg(F.count(F.lit(1)).alias("_rl_n"), F.min(_MID).alias("_rl_first")))
    w = Window.partitionBy(*group_by).orderBy(_PID)
    offsets = counts.select(_PID, *group_by, "_rl_first",
                            (F.sum("_rl_n").over(w) - F.col("_rl_n")).alias("_rl_off"),
                            *([F.sum("_rl_n").over(Window.partitionBy(*group_by)).alias(size_col)] if size_col else []))
    # offsets has one row per (partition, group present in it) — about partitions +
    # groups rows, since range partitions hold contiguous groups.  Broadcast only
    # when that count is proven small; otherwise a shuffle join.
    right = offsets
    if not group_by or offsets.count() <= OFFSETS_BROADCAST_ROWS:
        right = F.broadcast(offsets)
    out = (parted.join(right, on=[_PID, *group_by], how="inner")
                 .withColumn(rank_col, F.col(_MID) - F.col("_rl_first") + F.col("_rl_off") + F.lit(1))
                 .drop(_PID, _MID, "_rl_first", "_rl_off"))
    return out


def prefix_sums(df: DataFrame, order_by: Sequence, value_cols: Sequence[str], out_suffix: str = "_cum",
                num_partitions: int | None = None, next_cols: Sequence[str] = ()) -> DataFrame:
    """Running totals of ``value_cols`` in the global ``order_by`` order (inclusive), the totals over all rows
    (``<col>_total``), and for ``next_cols`` the value of the next row (``<col>_next``; null in the last).

    Local running sums are computed per partition with NumPy (``mapInPandas``,
    state carried across Arrow batches).  One small table has a row for each partition: its totals, which
    give the others their offsets, and its first row, which the partition before it takes as its next one.
    The ordered rows are read once for that table and once for the result; nothing is joined with itself.
    """
    key = _cols(order_by)
    parted = _range_parted(df, key, num_partitions)
    value_cols, next_cols = list(value_cols), list(next_cols)
    cum_names = [c + out_suffix for c in value_cols]
    in_schema = parted.schema
    out_schema = T.StructType(list(in_schema.fields) + [T.StructField(n, T.DoubleType(), True) for n in cum_names]
                              + [T.StructField(c + "_next", in_schema[c].dataType, True) for c in next_cols]
                              + [T.StructField("_rl_end", T.BooleanType(), False)])

    def local(batches):
        carry, held = np.zeros(len(value_cols)), None
        for pdf in batches:
            if len(pdf) == 0:
                continue
            vals = pdf[value_cols].to_numpy(dtype="float64")
            cum = np.cumsum(vals, axis=0) + carry
            carry = cum[-1].copy()
            out = pdf.copy()
            for j, n in enumerate(cum_names):
                out[n] = cum[:, j]
            if held is not None:                    # the last row so far now has a next one
                out = pd.concat([held, out], ignore_index=True)
            for c in next_cols:
                out[c + "_next"] = out[c].shift(-1)
            out["_rl_end"] = False
            held = out.tail(1).drop(columns=["_rl_end", *[c + "_next" for c in next_cols]])
            yield out.head(len(out) - 1)
        if held is not None:
            last = held.assign(_rl_end=True)
            for c in next_cols:
                last[c + "_next"] = None
            yield last[out_schema.names]

    rows = parted.mapInPandas(local, out_schema)
    first = F.min_by(F.struct(*next_cols), _MID) if next_cols else F.lit(None)
    parts = parted.groupBy(_PID).agg(*[F.sum(F.col(c).cast("double")).alias(c + "_tot") for c in value_cols], first.alias("_rl_first"))
    w, every = Window.orderBy(_PID), Window.partitionBy()       # one row per partition: tiny
    table = parts.select(_PID, *[(F.sum(c + "_tot").over(w) - F.col(c + "_tot")).alias(c + "_off") for c in value_cols],
                         *[F.sum(c + "_tot").over(every).alias(c + "_total") for c in value_cols],
                         F.lead("_rl_first").over(w).alias("_rl_next"))
    out = rows.join(F.broadcast(table), on=_PID, how="inner")
    for c, n in zip(value_cols, cum_names):
        out = out.withColumn(n, F.col(n) + F.col(c + "_off"))
    for c in next_cols:
        out = out.withColumn(c + "_next", F.when(F.col("_rl_end"), F.col("_rl_next")[c]).otherwise(F.col(c + "_next")))
    return out.drop(_PID, _MID, "_rl_end", "_rl_next", *[c + "_off" for c in value_cols])


# Values of a target that are few enough to be put in order in one window; bins of a round.
IN_ORDER, SELECT_BINS = 20_000, 1024


def order_statistics(df: DataFrame, value: str, targets: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """The values at given ranks without sorting the rows: boundary selection.

    ``targets``: group columns and ``rank`` (1-based, within the group's values; nulls
    and NaN are none).  Output: ``targets`` with ``value``, ``below`` (how many values are smaller)
    and ``equal`` (how many are equal to it).

    Each round counts the values of a target's interval in ``SELECT_BINS`` bins (one
    aggregate with map-side combine) and goes on in the bin that holds the rank, its
    edges being the smallest and largest value in it, until the interval has one
    value, or few enough to be put in order.  A repeated value or a hot group is
    only counted.  Rows outside the intervals are filtered in the scan's stage; what
    is written or shuffled is bins × targets.
    """
    group_by = list(group_by)
    rows = df.select(*group_by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    same = [F.col(f"_r.{c}").eqNullSafe(F.col(f"_i.{c}")) for c in group_by]
    span = rows.groupBy(*group_by).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    found = targets.select(*group_by, "rank").distinct().alias("_r").join(
        span.alias("_i"), _all(same), "inner").select(*[F.col(f"_r.{c}") for c in group_by], "rank", "_lo", "_hi", "_n")
    state = _settled(found.where((F.col("rank") >= 1) & (F.col("rank") <= F.col("_n")))
                     .withColumn("_below", F.lit(0).cast("long")))
    rounds = 0
    while state.where((F.col("_n") > IN_ORDER) & (F.col("_lo") < F.col("_hi"))).limit(1).count():
        wide = state.where((F.col("_n") > IN_ORDER) & (F.col("_lo") < F.col("_hi")))
        # targets that still share an interval are counted once
        cells = wide.select(*group_by, "_lo", "_hi", "_below").distinct()
        inside = _all([*same, F.col("_v") >= F.col("_lo"), F.col("_v") <= F.col("_hi")])
        if rounds == 0:
            inside = _all(same)      # the first interval is the group's whole range
        part = rows.alias("_r").join(cells.alias("_i"), inside).select(
            *[F.col(f"_i.{c}").alias(c) for c in group_by], "_lo", "_hi", "_below", "_v")
        width = (F.col("_hi") - F.col("_lo")) / float(SELECT_BINS)
        endless = width == float("inf")
        scaled = F.signum("_v") * F.log1p(F.abs("_v"))          # within 710 for any finite number
        bin_ = (F.when(endless & (F.abs("_v") == float("inf")), F.when(F.col("_v") > 0, SELECT_BINS - 1).otherwise(0))
                .when(endless, 1 + F.floor((scaled + 710) / 1420 * (SELECT_BINS - 2)))
                .when(width > 0, F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(SELECT_BINS - 1)))
                .when(F.col("_v") > F.col("_lo"), 1).otherwise(0).cast("int"))
        counts = (part.groupBy(*group_by, "_lo", "_hi", "_below", bin_.alias("_bin"))
                  .agg(F.min("_v").alias("_lo2"), F.max("_v").alias("_hi2"), F.count(F.lit(1)).alias("_n2")))
        w = Window.partitionBy(*group_by, "_lo", "_hi", "_below").orderBy("_bin")       # SELECT_BINS rows
        counts = counts.withColumn("_upto", F.col("_below") + F.sum("_n2").over(w))
        keys = [F.col(f"_s.{c}").eqNullSafe(F.col(f"_c.{c}")) for c in [*group_by, "_lo", "_hi", "_below"]]
        hit = wide.alias("_s").join(counts.alias("_c"), _all([*keys, F.col("_s.rank") <= F.col("_c._upto"),
                                                              F.col("_s.rank") > F.col("_c._upto") - F.col("_c._n2")]))
        moved = hit.select(*[F.col(f"_s.{c}").alias(c) for c in group_by], F.col("_s.rank").alias("rank"),
                           F.col("_c._lo2").alias("_lo"), F.col("_c._hi2").alias("_hi"), F.col("_c._n2").alias("_n"),
                           (F.col("_c._upto") - F.col("_c._n2")).alias("_below"))
        state = _settled(state.where(~((F.col("_n") > IN_ORDER) & (F.col("_lo") < F.col("_hi")))).unionByName(moved))
        rounds += 1
    one = state.where(F.col("_lo") == F.col("_hi")).select(*group_by, "rank", F.col("_lo").alias("value"),
                                                          F.col("_below").alias("below"), F.col("_n").alias("equal"))
    few = state.where(F.col("_lo") < F.col("_hi"))
    inside = _all([*same, F.col("_v") >= F.col("_lo"), F.col("_v") <= F.col("_hi")])
    cells = few.select(*group_by, "_lo", "_hi", "_below").distinct()
    values = (rows.alias("_r").join(cells.alias("_i"), inside)
              .groupBy(*[F.col(f"_i.{c}").alias(c) for c in group_by], "_lo", "_hi", "_below", "_v").agg(F.count(F.lit(1)).alias("_c")))
    w = Window.partitionBy(*group_by, "_lo", "_hi", "_below").orderBy("_v")             # at most IN_ORDER rows
    values = values.withColumn("_upto", F.col("_below") + F.sum("_c").over(w))
    keys = [F.col(f"_s.{c}").eqNullSafe(F.col(f"_c.{c}")) for c in [*group_by, "_lo", "_hi", "_below"]]
    picked = few.alias("_s").join(values.alias("_c"), _all([*keys, F.col("_s.rank") <= F.col("_c._upto"),
                                                            F.col("_s.rank") > F.col("_c._upto") - F.col("_c._c")]))
    more = picked.select(*[F.col(f"_s.{c}").alias(c) for c in group_by], F.col("_s.rank").alias("rank"), F.col("_c._v").alias("value"),
                         (F.col("_c._upto") - F.col("_c._c")).alias("below"), F.col("_c._c").alias("equal"))
    return one.unionByName(more)


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _settled(state: DataFrame) -> DataFrame:
    """The intervals of a round (a row for each target) written to the checkpoint folder."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(state.sparkSession)
    return state.checkpoint(eager=True)


#: Groups up to this many are literals of the scans that look for their quantiles.
LITERAL_GROUPS = 64


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], group_by: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy/``percentile`` semantics) without
    sorting the rows or holding a group's values in one task.

    Two scans: a mergeable sketch brackets the ranks of every group, the rows inside the brackets decide
    (:func:`draws.sketched_quantiles`).  Many groups, or several group columns, go through
    :func:`order_statistics`, which keeps their intervals as a table.
    Output: group columns, q, value; groups without a value have no row."""
    group_by = list(group_by)
    v = F.col(value).cast("double")
    if len(group_by) <= 1:
        group = F.col(group_by[0]) if group_by else F.lit(None).cast("string")
        rows = df.select(group.alias("_class"), v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        got = sketched_quantiles(rows, qs, LITERAL_GROUPS)
        if got is not None:
            out = [(c, float(q), x) for c, xs in got.items() for q, x in zip(qs, xs, strict=True)]
            schema = T.StructType([T.StructField("_class", rows.schema["_class"].dataType), T.StructField("q", T.DoubleType()),
                                   T.StructField("value", T.DoubleType())])
            table = df.sparkSession.createDataFrame(out, schema)        # groups x quantiles
            return table.select(*[F.col("_class").alias(g) for g in group_by], "q", "value")
    return _selected_quantiles(df, value, qs, group_by)


def column_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float]) -> dict[str, list[float]]:
    """Exact quantiles of several columns in the same two scans; a column without values is left out."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("_class"), F.col(c).cast("double").alias("_v")) for c in cols]))
    rows = df.select(pairs.alias("p")).select("p.*").where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    out: dict[str, list[float]] = {}
    for k in range(0, len(cols), LITERAL_GROUPS):
        part = list(cols[k:k + LITERAL_GROUPS])
        of = rows if len(cols) <= LITERAL_GROUPS else rows.where(F.col("_class").isin(*part))
        out |= sketched_quantiles(of, qs, LITERAL_GROUPS)
    return out


def _selected_quantiles(df: DataFrame, value: str, qs: Sequence[float], group_by: Sequence[str]) -> DataFrame:
    """:func:`exact_quantiles` by boundary selection: for each group and q the 1-based position h = (n−1)q + 1 needs
    the values at ⌊h⌋ and ⌈h⌉, which are interpolated."""
    base = df.select(*group_by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    n = base.groupBy(*group_by).agg(F.count(F.lit(1)).alias("_n"))
    qarr = F.array(*[F.lit(float(q)) for q in qs])
    t = n.where(F.col("_n") > 0).select(*group_by, "_n", F.explode(qarr).alias("q"))
    h = (F.col("_n") - 1).cast("double") * F.col("q") + F.lit(1.0)
    t = t.select(*group_by, "q", F.floor(h).cast("long").alias("_a"), F.ceil(h).cast("long").alias("_b"),
                 (h - F.floor(h)).alias("_f"))
    need = t.select(*group_by, F.explode(F.array_distinct(F.array("_a", "_b"))).alias("rank"))
    picked = order_statistics(base, "_v", need, group_by).select(*group_by, "rank", "value")
    out = t
    for at, name in (("_a", "_va"), ("_b", "_vb")):
        keys = [F.col(f"_x.{c}").eqNullSafe(F.col(f"_y.{c}")) for c in group_by]
        out = out.alias("_x").join(picked.alias("_y"), _all([*keys, F.col(f"_x.{at}") == F.col("_y.rank")])).select(
            "_x.*", F.col("_y.value").alias(name))
    return out.select(*group_by, "q", (F.col("_va") + F.col("_f") * (F.col("_vb") - F.col("_va"))).alias("value"))
