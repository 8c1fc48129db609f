"""Rows at given ranks of a digest order, by a rank directory.

The directory counts the rows by the first digits of their digest: at most 65,536 counts, whose
running sums map a rank to the bucket that holds it.  Only buckets that hold a wanted
rank are looked at again: of a large table they are divided by the next digits, and
the few rows of the last buckets are put in order, each bucket for itself.  The table is
neither sorted nor written.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterable, Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Hexadecimal digits of a level, and rows that a bucket is meant to have.
DIGITS, BUCKET = 4, 64
#: Wanted ranks up to this many are broadcast; more are joined by shuffle.
BROADCAST_RANKS = 5_000_000


def _small(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_RANKS else table


def _levels(total: int) -> int:
    """Digits of the first level for a table of so many rows."""
    return min(DIGITS, max(1, math.ceil(math.log(max(total / BUCKET, 1), 16))))


def rows_at(rows: DataFrame, key: str, tie: Sequence[str], ranks: Iterable[int], total: int) -> DataFrame:
    """``rows`` at the 1-based ``ranks`` in the order of ``key`` (a hexadecimal digest) and ``tie``, with a column ``rank``.

    ``total`` is about the number of rows; it only sets the size of buckets.  The ranks pass through the
    driver (of a sampled descent: iterations x batch).  Equal rows are counted together, so a row
    that is repeated many times stays one; ``tie`` decides between rows with equal digests, then the other columns do, larger values first.
    Ranks below 1 or above the number of rows give nothing.
    """
    spark = rows.sparkSession
    wanted = sorted({int(r) for r in ranks if r >= 1})
    digits = _levels(total)
    counts = sorted(tuple(r) for r in rows.groupBy(F.substring(key, 1, digits).alias("_p")).agg(F.count(F.lit(1)).alias("_n")).collect())
    ends = list(accumulate(n for _, n in counts))
    places = []                                                         # (rank, bucket, rows before the bucket)
    crowded = False
    for r in wanted:
        k = bisect_left(ends, r)
        if k < len(counts):
            places.append((r, counts[k][0], ends[k] - counts[k][1]))
            crowded |= counts[k][1] > 16 * BUCKET
    schema = "rank long, _prefix string, _before long"
    table = spark.createDataFrame(places, schema)
    if crowded:
        table, digits = _divided(rows, key, table, len(places), digits), digits + DIGITS
    buckets = _small(table.select("_prefix", "_before").distinct(), len(places))
    own = rows.columns
    near = rows.withColumn("_prefix", F.substring(key, 1, digits)).join(buckets, "_prefix")
    # a repeated row is one row with a number
    near = near.groupBy("_prefix", "_before", *own).agg(F.count(F.lit(1)).alias("_times"))
    rest = [c for c in own if c != key and c not in tie]
    order = Window.partitionBy("_prefix").orderBy(key, *tie, *[F.col(c).desc() for c in rest]).rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("_upto", F.col("_before") + F.sum("_times").over(order))
    hit = near.drop("_before").join(_small(table.drop("_before"), len(places)), "_prefix")
    return hit.where((F.col("rank") <= F.col("_upto")) & (F.col("rank") > F.col("_upto") - F.col("_times"))).select(*own, "rank")


def _divided(rows: DataFrame, key: str, table: DataFrame, places: int, digits: int) -> DataFrame:
    """``table`` with the buckets that the next ``DIGITS`` digits make of its buckets; only those are counted."""
    buckets = _small(table.select(F.col("_prefix").alias("_p")).distinct(), places)
    deeper = (rows.select(F.substring(key, 1, digits).alias("_p"), F.substring(key, digits + 1, DIGITS).alias("_q"))
              .join(buckets, "_p", "left_semi").groupBy("_p", "_q").agg(F.count(F.lit(1)).alias("_n")))
    order = Window.partitionBy("_p").orderBy("_q").rowsBetween(Window.unboundedPreceding, 0)       # at most 65,536 counts
    deeper = deeper.withColumn("_upto", F.sum("_n").over(order))
    hit = deeper.join(_small(table, places), F.col("_p") == F.col("_prefix")).where(
        (F.col("rank") - F.col("_before") <= F.col("_upto")) & (F.col("rank") - F.col("_before") > F.col("_upto") - F.col("_n")))
    found = hit.select("rank", F.concat("_p", "_q").alias("_prefix"), (F.col("_before") + F.col("_upto") - F.col("_n")).alias("_before"))
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(rows.sparkSession)
    return found.checkpoint(eager=True)                                 # a row for each wanted rank
