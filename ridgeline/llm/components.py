"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialise


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(id, component) for every id that occurs in ``edges`` (``a``, ``b``: long).

    ``component`` is the smallest id reachable.  Every round rewrites the edges as
    stars towards smaller ids and is written to the shared folder; nothing but one
    count and one checksum a round reaches the driver.  Self-loops and repeated
    edges are allowed; an empty table gives an empty result.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = materialise(e, f"{name}-edges")
    mark = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or tuple(now) == mark:
            break
        mark = tuple(now)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = materialise(large, f"{name}-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), f"{name}-small")
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
