"""Tables written to the cluster's shared folder to cut lineage, and the bounded id filter."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.operators.draws import unused
from ridgeline.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` (shared by driver and executors)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Survives the loss of executors, and later reads do not recompute it.  zstd keeps
    the files small and, unlike the default codec, needs no direct buffers for each
    file that is read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ID_BITS = 1 << 20


def possible(df: DataFrame, ids: DataFrame, bits: int = ID_BITS, column: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose ``column`` may be in ``ids`` (one column of the same name).

    The ids are reduced to at most ``bits`` hash slots, so what is broadcast is
    bounded whatever the number of ids.  Rows that are not in ``ids`` may pass;
    none that is gets lost.
    """
    at = unused(df.columns, "_slot")
    slot = F.pmod(F.xxhash64(F.col(column)), F.lit(bits))
    slots = F.broadcast(ids.select(slot.alias(at)).distinct())
    return df.withColumn(at, slot).join(slots, at, "left_semi").select(*df.columns)


def without(df: DataFrame, ids: DataFrame, bits: int = ID_BITS, column: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose ``column`` is not in ``ids``; rows with a null id stay.

    Only rows whose hash slot an id occupies are joined on the id itself; the others
    are known to stay and are not shuffled.
    """
    at = unused(df.columns, "_slot")
    slot = F.pmod(F.xxhash64(F.col(column)), F.lit(bits))
    slots = F.broadcast(ids.select(slot.alias(at)).distinct())
    sure = df.withColumn(at, slot).join(slots, at, "left_anti").select(*df.columns)
    return sure.unionByName(possible(df, ids, bits, column).join(ids, column, "left_anti").select(*df.columns))
