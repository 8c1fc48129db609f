"""Incremental scoring with Structured Streaming.

A fitted model is a handful of literals, so scoring a stream is the same
codegen expression as batch scoring (E1–E6); no state is kept per row.  Running
evaluation metrics are a global streaming aggregate of five sums (state of one
row), or per event-time window with a watermark so old windows are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Rows of new files in ``path`` (declared schema, never inferred)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def score(stream: DataFrame, prediction: Column, name: str = "prediction") -> DataFrame:
    """Attach a model's prediction expression (e.g. ``LinearModel.predict_expr()``,
    ``LogisticModel.class_expr()``, or ``argmax_class(ova_scores(...))``)."""
    return stream.withColumn(name, prediction)


def running_metrics(scored: DataFrame, label: str, pred: str, event_time: str | None = None,
                    window: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """Streaming MSE/MAE/R² from five running sums; with ``event_time`` one row per
    tumbling window (watermarked), else one global row (complete/update mode)."""
    r = F.col(label).cast("double") - F.col(pred).cast("double")
    y = F.col(label).cast("double")
    sums = [F.count(F.lit(1)).alias("n"), F.sum(r * r).alias("sse"), F.sum(F.abs(r)).alias("sae"),
            F.sum(y).alias("sy"), F.sum(y * y).alias("syy")]
    if event_time:
        g = scored.withWatermark(event_time, watermark).groupBy(F.window(event_time, window).alias("window"))
    else:
        g = scored.groupBy()
    a = g.agg(*sums)
    tss = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    return a.select(*(["window"] if event_time else []), "n", (F.col("sse") / F.col("n")).alias("mse"),
                    (F.col("sae") / F.col("n")).alias("mae"),
                    F.when(tss > 0, F.lit(1.0) - F.col("sse") / tss).alias("r2"))


def write_files(scored: DataFrame, out_path: str, checkpoint: str | None = None, fmt: str = "parquet",
                available_now: bool = True):
    """Append predictions to files; progress is kept in a checkpoint folder below
    the shared ``spark.checkpoint.dir`` so a restarted query resumes exactly once."""
    spark = scored.sparkSession
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/ridgeline-stream/{out_path.strip('/').replace('/', '_')}"
    w = scored.writeStream.format(fmt).option("path", out_path).option("checkpointLocation", ckpt).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
