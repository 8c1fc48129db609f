"""The document pipeline: quality classifier, line dedup, n-gram Jaccard join,
benchmark decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor
kept; its output is written as Parquet to the shared folder and read again as the
next stage's ``docs``.  All but the last stage return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridgeline.llm import compression_quality, decontaminate, jaccard_join, line_dedup, packing
from ridgeline.llm.shared import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the compression classifier rejects."""
    return compression_quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that three or more documents share, but for the one that keeps them."""
    return line_dedup.rewrite(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: the smallest id."""
    return jaccard_join.keep_representatives(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain a benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences: one row for each piece of a document."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", contamination),
    ("packing", packed),
]

#: The classifier and the tokenizer cannot be stated in SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
