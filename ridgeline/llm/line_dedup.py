"""Line deduplication over levelled sorted runs of line hashes (DataFrame functions only).

A line's key is the line with ASCII white space stripped at both ends and A-Z
lower-cased; keys are carried as 128 hash bits.  Documents are taken in batches
of falling ids.  A batch's distinct keys are merge-joined against the runs kept so
far: keys that no run has (the anti-join) are first seen here, so the batch holds
their largest document; the others only add to the count.  The batch becomes a
run of its own, and whenever a level holds two runs they are compacted to one run
of the next level.  After the last batch the runs say for every key in how many
documents it stands and which of them keeps it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import materialise, scratch_path

SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS, MIN_DOCS, BATCHES, FANOUT = 20, 3, 4, 2


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


class LineRuns:
    """Sorted runs of (h1, h2, n_docs, keeper), by level; each run is a table in the shared folder.

    ``keeper`` is set where the run's batch was the first to hold the key.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def _write(self, rows: DataFrame) -> DataFrame:
        # a run is small rows: no more files than the cluster has cores
        rows = rows.select("h1", "h2", "n_docs", "keeper").coalesce(self.spark.sparkContext.defaultParallelism)
        return materialise(rows.sortWithinPartitions("h1", "h2"), "line-run")

    def all_runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def merged(self) -> DataFrame:
        """One row for each key over all the runs."""
        runs = self.all_runs()
        if len(runs) == 1:
            return runs[0]
        rows = runs[0]
        for r in runs[1:]:
            rows = rows.unionByName(r)
        return rows.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (doc_id, h1, h2) whose ids are all below those of earlier batches."""
        keys = (lines.select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2")
                .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("largest")))
        if self.levels:
            seen = self.merged().select("h1", "h2", F.lit(True).alias("seen"))
            keys = keys.join(seen, ["h1", "h2"], "left")
        else:
            keys = keys.withColumn("seen", F.lit(None).cast("boolean"))
        run = keys.withColumn("keeper", F.when(F.col("seen").isNull(), F.col("largest")))
        self._push(0, self._write(run))

    def _push(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            rows = self.levels[level][0]
            for r in self.levels[level][1:]:
                rows = rows.unionByName(r)
            self.levels[level] = []
            both = rows.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))
            self._push(level + 1, self._write(both))


def dropped_positions(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                      batches: int = BATCHES) -> DataFrame:
    """(doc_id, text_hash, dropped: positions of the lines to drop), documents with any only."""
    spark = docs.sparkSession
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = ids.where("doc_id is not null")
    marks = [(i + 1) / batches for i in range(batches - 1)]
    cuts = sorted(set(ids.agg(F.percentile_approx("doc_id", marks)).first()[0] or [])) if marks else []
    batch = sum((F.when(F.col("doc_id") <= c, 1).otherwise(0) for c in cuts), F.lit(0))
    found = (ids.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(
        F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"))
        .withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
        .select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
                batch.alias("batch")))
    path = scratch_path(spark, "line-keys")
    found.write.option("compression", "zstd").partitionBy("batch").parquet(path)
    lines = spark.read.schema(found.schema).parquet(path)
    runs = LineRuns(spark)
    for b in range(len(cuts) + 1):
        runs.add(lines.where(F.col("batch") == b))
    repeated = runs.merged().where(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper")
    return (lines.join(repeated, ["h1", "h2"]).where("doc_id <> keeper").groupBy("doc_id", "text_hash")
            .agg(F.collect_set("pos").alias("dropped")))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                batches: int = BATCHES) -> DataFrame:
    """The rows of ``docs`` as (doc, kept, n_lines, n_dropped): ``doc`` is the row itself, as a struct that no name of ours
    can clash with, ``kept`` the array of the lines that stay.

    Keys of at least ``min_chars`` code points that stand in at least ``min_docs``
    documents lose all their lines except in the largest ``doc_id`` that holds them.
    Null or empty text: one empty line, kept.  Rows that repeat an id are one
    document.  Rows with a null id are left as they are and do not count.  An empty table gives an
    empty result.
    """
    drops = dropped_positions(docs, min_chars, min_docs, batches)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    named = rows.where("doc.doc_id is not null").join(
        drops, (F.col("doc.doc_id") == F.col("doc_id")) & (F.xxhash64(F.col("doc.text").cast("string")) == F.col("text_hash")), "left"
    ).select("doc", "dropped")
    unnamed = rows.where("doc.doc_id is null").withColumn("dropped", F.lit(None).cast("array<int>"))
    rows = named.unionByName(unnamed).withColumn("lines", F.split(F.coalesce(F.col("doc.text").cast("string"), F.lit("")), "\n", -1))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    stay = F.array_except(every, F.coalesce("dropped", F.array().cast("array<int>")))
    kept = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(F.transform(stay, lambda i: F.col("lines")[i]))
    return rows.select("doc", kept.alias("kept"), F.size("lines").cast("long").alias("n_lines"),
                       F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the text that stays."""
    rows = dedup_lines(docs.select("doc_id", "text"))
    return rows.select("doc.doc_id", "n_lines", "n_dropped", F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"))


def rewrite(docs: DataFrame) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text`` (a null text stays null) and
    ``n_chars``, where there is such a column, counted anew.  Other columns pass through, whatever their names."""
    text = F.when(F.col("doc.text").isNotNull(), F.array_join("kept", "\n"))
    new = {"text": text, "n_chars": F.char_length(text).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return dedup_lines(docs).select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
