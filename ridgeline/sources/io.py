"""Scans and sinks (A1–A10).

All readers declare their schema (never inferred); all writers are Spark's own
distributed writers.  Scratch outputs of the registered queries go below the
session's ``spark.checkpoint.dir`` (a shared folder on a cluster), one fresh
sub-folder per run.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ridgeline-scratch/{name}-{uuid.uuid4().hex}"


def clean_comment_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """A1 line rules: strip white space of any kind; drop blank and ``#`` lines; cut
    inline text after the first ``#`` (even inside quotes) and strip again."""
    strip = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    return (lines.select(strip(F.col(col)).alias("line"))
                 .where((F.col("line") != "") & ~F.col("line").startswith("#"))
                 .select(strip(F.substring_index(F.col("line"), "#", 1)).alias("line")))


def _cells(line: Column, n: int, sep: str) -> Column:
    """The first ``n`` cells of a line by the CSV rules (quotes, a literal separator);
    a short line leaves the missing ones null."""
    schema = ", ".join(f"c{i} STRING" for i in range(n))
    return F.from_csv(line, schema, {"sep": sep, "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "true",
                                     "ignoreTrailingWhiteSpace": "true"})


def _head_of(spark: SparkSession, file: str) -> str | None:
    """The first line of a file that A1 keeps.  Its blocks are taken in order, and only until a line is found."""
    strip = F.regexp_replace("value", r"^\s+|\s+$", "")
    first = spark.read.text(file).select(strip.alias("line")).where((F.col("line") != "") & ~F.col("line").startswith("#")).first()
    return first["line"].split("#", 1)[0].strip() if first else None


def _first_line(spark: SparkSession, path: str) -> str | None:
    """The first line that A1 keeps: of a folder, that of its first file by name that has one.  The listing
    names the files; the others are not opened."""
    for file in sorted(spark.read.text(path).inputFiles()):
        line = _head_of(spark, file)
        if line is not None:
            return line
    return None


def scan_comment_csv(spark: SparkSession, path: str, columns: Sequence[str], header: str | None = None,
                     sep: str = ",") -> DataFrame:
    """A1 + A3: comment-tolerant CSV scan; ``columns`` are selected by name and coerced
    to double (``try_cast``: a bad cell becomes null, ANSI mode never raises).

    The names come from ``header``, by default the first line that is kept (of a
    folder: of its first file by name, the only one that is opened for it); lines equal to it but for blanks are dropped
    wherever they stand.  Cells follow the CSV rules, ``sep`` is literal, a line
    with too few cells gives nulls, extra cells are ignored.  A name of
    ``columns`` that the header lacks is an error; an empty file gives no rows.
    """
    columns = list(columns)
    head = header if header is not None else _first_line(spark, path)
    if head is None:
        return spark.createDataFrame([], ", ".join(f"`{c}` double" for c in columns))
    # as many names as the header has cells, by the same CSV rules
    row = spark.createDataFrame([(head,)], "line string").select(_cells(F.col("line"), head.count(sep) + 1, sep).alias("c"))
    names = [n.strip() if n is not None else "" for n in row.first()["c"]]
    missing = [c for c in columns if c not in names]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {names}")
    lines = clean_comment_lines(spark.read.text(path))
    squeeze = lambda c: F.regexp_replace(c, r"\s+", "")
    data = lines.where(squeeze(F.col("line")) != squeeze(F.lit(head)))
    parts = data.select(_cells(F.col("line"), len(names), sep).alias("c"))
    return parts.select(*[F.expr(f"try_cast(trim(c.c{names.index(c)}) AS DOUBLE)").alias(c) for c in columns])


def scan_header_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A2: headered CSV with a declared schema."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def label_from_text(df: DataFrame, col: str, token: str = "pos", out: str = "label") -> DataFrame:
    """A4: 1 when the lower-cased text contains ``token``, else 0 (null text → 0)."""
    hit = F.coalesce(F.lower(F.col(col)).contains(token.lower()), F.lit(False))
    return df.withColumn(out, hit.cast("int"))


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """A5: column rename map."""
    return df.withColumnsRenamed(mapping)


def vector_profile(df: DataFrame, vec_col: str) -> DataFrame:
    """Rows, min/max vector length (constant length is the check) and the
    value range — one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.min(F.size(vec_col)).alias("min_len"),
                  F.max(F.size(vec_col)).alias("max_len"),
                  F.min(F.array_min(vec_col)).cast("double").alias("min_value"),
                  F.max(F.array_max(vec_col)).cast("double").alias("max_value"))


def audited(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count riding on the job that consumes ``df`` (no extra pass)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_report(df: DataFrame, path: str, fmt: str = "json") -> str:
    """Nested rows written by Spark's writer (structs stay structs)."""
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def read_report(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)


OTHER = "(other)"


def matrix_wide(cells: DataFrame, row: str, col: str, value: str, col_values: Sequence) -> DataFrame:
    """Square form of a long (row, col, value) table with explicit column values
    (a bounded pivot: no distinct pass, zeros filled).  What is in none of them, nulls
    included, is summed in the column ``(other)``, so the total is that of the table."""
    named = F.when(F.col(col).isin(list(col_values)), F.col(col).cast("string")).otherwise(F.lit(OTHER))
    return (cells.withColumn(col, named).groupBy(row).pivot(col, [*map(str, col_values), OTHER]).agg(F.sum(value))
            .na.fill(0, [*map(str, col_values), OTHER]))


def matrix_long(wide: DataFrame, row: str, col_values: Sequence, col: str = "col", value: str = "n") -> DataFrame:
    """Inverse of :func:`matrix_wide` (``stack``)."""
    pairs = ", ".join(f"'{v}', `{v}`" for v in col_values)
    return wide.select(row, F.expr(f"stack({len(col_values)}, {pairs}) AS ({col}, {value})"))


RUN_SCHEMA = ("model string, n_train long, n_val long, n_test long, features array<string>, weights array<double>, "
              "bias double, iterations int, lambdas array<double>, classes array<int>, metrics map<string,double>")


def run_summary(spark: SparkSession, fields: dict) -> DataFrame:
    """A10: one row describing a training run, with the declared schema
    :data:`RUN_SCHEMA`.  Fields that are not given are null; further single numbers
    go to ``metrics``; anything else is an error."""
    known = [part.split()[0] for part in RUN_SCHEMA.split(", ")]
    row = {k: fields.get(k) for k in known}
    extra = {k: v for k, v in fields.items() if k not in known}
    wrong = [k for k, v in extra.items() if v is not None and not isinstance(v, (int, float))]
    if wrong:
        raise ValueError(f"fields {wrong} are not in the schema of a run record")
    row["metrics"] = {k: None if v is None else float(v) for k, v in {**(row["metrics"] or {}), **extra}.items()}
    return spark.createDataFrame([row], RUN_SCHEMA)
