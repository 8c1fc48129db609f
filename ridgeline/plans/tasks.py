"""Modelling tables derived from the driver's test tables.

Each builder has a SQL twin (``*_SQL``) computing the same rows in DuckDB for
the oracle.  The builders only shape rows; every modelling step runs on them
through the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

# ------------------------------------------------------------------ house-like
HOUSE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]  # unique together
HOUSE_FEATURES = ["l_extendedprice", "l_quantity", "l_discount", "l_tax", "p_retailprice"]
HOUSE_TARGET = "net_price"


def house_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ part; y = extendedprice·(1−discount)·(1+tax).  The join strategy is
    left to Catalyst/AQE (``part`` grows with the scale factor)."""
    li = table(spark, sf_dir, "lineitem")
    pa = table(spark, sf_dir, "part")
    j = li.join(pa, li.l_partkey == pa.p_partkey, "inner")
    y = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")) * (F.lit(1.0) + F.col("l_tax"))
    return j.select(*HOUSE_ID, *HOUSE_FEATURES, y.alias(HOUSE_TARGET))


HOUSE_SQL = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, p_retailprice, "
    "l_extendedprice * (1.0 - l_discount) * (1.0 + l_tax) AS net_price "
    "FROM lineitem JOIN part ON l_partkey = p_partkey"
)

# ------------------------------------------------------------------ sales-like
SALES_ID = ["day"]
SALES_FEATURES = ["price", "discount", "quantity", "n_lines", "holiday", "month", "weekday"]
SALES_TARGET = "revenue"


def sales_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily table of orders ⋈ lineitem: unit price, mean discount, quantity, line
    count, weekend flag, month, ISO weekday (Mon=1); y = revenue.  Partial
    aggregation runs map-side, so a hot day does not overload one reducer."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount")
    j = o.join(li, o.o_orderkey == li.l_orderkey, "inner")
    daily = j.groupBy("day").agg(
        F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.avg("l_discount").alias("discount"),
        F.sum("l_quantity").alias("quantity"),
        F.count(F.lit(1)).cast("double").alias("n_lines"),
        F.sum(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("revenue"))
    wd = F.weekday("day") + 1
    return daily.select("day", "price", "discount", "quantity", "n_lines",
                        F.when(wd >= 6, 1.0).otherwise(0.0).alias("holiday"),
                        F.month("day").cast("double").alias("month"),
                        wd.cast("double").alias("weekday"), "revenue")


SALES_SQL = (
    "SELECT day, price, discount, quantity, n_lines, "
    "CASE WHEN isodow(day) >= 6 THEN 1.0 ELSE 0.0 END AS holiday, "
    "month(day)::DOUBLE AS month, isodow(day)::DOUBLE AS weekday, revenue FROM ("
    "SELECT CAST(o_orderdate AS DATE) AS day, avg(l_extendedprice / l_quantity) AS price, "
    "avg(l_discount) AS discount, sum(l_quantity) AS quantity, count(*)::DOUBLE AS n_lines, "
    "sum(l_extendedprice * (1.0 - l_discount)) AS revenue "
    "FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY CAST(o_orderdate AS DATE))"
)

# ------------------------------------------------------------------ patient-like
DOC_ID = ["doc_id"]
DOC_FEATURES = ["n_chars", "n_words", "n_lines", "mean_word_len", "digit_share", "punct_share",
                "distinct_share", "upper_share"]
DOC_TARGET = "quality"

# The token separators and character classes of the text measures
# (regex form for the SQL twin; the same sets as plain character lists for
# Spark's ``translate`` and ``replace``, which remove characters without a regex engine).
_DIGIT = "[0-9]"
_PUNCT = "[.,;:!?]"
_UPPER = "[A-Z]"
SPACE_CHARS = " \t\n"
DIGIT_CHARS = "0123456789"
PUNCT_CHARS = ".,;:!?"
UPPER_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _each(text, chars: str, by: str):
    """``text`` with every one of a few characters replaced (a byte search each; ``translate`` looks up every character)."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def _count_chars(text: str, chars: str):
    """Occurrences of any character of ``chars`` in ``text``."""
    return F.length(text) - F.length(F.translate(F.col(text), chars, ""))


def text_measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Eight per-document measures, all built-in string functions (JVM-side); a text is cut into words once."""
    L = F.greatest(F.length(text), F.lit(1)).cast("double")
    toks = F.array_remove(F.split(_each(F.lower(F.col(text)), SPACE_CHARS[1:], " "), " "), "")
    words = F.greatest(F.size(toks), F.lit(1)).cast("double")
    nonspace = F.length(_each(F.col(text), SPACE_CHARS, "")).cast("double")
    lines = (F.length(text) - F.length(_each(F.col(text), "\n", "")) + 1).cast("double")
    return df.select("*",
                     F.length(text).cast("double").alias("n_chars"),
                     words.alias("n_words"),
                     lines.alias("n_lines"),
                     (nonspace / words).alias("mean_word_len"),
                     (_count_chars(text, DIGIT_CHARS) / L).alias("digit_share"),
                     (_count_chars(text, PUNCT_CHARS) / L).alias("punct_share"),
                     (F.size(F.array_distinct(toks)) / words).alias("distinct_share"),
                     (_count_chars(text, UPPER_CHARS) / L).alias("upper_share"))


def patient_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents ⋈ labels with eight text measures; y = quality."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(lab, on="doc_id", how="inner")
    return text_measures(j).select("doc_id", *DOC_FEATURES, F.col("quality").cast("int").alias("quality"))


def _count_class_sql(cls: str) -> str:
    return f"(length(text) - length(regexp_replace(text, '{cls}', '', 'g')))"


PATIENT_SQL = (
    "SELECT doc_id, length(text)::DOUBLE AS n_chars, "
    "greatest(len(regexp_extract_all(text, '[^ \\t\\n]+')), 1)::DOUBLE AS n_words, "
    "(length(text) - length(replace(text, chr(10), '')) + 1)::DOUBLE AS n_lines, "
    "length(regexp_replace(text, '[ \\t\\n]+', '', 'g'))::DOUBLE / greatest(len(regexp_extract_all(text, '[^ \\t\\n]+')), 1) AS mean_word_len, "
    f"{_count_class_sql(_DIGIT)}::DOUBLE / greatest(length(text), 1) AS digit_share, "
    f"{_count_class_sql(_PUNCT)}::DOUBLE / greatest(length(text), 1) AS punct_share, "
    "len(list_distinct(list_filter(string_split_regex(lower(text), '[ \\t\\n]+'), lambda t: t <> '')))::DOUBLE "
    "/ greatest(len(regexp_extract_all(text, '[^ \\t\\n]+')), 1) AS distinct_share, "
    f"{_count_class_sql(_UPPER)}::DOUBLE / greatest(length(text), 1) AS upper_share, "
    "quality::INTEGER AS quality "
    "FROM documents JOIN labels USING (doc_id)"
)

# ------------------------------------------------------------------ digit-like
VEC_ID = ["vec_id"]


def digit_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings: vec_id, 64-float vector, label 0–9."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
