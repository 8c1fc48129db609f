"""Registered scan, sink, cleaning, scaling and splitting queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import hash_uniform_sql
from ..operators import prep, split
from ..operators.moments import moments
from ..sources import io
from ..sources.tables import table
from . import sqlgen
from .catalog import query, rnd
from .tasks import HOUSE_FEATURES, HOUSE_ID, HOUSE_SQL, HOUSE_TARGET, house_like

SEED = 42

# ---------------------------------------------------------------- A1, A3, A7 comment CSV
_SCAN_COLS = ["p_partkey", "p_size", "p_retailprice"]


@query("csv_comment_scan", ops=("A1", "A3", "A7"), sql=(
    "SELECT count(*) AS n, count(CASE WHEN p_size <> 1 THEN 1 END) AS n_price, sum(p_partkey)::BIGINT AS key_sum, "
    "sum(p_size)::BIGINT AS size_sum, " + sqlgen.rnd("sum(CASE WHEN p_size <> 1 THEN p_retailprice END)", 2)
    + " AS price_sum FROM part"))
def csv_comment_scan(spark, sf_dir):
    """`part` written as a comment-laden text file (indented lines, blank lines, whole
    comment lines, inline comments containing commas, a spaced header, 'n/a' cells),
    then scanned back: counts and sums of the coerced columns."""
    part = table(spark, sf_dir, "part")
    price = F.when((F.col("p_size") == 1) & (F.col("p_partkey") % 2 == 0), F.lit(""))
    price = price.when(F.col("p_size") == 1, F.lit(", n/a")).otherwise(F.concat(F.lit(', "'), F.col("p_retailprice").cast("string"), F.lit('"')))
    note = F.when(F.col("p_size") > 25, F.lit("  # inline note, with a comma")).otherwise(F.lit(""))
    data = part.select(F.concat(F.lit("  "), F.col("p_partkey").cast("string"), F.lit(","), F.col("p_size").cast("string"),
                                price, note).alias("value"))
    comments = part.select(F.concat(F.lit("# brand "), F.col("p_brand")).alias("value")).distinct()
    blanks = part.select("p_type").distinct().select(F.lit("   ").alias("value"))
    # the header stands in another order than the columns that are asked for; the two tab
    # lines (one blank, one a comment) are no rows; a price of n/a at the end of a line may be left out
    head = "p_partkey, p_size,  p_retailprice"
    header = spark.createDataFrame([(f"\t{head}   # header",), ("\t \t",), ("\t# tab comment",)], "value string")
    path = io.scratch_path(spark, "comment-csv")
    # the rows keep their partitions; the three lines of the header are the folder's first file, where the scan finds it
    header.coalesce(1).unionByName(comments).unionByName(blanks).unionByName(data).write.mode("overwrite").text(path)
    scanned, obs = io.audited(io.scan_comment_csv(spark, path, sorted(_SCAN_COLS, reverse=True)), "scan")
    sums = scanned.agg(F.count("p_retailprice").alias("n_price"), F.sum(F.col("p_partkey").cast("long")).alias("key_sum"),
                       F.sum(F.col("p_size").cast("long")).alias("size_sum"),
                       rnd(F.sum("p_retailprice"), 2).alias("price_sum")).collect()
    # the audit has counted the rows in the same job
    return spark.createDataFrame(sums, "n_price long, key_sum long, size_sum long, price_sum double").select(
        F.lit(int(obs.get["rows"])).cast("long").alias("n"), "*")


# ---------------------------------------------------------------- A2, A5 headered CSV + rename
NATION_RENAME = {"n_nationkey": "nation_id", "n_name": "name", "n_regionkey": "region_id"}


@query("csv_header_scan", ops=("A2", "A5"), sql=(
    "SELECT n_nationkey AS nation_id, n_name AS name, n_regionkey AS region_id FROM nation"))
def csv_header_scan(spark, sf_dir):
    """`nation` written as headered CSV, read back with a declared schema, renamed."""
    path = io.scratch_path(spark, "header-csv")
    table(spark, sf_dir, "nation").write.mode("overwrite").option("header", True).csv(path)
    schema = T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
                           T.StructField("n_regionkey", T.IntegerType())])
    return io.rename(io.scan_header_csv(spark, path, schema), NATION_RENAME)


# ---------------------------------------------------------------- A4 label from text


@query("label_from_text", ops=("A4",), sql=(
    "SELECT event_type, CASE WHEN coalesce(contains(lower(event_type), 'purchase'), false) THEN 1 ELSE 0 END AS label, "
    "count(*) AS n FROM events GROUP BY 1, 2"))
def label_from_text(spark, sf_dir):
    """Binary label from a class text (contains the positive token → 1)."""
    ev = io.label_from_text(table(spark, sf_dir, "events"), "event_type", "purchase")
    return ev.groupBy("event_type", "label").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- A6 vector scan


@query("vector_scan_profile", ops=("A6",), sql=(
    "SELECT count(*) AS n, min(len(embedding)) AS min_len, max(len(embedding)) AS max_len, "
    "min(list_min(embedding))::DOUBLE AS min_value, max(list_max(embedding))::DOUBLE AS max_value FROM embeddings"))
def vector_scan_profile(spark, sf_dir):
    """Vector table: rows, constant-length check, value range."""
    p = io.vector_profile(table(spark, sf_dir, "embeddings"), "embedding")
    return p.select(F.col("n").cast("long"), F.col("min_len").cast("int"), F.col("max_len").cast("int"),
                    "min_value", "max_value")


# ---------------------------------------------------------------- A8, A10 report round trip
REPORT_SCHEMA = T.StructType([
    T.StructField("n_orders", T.LongType()), T.StructField("n_customers", T.LongType()),
    T.StructField("total_value", T.DoubleType()),
    T.StructField("statuses", T.ArrayType(T.StructType([T.StructField("status", T.StringType()),
                                                          T.StructField("n", T.LongType())])))])


@query("report_roundtrip", ops=("A8", "A10"), sql=(
    "WITH t AS (SELECT count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers, "
    + sqlgen.rnd("sum(o_totalprice)", 2) + " AS total_value FROM orders), "
    "s AS (SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1) "
    "SELECT status, n, n_orders, n_customers, total_value FROM s, t"))
def report_roundtrip(spark, sf_dir):
    """A nested run record (counts, a value total and an array of per-status
    structs) written as JSON and read back with its declared schema."""
    o = table(spark, sf_dir, "orders")
    per = o.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    statuses = per.agg(F.sort_array(F.collect_list(F.struct("status", "n"))).alias("statuses"))  # one row per status
    tot = o.agg(F.count(F.lit(1)).alias("n_orders"), F.count_distinct("o_custkey").alias("n_customers"),
                rnd(F.sum("o_totalprice"), 2).alias("total_value"))
    record = tot.withColumn("_one", F.lit(1)).join(statuses.withColumn("_one", F.lit(1)), "_one").drop("_one")  # 1 row each
    path = io.write_report(record, io.scratch_path(spark, "report"))
    back = io.read_report(spark, path, REPORT_SCHEMA)
    return back.select(F.explode("statuses").alias("s"), "n_orders", "n_customers", "total_value") \
               .select("s.status", "s.n", "n_orders", "n_customers", "total_value")


# The order-priority domain of the orders table.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("matrix_sink", ops=("A9",), sql=(
    "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2"))
def matrix_sink(spark, sf_dir):
    """Status × priority count matrix written in square form (JSON) and read back
    to the long form."""
    o = table(spark, sf_dir, "orders")
    cells = o.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    wide = io.matrix_wide(cells, "o_orderstatus", "o_orderpriority", "n", PRIORITIES)
    path = io.write_report(wide, io.scratch_path(spark, "matrix"))
    columns = (*PRIORITIES, io.OTHER)
    schema = T.StructType([T.StructField("o_orderstatus", T.StringType())] + [T.StructField(p, T.LongType()) for p in columns])
    back = io.read_report(spark, path, schema)
    long = io.matrix_long(back, "o_orderstatus", columns, "o_orderpriority", "n")
    return long.where(F.col("n") > 0).select("o_orderstatus", "o_orderpriority", F.col("n").cast("long"))


# ---------------------------------------------------------------- B2, B3 missing values
_U = hash_uniform_sql(HOUSE_ID, SEED)
_UC = hash_uniform_sql(HOUSE_ID + ["'col'"], SEED)
RATE = 0.02
_K = len(HOUSE_FEATURES)


def _injected_sql():
    cols = ", ".join(f"CASE WHEN hit AND ci = {i} THEN NULL ELSE {c} END AS {c}" for i, c in enumerate(HOUSE_FEATURES))
    return (f"WITH base AS ({HOUSE_SQL}), h AS (SELECT *, {_U} AS _u, floor({_UC} * {_K}) AS ci FROM base), "
            f"r AS (SELECT *, row_number() OVER (ORDER BY _u, {', '.join(HOUSE_ID)}) AS _r, count(*) OVER () AS m FROM h), "
            f"f AS (SELECT *, _r <= floor(m::DOUBLE * {RATE!r}) AS hit FROM r), "
            f"inj AS (SELECT {', '.join(HOUSE_ID)}, {cols}, {HOUSE_TARGET} FROM f)")


def injected(spark, sf_dir):
    return prep.inject_missing(house_like(spark, sf_dir), HOUSE_ID, HOUSE_FEATURES, RATE, SEED, exact=True)


@query("null_injection", ops=("B2",), sql=(
    _injected_sql() + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) - count({c}) AS n_null FROM inj" for c in HOUSE_FEATURES)))
def null_injection(spark, sf_dir):
    """int(m·.02) rows first in md5 order each lose one hashed feature (never the
    target): nulls per feature."""
    d = injected(spark, sf_dir)
    row = d.agg(*[(F.count(F.lit(1)) - F.count(c)).alias(c) for c in HOUSE_FEATURES])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("n_null")) for c in HOUSE_FEATURES]
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.feature", "c.n_null")


@query("median_impute", ops=("B2", "B3"), sql=(
    _injected_sql() + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, " + sqlgen.rnd(f"median({c})", 4) + " AS median, "
        + sqlgen.rnd(f"sum(coalesce({c}, (SELECT median({c}) FROM inj)))", 2) + " AS sum_after FROM inj"
        for c in HOUSE_FEATURES + [HOUSE_TARGET])))
def median_impute(spark, sf_dir):
    """Median of every feature and the target over the whole table (the
    reference's scope), nulls filled: medians and column sums after filling."""
    d = injected(spark, sf_dir)
    cols = HOUSE_FEATURES + [HOUSE_TARGET]
    med = prep.medians(d, cols)
    filled = prep.impute(d, med)
    row = filled.agg(*[F.sum(c).alias(c) for c in cols])
    cells = [F.struct(F.lit(c).alias("feature"), rnd(F.lit(med[c]), 4).alias("median"), rnd(F.col(c), 2).alias("sum_after"))
             for c in cols]
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


# ---------------------------------------------------------------- B1, B4, A7 outliers
OUTLIER_COL, OUTLIER_MAX = "l_extendedprice", 90000.0


@query("outlier_filter", ops=("B1", "B4", "A7"), sql=(
    f"WITH h AS ({HOUSE_SQL}) SELECT count(*) AS n_before, count(*) FILTER (WHERE {OUTLIER_COL} <= {OUTLIER_MAX!r}) AS n_after, "
    f"count(*) FILTER (WHERE NOT ({OUTLIER_COL} <= {OUTLIER_MAX!r})) AS n_removed FROM h"))
def outlier_filter(spark, sf_dir):
    """Rows above the threshold removed; the before-count rides on the same job
    (``observe`` above the scan, so here the predicate stays above it too)."""
    src, obs = io.audited(house_like(spark, sf_dir), "before")
    n_after = prep.outlier_filter(src, OUTLIER_COL, OUTLIER_MAX).count()
    n_before = int(obs.get["rows"])
    return spark.createDataFrame([(n_before, n_after, n_before - n_after)], "n_before long, n_after long, n_removed long")


# ---------------------------------------------------------------- B5 calendar


@query("calendar_features", ops=("B5",), sql=(
    "SELECT month(o_orderdate)::INTEGER AS month, isodow(o_orderdate)::INTEGER AS weekday, count(*) AS n FROM orders GROUP BY 1, 2"))
def calendar_features(spark, sf_dir):
    """Month and ISO weekday (Monday = 1) of every order date, counted."""
    c = prep.calendar(table(spark, sf_dir, "orders"), "o_orderdate")
    return c.groupBy(F.col("month").cast("int").alias("month"), F.col("weekday").cast("int").alias("weekday")) \
            .agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- B6–B8 scaling
_HU = hash_uniform_sql(HOUSE_ID, SEED)
_HCOLS = HOUSE_FEATURES + [HOUSE_TARGET]


def _std_sql():
    zs = ", ".join(f"({c} - m{i}) / s{i} AS z{i}" for i, c in enumerate(_HCOLS))
    return (f"WITH base AS ({HOUSE_SQL}), t AS (SELECT *, CASE WHEN {_HU} < 0.2 THEN 'test' ELSE 'train' END AS split FROM base), "
            f"sc AS (SELECT {sqlgen.scaler_select(_HCOLS)} FROM t WHERE split = 'train'), "
            f"z AS (SELECT split, {HOUSE_TARGET}, {zs}, sc.* FROM t, sc)")


def _scaled(spark, sf_dir):
    tagged = split.hash_split(house_like(spark, sf_dir), HOUSE_ID, 0.2, SEED)
    mom = moments(tagged.where(F.col("split") == "train"), _HCOLS)
    z = tagged.select("split", HOUSE_TARGET, *prep.standardize_exprs(_HCOLS, mom.mean, mom.scale, "_z"))
    return z, mom


@query("standardize", ops=("B6", "B7"), sql=(
    _std_sql() + " " + " UNION ALL ".join(
        f"SELECT split, '{c}' AS feature, " + sqlgen.rnd(f"avg(z{i})", 6) + " AS mean_z, "
        + sqlgen.rnd(f"stddev_pop(z{i})", 6) + " AS sd_z FROM z GROUP BY split" for i, c in enumerate(_HCOLS))))
def standardize(spark, sf_dir):
    """Train mean / population sd applied to both splits: per split the mean and
    sd of every standardised column (0 and 1 on train)."""
    z, _ = _scaled(spark, sf_dir)
    g = z.groupBy("split").agg(*[F.avg(f"{c}_z").alias(f"m{i}") for i, c in enumerate(_HCOLS)],
                               *[F.stddev_pop(f"{c}_z").alias(f"s{i}") for i, c in enumerate(_HCOLS)])
    cells = [F.struct(F.lit(c).alias("feature"), rnd(f"m{i}", 6).alias("mean_z"), rnd(f"s{i}", 6).alias("sd_z"))
             for i, c in enumerate(_HCOLS)]
    return g.select("split", F.explode(F.array(*cells)).alias("c")).select("split", "c.*")


@query("standardize_inverse", ops=("B8",), sql=(
    _std_sql() + f" SELECT split, count(*) AS n, " + sqlgen.rnd(f"sum(z{len(HOUSE_FEATURES)} * s{len(HOUSE_FEATURES)} + m{len(HOUSE_FEATURES)})", 2)
    + " AS target_sum, " + sqlgen.rnd(f"max(abs(z{len(HOUSE_FEATURES)} * s{len(HOUSE_FEATURES)} + m{len(HOUSE_FEATURES)} - {HOUSE_TARGET}))", 6)
    + " AS max_abs_error FROM z GROUP BY split"))
def standardize_inverse(spark, sf_dir):
    """Standardised target mapped back to its units: per split the sum and the
    largest round-trip error."""
    z, mom = _scaled(spark, sf_dir)
    t = mom.index(HOUSE_TARGET)
    back = prep.inverse_expr(f"{HOUSE_TARGET}_z", float(mom.mean[t]), float(mom.scale[t]))
    return z.groupBy("split").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum(back), 2).alias("target_sum"),
                                  rnd(F.max(F.abs(back - F.col(HOUSE_TARGET))), 6).alias("max_abs_error"))


# ---------------------------------------------------------------- B10–B13, B16 splits
_OU = hash_uniform_sql(["o_orderkey"], SEED)


@query("split_hash", ops=("B10",), sql=(
    f"WITH base AS ({HOUSE_SQL}) SELECT CASE WHEN {_HU} < 0.2 THEN 'test' ELSE 'train' END AS split, count(*) AS n, "
    "sum(l_orderkey)::BIGINT AS key_sum FROM base GROUP BY 1"))
def split_hash(spark, sf_dir):
    """Row-stable hash split (md5 draw < .2 → test): narrow, no shuffle."""
    s = split.hash_split(house_like(spark, sf_dir), HOUSE_ID, 0.2, SEED)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("key_sum"))


@query("split_exact", ops=("B10",), sql=(
    f"WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {_OU}, o_orderkey) AS _r, count(*) OVER () AS m FROM orders) "
    "SELECT CASE WHEN _r <= ceil(m::DOUBLE * 0.2) THEN 'test' ELSE 'train' END AS split, count(*) AS n, "
    "sum(o_orderkey)::BIGINT AS key_sum FROM r GROUP BY 1"))
def split_exact(spark, sf_dir):
    """Exact-size split: the ceil(m·.2) orders first in md5 order are test
    (distributed rank, no single-task window)."""
    s = split.exact_split(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 0.2, SEED)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query("split_stratified", ops=("B11",), sql=(
    "WITH o AS (SELECT o_orderkey, o_orderstatus FROM orders), "
    + sqlgen.stratified_ctes("o", ["o_orderkey"], "o_orderstatus", 0.2, _OU)
    + " SELECT o_orderstatus, split, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum FROM tagged GROUP BY 1, 2"))
def split_stratified(spark, sf_dir):
    """Stratified 80/20 split by order status: per-class quotas by largest remainder
    summing to ceil(m·.2), rank in md5 order inside each class (two-level rank)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    s = split.stratified_split(o, ["o_orderkey"], "o_orderstatus", 0.2, SEED)
    return s.groupBy("o_orderstatus", "split").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query("split_three_way", ops=("B12", "B16"), sql=(
    f"WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {_OU}, o_orderkey) AS _r, count(*) OVER () AS m FROM orders), "
    "c AS (SELECT *, ceil(m::DOUBLE * 0.15) AS nt FROM r), "
    "t AS (SELECT *, CASE WHEN _r <= nt THEN 'test' WHEN _r <= nt + ceil((m - nt)::DOUBLE * 0.176) THEN 'val' ELSE 'train' END AS split FROM c) "
    "SELECT split, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum FROM t GROUP BY 1 UNION ALL "
    "SELECT 'train+val', count(*), sum(o_orderkey)::BIGINT FROM t WHERE split IN ('train', 'val')"))
def split_three_way(spark, sf_dir):
    """70/15/15 train/validation/test by two cuts of one md5 ranking, plus the
    train ∪ validation union."""
    s = split.three_way_split(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 0.15, 0.176, SEED,
                              exact=True)
    agg = [F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum")]
    per = s.groupBy("split").agg(*agg)
    union = s.where(F.col("split").isin("train", "val")).agg(*agg).select(F.lit("train+val").alias("split"), "n", "key_sum")
    return per.unionByName(union)


FRACTIONS = (0.1, 0.3, 0.5, 0.7, 0.9)
_VU = hash_uniform_sql(["vec_id"], SEED)


def _fractions_sql():
    parts, sels = [], []
    for i, f in enumerate(FRACTIONS):
        parts.append(sqlgen.stratified_ctes("e", ["vec_id"], "label", f, _VU, out=f"t{i}", total="floor", prefix=f"f{i}_"))
        sels.append(f"SELECT {f!r}::DOUBLE AS fraction, count(*) AS n_train, sum(vec_id)::BIGINT AS id_sum "
                    f"FROM t{i} WHERE split = 'test'")
    return "WITH e AS (SELECT vec_id, label FROM embeddings), " + ", ".join(parts) + " " + " UNION ALL ".join(sels)


@query("split_fractions", ops=("B13",), sql=_fractions_sql())
def split_fractions(spark, sf_dir):
    """Nested stratified training subsets of 10–90 %: prefixes of one per-class md5
    ranking with floor quotas (test = complement)."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    s = split.fraction_subsets(e, ["vec_id"], "label", FRACTIONS, SEED)
    mine = lambda i: F.col("member")[i]
    sums = s.agg(*[F.count(F.when(mine(i), 1)).alias(f"n{i}") for i in range(len(FRACTIONS))],
                 *[F.sum(F.when(mine(i), F.col("vec_id"))).alias(f"s{i}") for i in range(len(FRACTIONS))])
    rows = [F.struct(F.lit(float(f)).alias("fraction"), F.col(f"n{i}").alias("n_train"), F.col(f"s{i}").alias("id_sum"))
            for i, f in enumerate(FRACTIONS)]
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
