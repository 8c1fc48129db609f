"""Registered profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import hash_uniform_sql
from ..operators import profile, split
from ..sources.tables import table
from . import sqlgen
from .catalog import query, rnd, sig
from .tasks import HOUSE_FEATURES, HOUSE_ID, HOUSE_SQL, HOUSE_TARGET, house_like

# ---------------------------------------------------------------- C1 class balance


@query("class_balance", ops=("C1",), sql=(
    "SELECT o_orderstatus, count(*) AS n, " + sqlgen.rnd("count(*) / sum(count(*)) OVER ()", 9)
    + " AS share FROM orders GROUP BY o_orderstatus"))
def class_balance(spark, sf_dir):
    """Count and share of every order status (the class column)."""
    o = table(spark, sf_dir, "orders")
    b = profile.class_balance(o, "o_orderstatus")
    return b.select("o_orderstatus", F.col("n").cast("long").alias("n"), rnd("share", 9).alias("share"))


# ---------------------------------------------------------------- C2 rates by band
# The band edges of the two dimensions (lo ≤ x < hi).  Negative
# balances fall in no band, like ages under 20 in the reference's age bands.
ACCTBAL_BANDS = (("0-3000", 0.0, 3000.0), ("3000-6000", 3000.0, 6000.0),
                 ("6000-9000", 6000.0, 9000.0), (">=9000", 9000.0, None))
TOTALPRICE_BANDS = (("<100000", None, 100000.0), ("100000-250000", 100000.0, 250000.0),
                    (">=250000", 250000.0, None))


def _band_sql(col, bands):
    parts = []
    for name, lo, hi in bands:
        cond = " AND ".join(([f"{col} >= {lo!r}"] if lo is not None else []) +
                            ([f"{col} < {hi!r}"] if hi is not None else [])) or "TRUE"
        parts.append(f"WHEN {cond} THEN '{name}'")
    return "CASE " + " ".join(parts) + " END"


RISK_SQL = (
    "WITH j AS (SELECT o_orderstatus AS label, c_acctbal, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey), "
    "e AS (SELECT label, 'acctbal' AS dimension, " + _band_sql("c_acctbal", ACCTBAL_BANDS) + " AS band FROM j "
    "UNION ALL SELECT label, 'totalprice', " + _band_sql("o_totalprice", TOTALPRICE_BANDS) + " FROM j), "
    "g AS (SELECT dimension, band, label, count(*) AS n FROM e WHERE band IS NOT NULL GROUP BY ALL) "
    "SELECT dimension, band, label, n, " + sqlgen.rnd("n / sum(n) OVER (PARTITION BY dimension, band)", 9)
    + " AS share FROM g")


@query("risk_by_band", ops=("B14", "B15", "C2"), sql=RISK_SQL)
def risk_by_band(spark, sf_dir):
    """Class (order status) shares inside account-balance and order-value bands,
    all bandings in one pass over orders ⋈ customer."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    r = profile.rate_by_band(j, "o_orderstatus", {"acctbal": ("c_acctbal", ACCTBAL_BANDS),
                                                  "totalprice": ("o_totalprice", TOTALPRICE_BANDS)})
    return r.select("dimension", "band", "label", F.col("n").cast("long").alias("n"), rnd("share", 9).alias("share"))


# ---------------------------------------------------------------- C3, C4


@query("summary_stats", ops=("C3",), sql=(
    "SELECT count(o_totalprice) AS n, " + sqlgen.rnd("avg(o_totalprice)", 4) + " AS mean, "
    + sqlgen.rnd("median(o_totalprice)", 4) + " AS median, " + sqlgen.rnd("stddev_samp(o_totalprice)", 4) + " AS sd, "
    "min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders"))
def summary_stats(spark, sf_dir):
    """Count, mean, exact median, sample sd, min and max of the order value."""
    s = profile.summary_stats(table(spark, sf_dir, "orders"), "o_totalprice")
    return s.select(F.col("n").cast("long").alias("n"), rnd("mean", 4).alias("mean"), rnd("median", 4).alias("median"),
                    rnd("sd", 4).alias("sd"), "min", "max")


QS = (0.25, 0.5, 0.75, 0.9, 0.95)


@query("quantiles", ops=("C4",), sql=(
    "SELECT 'o_totalprice' AS column, unnest([0.25, 0.5, 0.75, 0.9, 0.95]::DOUBLE[]) AS q, "
    "unnest(list_transform(quantile_cont(o_totalprice, [0.25, 0.5, 0.75, 0.9, 0.95]), lambda v: round(v, 4) + 0.0)) AS value "
    "FROM orders UNION ALL "
    "SELECT 'l_extendedprice', unnest([0.25, 0.5, 0.75, 0.9, 0.95]::DOUBLE[]), "
    "unnest(list_transform(quantile_cont(l_extendedprice, [0.25, 0.5, 0.75, 0.9, 0.95]), lambda v: round(v, 4) + 0.0)) "
    "FROM lineitem"))
def quantiles(spark, sf_dir):
    """Linear-interpolation quantiles .25/.5/.75/.9/.95 of order value and line price."""
    out = None
    for t, c in (("orders", "o_totalprice"), ("lineitem", "l_extendedprice")):
        q = profile.quantiles(table(spark, sf_dir, t), c, QS)
        q = q.select(F.lit(c).alias("column"), F.col("q").cast("double").alias("q"), rnd("value", 4).alias("value"))
        out = q if out is None else out.unionByName(q)
    return out


# ---------------------------------------------------------------- C5, C6 correlation
_HCOLS = HOUSE_FEATURES + [HOUSE_TARGET]


def _corr_sql():
    aggs = ", ".join(f"corr({a}, {b}) AS r_{i}_{j}" for i, a in enumerate(_HCOLS) for j, b in enumerate(_HCOLS) if i < j)
    pairs = []
    for i, a in enumerate(_HCOLS):
        for j, b in enumerate(_HCOLS):
            r = "1.0" if i == j else f"r_{min(i, j)}_{max(i, j)}"
            pairs.append(f"SELECT '{a}' AS a, '{b}' AS b, {sqlgen.rnd(r, 6)} AS r FROM agg")
    return f"WITH h AS ({HOUSE_SQL}), agg AS (SELECT {aggs} FROM h) " + " UNION ALL ".join(pairs)


@query("correlation_matrix", ops=("C5",), sql=_corr_sql())
def correlation_matrix(spark, sf_dir):
    """Pearson matrix of the house-like features and target: one aggregate for all pairs."""
    c = profile.correlation_matrix(house_like(spark, sf_dir), _HCOLS)
    return c.select("a", "b", rnd("r", 6).alias("r"))


def _target_corr_sql():
    rows = " UNION ALL ".join(f"SELECT '{f}' AS feature, corr({f}, {HOUSE_TARGET}) AS r FROM h" for f in HOUSE_FEATURES)
    return (f"WITH h AS ({HOUSE_SQL}), t AS ({rows}) "
            "SELECT feature, " + sqlgen.rnd("r", 6) + " AS r, CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS direction, "
            "CASE WHEN abs(r) > 0.5 THEN 'strong' WHEN abs(r) > 0.3 THEN 'medium' ELSE 'weak' END AS strength, "
            "row_number() OVER (ORDER BY abs(r) DESC, feature) AS rank FROM t")


@query("target_correlation", ops=("C6",), sql=_target_corr_sql())
def target_correlation(spark, sf_dir):
    """r of each feature with the target, direction, strength label, rank by |r|."""
    t = profile.target_correlation(house_like(spark, sf_dir), HOUSE_FEATURES, HOUSE_TARGET)
    return t.select("feature", rnd("r", 6).alias("r"), "direction", "strength", F.col("rank").cast("long").alias("rank"))


# ---------------------------------------------------------------- C7, C11 histograms


def _hist_sql(tbl, col, k):
    return (f"WITH r AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {tbl}), "
            f"c AS (SELECT CASE WHEN hi = lo THEN 1 ELSE least(floor(({col} - lo) * {float(k)!r} / (hi - lo)) + 1, {k}) END::INTEGER AS bin, "
            f"count(*) AS n FROM {tbl}, r GROUP BY 1) "
            f"SELECT b.bin::INTEGER AS bin, {sqlgen.rnd(f'lo + (b.bin - 1) * ((hi - lo) / {float(k)!r})', 4)} AS edge_lo, "
            f"{sqlgen.rnd(f'lo + b.bin * ((hi - lo) / {float(k)!r})', 4)} AS edge_hi, coalesce(c.n, 0)::BIGINT AS n "
            f"FROM range(1, {k + 1}) b(bin) CROSS JOIN r LEFT JOIN c ON c.bin = b.bin")


@query("histogram", ops=("C7",), sql=_hist_sql("orders", "o_totalprice", 30))
def histogram(spark, sf_dir):
    """30 equal-width bins of the order value, right edge in the last bin, empty bins kept."""
    h = profile.histogram(table(spark, sf_dir, "orders"), "o_totalprice", 30)
    return h.select("bin", rnd("edge_lo", 4).alias("edge_lo"), rnd("edge_hi", 4).alias("edge_hi"), "n")


def _bin_sql(col, lo, hi, k):
    return (f"(CASE WHEN {hi} = {lo} THEN 1 ELSE least(floor(({col} - {lo}) * {float(k)!r} / ({hi} - {lo})) + 1, {k}) END)::INTEGER")


@query("scatter_bins", ops=("C11",), sql=(
    "WITH r AS (SELECT min(l_quantity) AS xl, max(l_quantity) AS xh, min(l_extendedprice) AS yl, max(l_extendedprice) AS yh FROM lineitem) "
    "SELECT " + _bin_sql("l_quantity", "xl", "xh", 20) + " AS bx, " + _bin_sql("l_extendedprice", "yl", "yh", 20)
    + " AS by, count(*) AS n FROM lineitem, r GROUP BY 1, 2"))
def scatter_bins(spark, sf_dir):
    """Quantity/price scatter as 20×20 binned counts (size k², not rows)."""
    b = profile.binned_2d(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", 20)
    return b.select("bx", "by", F.col("n").cast("long").alias("n"))


# ---------------------------------------------------------------- C8, C9


@query("box_stats", ops=("C8",), sql=(
    "WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS q FROM orders GROUP BY 1), "
    "l AS (SELECT o_orderpriority, q[1] AS q1, q[2] AS median, q[3] AS q3, q[3] - q[1] AS iqr FROM q), "
    "w AS (SELECT o.o_orderpriority, min(CASE WHEN x BETWEEN q1 - 1.5 * iqr AND q3 + 1.5 * iqr THEN x END) AS whisker_lo, "
    "max(CASE WHEN x BETWEEN q1 - 1.5 * iqr AND q3 + 1.5 * iqr THEN x END) AS whisker_hi, "
    "sum(CASE WHEN x BETWEEN q1 - 1.5 * iqr AND q3 + 1.5 * iqr THEN 0 ELSE 1 END) AS n_outliers, count(*) AS n "
    "FROM (SELECT o_orderpriority, o_totalprice AS x FROM orders) o JOIN l USING (o_orderpriority) GROUP BY 1) "
    "SELECT o_orderpriority, " + sqlgen.rnd("q1", 4) + " AS q1, " + sqlgen.rnd("median", 4) + " AS median, "
    + sqlgen.rnd("q3", 4) + " AS q3, whisker_lo, whisker_hi, n_outliers::BIGINT AS n_outliers, n FROM l JOIN w USING (o_orderpriority)"))
def box_stats(spark, sf_dir):
    """Quartiles, whiskers and outlier counts of order value per priority."""
    b = profile.box_stats(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice")
    return b.select("o_orderpriority", rnd("q1", 4).alias("q1"), rnd("median", 4).alias("median"), rnd("q3", 4).alias("q3"),
                    "whisker_lo", "whisker_hi", F.col("n_outliers").cast("long").alias("n_outliers"),
                    F.col("n").cast("long").alias("n"))


@query("top_groups", ops=("C9",), sql=(
    "WITH g AS (SELECT DISTINCT o_custkey FROM orders ORDER BY o_custkey LIMIT 10) "
    "SELECT o_custkey, count(*) AS n, " + sqlgen.rnd("avg(o_totalprice)", 4) + " AS mean_value "
    "FROM orders WHERE o_custkey IN (SELECT o_custkey FROM g) GROUP BY o_custkey"))
def top_groups(spark, sf_dir):
    """First 10 sorted distinct customers, then their order count and mean value
    (k-row group list broadcast into a left-semi join)."""
    o = table(spark, sf_dir, "orders")
    g = profile.first_groups(o, "o_custkey", 10)
    s = o.join(F.broadcast(g), on="o_custkey", how="left_semi")
    return s.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("o_totalprice"), 4).alias("mean_value"))


# ---------------------------------------------------------------- C10 density


def _kde_sql(tbl, col, label, grid=200):
    return (
        f"WITH b AS (SELECT {label} AS label, {col}::DOUBLE AS x FROM {tbl} WHERE {col} IS NOT NULL), "
        f"per AS (SELECT label, stddev_samp(x) * pow(count(*)::DOUBLE, -0.2) AS h, min(x) AS lo, max(x) AS hi FROM b "
        f"GROUP BY label HAVING stddev_samp(x) > 0), "
        f"m AS (SELECT count(*) AS m FROM b), "
        f"v AS (SELECT b.label, per.lo + (floor((b.x - per.lo) / (per.h / 8)) + 0.5) * (per.h / 8) AS x, count(*) AS c "
        f"FROM b JOIN per ON per.label = b.label GROUP BY 1, 2), "
        f"g AS (SELECT per.label, h, gi.g, lo - 3 * h + (hi - lo + 6 * h) * gi.g / {float(grid - 1)!r} AS x FROM per, range(0, {grid}) gi(g)), "
        f"d AS (SELECT g.label, g.g, g.x, sum(v.c * exp(-0.5 * pow((g.x - v.x) / g.h, 2))) / (g.h * sqrt(2 * pi())) / max(m.m) AS density "
        f"FROM g JOIN v ON v.label = g.label, m GROUP BY g.label, g.g, g.x, g.h) "
        f"SELECT label, g::INTEGER AS g, {sqlgen.rnd('x', 4)} AS x, {sqlgen.sig('density', 5)} AS density FROM d")


@query("density_by_class", ops=("C10",), sql=_kde_sql("lineitem", "l_extendedprice", "l_returnflag"))
def density_by_class(spark, sf_dir):
    """Gaussian kernel density of line price per return flag on a 200-point grid
    (Scott bandwidth; binned by an eighth of it, so the work after one pass is bins × grid)."""
    k = profile.kde_by_class(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_returnflag")
    return k.select("label", F.col("g").cast("int").alias("g"), rnd("x", 4).alias("x"), sig("density", 5).alias("density"))


# ---------------------------------------------------------------- C12
_U = hash_uniform_sql(HOUSE_ID, 42)


@query("train_feature_stats", ops=("C12", "B10"), sql=(
    f"WITH h AS ({HOUSE_SQL}), t AS (SELECT * FROM h WHERE NOT ({_U} < 0.2)) "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, {sqlgen.sig(f'avg({c})', 9)} AS mean, {sqlgen.sig(f'stddev_pop({c})', 9)} AS sd FROM t"
                         for c in HOUSE_FEATURES)))
def train_feature_stats(spark, sf_dir):
    """Mean and population sd of every feature on the training split."""
    t = split.hash_split(house_like(spark, sf_dir), HOUSE_ID, 0.2, 42).where(F.col("split") == "train")
    s = profile.mean_sd(t, HOUSE_FEATURES)
    return s.select("feature", sig("mean", 9).alias("mean"), sig("sd", 9).alias("sd"))


# ---------------------------------------------------------------- C5 on a wide table


@query("correlation_embeddings", ops=("C5",), sql=(
    "WITH u AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(0, len(embedding))) AS i FROM embeddings) "
    "SELECT x.i::INTEGER AS a, y.i::INTEGER AS b, " + sqlgen.rnd("CASE WHEN x.i = y.i THEN 1.0 ELSE corr(x.v, y.v) END", 6)
    + " AS r FROM u x JOIN u y ON x.vec_id = y.vec_id GROUP BY x.i, y.i"))
def correlation_embeddings(spark, sf_dir):
    """Correlation of all 64 × 64 positions of the embeddings by blocked matrix products."""
    c = profile.vector_correlation(table(spark, sf_dir, "embeddings"), "embedding")
    return c.select("a", "b", rnd("r", 6).alias("r"))
