"""Reproducible splits.

``hash`` mode: a row's side is decided by md5(id‖seed) alone — no shuffle, no
global state, stable when rows are added.  ``exact`` mode reproduces the sizes
of an exact splitter (n_test = ceil(m·f)): one scan counts the rows, one finds the draws
at the cuts (see :mod:`draws`), and the split is a literal predicate on a row's draw.
Stratified modes do so inside each class, against per-class quotas allocated by largest
remainder (ties by class order).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import hash_uniform
from .draws import by_class, hash_cuts, taken, ties, unused
from .rank import global_rank, order_statistics

#: Classes up to this many are literals of a split's expressions; more are joined.
LITERAL_CLASSES = 64


def with_hash(df: DataFrame, id_cols: Sequence[str], seed=42, name: str = "_u") -> DataFrame:
    return df.withColumn(name, hash_uniform(list(id_cols), seed))


def hash_split(df: DataFrame, id_cols: Sequence[str], test_frac=0.2, seed=42,
               split_col: str = "split") -> DataFrame:
    """B10 hash mode: test when md5-uniform < test_frac.  Narrow, no shuffle."""
    u = hash_uniform(list(id_cols), seed)
    return df.withColumn(split_col, F.when(u < F.lit(test_frac), F.lit("test")).otherwise(F.lit("train")))


def first_in_hash_order(df: DataFrame, id_cols: Sequence[str], seed, u: Column, rows: int, counts: Sequence[int]) -> list[Column]:
    """Conditions that hold for the first n of ``rows`` rows in hash order, for each n of ``counts``; ``u`` is the
    rows' draw as a column.

    Where several rows share the draw at a cut, the ids order these few rows only: the
    condition compares with the last one's ids.
    """
    found = hash_cuts(df, id_cols, seed, {None: counts}, {None: rows})[None]
    return [taken(u, found.get(n), rows, n, ties(df, id_cols, seed, found[n]) if n in found else None, id_cols, df.schema)
            for n in counts]


def exact_split(df: DataFrame, id_cols: Sequence[str], test_frac=0.2, seed=42,
                split_col: str = "split") -> DataFrame:
    """B10 exact mode: the ceil(m·f) rows first in hash order are test (rows with equal
    ids fall on the same side)."""
    m = df.count()
    u = unused(df.columns, "_u")
    (test,) = first_in_hash_order(df, id_cols, seed, F.col(u), m, [math.ceil(m * test_frac)])
    return with_hash(df, id_cols, seed, u).withColumn(split_col, F.when(test, "test").otherwise("train")).drop(u)


def three_way_split(df: DataFrame, id_cols: Sequence[str], test_frac=0.15, val_frac_of_rest=0.176,
                    seed=42, exact=True, split_col: str = "split") -> DataFrame:
    """test = first cut, validation = second cut of the remainder, rest train."""
    u = unused(df.columns, "_u")
    if not exact:
        cut2 = test_frac + (1.0 - test_frac) * val_frac_of_rest
        test, upto_val = F.col(u) < test_frac, F.col(u) < cut2
    else:
        m = df.count()
        n_test = math.ceil(m * test_frac)
        n_val = math.ceil((m - n_test) * val_frac_of_rest)
        test, upto_val = first_in_hash_order(df, id_cols, seed, F.col(u), m, [n_test, n_test + n_val])
    return with_hash(df, id_cols, seed, u).withColumn(
        split_col, F.when(test, "test").when(upto_val, "val").otherwise("train")).drop(u)


def quotas(sizes: Mapping, fraction: float, total: str = "ceil") -> dict:
    """Rows of each class that sum to ceil(m·f) (or floor): floor shares plus one extra for the largest
    remainders, ties by class (null first)."""
    m = sum(sizes.values())
    target = math.ceil(m * fraction) if total == "ceil" else math.floor(m * fraction)
    share = {c: n * target / m for c, n in sizes.items()}
    out = {c: math.floor(x) for c, x in share.items()}
    order = sorted(sizes, key=lambda c: (-(share[c] - out[c]), c is not None, c))
    for c in order[:target - sum(out.values())]:
        out[c] += 1
    return out


def class_sizes(df: DataFrame, label: str, most: int | None = None) -> dict | None:
    """Rows of each class (K numbers); None if there are more classes than ``most``."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    rows = (counts.limit(most + 1) if most else counts).collect()
    return None if most and len(rows) > most else {r[label]: r["_n"] for r in rows}


def _class_cuts(df: DataFrame, id_cols: Sequence[str], label: str, seed, sizes: Mapping, wanted: Sequence[Mapping], u: Column) -> list[Column]:
    """For each of ``wanted`` ({class: n}) whether a row is among the first n of its class in hash order; one scan for all."""
    found = hash_cuts(df, id_cols, seed, {c: [w[c] for w in wanted] for c in sizes}, sizes, label)
    last = {(c, n): ties(df, id_cols, seed, cut, label, c) for c, cuts in found.items() for n, cut in cuts.items()}

    def one(w):
        return by_class(list(sizes), F.col(label), lambda c: taken(u, found[c].get(w[c]), sizes[c], w[c], last.get((c, w[c])),
                                                                   id_cols, df.schema))
    return [one(w) if sizes else F.lit(False) for w in wanted]


def class_quotas(df: DataFrame, label: str, fraction: float, total: str = "ceil") -> DataFrame:
    """Per-class quota summing to ceil(m·f) (or floor): floor shares plus one
    extra for the largest remainders.  Works on the K-row class-count table."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    m = F.sum("n_class").over(Window.partitionBy())
    target = F.ceil(m * F.lit(fraction)) if total == "ceil" else F.floor(m * F.lit(fraction))
    share = F.col("n_class") * F.col("_target") / F.col("_m")
    q = (counts.withColumn("_m", m).withColumn("_target", target)
               .withColumn("_base", F.floor(share))
               .withColumn("_rem", share - F.col("_base")))
    short = F.col("_target") - F.sum("_base").over(Window.partitionBy())
    order = Window.orderBy(F.col("_rem").desc(), F.col(label))
    q = q.withColumn("_short", short).withColumn("_pos", F.row_number().over(order))
    return q.select(label, "n_class",
                    (F.col("_base") + F.when(F.col("_pos") <= F.col("_short"), 1).otherwise(0))
                    .cast("long").alias("quota"))


def class_rank(df: DataFrame, id_cols: Sequence[str], label: str, seed=42,
               rank_col: str = "class_rank") -> DataFrame:
    """Rank of each row inside its class in hash order (two-level distributed rank,
    safe when one class holds most rows)."""
    return global_rank(with_hash(df, id_cols, seed), ["_u", *id_cols], group_by=[label],
                       rank_col=rank_col).drop("_u")


def stratified_split(df: DataFrame, id_cols: Sequence[str], label: str, test_frac=0.2, seed=42,
                     split_col: str = "split") -> DataFrame:
    """Class proportions kept; quotas sum to ceil(m·f).

    One scan counts the classes, one finds the draw at each class's quota; a row's side is a
    predicate on its class and draw.  Null labels are a class of their own."""
    sizes = class_sizes(df, label, LITERAL_CLASSES)
    if sizes is None:
        return _split_many_classes(df, id_cols, label, test_frac, seed, split_col)
    u = unused(df.columns, "_u")
    (test,) = _class_cuts(df, id_cols, label, seed, sizes, [quotas(sizes, test_frac)], F.col(u))
    return with_hash(df, id_cols, seed, u).withColumn(split_col, F.when(test, "test").otherwise("train")).drop(u)


def _split_many_classes(df: DataFrame, id_cols: Sequence[str], label: str, test_frac, seed, split_col: str) -> DataFrame:
    """:func:`stratified_split` where the classes are too many for literals: their quotas and cuts stay tables."""
    limits = class_quotas(df, label, test_frac, "ceil").select(label, "quota")
    u = hash_uniform(list(id_cols), seed)
    keyed = df.select(F.col(label), u.alias("_u"))
    cut = order_statistics(keyed, "_u", limits.select(label, F.col("quota").alias("rank")), [label])
    cut = cut.checkpoint(eager=True)                       # one row a class
    if cut.where(F.col("rank") - F.col("below") < F.col("equal")).limit(1).count():
        ranked = class_rank(df, id_cols, label, seed, "_cr")
        return (ranked.join(limits, on=label, how="inner")
                      .withColumn(split_col, F.when(F.col("_cr") <= F.col("quota"), "test").otherwise("train"))
                      .drop("_cr", "quota"))
    # one row a class: AQE broadcasts it when that is small; a class without a quota has no cut
    cuts = cut.select(F.col(label).alias("_label"), F.col("value").alias("_cut"))
    return (df.join(cuts, F.col(label).eqNullSafe(F.col("_label")), "left")
              .withColumn(split_col, F.when(F.col("_cut").isNotNull() & (u <= F.col("_cut")), "test").otherwise("train"))
              .drop("_label", "_cut"))


def fraction_subsets(df: DataFrame, id_cols: Sequence[str], label: str,
                     fractions: Sequence[float] = (0.1, 0.3, 0.5, 0.7, 0.9), seed=42, member: str = "member") -> DataFrame:
    """Nested stratified training subsets, as a column ``member`` of one boolean a fraction.

    A row is in the subset of fraction f when it is among the first quota_f rows of its class
    in hash order (floor quotas; the test rows are the complement).  One scan counts the classes, one finds the
    draws at all quotas of all classes, and membership is a predicate: nothing is ranked, sorted or joined.
    """
    sizes = class_sizes(df, label)
    u = unused(df.columns, "_u")
    conditions = _class_cuts(df, id_cols, label, seed, sizes, [quotas(sizes, f, "floor") for f in fractions], F.col(u))
    return with_hash(df, id_cols, seed, u).withColumn(member, F.array(*conditions)).drop(u)
