"""Values at given ranks by bracketing, without sorting or moving rows.

Each wanted rank starts with a bracket that very likely holds it.  One scan counts the rows
between the brackets of all wanted ranks, of all classes at once, and, inside a bracket,
the rows of each value.  Where that would be too many values to hold, or a rank is outside its bracket,
the next scan takes the stretch that holds it, in bins.  The counts prove the result; the
bracket only saves scans.

Hash draws have an analytic bracket: an md5 draw is uniform, so of m rows the one at rank n in draw order
lies within n/m ± a few standard errors, sqrt(p(1-p)/m), which holds some sqrt(m) rows.  (Repeated ids
share a draw and can be elsewhere.)  Quantiles of any column take theirs from a mergeable quantile sketch, see
:func:`sketched_quantiles`.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_uniform

#: Standard errors on each side of a bracket, and rows added for very small tables.
ERRORS, SPARE = 6.0, 4.0
#: Draws that a scan may bring to the driver, and bins of a stretch where there would be more.
MAX_DRAWS, BINS = 400_000, 4096


@dataclass(frozen=True)
class Cut:
    """The draw at a rank, how many draws are smaller and how many are equal to it."""
    rank: int
    value: float
    below: int
    equal: int


@dataclass
class Stretch:
    """An interval of values with about ``expected`` rows; ``bins`` > 0: they are counted in so many bins."""
    lo: float
    hi: float
    expected: float
    bins: int = 0


def unused(columns: Sequence[str], name: str) -> str:
    """``name``, lengthened until no column has it (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bracket(rank: int, m: int) -> Stretch:
    """Where the draw at ``rank`` of ``m`` independent ones lies, but for about one case in 10^9."""
    p = (rank - 0.5) / m
    half = (ERRORS * math.sqrt(p * (1 - p) * m) + SPARE) / m
    return Stretch(p - half, p + half, 2 * half * m)


def _merged(stretches: Sequence[Stretch]) -> list[Stretch]:
    out: list[Stretch] = []
    for s in sorted(stretches, key=lambda s: (s.lo, s.hi)):
        if out and s.lo <= out[-1].hi:
            out[-1] = Stretch(out[-1].lo, max(out[-1].hi, s.hi), out[-1].expected + s.expected)
        else:
            out.append(Stretch(s.lo, s.hi, s.expected))
    return out


def _region(v: Column, stretches: Sequence[Stretch]) -> Column:
    """2k + 1 inside stretch k, even numbers between them."""
    passed = F.lit(0)
    for s in stretches:
        passed = passed + (v >= s.lo).cast("int") + (v > s.hi).cast("int")
    return passed


def _bin(v: Column, s: Stretch) -> Column:
    """The smallest and the largest value of a stretch never share a bin."""
    width = (s.hi - s.lo) / s.bins
    if math.isinf(width):           # ends of the number range: by magnitude, infinities apart
        scaled = F.signum(v) * F.log1p(F.abs(v))            # within 710 for any finite number
        return (F.when(v == float("-inf"), -1).when(v == float("inf"), s.bins + 1)
                .otherwise(F.floor((scaled + 710) / 1420 * s.bins))).cast("double")
    if width == 0:                  # neighbouring numbers
        return F.when(v > s.lo, 1.0).otherwise(0.0)
    return F.floor((v - s.lo) / width).cast("double")


def _cell(v: Column, region: Column, stretches: Sequence[Stretch]) -> Column:
    """The value itself inside a stretch (its bin where that has bins); null between stretches."""
    cell = F.lit(None).cast("double")
    for k, s in enumerate(stretches):
        cell = F.when(region == 2 * k + 1, _bin(v, s) if s.bins else v).otherwise(cell)
    return cell


def by_class(classes: Sequence, column: Column, of) -> Column:
    """``of(class)`` for each row by its class (null is a class of its own); null for others."""
    out = None
    for c in classes:
        hit = column.isNull() if c is None else column == F.lit(c)
        value = of(c)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def cuts(rows: DataFrame, start: Mapping) -> dict:
    """{class: {rank: :class:`Cut`}} for ``start`` {class: {rank: bracket}} over ``rows`` (_class, _v: double without
    nulls and NaN).  The classes are literals of the scan's expressions: a few dozen at most."""
    found: dict = {c: {} for c in start}
    left = {c: dict(rs) for c, rs in start.items() if rs}
    v = F.col("_v")
    while left:
        stretches = {c: _merged(list(rs.values())) for c, rs in left.items()}
        room = MAX_DRAWS / sum(map(len, stretches.values()))
        for s in (s for ss in stretches.values() for s in ss):
            s.bins = BINS if s.expected > room else 0
        classes = list(stretches)
        if classes == [None]:
            at, cell = _region(v, stretches[None]), _cell(v, F.col("_at"), stretches[None])
        else:
            at = by_class(classes, F.col("_class"), lambda c: _region(v, stretches[c]))  # noqa: B023
            cell = by_class(classes, F.col("_class"), lambda c: _cell(v, F.col("_at"), stretches[c]))  # noqa: B023
        counts = (rows.select("_class", "_v", at.alias("_at")).where(F.col("_at").isNotNull())
                  .groupBy("_class", "_at", cell.alias("_cell"))
                  .agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).collect())
        cells = defaultdict(list)
        for r in counts:
            cells[r["_class"]].append((r["lo"], r["hi"], r["n"]))
        still: dict = {}
        for c, rs in left.items():
            below, wanted = 0, sorted(rs)
            for lo, hi, n in sorted(cells[c]):
                while wanted and wanted[0] <= below + n:
                    r = wanted.pop(0)
                    if lo == hi:
                        found[c][r] = Cut(r, lo, below, n)
                    else:
                        still.setdefault(c, {})[r] = Stretch(lo, hi, n)
                below += n
        left = still
    return found


def hash_cuts(df: DataFrame, id_cols: Sequence[str], seed, ranks: Mapping, sizes: Mapping,
              label: str | None = None) -> dict:
    """{class: {rank: :class:`Cut`}} for the wanted ``ranks`` {class: [rank, ...]} in draw order within
    each class of ``label`` (one class None without it), ``sizes`` {class: rows}.

    Ranks below 1 or above the class's size have no cut.  A scan computes the digest of a row once.
    """
    rows = df.select((F.col(label) if label else F.lit(None).cast("string")).alias("_class"),
                     hash_uniform(list(id_cols), seed).alias("_v"))
    return cuts(rows, {c: {r: bracket(r, sizes[c]) for r in set(rs) if 1 <= r <= sizes.get(c, 0)} for c, rs in ranks.items()})


#: Rank error of the sketch, as a share of the rows; brackets are wider by twice as much.
SKETCH_ERROR = 1e-4
#: A class with fewer values is taken whole.
SMALL_CLASS = 20_000


def sketched_quantiles(rows: DataFrame, qs: Sequence[float], most_classes: int) -> dict | None:
    """{class: [value of each q]}: exact quantiles with linear interpolation over ``rows`` (_class, _v: double without
    nulls and NaN), in two scans: a quantile sketch of each class brackets the ranks, and the rows inside the brackets
    decide.  None if there are more classes than ``most_classes``.

    The sketch is merged from the tasks' sketches; its size depends on its error only.
    """
    ends = [min(1.0, max(0.0, q + side * 3 * SKETCH_ERROR)) for q in qs for side in (-1, 1)]
    sketch = F.percentile_approx("_v", F.array(*[F.lit(e) for e in ends]), int(1 / SKETCH_ERROR))
    heads = rows.groupBy("_class").agg(F.count(F.lit(1)).alias("n"), sketch.alias("ends")).limit(most_classes + 1).collect()
    if len(heads) > most_classes:
        return None
    start: dict = {}
    places: dict = {}
    for r in heads:
        places[r["_class"]] = at = [(math.floor(h), math.ceil(h), h - math.floor(h)) for h in ((r["n"] - 1) * q + 1.0 for q in qs)]
        brackets = start.setdefault(r["_class"], {})
        for k, (a, b, _) in enumerate(at):
            s = (Stretch(float("-inf"), float("inf"), r["n"]) if r["n"] <= SMALL_CLASS
                 else Stretch(r["ends"][2 * k], r["ends"][2 * k + 1], 8 * SKETCH_ERROR * r["n"]))
            brackets[a] = brackets[b] = s
    found = cuts(rows, start)

    def between(c, a, b, f):
        low, high = found[c][a].value, found[c][b].value
        return low + f * (high - low)
    return {c: [between(c, *p) for p in at] for c, at in places.items()}


def ties(df: DataFrame, id_cols: Sequence[str], seed, cut: Cut, label: str | None = None, of=None):
    """The ids of the last row that a cut takes, where only some of the rows with its draw are taken: these rows
    alone are put in order of their ids.  None if all of them are taken."""
    if cut.rank - cut.below >= cut.equal:
        return None
    rows = df.where(hash_uniform(list(id_cols), seed) == F.lit(cut.value))
    if label:
        rows = rows.where(F.col(label).isNull() if of is None else F.col(label) == F.lit(of))
    rows = rows.select(*id_cols)
    return rows.orderBy(*id_cols).limit(cut.rank - cut.below).orderBy(*[F.col(c).desc() for c in id_cols]).limit(1).first()


def taken(u: Column, cut: Cut | None, size: int, rank: int, last, id_cols: Sequence[str], schema) -> Column:
    """Whether a row with draw ``u`` is among the first ``rank`` of ``size``, by the cut at that rank."""
    if rank < 1:
        return F.lit(False)
    if cut is None:                 # more than there are rows
        return F.lit(rank >= size)
    if last is None:
        return u <= F.lit(cut.value)
    upto = F.struct(*[F.col(c) for c in id_cols]) <= F.struct(*[F.lit(last[c]).cast(schema[c].dataType) for c in id_cols])
    return (u < F.lit(cut.value)) | ((u == F.lit(cut.value)) & upto)
