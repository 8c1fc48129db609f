"""Gradient boosting on a table of counts, compiled to a Spark expression.

Features are small integers, so rows with equal features are one *cell* with two
counts: label 1 and label 0.  The cells are what is fitted; their number is bounded by
the product of the features' ranges, whatever the number of rows.  Trees have a few
levels, splits minimise the second-order loss of the logistic model, and the sum of the leaves
becomes a sum of CASE expressions, evaluated without user functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS, DEPTH, RATE, SHRINK = 16, 2, 0.4, 1.0


@dataclass
class Cell:
    values: tuple[int, ...]
    ones: float
    zeros: float
    margin: float = field(default=0.0, compare=False)


@dataclass
class Node:
    """``values[feature] <= cut`` goes to ``low``, else to ``high``; a leaf has neither."""
    leaf: float = 0.0
    feature: int = -1
    cut: int = 0
    low: Node | None = None
    high: Node | None = None

    def value(self, values: Sequence[int]) -> float:
        node = self
        while node.low is not None:
            node = node.low if values[node.feature] <= node.cut else node.high
        return node.leaf

    def expr(self, get: Callable[[int], Column]) -> Column:
        if self.low is None:
            return F.lit(self.leaf)
        return F.when(get(self.feature) <= self.cut, self.low.expr(get)).otherwise(self.high.expr(get))


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def _gain(g: float, h: float) -> float:
    return g * g / (h + SHRINK)


def _grow(cells: list[Cell], depth: int) -> Node:
    slope = [c.ones - (c.ones + c.zeros) * sigmoid(c.margin) for c in cells]
    bend = [(c.ones + c.zeros) * sigmoid(c.margin) * (1 - sigmoid(c.margin)) for c in cells]
    g, h = math.fsum(slope), math.fsum(bend)
    best = (1e-9, -1, 0)
    for f in range(len(cells[0].values)) if depth else ():
        at: dict[int, list[float]] = {}
        for c, s, b in zip(cells, slope, bend, strict=True):
            sums = at.setdefault(c.values[f], [0.0, 0.0])
            sums[0] += s
            sums[1] += b
        low_g = low_h = 0.0
        for cut in sorted(at)[:-1]:
            low_g, low_h = low_g + at[cut][0], low_h + at[cut][1]
            gain = _gain(low_g, low_h) + _gain(g - low_g, h - low_h) - _gain(g, h)
            if gain > best[0] + 1e-9:
                best = (gain, f, cut)
    if best[1] < 0:
        return Node(leaf=RATE * g / (h + SHRINK))
    _, f, cut = best
    return Node(feature=f, cut=cut, low=_grow([c for c in cells if c.values[f] <= cut], depth - 1),
                high=_grow([c for c in cells if c.values[f] > cut], depth - 1))


@dataclass
class Boosted:
    start: float
    trees: list[Node]

    def score(self, values: Sequence[int]) -> float:
        return self.start + sum(t.value(values) for t in self.trees)

    def expr(self, get: Callable[[int], Column]) -> Column:
        """The score of the features that ``get`` gives by number."""
        out = F.lit(self.start)
        for t in self.trees:
            out = out + t.expr(get)
        return out


def fit(cells: Sequence[Cell]) -> Boosted:
    """Trees for the cells; the start is the log odds of all (one case added to each side)."""
    cells = sorted((Cell(c.values, c.ones, c.zeros) for c in cells), key=lambda c: c.values)
    start = math.log((sum(c.ones for c in cells) + 1) / (sum(c.zeros for c in cells) + 1))
    model = Boosted(start, [])
    for c in cells:
        c.margin = start
    for _ in range(ROUNDS if cells else 0):
        tree = _grow(cells, DEPTH)
        model.trees.append(tree)
        for c in cells:
            c.margin += tree.value(c.values)
    return model


def calibrate(scored: Sequence[tuple[float, float, float]]) -> tuple[float, float]:
    """(a, b) of probability = sigmoid(a * score + b), fitted to (score, ones, zeros) with softened labels."""
    ones, zeros = sum(x[1] for x in scored), sum(x[2] for x in scored)
    hit, miss = (ones + 1) / (ones + 2), 1 / (zeros + 2)
    a, b = 1.0, 0.0
    for _ in range(50):
        ga = gb = haa = hab = hbb = 0.0
        for s, n1, n0 in scored:
            p = sigmoid(a * s + b)
            d = n1 * (hit - p) + n0 * (miss - p)
            w = (n1 + n0) * max(p * (1 - p), 1e-9)
            ga, gb = ga + d * s, gb + d
            haa, hab, hbb = haa + w * s * s, hab + w * s, hbb + w
        haa, hbb = haa + 1e-6, hbb + 1e-6
        det = haa * hbb - hab * hab
        step = ((hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det)
        size = max(1.0, abs(step[0]), abs(step[1]))
        a, b = a + step[0] / size, b + step[1] / size
        if abs(step[0]) + abs(step[1]) < 1e-10:
            break
    return max(a, 1e-3), b


def threshold(scored: Sequence[tuple[float, float, float]], precision: float) -> float | None:
    """A score from which on (ones + 1) / (all + 2) is at least ``precision``, as low as the cells allow: half way to the
    next lower score, which would be too many.  None if no score is safe."""
    sums: dict[float, list[float]] = {}
    for s, n1, n0 in scored:
        at = sums.setdefault(s, [0.0, 0.0])
        at[0] += n1
        at[1] += n0
    ones = zeros = 0.0
    order = sorted(sums, reverse=True)
    best = None
    for i, s in enumerate(order):
        ones, zeros = ones + sums[s][0], zeros + sums[s][1]
        if (ones + 1) / (ones + zeros + 2) >= precision:
            best = (s + order[i + 1]) / 2 if i + 1 < len(order) else s
    return best
