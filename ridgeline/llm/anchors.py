"""Metric trees by the anchors hierarchy, and nearest entries of whole balls.

The points of a ball get about sqrt(n) anchors, one after the other: the point that is
farthest from its anchor becomes the next one and takes over the points that are nearer
to it, where a point nearer to its anchor than half the way between both need not be
looked at.  Anchors are then merged two by two, the pair with the smallest common ball
first, up to the root (the middle-out step), and each anchor's points are divided
likewise, down to small leaves.  Every ball keeps an integer pivot, the largest squared
distance of a point to it, and the sum and count of its points.

To find each point's nearest entry, balls are taken from the root down with the list of
entries that may own some point of them.  Of the entry c nearest to the pivot p and
another e, no point within radius r of p is as near to e as to c when
``|p-e|^2 - |p-c|^2 > 2 r |c-e|``; e leaves the list, and the balls below inherit what is
left.  A ball whose list has one entry is owned by it whole: sum and count are added as they
are.  Points of leaves that several entries may own are compared with these.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np

LEAF = 32
#: Entries are dropped only where float64 leaves no doubt.
SLACK = 1 + 1e-9


@dataclass
class Tree:
    points: np.ndarray      # distinct, leaf by leaf
    weight: np.ndarray      # how often each occurs
    pivot: np.ndarray
    radius2: np.ndarray
    total: np.ndarray
    count: np.ndarray
    start: np.ndarray       # the ball's points are points[start:end]
    end: np.ndarray
    left: np.ndarray        # -1: a leaf
    right: np.ndarray

    def dumps(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.__dataclass_fields__})
        return out.getvalue()

    @classmethod
    def loads(cls, blob) -> Tree:
        with np.load(io.BytesIO(blob)) as arrays:
            return cls(**{name: arrays[name] for name in cls.__dataclass_fields__})


def anchors(x: np.ndarray) -> list[np.ndarray]:
    """Row numbers of ``x`` (distinct points) by anchor; at least two groups if there are two points."""
    at = [0]
    owner = np.zeros(len(x), np.int64)
    dist = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    for new in range(1, int(np.ceil(np.sqrt(len(x))))):
        far = int(dist.argmax())
        if dist[far] == 0:
            break
        half = np.sqrt(((x[at] - x[far]) ** 2).sum(axis=1)) / 2 / SLACK
        look = np.flatnonzero(dist >= half[owner])
        d = np.sqrt(((x[look] - x[far]) ** 2).sum(axis=1))
        nearer = d < dist[look]
        look = look[nearer]
        dist[look], owner[look] = d[nearer], new
        at.append(far)
    order = np.argsort(owner, kind="stable")
    return [g for g in np.split(order, np.flatnonzero(np.diff(owner[order])) + 1) if len(g)]


def _joint_radius(centre, radius, count, a, b):
    """Radius of the smallest balls round the common centres that hold ball ``a`` and each ball of ``b``."""
    share = count[b] / (count[a] + count[b])
    apart = np.sqrt(((centre[b] - centre[a]) ** 2).sum(axis=1))
    return np.maximum(share * apart + radius[a], (1 - share) * apart + radius[b])


class _Builder:
    def __init__(self, points: np.ndarray):
        self.x = points.astype(np.float64)
        self.children: list[tuple[int, int]] = []
        self.rows: list[np.ndarray] = []

    def add(self, rows: np.ndarray, left: int = -1, right: int = -1) -> int:
        self.children.append((left, right))
        self.rows.append(rows)
        return len(self.rows) - 1

    def grow(self, rows: np.ndarray) -> int:
        """The number of the ball of these points, everything below it built."""
        if len(rows) <= LEAF:
            return self.add(rows)
        balls = [self.grow(rows[g]) for g in anchors(self.x[rows])]
        members = [self.rows[b] for b in balls]
        count = np.array([len(m) for m in members], float)
        centre = np.array([self.x[m].mean(axis=0) for m in members])
        radius = np.array([np.sqrt(((self.x[m] - c) ** 2).sum(axis=1).max()) for m, c in zip(members, centre, strict=True)])
        everyone = np.arange(len(balls))
        cost = np.array([_joint_radius(centre, radius, count, i, everyone) for i in everyone])
        np.fill_diagonal(cost, np.inf)
        for _ in range(len(balls) - 1):
            i, j = divmod(int(cost.argmin()), len(balls))
            joint = cost[i, j]
            balls[i] = self.add(np.concatenate([self.rows[balls[i]], self.rows[balls[j]]]), balls[i], balls[j])
            centre[i] = (count[i] * centre[i] + count[j] * centre[j]) / (count[i] + count[j])
            radius[i], count[i] = joint, count[i] + count[j]
            cost[j], cost[:, j] = np.inf, np.inf
            alive = np.isfinite(cost[i])
            alive[i] = False
            cost[i, alive] = cost[alive, i] = _joint_radius(centre, radius, count, i, np.flatnonzero(alive))
        return balls[i]


def build(points: np.ndarray, weight: np.ndarray) -> tuple[Tree, np.ndarray]:
    """(the tree of distinct int64 points, the place in it of each of them)"""
    b = _Builder(points)
    root = b.grow(np.arange(len(points)))
    leaves, stack = [], [root]
    start, at = np.zeros(len(b.rows), np.int64), 0
    while stack:
        ball = stack.pop()
        start[ball] = at
        left, right = b.children[ball]
        if left < 0:
            leaves.append(b.rows[ball])
            at += len(b.rows[ball])
        else:
            stack += [right, left]
    order = np.concatenate(leaves)
    points, weight = points[order], weight[order]
    end = start + np.array([len(r) for r in b.rows])
    upto = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points * weight[:, None], axis=0)])
    many = np.concatenate([[0], np.cumsum(weight)])
    total, count = upto[end] - upto[start], many[end] - many[start]
    pivot = total // count[:, None]
    radius2 = np.array([((points[s:e] - p) ** 2).sum(axis=1).max() for s, e, p in zip(start, end, pivot, strict=True)])
    # the root comes first
    number = np.arange(len(b.rows))
    number[[0, root]] = root, 0
    child = np.array(b.children, np.int64)
    renamed = np.where(child < 0, -1, number[child])
    swap = number        # its own inverse
    tree = Tree(points, weight, pivot[swap], radius2[swap], total[swap], count[swap], start[swap], end[swap],
                renamed[swap, 0], renamed[swap, 1])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return tree, place


def nearest(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(nearest entry of each of the tree's points, ties to the lower one; points and component sums
    of each entry; how many balls were owned whole)"""
    k = len(entries)
    code = np.empty(len(tree.points), np.int64)
    count, total = np.zeros(k, np.int64), np.zeros(entries.shape, np.int64)
    apart = np.sqrt(((entries[:, None, :] - entries[None]) ** 2).sum(axis=2).astype(float))
    ball, may, owned_balls = np.zeros(1, np.int64), np.ones((1, k), bool), 0
    rest_rows, rest_may = [], []
    while len(ball):
        d = ((tree.pivot[ball][:, None, :] - entries[None]) ** 2).sum(axis=2)
        star = np.where(may, d, np.iinfo(np.int64).max).argmin(axis=1)
        behind = (d - d[np.arange(len(ball)), star][:, None]).astype(float)
        reach = 2 * np.sqrt(tree.radius2[ball].astype(float))[:, None] * apart[star] * SLACK
        same = (apart[star] == 0) & (np.arange(k) > star[:, None])         # a copy of the nearest entry, numbered higher
        may = may & ~(behind > reach) & ~same
        owned = may.sum(axis=1) == 1
        for b, e in zip(ball[owned].tolist(), star[owned].tolist(), strict=True):
            code[tree.start[b]:tree.end[b]] = e
        np.add.at(count, star[owned], tree.count[ball[owned]])
        np.add.at(total, star[owned], tree.total[ball[owned]])
        owned_balls += int(owned.sum())
        leaf = ~owned & (tree.left[ball] < 0)
        for b, m in zip(ball[leaf].tolist(), may[leaf], strict=True):
            size = int(tree.end[b] - tree.start[b])
            rest_rows.append(np.arange(tree.start[b], tree.end[b]))
            rest_may.append(np.broadcast_to(m, (size, k)))
        deeper = ~owned & ~leaf
        ball, may = np.concatenate([tree.left[ball[deeper]], tree.right[ball[deeper]]]), np.concatenate([may[deeper]] * 2)
    if rest_rows:
        rows, may = np.concatenate(rest_rows), np.concatenate(rest_may)
        for at in range(0, len(rows), 4096):
            r, m = rows[at:at + 4096], may[at:at + 4096]
            d = ((tree.points[r][:, None, :] - entries[None]) ** 2).sum(axis=2)
            code[r] = np.where(m, d, np.iinfo(np.int64).max).argmin(axis=1)
        np.add.at(count, code[rows], tree.weight[rows])
        np.add.at(total, code[rows], tree.points[rows] * tree.weight[rows][:, None])
    return code, count, total, owned_balls
