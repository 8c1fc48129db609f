import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeline.llm import anchors as A
from ridgeline.llm import centroid_clusters as C
from ridgeline.llm import int_vectors as V
from ridgeline.llm import vector_codes as P

SCHEMA = "vec_id long, embedding array<float>, label int"


def kept(rows, scale, dims=64):
    out = []
    for i, v, label in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, [math.floor(scale * float(np.float32(x))) for x in v], label))
    return out


def distance(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def refine(points, centres, rounds):
    """(centres after the rounds, nearest centre of each point, its distance)"""
    def assign():
        return [min(range(len(centres)), key=lambda c: (distance(p, centres[c]), c)) for p in points]
    for _ in range(rounds):
        near = assign()
        for c in range(len(centres)):
            own = [p for p, n in zip(points, near, strict=True) if n == c]
            if own:
                centres[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    near = assign()
    return centres, near, [distance(p, centres[n]) for p, n in zip(points, near, strict=True)]


def plain_clusters(rows):
    k = kept(rows, 64)
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centres, near, d = refine([v for _, v, _ in k], [list(r[1]) for r in sorted(k, key=key)[:16]], 3)
    sums = [sum(x for x, n in zip(d, near, strict=True) if n == c) for c in range(len(centres))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((str(i), n, x, min(sums[n], V.LONG_MAX), min(sum(d), V.LONG_MAX), sha[n]) if x <= V.LONG_MAX else
                  (str(i), n, V.LONG_MAX, V.LONG_MAX, V.LONG_MAX, sha[n]) for (i, _, _), n, x in zip(k, near, d, strict=True))


def plain_codes(rows):
    k = kept(rows, 256)
    first = sorted(k, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:64]
    codes, errors, numbers = [""] * len(k), [0] * len(k), []
    for p in range(16):
        cut = lambda v: v[4 * p:4 * p + 4]  # noqa: B023, E731
        centres, near, d = refine([cut(v) for _, v, _ in k], [list(cut(v)) for _, v, _ in first], 2)
        codes = [c + f"{n:02x}" for c, n in zip(codes, near, strict=True)]
        errors = [e + x for e, x in zip(errors, d, strict=True)]
        numbers += [x for c in centres for x in c]
    labels = {}
    for (_, _, label), e in zip(k, errors, strict=True):
        labels[label] = labels.get(label, 0) + e
    sha = hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()
    clamp = lambda x: min(x, V.LONG_MAX)
    return sorted((str(i), c, clamp(e), clamp(labels[label]), sha) for (i, _, label), c, e in zip(k, codes, errors, strict=True))


def check(spark, rows, partitions=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    got = sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
                 for r in C.cluster_vectors(df).collect())
    assert got == plain_clusters(rows)
    got = sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in P.digest(df).collect())
    assert got == plain_codes(rows)


def vectors(seed, n, spread=1.0, dims=64):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(7)]
    return [(i, [x + rng.gauss(0, 0.1) for x in rng.choice(centres)], rng.choice([None, 0, 1, 2])) for i in range(n)]


def test_against_plain_version(spark):
    check(spark, vectors(1, 150))


def test_ties_repeats_and_a_hot_vector(spark):
    rng = random.Random(2)
    few = [[rng.choice([-0.25, 0.0, 0.25]) for _ in range(64)] for _ in range(12)]
    rows = [(i, few[0] if i % 3 == 0 else rng.choice(few), 0) for i in range(120)]
    check(spark, rows + rows[:5], partitions=5)     # ids repeat too


def test_rows_that_are_not_kept(spark):
    rows = vectors(3, 30)
    bad = [(100, None, 1), (101, [], 1), (102, [0.5] * 63, 1), (103, [0.5] * 65, 1), (104, [None] + [0.5] * 63, 1),
           (105, [float("nan")] + [0.5] * 63, 1), (106, [float("inf")] * 64, None), (None, [0.25] * 64, None), (-5, [0.125] * 64, 9)]
    check(spark, rows + bad)


def test_huge_components_stay_exact(spark):
    rows = vectors(4, 20) + [(50, [3e38] * 64, 1), (51, [-3e38, 1e30] * 32, 1), (52, [1e7] * 64, 2), (53, [2e18] * 64, 2)]
    check(spark, rows, partitions=2)


def test_fewer_vectors_than_centroids_and_none(spark):
    check(spark, vectors(5, 3))
    for rows in ([], [(1, None, 2)]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert C.cluster_vectors(df).collect() == [] and P.digest(df).collect() == []
        assert P.digest(df).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_clashing_columns_and_other_label_types(spark):
    rows = vectors(6, 25)
    df = spark.createDataFrame(rows, SCHEMA)
    more = df.select("*", F.lit(1).alias("id"), F.lit("x").alias("vec"), F.lit(2).alias("cluster"), F.lit(3).alias("code"),
                     F.lit(4).alias("error"), F.lit(5).alias("distance"), F.lit(6).alias("other"), F.lit(7).alias("label_error"))
    assert sorted(C.cluster_vectors(more).collect(), key=str) == sorted(C.cluster_vectors(df).collect(), key=str)
    assert sorted(P.digest(more).collect(), key=str) == sorted(P.digest(df).collect(), key=str)
    named = df.withColumn("label", F.concat(F.lit("l"), "label"))
    assert sorted(P.digest(named).collect(), key=str) == sorted(P.digest(df).collect(), key=str)


@pytest.mark.parametrize("seed,n,spread", [(1, 3000, 200), (2, 500, 1), (3, 2000, 5), (4, 1, 9), (5, 33, 1000)])
def test_trees(seed, n, spread):
    """Balls hold their points, caches add up, and the walk agrees with comparing all."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, spread, (12, 4))
    x = np.floor(centre[rng.integers(0, 12, n)] + rng.normal(0, spread / 8, (n, 4)))
    points, code = C.distinct(x)
    assert (points[code] == x).all() and len({tuple(p) for p in points}) == len(points)
    tree, place = A.build(points.astype(np.int64), np.bincount(code))
    tree = A.Tree.loads(tree.dumps())
    assert (tree.points[place[code]] == x).all()
    for b in range(len(tree.count)):
        own, weight = tree.points[tree.start[b]:tree.end[b]], tree.weight[tree.start[b]:tree.end[b]]
        assert tree.count[b] == weight.sum() and (tree.total[b] == (own * weight[:, None]).sum(axis=0)).all()
        assert ((own - tree.pivot[b]) ** 2).sum(axis=1).max() == tree.radius2[b]
        if tree.left[b] >= 0:
            assert sorted([tree.start[b], tree.end[b]]) == sorted([min(tree.start[[tree.left[b], tree.right[b]]]),
                                                                  max(tree.end[[tree.left[b], tree.right[b]]])])
        else:
            assert len(own) <= A.LEAF
    entries = tree.points[rng.integers(0, len(points), 20)]
    entries[7] = entries[3]                                             # equal entries: the lower one wins
    near, count, total, owned = A.nearest(tree, entries)
    want = ((tree.points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (near == want).all()
    assert (count == np.bincount(want, tree.weight, 20)).all()
    for e in range(20):
        assert (total[e] == (tree.points * tree.weight[:, None])[want == e].sum(axis=0)).all()
    if spread >= 200 and n > 1000:
        assert owned > 10                                               # whole balls, not only leaves point by point


def test_dictionary_distances_are_exact():
    rng = np.random.default_rng(9)
    x = rng.integers(-40, 40, (500, 7)).astype(float)
    blocks = [C.distinct(x[:, a:a + C.BLOCK]) for a in range(0, 7, C.BLOCK)]
    chunk = C.Chunk(None, [V.whole(e) for e, _ in blocks], [c for _, c in blocks])
    centres = rng.integers(-40, 40, (5, 7))
    want = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (chunk.distances(centres) == want).all()
    near = want.argmin(axis=1)
    got = chunk.sums(near, 5)
    for c in range(5):
        assert got[c, 0] == (near == c).sum() and (got[c, 1:] == x[near == c].sum(axis=0)).all()
