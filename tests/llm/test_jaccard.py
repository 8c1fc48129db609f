import os
import random
import sys

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from ridgeline.llm import jaccard_join as J  # noqa: E402

SCHEMA = "doc_id long, text string"


def result(spark, rows, schema=SCHEMA):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_groups(spark.createDataFrame(rows, schema)).collect()}


def made_rows(seed=5):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    base = [[rnd.choice(vocab) for _ in range(rnd.choice([3, 6, 20, 60, 200]))] for _ in range(40)]
    rows, i = [], 0
    passage = [rnd.choice(vocab) for _ in range(55)]
    for b in base:
        for _ in range(rnd.randint(1, 8)):
            w = list(b)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            if rnd.random() < .2:
                w += passage
            rows.append((i, rnd.choice([" ", "\n", "\t "]).join(w).upper() if rnd.random() < .3 else " ".join(w)))
            i += 1
    return rows


def test_matches_brute_force(spark):
    rows = made_rows()
    assert result(spark, rows) == brute.jaccard_components(rows)


def test_test_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_groups(d).collect()}
    assert got == brute.jaccard_components(rows)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two"), (6, "one two three four five"),
            (7, "one two three four five six"), (8, "É é"), (9, "é é"), (None, "one two"), (10, "x" * 200000)]
    out = J.jaccard_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in out}
    assert got == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (1, 6), 7: (2, 7), 8: (1, 8), 9: (1, 9),
                   None: (1, None), 10: (1, 10)}


def test_empty_table_repeated_rows_and_extra_columns(spark):
    assert result(spark, []) == {}
    d = spark.createDataFrame([(1, "a b c d e f", 3, "z"), (1, "a b c d e f", 3, "z"), (2, "a b c d e f", 4, "y")],
                              "doc_id long, text string, n long, component string")
    out = sorted(tuple(r) for r in J.jaccard_groups(d).collect())
    assert out == [(1, 2, 1), (1, 2, 1), (2, 2, 1)]


def test_large_groups_around_the_threshold(spark):
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(i % 9):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    for i in range(160, 240):
        rows.append((i, " ".join([f"y{i}_{k}" for k in range(i % 23)] + passage)))
    assert result(spark, rows) == brute.jaccard_components(rows)


def test_bounds_hold_for_every_linked_pair():
    rnd = random.Random(2)
    for _ in range(3000):
        n = rnd.randint(1, 120)
        extra_a, extra_b = rnd.randint(0, n // 3 + 1), rnd.randint(0, n // 3 + 1)
        both = set(rnd.sample(range(1000), n))
        a = both | {1000 + rnd.randrange(10 ** 6) * 2 for _ in range(extra_a)}
        b = both | {1001 + rnd.randrange(10 ** 6) * 2 for _ in range(extra_b)}
        order = {x: rnd.random() for x in a | b}
        if 4 * len(a & b) < 3 * len(a | b):
            continue
        needed, early = (int(x) for x in J.bounds(len(a), len(b)))
        at = [{x: k for k, x in enumerate(sorted(s, key=order.get))} for s in (a, b)]
        prefix = [J._prefix_len(len(s)) for s in (a, b)]
        count = sum(all(len(s) - p[x] > needed - early and p[x] < q for s, p, q in zip((a, b), at, prefix))
                    for x in a & b)
        assert len(a & b) >= needed and early >= 1 and count >= early
        # the document whose prefix ends first: common in both prefixes, and all behind its own
        lasts = [max(order[x] for x in s if p[x] < q) for s, p, q in zip((a, b), at, prefix)]
        f = 0 if lasts[0] <= lasts[1] else 1
        common = sum(all(p[x] < q for p, q in zip(at, prefix)) for x in a & b)
        assert common + (3 * len((a, b)[f]) + 3) // 4 - 1 >= needed


def test_block_product_needs_no_same_component_pairs():
    import numpy as np
    keys = np.array([1, 1, 1, 1, 2, 2, 3, 3], np.uint64)
    row = np.array([0, 1, 2, 3, 0, 3, 0, 1])
    doc, comp, n = np.array([1, 2, 3, 4]), np.array([1, 1, 1, 4]), np.array([10, 10, 5, 10])
    got = {}
    anything = np.full((len(doc), J.PROFILE), 255, np.uint8)         # profiles that bound nothing
    for out in J.block_product(doc, comp, n, n, n, row, keys, np.zeros(8, np.uint16), anything):
        for a, b, *_, s in zip(*out, strict=True):
            got[int(a), int(b)] = got.get((int(a), int(b)), 0) + int(s)
    assert got == {(1, 4): 2, (2, 4): 1}
    assert not list(J.block_product(doc, comp, n, n, n, row, keys, np.full(8, 5, np.uint16), anything))
    assert not list(J.block_product(doc, comp, n, n, 0 * n, row, keys, np.zeros(8, np.uint16), anything))


def _grouped_texts(rows):
    """Components of (id, text) pairs by comparing all; texts of one id belong together."""
    pairs = sorted({(i, t) for i, t in rows if i is not None}, key=str)
    flat = brute.jaccard_components([(k, t) for k, (_, t) in enumerate(pairs)])
    parent = {i: i for i, _ in pairs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for k, (i, _) in enumerate(pairs):
        a, b = sorted((root(i), root(pairs[flat[k][1]][0])))
        parent[b] = a
    return {(i, t): (flat[k][0], root(i)) for k, (i, t) in enumerate(pairs)}


def _varied(seed):
    rnd = random.Random(seed)
    rows = made_rows(seed)
    ids = [i for i, _ in rows]
    return [(rnd.choice(ids[:40]) if rnd.random() < 0.3 else i, t) for i, t in rows] + [(ids[0], None), (ids[1], " ")]


def test_texts_of_a_repeated_id_keep_their_links(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "xy")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more")]
    assert {i: c for i, (_, c) in result(spark, rows).items()} == {1: 1, 2: 1, 3: 1}
    for rows in (_varied(3), _varied(4), [(5, a), (5, None), (4, a + " more"), (9, None), (9, "")]):
        want = _grouped_texts(rows)
        out = J.jaccard_groups(spark.createDataFrame(rows, SCHEMA)).collect()
        assert len(out) == len(rows)
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in out)
        assert got == sorted((i, *want[i, t]) for i, t in rows)


def test_a_text_of_a_repeated_id_that_is_nobodys_copy_stays(spark):
    a, b, c = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    rows = [(5, a), (5, b), (5, b), (3, a + " more"), (7, c), (8, None), (8, b + " more"), (None, a)]
    out = J.keep_representatives(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, _slot int"))
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(5, b), (5, b), (3, a + " more"), (7, c), (8, None), (None, a)], key=str)


def test_clashing_column_names(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other words stand in this one")]
    clash = "_slot", "row", "id", "text_hash", "component", "_id"
    d = spark.createDataFrame([(*r, *range(6)) for r in rows], "doc_id long, text string, " + ", ".join(f"{c} int" for c in clash))
    out = J.keep_representatives(d)
    assert out.columns == d.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]
    assert {r.component_id for r in J.jaccard_groups(d).collect()} == {1, 3}


def test_profiles_bound_the_overlap():
    import numpy as np
    rng = np.random.default_rng(4)
    for size in (5, 300, 60_000):
        x = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        y = np.concatenate([x[: size // 2], np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))])
        a, b = J.profile(x), J.profile(y)
        bound = J.most_shared(a[None], b[None])[0]
        assert bound >= len(np.intersect1d(x, y))
        if size == 300:
            assert bound < min(len(x), len(y)) and J.most_shared(a[None], a[None])[0] == len(x)
