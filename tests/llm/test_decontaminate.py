import os
import random
import sys

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from ridgeline.llm import decontaminate as D  # noqa: E402

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def frames(spark, rows, items):
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)


def got(spark, rows, items, **kw):
    out = D.find_leaks(*frames(spark, rows, items), **kw).collect()
    return {(r.doc_id, r.item_id): (r.shared, r.item_shingles) for r in out}


def made(seed=3):
    rnd = random.Random(seed)
    vocab = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([3, 5, 6, 9, 15, 40, 59])))) for i in range(40)]
    rows = []
    for d in range(120):
        w = [rnd.choice(vocab) for _ in range(rnd.choice([0, 4, 30, 900]))]
        for _ in range(rnd.randint(0, 2)):
            x = rnd.choice(items)[1].split()
            for _ in range(rnd.choice([0, 0, 1, 2])):
                x[rnd.randrange(len(x))] = "edited"
            cut = rnd.randrange(len(x) + 1) if rnd.random() < .3 else 0     # in two places of the text
            w = x[:cut] + w + x[cut:] if rnd.random() < .5 else w + x
        rows.append((d, " ".join(w).upper() if d % 5 == 0 else "\n".join(w)))
    return rows, items


def test_matches_brute_force(spark):
    rows, items = made()
    assert got(spark, rows, items) == brute.containments(items, rows)


def test_several_slices_give_the_same(spark):
    rows, items = made(4)
    assert got(spark, rows, items, slice_bytes=1500) == brute.containments(items, rows)


def test_test_table_misses_nothing(spark):
    d, b = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    rows, items = [(r.doc_id, r.text) for r in d.collect()], [(r.item_id, r.text) for r in b.collect()]
    want = brute.containments(items, rows)
    out = {(r.doc_id, r.item_id): (r.shared, r.item_shingles) for r in D.find_leaks(d, b).collect()}
    assert out == want and want


def test_drop_leaks_keeps_clean_rows(spark):
    rows, items = made(5)
    bad = {d for d, _ in brute.containments(items, rows)}
    docs, bench = frames(spark, rows, items)
    kept = [r.doc_id for r in D.drop_leaks(docs, bench).collect()]
    assert sorted(kept) == sorted(d for d, _ in rows if d not in bad)
    assert sorted(r.doc_id for r in D.drop_leaks(docs, bench, slice_bytes=1000).collect()) == sorted(kept)


def test_edge_rows(spark):
    item = "a b c d e f g"
    rows = [(1, None), (2, ""), (None, item), (3, item.upper()), (3, item.upper()), (4, "x " * 50000 + item), (5, "one two")]
    items = [(1, item), (1, item), (2, None), (3, " "), (None, "one two"), (4, "three four")]
    out = sorted(((r.doc_id or -1), (r.item_id or -1), r.containment) for r in D.find_leaks(*frames(spark, rows, items)).collect())
    assert out == [(-1, 1, 1.0), (3, 1, 1.0), (3, 1, 1.0), (4, 1, 1.0), (5, -1, 1.0)]
    assert got(spark, [], items) == {} and got(spark, rows, []) == {}
    extra = spark.createDataFrame([(1, item, 5, "n")], "doc_id long, text string, item_id long, shared string")
    out = D.find_leaks(extra, spark.createDataFrame([(9, item, 1)], ITEMS + ", doc_id long")).collect()
    assert [(r.doc_id, r.item_id) for r in out] == [(1, 9)]
    assert D.drop_leaks(extra, frames(spark, [], [(9, "q r s t u v")])[1]).collect() == extra.collect()
