import math
import os
import random
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from ridgeline.llm import elias_fano as E  # noqa: E402
from ridgeline.llm import kernel as K  # noqa: E402
from ridgeline.llm import lm_trie as L  # noqa: E402


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def expected(rows):
    """{doc_id: (held, n_tokens, n_known, N, base, score before quantising)}"""
    toks = {i: brute.words(t) + [None] for i, t in rows}
    train = [i for i in toks if not held(i)]
    c = Counter(w for i in train for w in toks[i])
    pair = Counter(p for i in train for p in zip(["<s>"] + toks[i][:-1], toks[i]))
    n, v = sum(c.values()), len(c)
    names = {w for t in toks.values() for w in t}
    hashes = {w: int(L.END) if w is None else int(K.word_hashes(_arr(w))[0][0]) for w in names}
    slot = Counter()
    for w, k in c.items():
        slot[hashes[w] >> (64 - L.SKETCH_BITS)] += k

    def prior(u):
        k = len(train) if u == "<s>" else slot[hashes[u] >> (64 - L.SKETCH_BITS)]
        return L.PRIOR * 2 ** (round(2 * math.log2(max(k, 1))) / 2) + L.PRIOR_FLOOR

    def count(u):
        return len(train) if u == "<s>" else c[u]

    out = {}
    for i, t in toks.items():
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)
        score = 0.0
        for u, w in zip(["<s>"] + t[:-1], t):
            p1 = (c[w] - L.DISCOUNT) / n if c[w] else L.DISCOUNT * v / n
            score += math.log10((pair[u, w] + prior(u) * p1) / (count(u) + prior(u)))
        out[i] = (held(i), len(t), sum(c[w] > 0 for w in t), n, base, score)
    return out


def _arr(w):
    import pyarrow as pa
    return pa.array([w.decode()])


def got(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string, train boolean, score double") if rows and len(rows[0]) == 4 \
        else spark.createDataFrame(rows, "doc_id long, text string")
    out = L.score_texts(d, F.crc32(F.col("doc_id").cast("string")) % 7 == 2).collect()
    return {r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in out}


def compare(a, b, tolerance):
    assert a.keys() == b.keys()
    for i in a:
        assert a[i][:4] == b[i][:4], i
        assert a[i][4] == pytest.approx(b[i][4], rel=1e-9, abs=1e-9)
        assert a[i][5] == pytest.approx(b[i][5], abs=tolerance * b[i][1] + 1e-6), i


def made(seed=1, n=120):
    rnd = random.Random(seed)
    vocab = [f"w{int(rnd.paretovariate(.7))}" for _ in range(500)]
    return [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 5, 40, 300])))) for i in range(n)]


def test_matches_the_formula(spark):
    rows = made()
    compare(got(spark, rows), expected(rows), 0.03)


def test_frequent_words_are_dealt_over_shards(spark, monkeypatch):
    rows = made(3)
    plain = got(spark, rows)
    monkeypatch.setattr(L, "HOT_TOKENS", 40)
    monkeypatch.setattr(L, "SHARD_TOKENS", 900)
    compare(got(spark, rows), expected(rows), 0.03)
    assert {i: r[:4] for i, r in got(spark, rows).items()} == {i: r[:4] for i, r in plain.items()}


def test_prior_is_of_the_contexts_own_count(spark, monkeypatch):
    names = [f"n{i}" for i in range(400_000)]
    slot = K.word_hashes(pa.array(names))[0] >> np.uint64(64 - L.SKETCH_BITS)
    rare = names[int(np.flatnonzero(slot[1:] == slot[0])[0]) + 1]       # in the slot of the very frequent n0
    free = [i for i in range(5000) if not held(i)]
    test = [i for i in range(5000, 6000) if held(i)][:3]
    rows = [(i, "n0 " * 40 + f"o{i}") for i in free[:500]] + [(i, f"{rare} after") for i in free[500:503]]
    rows += [(test[0], f"{rare} after"), (test[1], f"{rare} n0"), (test[2], "never after")]
    out = got(spark, rows)
    monkeypatch.setattr(L, "SKETCH_BITS", 64)                           # the expected prior: of one word, not of a slot
    want = expected(rows)
    compare(out, want, 0.03)
    monkeypatch.setattr(L, "SKETCH_BITS", 18)
    monkeypatch.setattr(L, "SHARD_TOKENS", 700)
    monkeypatch.setattr(L, "FREQUENT", 3)
    compare(got(spark, rows), want, 0.03)


def expected3(rows):
    """{doc_id: score of the trigram model before quantising}"""
    toks = {i: brute.words(t) + [None] for i, t in rows}
    train = [i for i in toks if not held(i)]
    c = Counter(w for i in train for w in toks[i])
    c["<s>"] = len(train)
    grams = {i: [(v, u, w) for v, u, w in zip((["<s>", "<s>"] + t)[:len(t)], ["<s>"] + t[:-1], t)] for i, t in toks.items()}
    two = Counter(g[1:] for i in train for g in grams[i])
    three = Counter(g for i in train for g in grams[i])
    pairs = Counter(g[:2] for i in train for g in grams[i])
    n, types = sum(c.values()) - len(train), len(c) - 1

    def p(v, u, w):
        one = (c[w] - L.DISCOUNT) / n if c[w] else L.DISCOUNT * types / n
        m = L.PRIOR * 2 ** (round(2 * math.log2(max(c[u], 1))) / 2) + L.PRIOR_FLOOR
        below = (two[u, w] + m * one) / (c[u] + m)
        return (three[v, u, w] + L.LONGER_PRIOR * below) / (pairs[v, u] + L.LONGER_PRIOR)

    return {i: sum(math.log10(p(*g)) for g in grams[i]) for i in toks}


def got3(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: (r.score, r.n_tokens) for r in L.score_texts(
        d, F.crc32(F.col("doc_id").cast("string")) % 7 == 2, order=3).collect()}


def test_trigrams_match_the_formula(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(i, t + " " + " ".join(rnd.choice(("a b c", "x b d", "w1 w2 w9", "w2 w2 w1")) for _ in range(20))) for i, t in made(5)]
    want = expected3(rows)
    for frequent, shard in ((1000, 3_000_000), (30, 900)):
        monkeypatch.setattr(L, "FREQUENT", frequent)
        monkeypatch.setattr(L, "SHARD_TOKENS", shard)
        out = got3(spark, rows)
        assert out.keys() == want.keys()
        for i, (score, n) in out.items():
            assert score == pytest.approx(want[i], abs=0.03 * n + 1e-6), i


def test_trigrams_know_more_than_one_word_before(spark):
    rows = [(i, "a b c" if k % 2 else "x b d") for k, i in enumerate(i for i in range(4000) if not held(i))]
    right, wrong = [i for i in range(5000, 5100) if held(i)][:2]
    rows += [(right, "a b c"), (wrong, "a b d")]
    three, two = got3(spark, rows), got(spark, rows)
    assert three[right][0] - three[wrong][0] > 1 > abs(two[right][5] - two[wrong][5])


def test_trigrams_without_rows(spark):
    first = next(i for i in range(100) if held(i))
    assert got3(spark, [(first, "a b")])[first] == (0.0, 3)
    with pytest.raises(ValueError):
        L.score_texts(spark.createDataFrame([(1, "a")], "doc_id long, text string"), F.lit(False), order=4)


def test_test_table_beats_the_base_on_held_out_texts(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    out = {r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in L.score_texts(
        d, F.crc32(F.col("doc_id").cast("string")) % 7 == 2).collect()}
    compare(out, expected(rows), 0.03)
    held_out = [r for r in out.values() if r[0]]
    assert sum(r[5] for r in held_out) > sum(r[4] for r in held_out)


def test_probabilities_sum_to_one(spark):
    rows = [(i, t) for i, t in made(7, 30) if not held(i)]
    words = sorted({w.decode() for _, t in rows for w in brute.words(t)})
    probe = next(i for i in range(1000, 2000) if held(i))
    total = 0.0
    ids = [i for i in range(2000, 90000) if held(i)]
    extra = [(ids[k], f"{words[0]} {w}") for k, w in enumerate([*words, "never-seen"])] + [(probe, words[0])]
    out = got(spark, rows + extra)
    # P(w | first word) = P(first, w, end) / (P(first) P(end | w)); compared through the formula's parts
    want = expected(rows + extra)
    for i, _ in extra:
        total += abs(out[i][5] - want[i][5])
    assert total / len(extra) < 0.05


def test_edge_rows(spark):
    first = next(i for i in range(100) if held(i))
    rows = [(None, "a b"), (first, None), (1000, ""), (1001, "a b"), (1001, "a b"), (1002, "x" * 100000)]
    d = spark.createDataFrame([r + (None, 1.0) for r in rows], "doc_id long, text string, train boolean, score double")
    out = L.score_texts(d, F.crc32(F.col("doc_id").cast("string")) % 7 == 2).collect()
    by = sorted((r.doc_id if r.doc_id is not None else -1, r.held_out, r.n_tokens, r.n_known) for r in out)
    trained = [r for r in rows if not held(r[0])]
    n = sum(len(brute.words(t)) + 1 for _, t in trained)
    assert all(r.train_tokens == n for r in out)
    known = {w for _, t in trained for w in brute.words(t)}
    want = sorted((-1 if i is None else i, held(i), len(brute.words(t)) + 1, 1 + sum(w in known for w in brute.words(t)))
                  for i, t in rows)
    assert by == want


def test_empty_table_and_no_training_row(spark):
    assert got(spark, []) == {}
    first = next(i for i in range(100) if held(i))
    out = got(spark, [(first, "a b")])[first]
    assert out[:4] == (True, 3, 0, 0) and out[5] == 0.0 and out[4] == pytest.approx(0.0)


def test_elias_fano_against_search():
    rng = np.random.default_rng(0)
    for u, n in ((100, 50), (1 << 40, 1000), (1 << 63, 5000), (5, 0), (10, 1), (1 << 20, 300000)):
        v = np.sort(rng.integers(0, u, n).astype(np.uint64))
        ef = E.EliasFano(*E.EliasFano.build(v, u))
        x = np.concatenate([v, rng.integers(0, u, 2000).astype(np.uint64)])
        i, equal = ef.successor(x)
        assert (i == np.searchsorted(v, x, "left")).all() and (equal == np.isin(x, v)).all()
        assert (ef.access(np.arange(n)) == v).all()


def test_trie_finds_what_it_holds():
    rng = np.random.default_rng(1)
    w = np.unique(rng.integers(0, 1 << 64, 5000, dtype=np.uint64))
    w = np.unique(np.concatenate([w, w[:300] ^ np.uint64(1)]))
    at = rng.integers(0, len(w), 20000).astype(np.uint64)
    entries = np.unique(at << np.uint64(40) | rng.integers(0, 1 << 40, 20000).astype(np.uint64))
    values = rng.normal(size=len(entries))
    trie = E.MappedTrie(w, np.arange(len(w)), entries.copy(), values, 40)
    number = trie.find_words(np.concatenate([w, rng.integers(0, 1 << 64, 999, dtype=np.uint64)]))
    assert (number[:len(w)] == np.arange(len(w))).all() and (number[len(w):] == -1).all()
    of = (entries >> np.uint64(40)).astype(np.int64)
    first, end = trie.ranges(of)
    ids = entries & np.uint64((1 << 40) - 1)
    assert np.abs(trie.find(first, end, ids) - values).mean() < 0.05
    assert np.isnan(trie.find(first, end, ids ^ np.uint64(1 << 39))).mean() > 0.99
    trie.close()
    assert not os.path.exists(trie.path)
