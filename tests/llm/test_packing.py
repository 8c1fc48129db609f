import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ridgeline.llm import packing as P
from ridgeline.llm.word_bpe import WordBpe

ODD = ["it's", "don't", "X'LLY", "×a", "÷", "naïve—x", "日本", "Ünï", "ÀÉß÷×", "İ", "ΣΑΣ", "a1b22c", "!!??", "hello,world", "<|endoftext|>",
       "a<|endoftext|>b", "<|ENDOFTEXT|>", "\x00a", "\x7f", "a\xa0b", " ", "😀x", "ÿŸ", "Ã", "1234567890", "ä", "́", "\x1c", "é", "the", "."]


@pytest.fixture(scope="module")
def bpe():
    return WordBpe(P.tokenizer_path())


def check_ids(bpe, texts):
    ids, first, _ = P.encode(pa.array(texts), bpe)
    want = [e.ids for e in bpe.library.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=6)), max_size=8), min_size=1, max_size=5), st.sampled_from([" ", "\n", "\t ", ""]))
def test_ids_are_the_library_s(bpe, pieces, sep):
    check_ids(bpe, [sep.join(p).encode("utf-8", "ignore").decode() for p in pieces])


def test_ids_on_the_test_table(spark, bpe):
    check_ids(bpe, [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()])


def least_cost(cuts, cost):
    best = [0.0]
    for j in range(1, len(cuts)):
        low = float("inf")
        for i in range(j):
            n = cuts[j] - cuts[i]
            if n <= P.LENGTH:
                low = min(low, best[i] + (0 if n in P.POWERS else P.LENGTH - n) + cost[j] + P.SEQUENCE_COST)
        best.append(low)
    return best[-1]


def test_windows_are_the_cheapest():
    rnd = random.Random(2)
    for _ in range(30):
        docs = []
        for _ in range(rnd.randint(1, 12)):
            n = rnd.choice([1, 40, 700, 2048, 5000, 12000])
            docs.append((n, np.array(sorted(rnd.sample(range(1, n + 1), min(n, rnd.randint(0, 60)))))))
        cuts, cost = P.cut_points(docs)
        assert cuts[-1] == sum(n for n, _ in docs) and all(0 < b - a <= P.LENGTH for a, b in zip(cuts, cuts[1:]))
        ends = P.best_windows(cuts, cost)
        total, start = 0.0, 0
        for j in ends:
            n = cuts[j] - cuts[start]
            assert n <= P.LENGTH
            total += (0 if n in P.POWERS else P.LENGTH - n) + cost[j] + P.SEQUENCE_COST
            start = j
        assert start == len(cuts) - 1 and total == pytest.approx(least_cost(cuts, cost))


def verify(spark, rows, out, library):
    """Every id in one piece, pieces in order, sequences gapless; gives the share of padding."""
    ids = [np.array(library.encode(t or "", add_special_tokens=False).ids + [P.END_ID], np.uint32) for _, t in rows]
    want = sorted((i if i is not None else -1, zlib.crc32(x.astype("<u4").tobytes()), len(x)) for (i, _), x in zip(rows, ids))
    by_doc, by_seq = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id if r.doc_id is not None else -1, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    texts = {}
    for (i, _), x in zip(rows, ids):
        texts.setdefault(i if i is not None else -1, []).append(x)
    assert set(by_doc) == {w[0] for w in want}
    for i, pieces in by_doc.items():
        assert sum(p.length for p in pieces) == sum(len(x) for x in texts[i])
        if len(texts[i]) == 1:
            x, at = texts[i][0], 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(x)
                assert p.ids_crc32 == zlib.crc32(x[at:at + p.length].astype("<u4").tobytes())
                at += p.length
    padding = tokens = 0
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= P.LENGTH
        tokens += at
        padding += 0 if at & (at - 1) == 0 else P.LENGTH - at
    return padding / max(tokens, 1)


def test_whole_table(spark, bpe):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    out = P.pack(d).collect()
    assert verify(spark, rows, out, bpe.library) < 0.02
    order = {i: k for k, (i, _) in enumerate(rows)}
    stream = sorted(out, key=lambda r: (r.sequence_id, r.offset))
    assert [order[r.doc_id] for r in stream] == sorted(order[r.doc_id] for r in stream)      # input order


def test_segments_are_joined(spark, bpe, monkeypatch):
    rnd = random.Random(3)
    rows = [(k, " ".join(rnd.choice(["alpha", "beta.", "gamma,", "delta"]) for _ in range(rnd.choice([3, 400, 9000])))) for k in range(60)]
    monkeypatch.setattr(P, "SEGMENT", 60_000)
    packer, out = P.Packer(0), []
    for i, t in rows:
        ids, _, stops = P.encode(pa.array([t]), bpe)
        out += packer.add(i, np.append(ids, np.uint32(P.END_ID)), stops)
    out += packer.solve(True)
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    from types import SimpleNamespace
    assert verify(spark, rows, [SimpleNamespace(**dict(zip(names, r))) for r in out], bpe.library) < 0.05


def test_edge_rows(spark, bpe):
    rows = [(1, None), (2, ""), (None, "a b."), (3, "no sentence end " * 9000), (4, "same"), (4, "same"), (5, "x" * 50000)]
    d = spark.createDataFrame([r + (1, "z") for r in rows], "doc_id long, text string, start long, sequence_id string").coalesce(1)
    verify(spark, rows, P.pack(d).collect(), bpe.library)
    assert P.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
