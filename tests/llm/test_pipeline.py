import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
from test_line_dedup import key  # noqa: E402

import corpus_pipeline as C  # noqa: E402
from ridgeline.llm import compression_quality as Q  # noqa: E402
from ridgeline.llm.shared import materialise  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in C.STAGES:
        out.append(materialise(stage(spark, out[-1], SF), name))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stage_names_and_columns(stages):
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "packing"]
    assert all(sorted(s.columns) == sorted(stages[0].columns) for s in stages[1:-1])


def test_quality_stage_keeps_what_the_classifier_accepts(spark, stages):
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    accepted = {r.doc_id for r in Q.classify(stages[0], lab).where("predicted = 1").collect()}
    assert texts(stages[1]).keys() == accepted and len(accepted) > 800
    good = {r.doc_id for r in lab.where("quality = 1").collect()}
    assert len(good & accepted) > 0.98 * len(good)


def test_line_stage(stages):
    before, after = texts(stages[1]), texts(stages[2])
    holders = {}
    for i, t in before.items():
        for line in t.split("\n"):
            holders.setdefault(key(line), set()).add(i)
    for i, t in before.items():
        kept = [x for x in t.split("\n") if len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)]) == i]
        assert after[i] == "\n".join(kept)
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_near_duplicate_and_benchmark_stages(spark, stages):
    before, after = texts(stages[2]), texts(stages[3])
    groups = brute.jaccard_components(before.items())
    assert after.keys() == {i for i, (_, c) in groups.items() if c == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {d for d, _ in brute.containments(items, after.items())}
    assert leaked and texts(stages[4]).keys() == after.keys() - leaked


def test_packing_stage_holds_every_kept_document(stages):
    pieces = stages[5].collect()
    assert {r.doc_id for r in pieces} == texts(stages[4]).keys()
    total = {}
    for r in pieces:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
        assert r.doc_tokens >= r.start + r.length
    assert all(total[r.doc_id] == r.doc_tokens for r in pieces)


def test_stages_take_empty_tables(spark, stages):
    for _, stage in C.STAGES:
        assert stage(spark, stages[0].limit(0), SF).collect() == []


def test_extra_columns_and_null_rows_pass(spark, stages):
    docs = stages[0].limit(40).selectExpr("*", "1 as n", "'x' as component_id", "2L as pos").unionByName(
        spark.createDataFrame([(None, None, None, None, None, 1, "x", 2)], stages[0].limit(0).selectExpr(
            "*", "1 as n", "'x' as component_id", "2L as pos").schema))
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = materialise(out, "extra")
