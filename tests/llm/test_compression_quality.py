import random
import zlib

import pytest
from pyspark.sql import functions as F

from ridgeline.llm import compression_quality as Q


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.1"
    d, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    return Q.classify(d, lab).join(lab.select("doc_id", "quality"), "doc_id", "left").toPandas()


def test_held_out_accuracy(scored):
    assert scored.score.between(0, 1).all()
    assert (scored.held_out == scored.doc_id.map(held)).all()
    assert (scored.predicted == (scored.score >= 0.3)).all()
    x = scored[scored.held_out & scored.quality.notna()]
    good, bad = x[x.quality == 1].score, x[x.quality == 0].score
    auc = sum((good > b).mean() + (good == b).mean() / 2 for b in bad) / len(bad)
    assert auc > 0.98 and (good >= 0.3).mean() > 0.98 and (bad < 0.3).mean() > 0.85
    assert abs(x.score.mean() - x.quality.mean()) < 0.05        # calibrated


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    sf = "/root/testdata/sf0.01"
    d, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = Q.fit(d, lab.where(Q.bucket(F.col("doc_id"), 5) != 0))
    other = lab.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = Q.fit(d.withColumn("lang", F.lit("zz")), other.where(Q.bucket(F.col("doc_id"), 5) != 0))
    assert out == again


def rows(n=60):
    rnd = random.Random(1)
    good = [" ".join(rnd.choice(["plain", "words", "of", "prose", "here"]) for _ in range(80)) for _ in range(n)]
    bad = ["".join(rnd.choice("#$%&*!") for _ in range(400)) for _ in range(n)]
    return [(i, t) for i, t in enumerate(x for p in zip(good, bad, strict=True) for x in p)]


def test_edge_rows(spark):
    base = rows()
    extra = [(500, None), (501, ""), (None, "words of prose"), (502, "plain words of prose here " * 20000), (502, "x"), (503, "x")]
    d = spark.createDataFrame([r + (1.0, "s") for r in base + extra], "doc_id long, text string, score double, part string")
    lab = spark.createDataFrame([(i, 1 - i % 2) for i, _ in base] + [(None, 1), (3, None), (9999, 1), (0, 1)], "doc_id long, quality int")
    out = Q.classify(d, lab).collect()
    assert len(out) == len(base) + len(extra)
    by = {r.doc_id: r for r in out}
    assert all(by[i].predicted == 1 - i % 2 for i, _ in base)
    assert by[500].score == by[501].score and 0 <= by[500].score <= 1 and by[None].held_out is False
    kept = Q.keep_good(d, lab)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} >= {i for i, _ in base if i % 2 == 0}


def test_few_or_no_labels_and_no_documents(spark):
    d = spark.createDataFrame(rows(), "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in Q.classify(d, none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 0) for i in range(50)], "doc_id long, quality int")
    assert {r.score for r in Q.classify(d, one).collect()} == {0.0}
    assert Q.classify(d.limit(0), one).collect() == []


def test_sizes_cover_the_whole_text():
    model = Q.Model(b"good words " * 50, b"#$%& " * 100, [], [], [])
    c = Q.Compressor(model)
    n, good, bad = c.sizes("a" * 5000 + "zqj" * 100)
    assert n == 5300 and c.sizes("")[0] == 0 and c.sizes("a" * 5000)[1] < good


def test_keep_good_keeps_a_column_named_like_ours(spark):
    docs = spark.createDataFrame([(1, "some text", 5.0), (2, None, 6.0)], "doc_id long, text string, _score double")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = Q.keep_good(docs, labels)
    assert out.columns == docs.columns and sorted(r._score for r in out.collect()) == [5.0, 6.0]
