"""Physical-plan properties the design relies on (pushdown, pruning, no Python in
the scoring path, no unchecked broadcast of row-sized data)."""

import contextlib
import io as _io
import re

from pyspark.sql import functions as F

from ridgeline.operators import prep, split
from ridgeline.plans import tasks
from ridgeline.plans.q_linear import house_fit
from ridgeline.plans.tasks import house_like

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filter_and_projection_reach_the_scan(spark):
    q = prep.outlier_filter(house_like(spark, SF), "l_extendedprice", 90000.0).agg(F.count(F.lit(1)))
    plan = _plan(q)
    assert "LessThanOrEqual(l_extendedprice,90000.0)" in plan
    scan = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema: struct<l_")][0]
    assert "l_shipdate" not in scan and "l_returnflag" not in scan


def test_scoring_stays_in_the_jvm(spark):
    tagged, model = house_fit(spark, SF)
    plan = _plan(tagged.where(F.col("split") == "test").select(model.predict_expr().alias("p")))
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_hash_split_is_narrow(spark):
    plan = _plan(split.hash_split(house_like(spark, SF), ["l_orderkey", "l_linenumber"], 0.2))
    # the split adds no exchange of its own: at most the join's broadcast
    assert plan.count("Exchange") == plan.count("BroadcastExchange")


def test_comment_csv_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    from ridgeline.plans import q_prep

    src = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    src.repartition(5).write.parquet(str(tmp_path / "part.parquet"))
    path = tmp_path / "out"
    monkeypatch.setattr(q_prep.io, "scratch_path", lambda *a: str(path))
    got = q_prep.csv_comment_scan(spark, str(tmp_path)).first()
    parts = [p.read_text() for p in path.glob("part-*")]
    assert sum('"' in t for t in parts) > 1             # the data lines lie in several files
    rows = src.collect()
    assert (got.n, got.key_sum, got.size_sum) == (len(rows), sum(r.p_partkey for r in rows), sum(r.p_size for r in rows))
    prices = [r.p_retailprice for r in rows if r.p_size != 1]
    assert got.n_price == len(prices) and abs(got.price_sum - sum(prices)) < 0.01


def test_text_measures_cut_a_text_once(spark):
    texts = ["", " ", "\t\n ", "a", "Ünï  İstanbul ΣΑΣ ΣΑΣ\tσας\n\n", "\x0b\x0c\ra b c", "A.B,c1 2;3:!?", "\n\nx\nX", "日本 語 x"]
    df = tasks.text_measures(spark.createDataFrame([(t,) for t in [None, *texts]], "text string"))
    plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "regexp" not in plan and "]+" not in plan                # no regular expression: words are cut at a plain blank
    got = {r.text: r[1:] for r in df.collect()}
    assert got[None] == (None, 1.0, None, None, None, None, None, None)
    for t in texts:
        words, n = [w for w in re.split("[ \t\n]+", t) if w], max(len(t), 1)
        distinct = {w for w in re.split("[ \t\n]+", t.lower()) if w}
        k = max(len(words), 1)
        want = (len(t), k, t.count("\n") + 1, sum(map(len, words)) / k, sum(c in tasks.DIGIT_CHARS for c in t) / n,
                sum(c in tasks.PUNCT_CHARS for c in t) / n, len(distinct) / k, sum(c in tasks.UPPER_CHARS for c in t) / n)
        assert got[t] == want, t
