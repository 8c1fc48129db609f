"""Streaming scoring equals batch scoring; running metrics equal batch metrics."""

import numpy as np
import pandas as pd
import pytest

from ridgeline.operators import evaluate, linear
from ridgeline.streaming import scoring


def test_stream_scoring_matches_batch(spark, tmp_path):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"id": np.arange(300), "a": rng.normal(size=300), "b": rng.normal(size=300)})
    pdf["y"] = 3 * pdf.a - 2 * pdf.b + rng.normal(0, 0.1, 300)
    df = spark.createDataFrame(pdf)
    model = linear.fit_batch_gd(df, ["a", "b"], "y", lr=0.1, max_iter=300)
    src = str(tmp_path / "src")
    df.repartition(3).write.parquet(src)          # three files arrive as the stream's input
    stream = scoring.score(scoring.file_stream(spark, src, df.schema), model.predict_expr(), "pred")
    q = scoring.write_files(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("id").toPandas()
    want = df.withColumn("pred", model.predict_expr()).orderBy("id").toPandas()
    assert np.allclose(got.pred, want.pred)

    metrics = scoring.running_metrics(stream, "y", "pred")
    mq = metrics.writeStream.format("memory").queryName("rl_metrics").outputMode("complete").start()
    mq.processAllAvailable()
    mq.stop()
    m = spark.sql("SELECT * FROM rl_metrics").collect()[0]
    b = evaluate.regression_metrics(df.withColumn("pred", model.predict_expr()), "y", "pred").collect()[0]
    assert m["n"] == 300 and m["mse"] == pytest.approx(b["mse"]) and m["r2"] == pytest.approx(b["r2"])


def test_windowed_running_metrics(spark, tmp_path):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, 1, h, m), float(v), float(v) + d)
            for h in (0, 1) for m, v, d in ((5, 1.0, 0.5), (20, 2.0, -0.5), (40, 4.0, 0.0))]
    df = spark.createDataFrame(rows, "ts timestamp, y double, pred double")
    src = str(tmp_path / "ev")
    df.write.parquet(src)
    stream = scoring.file_stream(spark, src, df.schema)
    m = scoring.running_metrics(stream, "y", "pred", event_time="ts", window="1 hour", watermark="1 hour")
    q = m.writeStream.format("memory").queryName("rl_win").outputMode("update").start()
    q.processAllAvailable()
    q.stop()
    got = {r["window"]["start"].hour: r for r in spark.sql("SELECT * FROM rl_win").collect()}
    assert set(got) == {0, 1}
    assert got[0]["n"] == 3 and got[0]["mse"] == pytest.approx((0.25 + 0.25 + 0.0) / 3)
