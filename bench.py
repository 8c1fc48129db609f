"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print ONE JSON line.

Each query is timed from an empty cache (no fit shared between queries) until
its result is fully collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "house_gd_eval",       # scan ⋈, hash split, moments, batch GD, scoring, metrics (flagship)
    "gd_compare",          # batch + stochastic + mini-batch GD with draw tables
    "ridge_sweep",         # daily aggregation, exact 3-way split, λ grid from two moment sets
    "logit_gd",            # 2000-iteration logistic GD (one pass per iteration)
    "ova_fit",             # one-vs-all Newton, 10 classes × 5 λ in one kernel pass per step
    "learning_curve",      # 5 stratified subsets × 10 classes
    "correlation_matrix",
    "quantiles",
    "risk_by_band",
    "density_by_class",
    "split_stratified",
    "median_impute",
    "qq_points",
    "roc_points",
    "csv_comment_scan",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from pyspark.sql import SparkSession

    from ridgeline.plans import catalog
    from ridgeline.session import DEFAULT_CONF, ensure_checkpoint_dir
    b = SparkSession.builder.master(f"local[{cpus}]").appName("ridgeline-bench")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = (b.config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
              .config("spark.ui.showConsoleProgress", "false")
              .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    qs = catalog.load_all()
    # warm-up outside the timings: JVM code paths, Python workers, parquet footers
    spark.read.parquet(os.path.join(sf_dir, "region.parquet")).count()
    spark.range(1000).mapInPandas(lambda it: it, "id long").count()
    times, failed = {}, {}
    for n in names:
        catalog.forget()
        spark.catalog.clearCache()
        t0 = time.time()
        try:
            qs[n].fn(spark, sf_dir).collect()
            times[n] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001  (one failing query must not hide the others' times)
            failed[n] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
