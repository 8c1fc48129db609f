"""The four end-to-end jobs on small hand-made inputs of the reference schemas."""

import os

import numpy as np
import pandas as pd

from ridgeline.plans import jobs


def written(out, names):
    for n in names.split():
        assert any(f.endswith(".json") and os.path.getsize(os.path.join(out, n, f)) for f in os.listdir(os.path.join(out, n))), n


def test_house_job(spark, tmp_path):
    rng = np.random.default_rng(7)
    n = 240
    area = rng.uniform(40, 180, n)
    rooms = rng.integers(1, 5, n)
    living = rng.integers(1, 3, n)
    floor = rng.integers(1, 31, n)
    dist = rng.uniform(0.1, 5.0, n)
    price = 2.0 * area + 15 * rooms + 5 * living + 0.5 * floor - 8 * dist + rng.normal(0, 5, n)
    lines = ["# house table", "area,room_num,living_room_num,floor,distance_subway,price", ""]
    lines += [f"  {a:.2f},{r},{l},{f},{d:.3f},{p:.2f}  # row" for a, r, l, f, d, p in zip(area, rooms, living, floor, dist, price)]
    lines += ["250,3,1,5,1.0,600", "bad,2,1,3,1.0,200"]
    src = tmp_path / "house.txt"
    src.write_text("\n".join(lines) + "\n")
    df = jobs.house_from_csv(spark, str(src))
    out = str(tmp_path / "out")
    s = jobs.house_job(spark, df, out, iters=300)
    assert s["metrics"]["r2"] > 0.9
    assert os.path.isdir(os.path.join(out, "evaluation", "qq_points"))
    assert spark.read.json(os.path.join(out, "training", "history")).count() == 9
    written(out, """profile/summary profile/price_quantiles profile/area_quantiles profile/correlation profile/target_correlation
        profile/price_hist profile/area_hist profile/area_price_bins profile/distance_subway_price_bins profile/floor_price_bins
        profile/room_num_price_bins profile/box_by_rooms profile/box_by_floor training/history evaluation/metrics
        evaluation/predictions evaluation/range evaluation/price_hist evaluation/pred_hist evaluation/residual_hist
        evaluation/rel_error_pct_hist evaluation/qq_points evaluation/qq_line features/importance training/summary""")
    assert s["n_train"] + s["n_test"] == 241 and s["n_test"] == 49      # the 250 m² row is filtered before the split
    audit = {r.stage: r.rows for r in spark.read.json(os.path.join(out, "training", "row_audit")).collect()}
    assert audit == {"loaded": 242, "cleaned": 241, "train": 192, "test": 49}
    jobs.house_job(spark, df, out + "-train", iters=20, impute_scope="train")
    audit = {r.stage: r.rows for r in spark.read.json(os.path.join(out + "-train", "training", "row_audit")).collect()}
    assert audit["loaded"] == 242 and audit["cleaned"] == audit["train"] + audit["test"] <= 242


def test_sales_job(spark, tmp_path):
    rng = np.random.default_rng(8)
    days = pd.date_range("2023-01-01", periods=120, freq="D")
    pdf = pd.DataFrame({"date": days.strftime("%Y-%m-%d"), "price": rng.uniform(1999, 3999, 120),
                        "promotion": rng.integers(0, 2, 120).astype(float), "ad_spend": rng.uniform(500, 5000, 120),
                        "user_rating": rng.uniform(3.0, 4.9, 120), "holiday": rng.integers(0, 2, 120).astype(float)})
    pdf["sales"] = 300 - 0.05 * pdf.price + 40 * pdf.promotion + 0.03 * pdf.ad_spend + rng.normal(0, 5, 120)
    src = str(tmp_path / "sales")
    spark.createDataFrame(pdf).coalesce(1).write.option("header", True).csv(src)
    df = jobs.sales_from_csv(spark, src)
    s = jobs.sales_job(spark, df, str(tmp_path / "out"))
    written(str(tmp_path / "out"), """profile/box_by_promotion profile/ad_sales_bins training/lambda_sweep training/weight_path
        features/importance features/sensitivity features/effects features/impacts features/advice evaluation/predictions
        evaluation/trainval_residual_hist evaluation/test_residual_hist evaluation/test_rel_error_pct_hist
        evaluation/qq_points evaluation/qq_line training/summary""")
    assert s["n_test"] == 18 and s["metrics"]["r2"] > 0.8 and s["best_lambda"] in s["lambdas"]


def test_diabetes_job(spark, tmp_path):
    rng = np.random.default_rng(9)
    n = 200
    raw = pd.DataFrame({k: rng.uniform(0, 1, n) for k in jobs.DIABETES_RENAME})
    raw["plas"] = rng.uniform(60, 180, n)
    raw["mass"] = rng.uniform(18, 45, n)
    raw["age"] = rng.integers(19, 70, n).astype(float)
    z = 0.05 * (raw.plas - 120) + 0.1 * (raw.mass - 30) + rng.normal(0, 1, n)
    raw["class"] = np.where(z > 0, "tested_positive", "tested_negative")
    df = jobs.diabetes_prepare(spark.createDataFrame(raw))
    s = jobs.diabetes_job(spark, df, str(tmp_path / "out"), iters=50)
    written(str(tmp_path / "out"), """profile/class_balance profile/risk_by_band profile/correlation profile/density_Pregnancies
        profile/density_BloodPressure profile/density_Insulin profile/density_DiabetesPedigreeFunction profile/density_age_all
        profile/age_hist profile/glucose_box profile/glucose_bmi_bins training/history evaluation/confusion evaluation/roc
        evaluation/decision_surface features/importance training/summary""")
    record = spark.read.json(str(tmp_path / "out" / "training" / "summary")).first()
    assert record.metrics["auc"] == s["auc"]
    assert 0.5 < s["accuracy"] <= 1.0 and 0.5 < s["auc"] <= 1.0


def test_digits_job(spark, tmp_path):
    rng = np.random.default_rng(10)
    n, k = 300, 16
    lab = rng.integers(0, 3, n)
    centers = rng.normal(0, 3, (3, k))
    X = centers[lab] + rng.normal(0, 1, (n, k))
    df = spark.createDataFrame([(int(i), [float(v) for v in X[i]], int(lab[i])) for i in range(n)],
                               "id long, features array<double>, label int")
    s = jobs.digits_job(spark, df, str(tmp_path / "out"), id_cols=["id"], classes=[0, 1, 2])
    assert s["accuracy"] > 0.8
    lc = spark.read.json(str(tmp_path / "out" / "training" / "learning_curve")).count()
    assert lc == 10
