"""End-to-end training and monitoring runs on the smallest driver tables."""

import os

from pyspark.sql import functions as F

from carelens.operators import telemetry as tm
from carelens.plans import base
from carelens.plans.training import RunConfig, run_monitoring, run_training
from carelens.sources import telemetry as src

SF = "/root/testdata/sf0.001"


def test_training_run(spark, tmp_path):
    raw = base.encounters(spark, SF)
    cfg = RunConfig(out_root=str(tmp_path), cfg={**RunConfig(out_root="").cfg, "min_roc_auc": 0.0, "min_pr_auc": 0.0,
                                                    "max_brier_score": 1.0, "max_equalized_odds_difference": 1.0})
    res = run_training(spark, raw, cfg)
    assert res["rows"] == raw.where("readmitted_30d IS NOT NULL").count()
    assert res["version"] == 1 and res["gate_failures"] == []
    m = res["metrics"]
    assert 0 <= m["roc_auc"] <= 1 and 0 <= m["brier_score"] <= 1
    for rep in ("validation", "metrics", "operating_points", "calibration", "fairness", "slices", "importance"):
        assert os.path.isdir(tmp_path / "reports" / rep)
    assert {r.split for r in spark.read.parquet(str(tmp_path / "curated/features.parquet")).select("split").distinct().collect()} \
        == {"train", "val", "test"}


def test_monitoring_and_drift_alerts(spark, tmp_path):
    s = base.split_features(spark, SF)
    p = base.predictions(spark, SF)
    hist = str(tmp_path / "history")
    out = run_monitoring(spark, s.where("split = 'train'"),
                         s.where("split = 'test'").withColumn("bmi", F.col("bmi") + 50),
                         p.where("split = 'val'"), p.where("split = 'test'"), hist)
    assert out["data_drift"] and "bmi" in out["drifted_features"]
    events = spark.read.parquet(hist)
    ev = spark.read.parquet(f"{SF}/events.parquet")
    alerts = tm.alerts(src.requests_from_events(ev), src.dependencies_from_events(ev), events)
    assert alerts.where("alert = 'DataDriftDetected'").count() == 1
