"""End-to-end runs: training (validate -> features -> split -> train -> evaluate ->
responsible-AI reports -> gate -> register) and monitoring (data drift, model drift,
drift-event history for the alert rules).

Each step is a lazy DataFrame; actions happen only at the validation gate, model fits
and report sinks. Reports are long-form tables written under ``out_root`` (any
Hadoop URI). Independent reports are separate jobs over the same persisted inputs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.operators import contributions as ct
from carelens.operators import drift as dr
from carelens.operators import evaluate as ev
from carelens.operators import fairness as fa
from carelens.operators import model as md
from carelens.operators import quality
from carelens.operators import scoring as sc
from carelens.operators.clean import transform
from carelens.operators.split import temporal_split
from carelens.schemas import DEFAULT_CONFIG
from carelens.session import materialize
from carelens.sources import io


@dataclass
class RunConfig:
    out_root: str
    model_name: str = "readmission-risk-model"
    algorithm: str = "logreg"
    params: dict = field(default_factory=lambda: {"maxIter": 50, "regParam": 0.01})
    cfg: dict = field(default_factory=lambda: dict(DEFAULT_CONFIG))
    tags: dict = field(default_factory=dict)
    enforce_validation: bool = True


def run_training(spark: SparkSession, raw: DataFrame, rc: RunConfig) -> dict:
    """The training lifecycle on a raw encounter table; returns a small summary dict."""
    c = rc.cfg
    out = rc.out_root.rstrip("/")
    # validate (Q1-Q7): the gate blocks features, unlike a DAG that runs them in parallel
    results = quality.run_expectations(raw)
    io.write_report(results, f"{out}/reports/validation")
    if rc.enforce_validation:
        quality.validation_gate(io.read_report(spark, f"{out}/reports/validation", results))
    # features + split, persisted once (S5); later steps read the partitioned table
    feats = temporal_split(materialize(transform(raw), "features"), c["train_fraction"], c["validation_fraction"])
    info = io.persist_splits(feats, f"{out}/curated/features", replace="all")
    splits = spark.read.parquet(info["path"])
    train, val, test = (splits.where(F.col("split") == s) for s in ("train", "val", "test"))
    model = md.train_model(train, val if rc.algorithm == "gbt" else None, md.TrainSpec(rc.algorithm, rc.params))
    scored = md.predict_proba(model, test).withColumn("y_true", F.col("readmitted_30d").cast("int")) \
        .withColumn("y_pred", (F.col("y_prob") >= c["decision_threshold"]).cast("int"))
    scored_path = f"{out}/curated/test_scores.parquet"
    scored.write.mode("overwrite").parquet(scored_path)
    scored = spark.read.parquet(scored_path)
    metrics = ev.evaluate(scored, c["decision_threshold"], c["high_recall_precision_floor"], c["min_roc_auc"],
                          c["min_pr_auc"], c["max_brier_score"])
    io.write_report(metrics, f"{out}/reports/metrics")
    io.write_report(ev.operating_points(scored, c["decision_threshold"], c["high_recall_precision_floor"]),
                    f"{out}/reports/operating_points")
    io.write_report(ev.calibration(scored), f"{out}/reports/calibration")
    diffs = fa.fairness_differences(scored, max_eod=c["max_equalized_odds_difference"])
    io.write_report(fa.group_metrics(scored), f"{out}/reports/fairness_groups")
    io.write_report(diffs, f"{out}/reports/fairness")
    io.write_report(fa.analyze_slices(scored, c["min_slice_size"], c["elevation_factor"]), f"{out}/reports/slices")
    if rc.algorithm == "logreg":
        contrib = ct.linear_contributions(model, test, train)
        io.write_report(ct.global_importance(contrib), f"{out}/reports/importance")
    m = io.read_report(spark, f"{out}/reports/metrics", metrics)
    d = io.read_report(spark, f"{out}/reports/fairness", diffs)
    gate = fa.promotion_gate(m, d, c["min_roc_auc"], c["min_pr_auc"], c["max_brier_score"],
                             c["max_equalized_odds_difference"])
    failures = [r["reason"] for r in gate.collect()]  # at most a handful of checks
    version = None
    if not failures:
        version = sc.register(spark, model, f"{out}/models", f"{out}/registry", rc.model_name, m, gate, rc.tags)
    return {"rows": info["rows"], "gate_failures": failures, "version": version,
            "metrics": m.first().asDict()}


def run_monitoring(spark: SparkSession, baseline: DataFrame, current: DataFrame, baseline_pred: DataFrame,
                   current_pred: DataFrame, history_path: str, cfg: dict | None = None) -> dict:
    """Data drift (D4) + model drift (D7); both outcomes appended as events to the history
    table that the drift alerts (L4, L5) read."""
    c = cfg or DEFAULT_CONFIG
    report = dr.drift_report(baseline, current, c["psi_threshold"])
    summary = dr.drift_summary(report, baseline, current).first()
    ks = dr.ks_two_sample(baseline_pred, current_pred, "readmission_probability", c["ks_pvalue_threshold"])
    model_flag = dr.model_drift(ks, dr.rolling_auc(current_pred, min_roc_auc=c["min_roc_auc"])).first()
    events = spark.createDataFrame(
        [("DataDriftReport", bool(summary["drift_detected"])), ("ModelDriftReport", bool(model_flag["model_drift_detected"]))],
        "name string, drift_detected boolean").withColumn("timestamp", F.current_timestamp())
    events.write.mode("append").parquet(history_path)
    return {"data_drift": bool(summary["drift_detected"]), "drifted_features": list(summary["drifted_features"]),
            "model_drift": bool(model_flag["model_drift_detected"])}
