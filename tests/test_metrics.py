"""Evaluation, fairness, slices and drift: literal cases + brute-force checks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from carelens.operators import drift as dr
from carelens.operators import evaluate as ev
from carelens.operators import fairness as fa


def _scored(spark, y, p):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y_true int, y_prob double")


def test_threshold_metrics_perfect(spark):
    r = ev.threshold_metrics(_scored(spark, [0, 0, 1, 1], [.1, .2, .8, .9]), 0.5).first()
    assert (r.tn, r.fp, r.fn, r.tp) == (2, 0, 0, 2)
    assert r.precision == r.recall == r.specificity == r.f1 == 1.0


def test_threshold_metrics_zero_division(spark):
    r = ev.threshold_metrics(_scored(spark, [0, 0, 1, 1], [.05] * 4), 0.9).first()
    assert r.precision == 0.0 and r.recall == 0.0 and r.tp == 0


def test_calibration_counts(spark):
    y = [0, 0, 1, 1, 0, 1, 0, 1, 1, 0]
    p = [.05, .12, .42, .55, .61, .78, .83, .91, .95, .02]
    rows = ev.calibration(_scored(spark, y, p)).collect()
    assert sum(r["count"] for r in rows) == 10
    assert {r["bin"] for r in rows} == {0, 1, 4, 5, 6, 7, 8, 9}


def test_calibration_edges_left_closed(spark):
    rows = {r["bin"]: r["count"] for r in ev.calibration(_scored(spark, [0, 1, 1], [0.3, 0.30000000000000004, 1.0])).collect()}
    assert rows == {2: 1, 3: 1, 9: 1}  # 0.3 < 0.30000000000000004 (the literal edge) -> bin 2


def test_high_recall_threshold(spark):
    y = [0, 0, 0, 1, 1, 1, 1, 1]
    p = [.05, .1, .3, .4, .6, .7, .8, .95]
    assert ev.high_recall_threshold(_scored(spark, y, p), 0.5).first()[0] == 0.05


def _auc_brute(y, p):
    pos = [b for a, b in zip(y, p) if a == 1]
    neg = [b for a, b in zip(y, p) if a == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def _ap_brute(y, p):
    P = sum(y)
    total = 0.0
    for t in sorted(set(p), reverse=True):
        tp = sum(1 for a, b in zip(y, p) if b >= t and a == 1)
        fp = sum(1 for a, b in zip(y, p) if b >= t and a == 0)
        pos_here = sum(1 for a, b in zip(y, p) if b == t and a == 1)
        total += pos_here / P * tp / (tp + fp)
    return total


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_auc_ap_brier_vs_brute_force(spark, seed):
    rnd = random.Random(seed)
    y = [rnd.randint(0, 1) for _ in range(300)]
    p = [round(rnd.random() * 0.5 + 0.3 * a, 2) for a in y]  # ties on purpose
    df = _scored(spark, y, p)
    assert ev.roc_auc(df).first()["roc_auc"] == pytest.approx(_auc_brute(y, p), abs=1e-12)
    assert ev.average_precision(df).first()["average_precision"] == pytest.approx(_ap_brute(y, p), abs=1e-12)
    assert ev.brier(df).first()[0] == pytest.approx(sum((b - a) ** 2 for a, b in zip(y, p)) / len(y))


def test_distributed_prefix_and_quantiles(spark):
    from carelens.operators import prefix

    rnd = random.Random(7)
    y = [rnd.randint(0, 1) for _ in range(500)]
    p = [rnd.random() for _ in y]  # not quantised
    assert ev.roc_auc(_scored(spark, y, p)).first()["roc_auc"] == pytest.approx(_auc_brute(y, p), abs=1e-12)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), round(rnd.gauss(0, 3), 1)) for _ in range(700)]
    df = spark.createDataFrame(rows, "g string, v double")
    counts = df.groupBy("g", "v").count().withColumnRenamed("count", "n")
    got = {r["g"]: r["q"] for r in prefix.quantiles(counts, "v", [0.0, 0.1, 0.5, 0.95, 1.0], ["g"]).collect()}
    for g in ("a", "b", None):
        vals = sorted(v for k, v in rows if k == g)
        for q, x in zip([0.0, 0.1, 0.5, 0.95, 1.0], got[g]):
            at = q * (len(vals) - 1)
            lo = int(at)
            assert x == pytest.approx(vals[lo] + (at - lo) * (vals[min(lo + 1, len(vals) - 1)] - vals[lo]), abs=1e-9)
    numbered = prefix.with_row_number(df.repartition(5).orderBy("v")).collect()
    assert [r["v"] for r in sorted(numbered, key=lambda r: r["row_no"])] == sorted(v for _, v in rows)
    assert sorted(r["row_no"] for r in numbered) == list(range(1, 701))


def _groups(spark, rows):
    return spark.createDataFrame(rows, "y_true int, y_pred int, sex string")


def test_fairness_zero_difference(spark):
    rows = [(a, a, g) for g in "AB" for a in (0, 1, 0, 1)]
    d = fa.fairness_differences(_groups(spark, rows), ["sex"]).first()
    assert d.demographic_parity_difference == 0.0 and d.equalized_odds_difference == 0.0


def test_fairness_max_difference(spark):
    rows = [(0, 0, "A")] * 4 + [(0, 1, "B")] * 4
    d = fa.fairness_differences(_groups(spark, rows), ["sex"]).first()
    assert d.demographic_parity_difference == 1.0 and d.equalized_odds_difference == 1.0
    assert d.passes_equalized_odds_gate is False


def test_error_rate(spark):
    same = spark.createDataFrame([(a, a) for a in (0, 1, 0, 1)], "y_true int, y_pred int")
    inv = spark.createDataFrame([(a, 1 - a) for a in (0, 1, 0, 1)], "y_true int, y_pred int")
    assert fa.error_rate(same).first()[0] == 0.0 and fa.error_rate(inv).first()[0] == 1.0


def test_slices_shape(spark):
    rnd = random.Random(3)
    cols = ["admission_type", "discharge_disposition", "insurance_type", "age_band", "los_bucket"]
    rows = [(rnd.choice("AB"), rnd.choice("XY"), rnd.choice("PQ"), rnd.choice("12"), rnd.choice("34"),
             rnd.randint(0, 1), rnd.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols) + ", y_true int, y_pred int")
    out = fa.analyze_slices(df, min_slice_size=30).collect()
    singles = [r for r in out if "," not in r.slice_columns]
    assert len(singles) == 10  # 5 columns x 2 values, all >= 30 rows
    assert all(r.flagged for r in out if "," in r.slice_columns)
    rates = [r.error_rate for r in out]
    assert rates == sorted(rates, reverse=True)


def test_promotion_gate(spark):
    m = spark.createDataFrame([(0.60, 0.45, 0.35)], "roc_auc double, pr_auc double, brier_score double")
    d = spark.createDataFrame([("sex", 0.40), ("age_band", 0.95)], "attribute string, equalized_odds_difference double")
    checks = {r.check for r in fa.promotion_gate(m, d).collect()}
    assert checks == {"roc_auc", "brier_score", "equalized_odds_difference[sex]"}
    ok = spark.createDataFrame([(0.80, 0.45, 0.15)], "roc_auc double, pr_auc double, brier_score double")
    d2 = spark.createDataFrame([("sex", 0.05), ("ethnicity", 0.08), ("age_band", 0.30)],
                               "attribute string, equalized_odds_difference double")
    assert fa.promotion_gate(ok, d2).count() == 0


def _cat(spark, counts):
    rows = [(k,) for k, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "sex string")


def test_psi_categorical(spark):
    b = _cat(spark, {"A": 500, "B": 300, "C": 200})
    same = dr.psi_categorical(b, _cat(spark, {"A": 500, "B": 300, "C": 200}), ["sex"]).first().psi
    shifted = dr.psi_categorical(b, _cat(spark, {"A": 100, "B": 100, "C": 800}), ["sex"]).first().psi
    assert abs(same) < 1e-6 and shifted == pytest.approx(1.6953, abs=1e-4)


def test_psi_numeric(spark):
    rnd = random.Random(0)
    base = spark.createDataFrame([(rnd.gauss(50, 10),) for _ in range(1000)], "bmi double")
    shift = spark.createDataFrame([(rnd.gauss(80, 10),) for _ in range(1000)], "bmi double")
    assert abs(dr.psi_numeric(base, base, ["bmi"]).first().psi) < 1e-6
    assert dr.psi_numeric(base, shift, ["bmi"]).first().psi > 0.2
    const = spark.createDataFrame([(1.0,)] * 50, "bmi double")
    assert dr.psi_numeric(const, shift, ["bmi"]).first().psi == 0.0


def test_drift_report(spark):
    rnd = random.Random(1)
    rows = [(rnd.gauss(28, 4), rnd.choice(["M", "F"])) for _ in range(500)]
    base = spark.createDataFrame(rows, "bmi double, sex string")
    cur = base.withColumn("bmi", F.col("bmi") + 50)
    rep = {r.feature: r.drifted for r in dr.drift_report(base, cur).collect()}
    assert rep == {"bmi": True, "sex": False}
    assert not any(r.drifted for r in dr.drift_report(base, base).collect())


def test_ks(spark):
    rnd = random.Random(2)
    a = spark.createDataFrame([(rnd.uniform(0, 0.3),) for _ in range(500)], "p double")
    b = spark.createDataFrame([(rnd.uniform(0.6, 1.0),) for _ in range(500)], "p double")
    r = dr.ks_two_sample(a, b, "p").first()
    assert r.ks_statistic == 1.0 and r.ks_pvalue < 0.01 and r.drift_detected
    same = dr.ks_two_sample(a, a, "p").first()
    assert same.ks_statistic == 0.0 and not same.drift_detected


def test_ks_pvalue_converges(spark):
    """Against a long alternating series; tiny gaps of large samples are no drift."""
    from carelens.operators.prefix import ks_pvalue

    cases = [(0.1, 100, 120), (0.02, 5000, 5000), (0.0001, 50_000, 50_000), (1 / 5_000_000, 5_000_000, 5_000_000), (0.5, 40, 30), (0.0, 5, 5)]
    df = spark.createDataFrame([(d, n, m) for d, n, m in cases], "d double, n long, m long")
    got = [r[0] for r in df.select(ks_pvalue(F.col("d"), F.col("n"), F.col("m"))).collect()]
    for (d, n, m), p in zip(cases, got):
        l2 = d * d * n * m / (n + m)
        want = 1.0 if l2 < 0.005 else min(1, max(0, math.fsum(2 * (-1) ** (k - 1) * math.exp(-2 * k * k * l2) for k in range(1, 2000))))
        assert p == pytest.approx(want, abs=1e-9)
    assert got[3] > 0.99


def test_ks_by_period_is_the_two_sample_test(spark):
    rnd = random.Random(4)
    base = spark.createDataFrame([(round(rnd.random(), 3),) for _ in range(400)], "p double")
    cur = spark.createDataFrame([(m, round(min(1.0, rnd.random() * (1 + 0.1 * m)), 3)) for m in range(4) for _ in range(100 + m)], "m int, p double")
    got = {r.m: tuple(r)[1:] for r in dr.ks_by_period(base, cur, "p", "m").collect()}
    for m in range(4):
        assert got[m] == tuple(dr.ks_two_sample(base, cur.where(F.col("m") == m), "p").first())


def test_rolling_auc(spark):
    none = spark.createDataFrame([(0.5, None)] * 3, "readmission_probability double, readmitted_30d int")
    r = dr.rolling_auc(none).first()
    assert r.n_labeled == 0 and r.roc_auc is None
    df = spark.createDataFrame([(0.9, 0), (0.8, 0), (0.2, 1), (0.1, 1)], "readmission_probability double, readmitted_30d int")
    r = dr.rolling_auc(df).first()
    assert r.n_labeled == 4 and r.roc_auc == 0.0 and r.below_threshold


def test_psi_and_ks_by_period_match_per_period_runs(spark):
    rnd = random.Random(4)
    base = spark.createDataFrame([(rnd.gauss(50, 10), round(rnd.random(), 2)) for _ in range(600)], "bmi double, p double")
    cur_rows = [(m, rnd.gauss(50 + 10 * m, 10), round(rnd.random() ** (1 + m), 2)) for m in range(3) for _ in range(300)]
    cur = spark.createDataFrame(cur_rows, "m int, bmi double, p double")
    per = {r.m: r.psi for r in dr.psi_numeric_by_period(base, cur, ["bmi"], "m").collect()}
    ks = {r.m: (r.ks_statistic, r.ks_pvalue) for r in dr.ks_by_period(base, cur, "p", "m").collect()}
    for m in range(3):
        one = cur.where(F.col("m") == m)
        assert per[m] == pytest.approx(dr.psi_numeric(base, one, ["bmi"]).first().psi, abs=1e-12)
        r = dr.ks_two_sample(base, one, "p").first()
        assert ks[m] == (r.ks_statistic, r.ks_pvalue)


def test_approx_percentiles_close_to_exact(spark):
    from carelens.operators import profile as pr
    rnd = random.Random(8)
    df = spark.createDataFrame([(rnd.gauss(100, 15),) for _ in range(5000)], "x double")
    ex = pr.describe_numeric(df, ["x"]).first()
    ap = pr.describe_numeric(df, ["x"], approx=True).first()
    assert abs(ex.p50 - ap.p50) < 1.0 and abs(ex.p25 - ap.p25) < 1.0 and ex["count"] == ap["count"] == 5000


def test_gate_fails_without_a_metric(spark):
    """A test set of one class has no AUC: the model is not promoted."""
    df = _scored(spark, [0] * 20, [0.1] * 20)
    m = ev.evaluate(df)
    row = m.first()
    assert row.roc_auc is None and not row.passes_roc_auc and not row.passes_pr_auc
    none = spark.createDataFrame([("sex", None)], "attribute string, equalized_odds_difference double")
    got = {r["check"] for r in fa.promotion_gate(m, none).collect()}
    assert got == {"roc_auc", "pr_auc", "equalized_odds_difference[sex]"}
