"""Literal feature cases."""

from pyspark.sql import functions as F

from carelens.functions import features as fx
from carelens.operators.clean import engineer_features


def _col(spark, values, expr, typ="int"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_age_band(spark):
    got = _col(spark, [0, 17, 18, 39, 40, 64, 65, 79, 80, 105, None, 201], fx.age_band)
    assert got == ["<18", "<18", "18-39", "18-39", "40-64", "40-64", "65-79", "65-79", "80+", "80+", None, None]


def test_los_bucket(spark):
    got = _col(spark, [0, 2, 3, 5, 6, 10, 11, 30], fx.los_bucket)
    assert got == ["0-2", "0-2", "3-5", "3-5", "6-10", "6-10", "11+", "11+"]


def test_comorbidity_score(spark):
    df = spark.createDataFrame([(0, 0.0), (2, 1.0), (10, 5.0)], "c int, ch double")
    assert [r[0] for r in df.select(fx.comorbidity_score("c", "ch")).collect()] == [0.0, 1.4, 7.0]


def test_utilization_rate(spark):
    df = spark.createDataFrame([(0, 0), (6, 6), (12, 0)], "a int, e int")
    assert [r[0] for r in df.select(fx.prior_utilization_rate("a", "e")).collect()] == [0.0, 1.0, 1.0]


def test_polypharmacy(spark):
    assert _col(spark, [0, 4, 5, 6, None], fx.polypharmacy_flag) == [False, False, True, True, False]


def test_risk_tier(spark):
    got = _col(spark, [0.0, 0.19, 0.1999, 0.20, 0.35, 0.50, 0.5001, 1.0], fx.risk_tier, "double")
    assert got == ["low", "low", "low", "medium", "medium", "medium", "high", "high"]


def _raw(spark, with_label=True, with_discharge=True):
    cols = ("encounter_id string, patient_id string, admit_date string, discharge_date string, age int, sex string, "
            "ethnicity string, insurance_type string, admission_type string, discharge_disposition string, "
            "length_of_stay int, primary_diagnosis_code string, comorbidity_count int, charlson_index double, "
            "prior_admissions_12mo int, prior_ed_visits_12mo int, num_medications int, bmi double, "
            "systolic_bp double, glucose_level double, creatinine double, readmitted_30d int")
    rows = [("ENC-1", "P-1", "2024-01-01", "2024-01-08", 72, "F", "White", "Medicare", "Emergency", "SNF", 7, "I50",
             3, 2.0, 2, 1, 8, 28.5, 130.0, 110.0, 1.1, 1),
            ("ENC-2", "P-2", "2024-01-03", "2024-01-05", 45, "M", "Black", "Private", "Elective", "Home", 2, "J18",
             0, 0.0, 0, 0, 3, 24.0, 120.0, 95.0, 0.9, 0)]
    df = spark.createDataFrame(rows, cols)
    if not with_label:
        df = df.drop("readmitted_30d")
    if not with_discharge:
        df = df.drop("discharge_date")
    return df


def test_engineer_features_row0(spark):
    out = engineer_features(_raw(spark)).collect()
    r0 = [r for r in out if r["encounter_id"] == "ENC-1"][0]
    assert r0["age_band"] == "65-79" and r0["los_bucket"] == "6-10" and r0["polypharmacy_flag"] is True


def test_engineer_features_columns(spark):
    cols = engineer_features(_raw(spark)).columns
    assert cols[1] == "discharge_date" and cols[-2:] == ["ethnicity", "readmitted_30d"]
    no_eth = engineer_features(_raw(spark), keep_ethnicity=False).columns
    assert "ethnicity" not in no_eth
    bare = engineer_features(_raw(spark, with_label=False, with_discharge=False)).columns
    assert "readmitted_30d" not in bare and "discharge_date" not in bare and bare[0] == "encounter_id"
