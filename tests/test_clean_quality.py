"""Cleaning (C1-C3), expectations (Q1-Q8), request rules."""

import pytest
from pyspark.sql import functions as F

from carelens.operators import clean, quality
from carelens.schemas import RAW_ENCOUNTER_COLUMNS
from tests.test_features import _raw


def test_dedup_and_null_label(spark):
    df = _raw(spark)
    dup = df.where("encounter_id = 'ENC-1'")
    nul = df.where("encounter_id = 'ENC-2'").withColumn("readmitted_30d", F.lit(None).cast("int"))
    out = clean.clean_raw_encounters(dup.unionByName(dup).unionByName(nul))
    assert [r["encounter_id"] for r in out.collect()] == ["ENC-1"]


def test_dedup_without_label(spark):
    df = _raw(spark, with_label=False)
    out = clean.clean_raw_encounters(df.unionByName(df.where("encounter_id = 'ENC-1'")))
    assert out.count() == 2


def test_dedup_keeps_first_by_order(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only")], "encounter_id string, _ingest_seq int, v string")
    got = {r["encounter_id"]: r["v"] for r in clean.dedup_first(df).collect()}
    assert got == {"a": "early", "b": "only"}


def test_null_label_observation(spark):
    from pyspark.sql import Observation
    df = _raw(spark).withColumn("readmitted_30d", F.when(F.col("encounter_id") == "ENC-2", None).otherwise(F.col("readmitted_30d")))
    obs = Observation("clean")
    n = clean.clean_raw_encounters(df, obs).count()
    assert n == 1 and obs.get["dropped_rows"] == 1


def test_an_observed_cleaning_leaves_the_session_to_models(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import Observation

    obs = Observation()
    rows = clean.transform(_raw(spark), obs)
    assert sorted(r["encounter_id"] for r in rows.collect()) == sorted(r["encounter_id"] for r in clean.transform(_raw(spark)).collect())
    assert obs.get == {"dropped_rows": 0, "rows_in": 2}
    x = VectorAssembler(inputCols=["id"], outputCol="features").transform(spark.range(50).selectExpr("id", "cast(id % 2 as double) label"))
    assert LogisticRegression(maxIter=2).fit(x).transform(x).select("probability").first() is not None
    assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("carelens_own_")]


def _suite_result(df):
    return {(r["expectation"], r["column"]): r for r in quality.run_expectations(df).collect()}


def test_suite_passes_on_valid_batch(spark):
    res = _suite_result(_raw(spark))
    assert len(res) == 20 and all(r["success"] for r in res.values())


@pytest.mark.parametrize("col,val", [("age", -5), ("sex", "X")])
def test_suite_fails(spark, col, val):
    df = _raw(spark).withColumn(col, F.when(F.col("encounter_id") == "ENC-1", F.lit(val)).otherwise(F.col(col)))
    res = quality.run_expectations(df)
    failed = [r["column"] for r in res.where(~F.col("success")).collect()]
    assert failed == [col]
    with pytest.raises(quality.ValidationError):
        quality.validation_gate(res)


def test_unique_counts_every_duplicate(spark):
    df = _raw(spark)
    df = df.unionByName(df.where("encounter_id = 'ENC-1'")).unionByName(df.where("encounter_id = 'ENC-1'"))
    res = _suite_result(df)
    r = res[("expect_column_values_to_be_unique", "encounter_id")]
    assert r["unexpected_count"] == 3 and r["success"] is False


def test_missing_column_fails_set(spark):
    res = _suite_result(_raw(spark).drop("bmi"))
    assert res[("expect_table_columns_to_match_set", None)]["success"] is False
    assert res[("expect_column_values_to_be_between", "bmi")]["success"] is False


def test_mostly_label(spark):
    # 1 of 2 labels outside {0,1}: 50% unexpected > 1% allowed
    df = _raw(spark).withColumn("readmitted_30d", F.when(F.col("encounter_id") == "ENC-1", 7).otherwise(0))
    assert _suite_result(df)[("expect_column_values_to_be_in_set", "readmitted_30d")]["success"] is False


def test_quarantine_codes(spark):
    df = _raw(spark).withColumn("bmi", F.when(F.col("encounter_id") == "ENC-2", 2.0).otherwise(F.col("bmi")))
    df = df.unionByName(df.where("encounter_id = 'ENC-1'"))
    got = {(r["encounter_id"], tuple(r["failures"])) for r in quality.quarantine(df).collect()}
    assert ("ENC-2", ("between:bmi",)) in got and ("ENC-1", ("unique:encounter_id",)) in got


def test_request_rules(spark):
    base = _raw(spark).select(*[c for c in RAW_ENCOUNTER_COLUMNS if c in (
        "encounter_id age sex insurance_type admission_type discharge_disposition length_of_stay comorbidity_count "
        "charlson_index prior_admissions_12mo prior_ed_visits_12mo num_medications bmi systolic_bp glucose_level "
        "creatinine").split()])
    bad_age = base.withColumn("age", F.lit(150))
    bad_type = base.withColumn("admission_type", F.lit("Scheduled"))
    assert all(len(r[0]) == 0 for r in base.select(quality.request_failures(base)).collect())
    assert all("range:age" in r[0] for r in bad_age.select(quality.request_failures(bad_age)).collect())
    assert all("in:admission_type" in r[0] for r in bad_type.select(quality.request_failures(bad_type)).collect())


def test_envelope(spark):
    df = spark.createDataFrame([([1],), ([],), (list(range(101)),), (None,)], "data array<int>")
    got = [r[0] for r in df.select(quality.envelope_failures(F.col("data"))).collect()]
    assert got[0] is None and "no records" in got[1] and "at most 100" in got[2] and "no records" in got[3]


def test_dedup_hot_key_and_nulls(spark):
    rows = [("HOT", i, f"v{i}") for i in range(300)] + [(f"K{i}", i, "u") for i in range(200)] + \
        [(None, 5, "n5"), (None, 3, "n3")]
    df = spark.createDataFrame(rows, "encounter_id string, _ingest_seq int, v string")
    got = {r.encounter_id: r.v for r in clean.dedup_first(df).collect()}
    assert len(got) == 202 and got["HOT"] == "v0" and got[None] == "n3" and got["K7"] == "u"
