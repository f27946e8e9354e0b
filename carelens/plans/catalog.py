"""Query catalog: one Spark query per operator family, each with a DuckDB twin.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``SQL[name]`` (absent for operators
with no SQL form). Computed columns carry the same alias on both sides; doubles are
rounded to 6 decimals on both sides unless the operator itself rounds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.operators import clean, quality, split
from carelens.plans import base
from carelens.plans.oracle import ENC, FEAT, SPLIT, with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- cohort and labels

@register("readmission_by_cohort", with_ctes(ENC, FEAT) + """
SELECT age_band, los_bucket, count(*) AS n_encounters,
       round(avg(CAST(readmitted_30d AS DOUBLE)), 6) AS readmission_rate,
       round(avg(prior_utilization_rate), 6) AS mean_prior_utilization
FROM feat GROUP BY age_band, los_bucket""")
def readmission_by_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: readmission rate by age band and length-of-stay bucket (flagship)."""
    f = base.features(spark, sf_dir)
    return (f.groupBy("age_band", "los_bucket")
            .agg(F.count(F.lit(1)).alias("n_encounters"),
                 F.round(F.avg(F.col("readmitted_30d").cast("double")), 6).alias("readmission_rate"),
                 F.round(F.avg("prior_utilization_rate"), 6).alias("mean_prior_utilization")))


@register("label_30d", with_ctes(ENC) + """
SELECT encounter_id, patient_id, admit_date, discharge_date, readmitted_30d FROM enc""")
def label_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look-ahead 30-day readmission label of every encounter."""
    return base.encounters(spark, sf_dir).select("encounter_id", "patient_id", "admit_date", "discharge_date",
                                                 "readmitted_30d")


@register("prior_utilization", with_ctes(ENC) + """
SELECT encounter_id, prior_admissions_12mo, prior_ed_visits_12mo FROM enc""")
def prior_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prior admissions / ED visits of the same patient in the previous 365 days."""
    return base.encounters(spark, sf_dir).select("encounter_id", "prior_admissions_12mo", "prior_ed_visits_12mo")


@register("raw_encounters", with_ctes(ENC) + "SELECT * FROM enc")
def raw_encounters_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 + S1: the full raw encounter table assembled from the driver tables."""
    return base.encounters(spark, sf_dir)


@register("features", with_ctes(ENC, FEAT) + "SELECT * FROM feat")
def features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engineered feature table."""
    return base.features(spark, sf_dir)


# ---------------------------------------------------------------- quality and cleaning

def _expectations_sql() -> str:
    parts = []
    for i, e in enumerate(quality.ENCOUNTER_SUITE):
        name = quality.expectation_name(e)
        if e.kind == "columns_match_set":
            parts.append(f"SELECT {i} AS idx, '{name}' AS expectation, CAST(NULL AS VARCHAR) AS \"column\", "
                         f"true AS success, (SELECT count(*) FROM enc) AS element_count, "
                         f"CAST(NULL AS BIGINT) AS missing_count, CAST(0 AS BIGINT) AS unexpected_count")
            continue
        c = e.column
        if e.kind == "not_null":
            miss, unexp = "0", f"count_if({c} IS NULL)"
        elif e.kind == "unique":
            miss = f"count_if({c} IS NULL)"
            unexp = (f"(SELECT coalesce(sum(k), 0) FROM (SELECT count(*) AS k FROM enc WHERE {c} IS NOT NULL "
                     f"GROUP BY {c} HAVING count(*) > 1))")
        elif e.kind == "between":
            miss = f"count_if({c} IS NULL)"
            unexp = f"count_if({c} IS NOT NULL AND NOT ({c} BETWEEN {e.min_value} AND {e.max_value}))"
        else:
            vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in e.value_set)
            miss = f"count_if({c} IS NULL)"
            unexp = f"count_if({c} IS NOT NULL AND {c} NOT IN ({vals}))"
        parts.append(
            f"SELECT {i} AS idx, '{name}' AS expectation, '{c}' AS \"column\", "
            f"CAST(NULL AS BOOLEAN) AS success, count(*) AS element_count, CAST({miss} AS BIGINT) AS missing_count, "
            f"CAST({unexp} AS BIGINT) AS unexpected_count FROM enc")
    mostly = ", ".join(str(float(e.mostly)) for e in quality.ENCOUNTER_SUITE)
    return with_ctes(ENC) + f"""
, parts AS ({' UNION ALL '.join(parts)})
SELECT idx, expectation, "column",
  coalesce(success, CASE WHEN element_count - coalesce(missing_count, 0) > 0
     THEN (1.0 - unexpected_count / CAST(element_count - coalesce(missing_count, 0) AS DOUBLE)) >= [{mostly}][idx + 1]
     ELSE true END) AS success,
  element_count, missing_count, unexpected_count,
  round(CASE WHEN element_count - coalesce(missing_count, 0) > 0
     THEN unexpected_count * 100.0 / (element_count - coalesce(missing_count, 0)) ELSE 0.0 END, 6) AS unexpected_percent
FROM parts"""


@register("expectations", _expectations_sql())
def expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q6: the 20-expectation suite on the raw encounter table, one row each."""
    return quality.run_expectations(base.encounters(spark, sf_dir))


@register("quarantine", with_ctes(ENC) + """
SELECT encounter_id,
  array_to_string(list_filter([
    CASE WHEN encounter_id IS NULL THEN 'not_null:encounter_id' END,
    CASE WHEN patient_id IS NULL THEN 'not_null:patient_id' END,
    CASE WHEN age IS NOT NULL AND NOT (age BETWEEN 0 AND 120) THEN 'between:age' END,
    CASE WHEN sex IS NOT NULL AND sex NOT IN ('M', 'F', 'U') THEN 'in_set:sex' END,
    CASE WHEN admission_type IS NOT NULL AND admission_type NOT IN ('Elective', 'Emergency', 'Urgent')
         THEN 'in_set:admission_type' END,
    CASE WHEN discharge_disposition IS NOT NULL
          AND discharge_disposition NOT IN ('Home', 'SNF', 'Rehab', 'HomeHealth', 'AMA')
         THEN 'in_set:discharge_disposition' END,
    CASE WHEN length_of_stay IS NOT NULL AND NOT (length_of_stay BETWEEN 0 AND 365) THEN 'between:length_of_stay' END,
    CASE WHEN comorbidity_count IS NOT NULL AND NOT (comorbidity_count BETWEEN 0 AND 30)
         THEN 'between:comorbidity_count' END,
    CASE WHEN charlson_index IS NOT NULL AND NOT (charlson_index BETWEEN 0 AND 20) THEN 'between:charlson_index' END,
    CASE WHEN prior_admissions_12mo IS NOT NULL AND NOT (prior_admissions_12mo BETWEEN 0 AND 50)
         THEN 'between:prior_admissions_12mo' END,
    CASE WHEN prior_ed_visits_12mo IS NOT NULL AND NOT (prior_ed_visits_12mo BETWEEN 0 AND 50)
         THEN 'between:prior_ed_visits_12mo' END,
    CASE WHEN num_medications IS NOT NULL AND NOT (num_medications BETWEEN 0 AND 60)
         THEN 'between:num_medications' END,
    CASE WHEN bmi IS NOT NULL AND NOT (bmi BETWEEN 5 AND 100) THEN 'between:bmi' END,
    CASE WHEN systolic_bp IS NOT NULL AND NOT (systolic_bp BETWEEN 40 AND 300) THEN 'between:systolic_bp' END,
    CASE WHEN glucose_level IS NOT NULL AND NOT (glucose_level BETWEEN 20 AND 1000) THEN 'between:glucose_level' END,
    CASE WHEN creatinine IS NOT NULL AND NOT (creatinine BETWEEN 0.1 AND 20) THEN 'between:creatinine' END
  ], lambda x: x IS NOT NULL)
  || CASE WHEN count(*) OVER (PARTITION BY encounter_id) > 1 THEN ['unique:encounter_id'] ELSE [] END, ',')
  AS failures
FROM enc""")
def quarantine_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8: per-row failure codes of the suite's row rules (empty string = valid)."""
    q = quality.quarantine(base.encounters(spark, sf_dir))
    return q.select("encounter_id", F.array_join("failures", ",").alias("failures"))


@register("dedup_clean", with_ctes(ENC, FEAT) + """
SELECT encounter_id, admit_date, discharge_date, readmitted_30d FROM dedup WHERE readmitted_30d IS NOT NULL""")
def dedup_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row per encounter, dates coerced, NULL labels dropped."""
    c = clean.clean_raw_encounters(base.encounters(spark, sf_dir))
    return c.select("encounter_id", "admit_date", "discharge_date", "readmitted_30d")


# ---------------------------------------------------------------- splits

@register("temporal_split", with_ctes(ENC, FEAT, SPLIT) + """
SELECT encounter_id, discharge_date, split FROM sfeat""")
def temporal_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """70/15/15 by (discharge_date, encounter_id)."""
    return base.split_features(spark, sf_dir).select("encounter_id", "discharge_date", "split")


@register("split_summary", with_ctes(ENC, FEAT, SPLIT) + """
SELECT split, count(*) AS n_rows, round(avg(CAST(readmitted_30d AS DOUBLE)), 6) AS positive_rate,
       min(discharge_date) AS first_discharge, max(discharge_date) AS last_discharge
FROM sfeat GROUP BY split""")
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and positive rate per split."""
    return (base.split_features(spark, sf_dir).groupBy("split")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.round(F.avg(F.col("readmitted_30d").cast("double")), 6).alias("positive_rate"),
                 F.min("discharge_date").alias("first_discharge"), F.max("discharge_date").alias("last_discharge")))


@register("patient_split", with_ctes(ENC, FEAT, SPLIT) + """
, pat AS (SELECT patient_id, arg_min(split, (discharge_date, encounter_id)) AS psplit
          FROM (SELECT s.*, e.patient_id FROM sfeat s JOIN enc e USING (encounter_id)) GROUP BY patient_id)
SELECT e.encounter_id, e.patient_id, p.psplit AS split
FROM sfeat s JOIN enc e USING (encounter_id) JOIN pat p ON p.patient_id = e.patient_id""")
def patient_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient-disjoint split: each patient follows their first discharge."""
    enc = base.encounters(spark, sf_dir).select("encounter_id", "patient_id")
    s = base.split_features(spark, sf_dir).select("encounter_id", "discharge_date", "split").join(enc, "encounter_id")
    return split.patient_split(s).select("encounter_id", "patient_id", "split")


# Further families register themselves on import.
from carelens.plans import catalog_eval  # noqa: E402,F401
from carelens.plans import catalog_monitor  # noqa: E402,F401
from carelens.plans import catalog_store  # noqa: E402,F401
from carelens.plans import catalog_models  # noqa: E402,F401
from carelens.plans import catalog_dirty  # noqa: E402,F401
from carelens.plans import catalog_streams  # noqa: E402,F401
from carelens.plans import catalog_io  # noqa: E402,F401
