"""Declared schemas and fixed value lists.

Fixed values: these lists must equal the reference's for results to match
(column order, category sets, thresholds). They are stated here once, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: raw encounter columns (22, all required, extra allowed) ---
RAW_ENCOUNTER_COLUMNS = [
    "encounter_id", "patient_id", "admit_date", "discharge_date", "age", "sex",
    "ethnicity", "insurance_type", "admission_type", "discharge_disposition",
    "length_of_stay", "primary_diagnosis_code", "comorbidity_count", "charlson_index",
    "prior_admissions_12mo", "prior_ed_visits_12mo", "num_medications", "bmi",
    "systolic_bp", "glucose_level", "creatinine", "readmitted_30d",
]

# --- fixed values: model feature columns, stable order (20) ---
MODEL_FEATURE_COLUMNS = [
    "age", "age_band", "sex", "insurance_type", "admission_type", "discharge_disposition",
    "length_of_stay", "los_bucket", "comorbidity_count", "charlson_index",
    "comorbidity_score", "prior_admissions_12mo", "prior_ed_visits_12mo",
    "prior_utilization_rate", "num_medications", "polypharmacy_flag", "bmi",
    "systolic_bp", "glucose_level", "creatinine",
]

# --- fixed values: categorical model columns (6) ---
CATEGORICAL_COLUMNS = ["age_band", "sex", "insurance_type", "admission_type", "discharge_disposition", "los_bucket"]

NUMERIC_COLUMNS = [c for c in MODEL_FEATURE_COLUMNS if c not in CATEGORICAL_COLUMNS]

# --- fixed values: sensitive attributes for fairness audits ---
FAIRNESS_SENSITIVE_COLUMNS = ["sex", "age_band", "ethnicity"]

# --- fixed values: columns used for slice generation ---
SLICE_COLUMNS = ["admission_type", "discharge_disposition", "insurance_type", "age_band", "los_bucket"]

LABEL_COLUMN = "readmitted_30d"

# --- fixed values: category sets ---
SEX_VALUES = ["M", "F", "U"]
ADMISSION_TYPES = ["Elective", "Emergency", "Urgent"]
DISCHARGE_DISPOSITIONS = ["Home", "SNF", "Rehab", "HomeHealth", "AMA"]

# --- fixed values: default configuration ---
DEFAULT_CONFIG = {
    "train_fraction": 0.70,
    "validation_fraction": 0.15,
    "decision_threshold": 0.5,
    "high_recall_precision_floor": 0.30,
    "min_roc_auc": 0.70,
    "min_pr_auc": 0.35,
    "max_brier_score": 0.20,
    "max_equalized_odds_difference": 0.10,
    "psi_threshold": 0.2,
    "ks_pvalue_threshold": 0.01,
    "min_slice_size": 30,
    "elevation_factor": 1.25,
    "rate_limit_rpm": 60,
    "max_batch_size": 100,
}

RAW_ENCOUNTER_SCHEMA = T.StructType([
    T.StructField("encounter_id", T.StringType()),
    T.StructField("patient_id", T.StringType()),
    T.StructField("admit_date", T.DateType()),
    T.StructField("discharge_date", T.DateType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("sex", T.StringType()),
    T.StructField("ethnicity", T.StringType()),
    T.StructField("insurance_type", T.StringType()),
    T.StructField("admission_type", T.StringType()),
    T.StructField("discharge_disposition", T.StringType()),
    T.StructField("length_of_stay", T.IntegerType()),
    T.StructField("primary_diagnosis_code", T.StringType()),
    T.StructField("comorbidity_count", T.IntegerType()),
    T.StructField("charlson_index", T.DoubleType()),
    T.StructField("prior_admissions_12mo", T.IntegerType()),
    T.StructField("prior_ed_visits_12mo", T.IntegerType()),
    T.StructField("num_medications", T.IntegerType()),
    T.StructField("bmi", T.DoubleType()),
    T.StructField("systolic_bp", T.DoubleType()),
    T.StructField("glucose_level", T.DoubleType()),
    T.StructField("creatinine", T.DoubleType()),
    T.StructField("readmitted_30d", T.IntegerType()),
])

# Scoring request: the raw columns a caller sends (no ids of patients, no dates, no label).
REQUEST_COLUMNS = [
    "encounter_id", "age", "sex", "insurance_type", "admission_type", "discharge_disposition",
    "length_of_stay", "comorbidity_count", "charlson_index", "prior_admissions_12mo",
    "prior_ed_visits_12mo", "num_medications", "bmi", "systolic_bp", "glucose_level", "creatinine",
]

REQUEST_SCHEMA = T.StructType([f for f in RAW_ENCOUNTER_SCHEMA.fields if f.name in REQUEST_COLUMNS])

TOP_FACTOR_TYPE = T.ArrayType(T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("shap_value", T.DoubleType()),
]))
