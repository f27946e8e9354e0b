"""DuckDB SQL twins of the catalog queries (the correctness oracle).

The CTEs mirror the Spark derivation written independently in plain SQL: range
self-joins where Spark uses windows over a per-day pre-aggregate, ``row_number`` where
Spark uses a distributed rank. Doubles are made explicit so both engines do the same
IEEE arithmetic.
"""

from __future__ import annotations

from carelens.functions.features import SQL_AGE_BAND, SQL_LOS_BUCKET, SQL_RISK_TIER, SQL_SCORE

ENC = """
li AS (SELECT l_orderkey, count(*) AS n_lines, count_if(l_returnflag = 'R') AS n_returned,
              sum(l_discount) AS discount_sum, count(DISTINCT l_partkey) AS n_parts
       FROM lineitem GROUP BY l_orderkey),
r0 AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS admit_date,
              CAST(coalesce(n_lines, 0) AS INTEGER) AS los, n_returned, discount_sum, n_parts
       FROM orders LEFT JOIN li ON l_orderkey = o_orderkey),
r1 AS (SELECT *, admit_date + los AS discharge_date,
              CASE WHEN o_orderpriority = '1-URGENT' THEN 'Urgent'
                   WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'Emergency' ELSE 'Elective' END AS admission_type
       FROM r0),
hp AS (SELECT a.o_orderkey, count(b.o_orderkey) AS n_prior, count(CASE WHEN b.admission_type = 'Emergency' THEN 1 END) AS n_prior_ed
       FROM r1 a LEFT JOIN r1 b ON b.o_custkey = a.o_custkey
            AND b.admit_date BETWEEN a.admit_date - 365 AND a.admit_date - 1
       GROUP BY a.o_orderkey),
hl AS (SELECT a.o_orderkey, count(b.o_orderkey) AS n_next
       FROM r1 a LEFT JOIN r1 b ON b.o_custkey = a.o_custkey AND b.o_orderkey <> a.o_orderkey
            AND b.admit_date BETWEEN a.discharge_date AND a.discharge_date + 30
       GROUP BY a.o_orderkey),
mx AS (SELECT max(admit_date) AS end_date FROM r1),
dim AS (SELECT c_custkey, c_mktsegment AS ethnicity, r_name AS insurance_type
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
enc AS (
  SELECT CAST(r1.o_orderkey AS VARCHAR) AS encounter_id, CAST(r1.o_custkey AS VARCHAR) AS patient_id,
    r1.admit_date, r1.discharge_date, CAST((r1.o_custkey * 37) % 101 AS INTEGER) AS age,
    CASE WHEN r1.o_custkey % 50 = 0 THEN 'U' WHEN r1.o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
    dim.ethnicity, dim.insurance_type, r1.admission_type,
    CASE r1.o_orderstatus WHEN 'F' THEN 'Home' WHEN 'O' THEN 'SNF' WHEN 'P' THEN 'Rehab' END AS discharge_disposition,
    r1.los AS length_of_stay, 'D' || CAST(r1.o_orderkey % 7 AS VARCHAR) AS primary_diagnosis_code,
    CAST(coalesce(r1.n_returned, 0) AS INTEGER) AS comorbidity_count,
    coalesce(round(r1.discount_sum * CAST(10.0 AS DOUBLE), 2), CAST(0.0 AS DOUBLE)) AS charlson_index,
    CAST(hp.n_prior AS INTEGER) AS prior_admissions_12mo, CAST(hp.n_prior_ed AS INTEGER) AS prior_ed_visits_12mo,
    CAST(coalesce(r1.n_parts, 0) AS INTEGER) AS num_medications,
    CAST(18 + r1.o_orderkey % 25 AS DOUBLE) AS bmi, CAST(90 + r1.o_orderkey % 91 AS DOUBLE) AS systolic_bp,
    CAST(70 + r1.o_orderkey % 181 AS DOUBLE) AS glucose_level,
    CAST(0.5 AS DOUBLE) + CAST(r1.o_orderkey % 30 AS DOUBLE) / CAST(10.0 AS DOUBLE) AS creatinine,
    CAST(CASE WHEN hl.n_next > 0 THEN 1 WHEN r1.discharge_date + 30 > mx.end_date THEN NULL ELSE 0 END AS INTEGER)
      AS readmitted_30d
  FROM r1 JOIN hp USING (o_orderkey) JOIN hl USING (o_orderkey) CROSS JOIN mx
  LEFT JOIN dim ON dim.c_custkey = r1.o_custkey)"""

_FEATURE_SELECT = f"""encounter_id, discharge_date, age, {SQL_AGE_BAND.format(a='age')} AS age_band, sex,
    insurance_type, admission_type, discharge_disposition, length_of_stay,
    {SQL_LOS_BUCKET.format(d='length_of_stay')} AS los_bucket, comorbidity_count, charlson_index,
    round(CAST(0.4 AS DOUBLE) * comorbidity_count + CAST(0.6 AS DOUBLE) * charlson_index, 3) AS comorbidity_score,
    prior_admissions_12mo, prior_ed_visits_12mo,
    round(CAST(prior_admissions_12mo + prior_ed_visits_12mo AS DOUBLE) / CAST(12.0 AS DOUBLE), 4) AS prior_utilization_rate,
    num_medications, coalesce(num_medications >= 5, false) AS polypharmacy_flag, bmi, systolic_bp, glucose_level,
    creatinine, ethnicity, readmitted_30d"""

FEAT = f"""
dedup AS (SELECT * FROM enc QUALIFY row_number() OVER (PARTITION BY encounter_id ORDER BY admit_date) = 1),
feat AS (SELECT {_FEATURE_SELECT} FROM dedup WHERE readmitted_30d IS NOT NULL)"""

ALLFEAT = f"""
allfeat AS (SELECT {_FEATURE_SELECT} FROM enc)"""

SCORED = f"""
scored AS (SELECT *, CAST(readmitted_30d AS INTEGER) AS y_true, {SQL_SCORE} AS y_prob FROM feat),
scored2 AS (SELECT *, CAST(y_prob >= 0.5 AS INTEGER) AS y_pred FROM scored)"""


def split_cte(src: str, name: str) -> str:
    """Temporal 70/15/15 split of ``src`` by (discharge_date, encounter_id)."""
    return f"""
{name}_rk AS (SELECT *, row_number() OVER (ORDER BY discharge_date, encounter_id) - 1 AS _rk,
                 count(*) OVER () AS _n FROM {src}),
{name} AS (SELECT * EXCLUDE (_rk, _n),
  CASE WHEN _rk < CAST(floor(_n * 0.70) AS BIGINT) THEN 'train'
       WHEN _rk < CAST(floor(_n * 0.70) AS BIGINT) + CAST(floor(_n * 0.15) AS BIGINT) THEN 'val'
       ELSE 'test' END AS split FROM {name}_rk)"""


SPLIT = split_cte("feat", "sfeat")
PRED = split_cte("allfeat", "spred") + f""",
pred AS (SELECT encounter_id, discharge_date, split, {SQL_SCORE} AS readmission_probability,
                CAST(readmitted_30d AS INTEGER) AS readmitted_30d FROM spred)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip().rstrip(",") for p in parts) + "\n"


TIER = SQL_RISK_TIER
