"""Column -> Column feature functions (JVM-side expressions, no UDF).

Each takes and returns ``pyspark.sql.Column`` so it can be used in any ``select``,
batch or streaming, and stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def age_band(age) -> Column:
    """Right-closed bands (-1,17] (17,39] (39,64] (64,79] (79,200]; outside or NULL -> NULL."""
    a = _c(age)
    return (F.when((a > -1) & (a <= 17), "<18")
            .when((a > 17) & (a <= 39), "18-39")
            .when((a > 39) & (a <= 64), "40-64")
            .when((a > 64) & (a <= 79), "65-79")
            .when((a > 79) & (a <= 200), "80+"))


def los_bucket(length_of_stay) -> Column:
    """Right-closed buckets (-1,2] (2,5] (5,10] (10,10000]; outside or NULL -> NULL."""
    d = _c(length_of_stay)
    return (F.when((d > -1) & (d <= 2), "0-2")
            .when((d > 2) & (d <= 5), "3-5")
            .when((d > 5) & (d <= 10), "6-10")
            .when((d > 10) & (d <= 10000), "11+"))


def comorbidity_score(comorbidity_count, charlson_index) -> Column:
    """0.4 * count + 0.6 * charlson, rounded to 3 decimals."""
    return F.round(F.lit(0.4) * _c(comorbidity_count) + F.lit(0.6) * _c(charlson_index), 3)


def prior_utilization_rate(prior_admissions, prior_ed_visits) -> Column:
    """(admissions + ED visits) / 12, rounded to 4 decimals."""
    return F.round((_c(prior_admissions) + _c(prior_ed_visits)) / F.lit(12.0), 4)


def polypharmacy_flag(num_medications) -> Column:
    """num_medications >= 5; NULL counts as False."""
    return F.coalesce(_c(num_medications) >= 5, F.lit(False))


def risk_tier(probability) -> Column:
    """< 0.20 low, <= 0.50 medium, else high (on the unrounded probability)."""
    p = _c(probability)
    p = F.when(~F.isnan(p), p)  # no tier without a probability
    return F.when(p < 0.20, "low").when(p <= 0.50, "medium").when(p.isNotNull(), "high")


def predict_label(probability, threshold: float) -> Column:
    """y_pred = 1 when probability >= threshold, else 0."""
    return (_c(probability) >= F.lit(float(threshold))).cast("int")


# The demo score: (feature the term explains, weight, term as SQL text valid in Spark SQL and
# DuckDB alike). Own choice of terms and weights, over the engineered features. The
# deterministic score column, its SQL twin and the explained margin terms are generated from it.
RISK_TERMS = [
    ("prior_utilization_rate", 1.4, "prior_utilization_rate"),
    ("comorbidity_score", 0.22, "comorbidity_score"),
    ("length_of_stay", 0.06, "CAST(length_of_stay AS DOUBLE)"),
    ("creatinine", 0.08, "creatinine"),
    ("polypharmacy_flag", 0.15, "CAST(polypharmacy_flag AS DOUBLE)"),
    ("discharge_disposition", 0.12, "CAST(discharge_disposition <> 'Home' AS DOUBLE)"),
    ("age", 0.25, "CAST(age >= 75 AS DOUBLE)"),
]
RISK_SLOPE, RISK_CENTER = 2.5, 1.5  # probability = 1 / (1 + exp(-slope * (risk - center)))


def synthetic_risk() -> Column:
    """Risk score over feature columns (see RISK_TERMS)."""
    return sum((F.lit(w) * F.expr(t) for _, w, t in RISK_TERMS[1:]), F.lit(RISK_TERMS[0][1]) * F.expr(RISK_TERMS[0][2]))


def synthetic_score() -> Column:
    """Deterministic probability ``round(1 / (1 + exp(-slope * (risk - center))), 4)``."""
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-RISK_SLOPE) * (synthetic_risk() - F.lit(RISK_CENTER)))), 4)


def _sql_risk() -> str:
    return " + ".join(f"CAST('{w!r}' AS DOUBLE) * ({t})" for _, w, t in RISK_TERMS)


# SQL twins of the expressions above, for the DuckDB oracle.
SQL_AGE_BAND = """CASE WHEN {a} > -1 AND {a} <= 17 THEN '<18' WHEN {a} > 17 AND {a} <= 39 THEN '18-39'
 WHEN {a} > 39 AND {a} <= 64 THEN '40-64' WHEN {a} > 64 AND {a} <= 79 THEN '65-79'
 WHEN {a} > 79 AND {a} <= 200 THEN '80+' END"""
SQL_LOS_BUCKET = """CASE WHEN {d} > -1 AND {d} <= 2 THEN '0-2' WHEN {d} > 2 AND {d} <= 5 THEN '3-5'
 WHEN {d} > 5 AND {d} <= 10 THEN '6-10' WHEN {d} > 10 AND {d} <= 10000 THEN '11+' END"""
SQL_RISK_TIER = "CASE WHEN {p} < 0.20 THEN 'low' WHEN {p} <= 0.50 THEN 'medium' WHEN {p} IS NOT NULL THEN 'high' END"
SQL_SCORE = (f"round(CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + exp(CAST('{-RISK_SLOPE!r}' AS DOUBLE) * "
             f"(({_sql_risk()}) - CAST('{RISK_CENTER!r}' AS DOUBLE)))), 4)")
