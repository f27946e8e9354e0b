"""Catalog: drift (PSI, KS, rolling AUC) and telemetry / alerts (registered into ``catalog``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.operators import drift as dr
from carelens.operators import telemetry as tm
from carelens.operators.prefix import ks_pvalue_sql, with_row_number
from carelens.plans import base
from carelens.plans.catalog import SQL, register
from carelens.plans.oracle import ALLFEAT, ENC, FEAT, PRED, SPLIT, with_ctes
from carelens.schemas import CATEGORICAL_COLUMNS, MODEL_FEATURE_COLUMNS
from carelens.sources import telemetry as src

NUMERIC = [c for c in MODEL_FEATURE_COLUMNS if c not in CATEGORICAL_COLUMNS]
GRID = dr.quantile_grid(10)


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Drift pair: baseline = train split, current = test split of the feature table."""
    s = base.split_features(spark, sf_dir)
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


def _long_sql(cols: list[str], cast: str) -> str:
    parts = []
    for c in cols:
        v = f"CAST(CAST({c} AS INTEGER) AS {cast})" if c == "polypharmacy_flag" else f"CAST({c} AS {cast})"
        parts.append(f"SELECT CASE split WHEN 'train' THEN 'baseline' ELSE 'current' END AS side, "
                     f"'{c}' AS feature, {v} AS value FROM sfeat WHERE split IN ('train', 'test')")
    return " UNION ALL ".join(parts)


def _psi_numeric_sql() -> str:
    grid = ", ".join(f"CAST('{q!r}' AS DOUBLE)" for q in GRID)
    return f"""
, lng AS ({_long_sql(NUMERIC, 'DOUBLE')}),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{grid}]))) AS edges
          FROM lng WHERE side = 'baseline' AND value IS NOT NULL GROUP BY feature),
binned AS (SELECT l.feature, l.side, len(list_filter(e.edges[2:len(e.edges) - 1], lambda x: x < l.value)) AS bin
           FROM lng l JOIN edges e USING (feature) WHERE l.value IS NOT NULL AND len(e.edges) >= 3),
cnt AS (SELECT feature, side, bin AS k, count(*) AS n FROM binned GROUP BY ALL),
props AS (SELECT *, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY feature, side) AS p FROM cnt),
wide AS (SELECT feature, k, coalesce(sum(p) FILTER (WHERE side = 'baseline'), 0.0) AS b,
                coalesce(sum(p) FILTER (WHERE side = 'current'), 0.0) AS c FROM props GROUP BY feature, k),
psi AS (SELECT feature, sum((greatest(c, 0.0001) - greatest(b, 0.0001)) * ln(greatest(c, 0.0001) / greatest(b, 0.0001)))
          AS psi FROM wide GROUP BY feature),
num AS (SELECT e.feature, coalesce(p.psi, 0.0) AS psi FROM edges e LEFT JOIN psi p USING (feature))"""


def _psi_categorical_sql() -> str:
    return f"""
, clng AS ({_long_sql(CATEGORICAL_COLUMNS, 'VARCHAR')}),
ccnt AS (SELECT feature, side, coalesce(value, 'None') AS k, count(*) AS n FROM clng GROUP BY ALL),
cprops AS (SELECT *, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY feature, side) AS p FROM ccnt),
cwide AS (SELECT feature, k, coalesce(sum(p) FILTER (WHERE side = 'baseline'), 0.0) AS b,
                 coalesce(sum(p) FILTER (WHERE side = 'current'), 0.0) AS c FROM cprops GROUP BY feature, k),
cat AS (SELECT feature, sum((greatest(c, 0.0001) - greatest(b, 0.0001)) * ln(greatest(c, 0.0001) / greatest(b, 0.0001)))
          AS psi FROM cwide GROUP BY feature)"""


DRIFT_BASE = with_ctes(ENC, FEAT, SPLIT)


@register("psi_numeric", DRIFT_BASE + _psi_numeric_sql() + """
SELECT feature, round(psi, 6) AS psi FROM num""")
def psi_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PSI of every numeric model feature, train vs test."""
    b, c = _sides(spark, sf_dir)
    return dr.psi_numeric(b, c, NUMERIC).withColumn("psi", F.round("psi", 6))


@register("psi_categorical", DRIFT_BASE + _psi_categorical_sql() + """
SELECT feature, round(psi, 6) AS psi FROM cat""")
def psi_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PSI of every categorical model feature, train vs test."""
    b, c = _sides(spark, sf_dir)
    return dr.psi_categorical(b, c, CATEGORICAL_COLUMNS).withColumn("psi", F.round("psi", 6))


@register("drift_report", DRIFT_BASE + _psi_numeric_sql() + _psi_categorical_sql() + """
, allp AS (SELECT feature, 'numeric' AS kind, psi FROM num UNION ALL SELECT feature, 'categorical', psi FROM cat)
SELECT feature, kind, round(psi, 4) AS psi, psi > 0.2 AS drifted FROM allp""")
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-feature PSI and drift flag for the 20 model features."""
    b, c = _sides(spark, sf_dir)
    return dr.drift_report(b, c, 0.2)


def _pred_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = base.predictions(spark, sf_dir)
    return p.where(F.col("split") == "val"), p.where(F.col("split") == "test")


KS_SQL = """
, kc AS (SELECT readmission_probability AS score, count_if(split = 'val') AS pos, count_if(split = 'test') AS neg
         FROM pred WHERE split IN ('val', 'test') AND readmission_probability IS NOT NULL GROUP BY 1),
kcum AS (SELECT *, sum(pos) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cp,
                   sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cn FROM kc),
kt AS (SELECT sum(pos) AS n, sum(neg) AS m FROM kc),
kd AS (SELECT CAST(n AS BIGINT) AS n, CAST(m AS BIGINT) AS m, max(abs(CAST(cp AS DOUBLE) / n - CAST(cn AS DOUBLE) / m)) AS d
       FROM kcum CROSS JOIN kt GROUP BY n, m),
kp AS (SELECT *, """ + ks_pvalue_sql("d", "n", "m") + """ AS p FROM kd)"""


@register("ks_two_sample", with_ctes(ENC, ALLFEAT, PRED) + KS_SQL + """
SELECT n AS baseline_n, m AS current_n, round(d, 4) AS ks_statistic, round(p, 6) AS ks_pvalue, p < 0.01 AS drift_detected
FROM kp""")
def ks_two_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KS test of predicted probabilities, validation vs test period."""
    b, c = _pred_sides(spark, sf_dir)
    return dr.ks_two_sample(b, c, "readmission_probability", 0.01)


AUC_SQL = """
, lab AS (SELECT * FROM pred WHERE split = 'test' AND readmitted_30d IS NOT NULL),
asc_ AS (SELECT readmission_probability AS score, count_if(readmitted_30d = 1) AS pos, count_if(readmitted_30d <> 1) AS neg
         FROM lab GROUP BY 1),
acum AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cneg
         FROM asc_),
ra AS (SELECT coalesce(CAST(sum(pos + neg) AS BIGINT), 0) AS n_labeled,
              sum(pos * (cneg + CAST(0.5 AS DOUBLE) * neg)) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) AS auc
       FROM acum)"""


@register("rolling_auc", with_ctes(ENC, ALLFEAT, PRED) + AUC_SQL + """
SELECT n_labeled, round(auc, 4) AS roc_auc, auc < 0.7 AS below_threshold FROM ra""")
def rolling_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC-AUC over the test period's encounters whose label has arrived."""
    _, c = _pred_sides(spark, sf_dir)
    return dr.rolling_auc(c)


@register("rolling_auc_by_month", with_ctes(ENC, ALLFEAT, PRED) + """
, sc AS (SELECT date_trunc('month', discharge_date) AS month, readmission_probability AS score,
                count_if(readmitted_30d = 1) AS pos, count_if(readmitted_30d <> 1) AS neg
         FROM pred WHERE readmitted_30d IS NOT NULL GROUP BY 1, 2),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY month ORDER BY score
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cneg FROM sc),
g AS (SELECT month, CAST(sum(pos + neg) AS BIGINT) AS n_labeled,
             sum(pos * (cneg + CAST(0.5 AS DOUBLE) * neg)) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) AS auc
      FROM c GROUP BY month)
SELECT CAST(month AS DATE) AS month, n_labeled, round(auc, 4) AS roc_auc, auc < 0.7 AS below_threshold FROM g""")
def rolling_auc_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 per time window: monthly ROC-AUC over labelled encounters."""
    p = base.predictions(spark, sf_dir).withColumn("month", F.trunc("discharge_date", "month"))
    return dr.rolling_auc(p, by=["month"])


@register("model_drift", with_ctes(ENC, ALLFEAT, PRED) + KS_SQL + AUC_SQL + """
SELECT n AS baseline_n, m AS current_n, round(d, 4) AS ks_statistic, round(p, 6) AS ks_pvalue, p < 0.01 AS drift_detected,
  n_labeled, round(auc, 4) AS rolling_roc_auc, auc < 0.7 AS below_threshold,
  (p < 0.01) OR coalesce(auc < 0.7, false) AS model_drift_detected
FROM kp CROSS JOIN ra""")
def model_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KS drift or rolling AUC below the gate minimum."""
    b, c = _pred_sides(spark, sf_dir)
    return dr.model_drift(dr.ks_two_sample(b, c, "readmission_probability", 0.01), dr.rolling_auc(c))


# ---------------------------------------------------------------- telemetry

TEL = """
req AS (SELECT CAST(ts AS TIMESTAMP) AS "timestamp", 'POST /api/v1/score' AS name,
          CASE event_type WHEN 'error' THEN '500' WHEN 'signup' THEN '429' ELSE '200' END AS resultCode,
          event_type NOT IN ('error', 'signup') AS success, value * CAST(10.0 AS DOUBLE) AS duration,
          json_object('appid', CAST(user_id AS VARCHAR)) AS customDimensions FROM events),
dep AS (SELECT CAST(ts AS TIMESTAMP) AS "timestamp", 'ep.inference.ml.azure.com' AS target,
          event_type <> 'error' AS success, value * CAST(10.0 AS DOUBLE) AS duration FROM events),
cev AS (SELECT CAST(ts AS TIMESTAMP) AS "timestamp", 'ScoringCompleted' AS name,
          CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 AS p FROM events)"""
HAS_SCORE = "regexp_matches(name, '(?i)(^|[^A-Za-z0-9_])v1/score($|[^A-Za-z0-9_])')"
HAS_TARGET = "regexp_matches(target, '(?i)(^|[^A-Za-z0-9_])inference\\.ml\\.azure\\.com($|[^A-Za-z0-9_])')"


def _tb(size: str) -> str:
    return f"time_bucket(INTERVAL '{size}', \"timestamp\")"


def _ntz(df: DataFrame, col: str = "timestamp") -> DataFrame:
    return df.withColumn(col, F.col(col).cast("timestamp_ntz"))


@register("latency_percentiles", with_ctes(TEL) + f"""
SELECT {_tb('5 minutes')} AS "timestamp", round(quantile_cont(duration, 0.5), 6) AS p50,
  round(quantile_cont(duration, 0.95), 6) AS p95, round(quantile_cont(duration, 0.99), 6) AS p99,
  count(*) AS requestCount FROM req WHERE {HAS_SCORE} GROUP BY 1""")
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency percentiles per 5 minutes over the whole telemetry table."""
    return _ntz(tm.latency_percentiles(src.requests(spark, sf_dir)))


@register("error_rate_5xx", with_ctes(TEL) + f"""
SELECT {_tb('5 minutes')} AS "timestamp", count(*) AS total, CAST(count_if(lower(resultCode) LIKE '5%') AS BIGINT) AS errors,
  round(100.0 * count_if(lower(resultCode) LIKE '5%') / count(*), 2) AS errorRate
FROM req WHERE {HAS_SCORE} GROUP BY 1""")
def error_rate_5xx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: 5xx error rate per 5 minutes."""
    return _ntz(tm.error_rate_5xx(src.requests(spark, sf_dir)))


@register("failures_by_code", with_ctes(TEL) + f"""
SELECT resultCode, {_tb('5 minutes')} AS "timestamp", count(*) AS count_ FROM req WHERE NOT success GROUP BY 1, 2""")
def failures_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: failed requests by result code per 5 minutes."""
    return _ntz(tm.failures_by_code(src.requests(spark, sf_dir)))


@register("dependency_health", with_ctes(TEL) + f"""
SELECT {_tb('5 minutes')} AS "timestamp", count(*) AS total, CAST(count_if(NOT success) AS BIGINT) AS failures,
  round(avg(duration), 6) AS avgDuration FROM dep WHERE {HAS_TARGET} GROUP BY 1""")
def dependency_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: inference dependency calls per 5 minutes."""
    return _ntz(tm.dependency_health(src.dependencies(spark, sf_dir)))


@register("tier_counts", with_ctes(TEL) + f"""
SELECT CASE WHEN p < 0.20 THEN 'low' WHEN p <= 0.50 THEN 'medium' WHEN p IS NOT NULL THEN 'high' END AS riskTier,
  {_tb('1 hour')} AS "timestamp", count(*) AS count_ FROM cev WHERE name = 'ScoringCompleted' GROUP BY 1, 2""")
def tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored encounters per risk tier per hour."""
    return _ntz(tm.tier_counts(src.custom_events(spark, sf_dir)))


@register("throttled_clients", with_ctes(TEL) + f"""
SELECT json_extract_string(customDimensions, '$.appid') AS appId, {_tb('5 minutes')} AS "timestamp", count(*) AS count_
FROM req WHERE resultCode = '429' GROUP BY 1, 2""")
def throttled_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """429 responses by client per 5 minutes."""
    return _ntz(tm.throttled_clients(src.requests(spark, sf_dir)))


@register("availability", with_ctes(TEL) + f"""
SELECT {_tb('15 minutes')} AS "timestamp", count(*) AS total, CAST(count_if(success) AS BIGINT) AS successCount,
  round(100.0 * count_if(success) / count(*), 3) AS availabilityPct FROM dep WHERE {HAS_TARGET} GROUP BY 1""")
def availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Endpoint availability per 15 minutes."""
    return _ntz(tm.availability(src.dependencies(spark, sf_dir)))


# ---------------------------------------------------------------- as written: lookback and time order

# Each query's own lookback and time bin.
RECENT = {
    "latency_percentiles": ("requests", "1 hour", "5 minutes"),
    "error_rate_5xx": ("requests", "30 minutes", "5 minutes"),
    "failures_by_code": ("requests", "30 minutes", "5 minutes"),
    "dependency_health": ("dependencies", "30 minutes", "5 minutes"),
    "tier_counts": ("custom_events", "24 hours", "1 hour"),
    "throttled_clients": ("requests", "1 hour", "5 minutes"),
    "availability": ("dependencies", "24 hours", "15 minutes"),
}
_TEL_VIEW = {"requests": "req", "dependencies": "dep", "custom_events": "cev"}
_ORDER_KEYS = {"failures_by_code": "resultCode", "tier_counts": "riskTier", "throttled_clients": "appId"}


def _recent_sql(name: str) -> str:
    """The query's SQL over rows after max(timestamp) - lookback, with its row number in time order."""
    source, lookback, _ = RECENT[name]
    view = _TEL_VIEW[source]
    body = SQL[name].strip().removeprefix("WITH ")
    cut = body.rindex("\nSELECT")
    query = body[cut:].replace(f"FROM {view}", f"FROM recent")
    order = ", ".join(['"timestamp"', *([f"{_ORDER_KEYS[name]} NULLS FIRST"] if name in _ORDER_KEYS else [])])
    return (f"WITH {body[:cut]}, recent AS (SELECT * FROM {view} WHERE \"timestamp\" > "
            f"(SELECT max(\"timestamp\") FROM {view}) - INTERVAL '{lookback}'), result AS ({query}) "
            f"SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS row_no FROM result")


def _recent_query(name: str):
    source, lookback, bin_size = RECENT[name]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = getattr(src, source)(spark, sf_dir)
        as_of = F.lit(rows.agg(F.max("timestamp")).first()[0])
        result = getattr(tm, name)(rows, as_of, lookback, bin_size)
        # The position of each row in the returned order: range partitions are in order.
        return _ntz(with_row_number(result))

    query.__doc__ = f"{name} over the last {lookback} before the newest record, in time order (row_no)."
    return query


for _name in RECENT:
    register(f"{_name}_recent", _recent_sql(_name))(_recent_query(_name))


@register("alerts", with_ctes(TEL) + f"""
, l1 AS (SELECT 'HighScoringLatencyP95' AS alert, {_tb('5 minutes')} AS ws, quantile_cont(duration, 0.95) AS value
         FROM req WHERE {HAS_SCORE} GROUP BY 2 HAVING quantile_cont(duration, 0.95) > 1000),
l2 AS (SELECT 'HighErrorRate' AS alert, {_tb('5 minutes')} AS ws,
         100.0 * count_if(lower(resultCode) LIKE '5%') / count(*) AS value
       FROM req WHERE {HAS_SCORE} GROUP BY 2 HAVING 100.0 * count_if(lower(resultCode) LIKE '5%') / count(*) > 5),
slid AS (SELECT time_bucket(INTERVAL '5 minutes', "timestamp") - INTERVAL (o) MINUTE AS ws, success
         FROM dep, (SELECT unnest([0, 5, 10]) AS o) WHERE {HAS_TARGET}),
l3 AS (SELECT 'EndpointAvailabilityDrop' AS alert, ws, 100.0 * count_if(success) / count(*) AS value
       FROM slid GROUP BY ws HAVING 100.0 * count_if(success) / count(*) < 99),
al AS (SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3)
SELECT alert, ws AS window_start,
  ws + CASE alert WHEN 'EndpointAvailabilityDrop' THEN INTERVAL 15 MINUTE ELSE INTERVAL 5 MINUTE END AS window_end,
  round(value, 6) AS value FROM al""")
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1-L3: fired alert windows (p95 latency, 5xx rate, sliding availability)."""
    a = tm.alerts(src.requests(spark, sf_dir), src.dependencies(spark, sf_dir))
    return _ntz(_ntz(a, "window_start"), "window_end")


# ---------------------------------------------------------------- drift over time

def _month_sides(spark: SparkSession, sf_dir: str):
    s = base.split_features(spark, sf_dir)
    cur = s.where(F.col("split").isin("val", "test")).withColumn("month", F.trunc("discharge_date", "month"))
    return s.where(F.col("split") == "train"), cur


def _long_month_sql(cols: list[str]) -> str:
    parts = []
    for c in cols:
        v = f"CAST(CAST({c} AS INTEGER) AS DOUBLE)" if c == "polypharmacy_flag" else f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT CAST(date_trunc('month', discharge_date) AS DATE) AS month, '{c}' AS feature, "
                     f"{v} AS value FROM sfeat WHERE split IN ('val', 'test')")
    return " UNION ALL ".join(parts)


def _psi_month_sql() -> str:
    grid = ", ".join(f"CAST('{q!r}' AS DOUBLE)" for q in GRID)
    inner = "len(list_filter(e.edges[2:len(e.edges) - 1], lambda x: x < l.value))"
    return f"""
, lb AS ({_long_sql(NUMERIC, 'DOUBLE')}),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{grid}]))) AS edges
          FROM lb WHERE side = 'baseline' AND value IS NOT NULL GROUP BY feature),
lc AS ({_long_month_sql(NUMERIC)}),
bb AS (SELECT l.feature, {inner} AS k, count(*) AS n FROM lb l JOIN edges e USING (feature)
       WHERE l.side = 'baseline' AND l.value IS NOT NULL AND len(e.edges) >= 3 GROUP BY 1, 2),
bc AS (SELECT l.month, l.feature, {inner} AS k, count(*) AS n FROM lc l JOIN edges e USING (feature)
       WHERE l.value IS NOT NULL AND len(e.edges) >= 3 GROUP BY 1, 2, 3),
periods AS (SELECT DISTINCT month FROM bc),
cnt AS (SELECT p.month, bb.feature, bb.k, 'baseline' AS side, bb.n FROM periods p CROSS JOIN bb
        UNION ALL SELECT month, feature, k, 'current', n FROM bc),
props AS (SELECT *, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY month, feature, side) AS p FROM cnt),
wide AS (SELECT month, feature, k, coalesce(sum(p) FILTER (WHERE side = 'baseline'), 0.0) AS b,
                coalesce(sum(p) FILTER (WHERE side = 'current'), 0.0) AS c FROM props GROUP BY month, feature, k),
psi AS (SELECT month, feature, sum((greatest(c, 0.0001) - greatest(b, 0.0001)) * ln(greatest(c, 0.0001) / greatest(b, 0.0001)))
          AS psi FROM wide GROUP BY month, feature),
mpsi AS (SELECT g.month, e.feature, coalesce(p.psi, 0.0) AS psi FROM periods g CROSS JOIN edges e
         LEFT JOIN psi p ON p.month = g.month AND p.feature = e.feature)"""


def _psi_cat_month_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT CASE split WHEN 'train' THEN NULL ELSE CAST(date_trunc('month', discharge_date) AS DATE) END AS month, "
        f"'{c}' AS feature, coalesce(CAST({c} AS VARCHAR), 'None') AS k FROM sfeat" for c in CATEGORICAL_COLUMNS)
    return f"""
, cl AS ({rows}),
cb AS (SELECT feature, k, count(*) / sum(CAST(count(*) AS DOUBLE)) OVER (PARTITION BY feature) AS p
       FROM cl WHERE month IS NULL GROUP BY feature, k),
cc AS (SELECT month, feature, k, count(*) / sum(CAST(count(*) AS DOUBLE)) OVER (PARTITION BY month, feature) AS p
       FROM cl WHERE month IS NOT NULL GROUP BY month, feature, k),
cboth AS (SELECT m.month, cb.feature, cb.k, cb.p AS b, 0.0 AS c FROM (SELECT DISTINCT month FROM cc) m CROSS JOIN cb
          UNION ALL SELECT month, feature, k, 0.0, p FROM cc),
cw AS (SELECT month, feature, k, greatest(sum(b), 0.0001) AS b, greatest(sum(c), 0.0001) AS c FROM cboth GROUP BY ALL),
cpsi AS (SELECT month, feature, sum((c - b) * ln(c / b)) AS psi FROM cw GROUP BY month, feature)"""


@register("drift_by_month_categorical", DRIFT_BASE + _psi_cat_month_sql() + """
SELECT month, feature, round(psi, 6) AS psi FROM cpsi""")
def drift_by_month_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 over time: PSI of every categorical feature per discharge month after the training
    period, against the training split."""
    b, c = _month_sides(spark, sf_dir)
    return dr.psi_categorical_by_period(b, c, CATEGORICAL_COLUMNS, "month").withColumn("psi", F.round("psi", 6))


@register("drift_by_month", DRIFT_BASE + _psi_month_sql() + """
SELECT month, feature, round(psi, 6) AS psi FROM mpsi""")
def drift_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 over time: PSI of every numeric feature per discharge month after the training
    period, against the training split (one fused job)."""
    b, c = _month_sides(spark, sf_dir)
    return dr.psi_numeric_by_period(b, c, NUMERIC, "month").withColumn("psi", F.round("psi", 6))


KS_MONTH_SQL = """
, kb AS (SELECT readmission_probability AS score, count(*) AS pos FROM pred WHERE split = 'val'
         AND readmission_probability IS NOT NULL GROUP BY 1),
kc AS (SELECT CAST(date_trunc('month', discharge_date) AS DATE) AS month, readmission_probability AS score,
              count(*) AS neg FROM pred WHERE split = 'test' AND readmission_probability IS NOT NULL GROUP BY 1, 2),
kper AS (SELECT DISTINCT month FROM kc),
krows AS (SELECT month, score, sum(pos) AS pos, sum(neg) AS neg FROM (
            SELECT p.month, kb.score, kb.pos, 0 AS neg FROM kper p CROSS JOIN kb
            UNION ALL SELECT month, score, 0, neg FROM kc) GROUP BY month, score),
kcum AS (SELECT month, sum(pos) OVER (PARTITION BY month ORDER BY score ROWS UNBOUNDED PRECEDING) AS cp,
                sum(neg) OVER (PARTITION BY month ORDER BY score ROWS UNBOUNDED PRECEDING) AS cn,
                sum(pos) OVER (PARTITION BY month) AS n, sum(neg) OVER (PARTITION BY month) AS m FROM krows),
kd AS (SELECT month, n, m, max(abs(CAST(cp AS DOUBLE) / n - CAST(cn AS DOUBLE) / m)) AS d FROM kcum GROUP BY month, n, m),
kp AS (SELECT *, """ + ks_pvalue_sql("d", "n", "m") + """ AS p FROM kd),
asc_ AS (SELECT CAST(date_trunc('month', discharge_date) AS DATE) AS month, readmission_probability AS score,
                count_if(readmitted_30d = 1) AS pos, count_if(readmitted_30d <> 1) AS neg
         FROM pred WHERE split = 'test' AND readmitted_30d IS NOT NULL GROUP BY 1, 2),
acum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY month ORDER BY score
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cneg FROM asc_),
ra AS (SELECT month, sum(pos * (cneg + CAST(0.5 AS DOUBLE) * neg)) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) AS auc
       FROM acum GROUP BY month)"""


@register("drift_alerts", with_ctes(ENC, FEAT, SPLIT, ALLFEAT, PRED) + _psi_month_sql() + _psi_cat_month_sql() + KS_MONTH_SQL + """
, ev AS (SELECT CAST(month AS TIMESTAMP) AS ts, 'DataDriftReport' AS name, max(psi) > 0.2 AS flagged
         FROM (SELECT * FROM mpsi UNION ALL SELECT * FROM cpsi) GROUP BY month
         UNION ALL
         SELECT CAST(kp.month AS TIMESTAMP), 'ModelDriftReport', (kp.p < 0.01) OR coalesce(ra.auc < 0.7, false)
         FROM kp LEFT JOIN ra USING (month))
SELECT CASE name WHEN 'DataDriftReport' THEN 'DataDriftDetected' ELSE 'ModelDriftDetected' END AS alert,
       time_bucket(INTERVAL '1 hour', ts) AS window_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR AS window_end,
       CAST(count(*) AS DOUBLE) AS value
FROM ev WHERE flagged GROUP BY 1, 2""")
def drift_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly data-drift (PSI) and model-drift (KS or rolling AUC) reports after the
    training period become events; hourly windows with a flagged report fire."""
    b, c = _month_sides(spark, sf_dir)
    data_events = dr.drift_events_by_period(b, c, "month", MODEL_FEATURE_COLUMNS).drop("max_psi")
    p = base.predictions(spark, sf_dir)
    test = p.where(F.col("split") == "test").withColumn("month", F.trunc("discharge_date", "month"))
    ks = dr.ks_by_period(p.where(F.col("split") == "val"), test, "readmission_probability", "month")
    auc = dr.rolling_auc(test, by=["month"])
    model_events = ks.join(auc.select("month", "below_threshold"), "month", "left").select(
        F.col("month").cast("timestamp").alias("timestamp"), F.lit("ModelDriftReport").alias("name"),
        (F.col("drift_detected") | F.coalesce(F.col("below_threshold"), F.lit(False))).alias("drift_detected"))
    flag = F.to_json(F.create_map(F.lit("drift_detected"), F.initcap(F.col("drift_detected").cast("string"))))
    events = data_events.unionByName(model_events).select("timestamp", "name", flag.alias("customDimensions"))
    a = tm.drift_alerts(events)
    return _ntz(_ntz(a, "window_start"), "window_end")


@register("late_labels", with_ctes(ENC, ALLFEAT, PRED) + """
, s AS (SELECT encounter_id, CAST(discharge_date AS TIMESTAMP) AS scored_ts, readmission_probability
        FROM pred WHERE split = 'test'),
l AS (SELECT encounter_id, CAST(discharge_date + 30 AS TIMESTAMP) AS label_ts, readmitted_30d FROM enc
      WHERE readmitted_30d IS NOT NULL)
SELECT s.encounter_id, s.scored_ts, s.readmission_probability, l.label_ts, l.readmitted_30d
FROM s LEFT JOIN l ON s.encounter_id = l.encounter_id AND l.label_ts >= s.scored_ts
  AND l.label_ts <= s.scored_ts + INTERVAL 60 DAY""")
def late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test-period scores joined to labels that arrive (30 days after discharge) within
    60 days of scoring; encounters whose label never arrives keep NULL."""
    p = base.predictions(spark, sf_dir).where(F.col("split") == "test")
    scores = p.select("encounter_id", F.col("discharge_date").cast("timestamp").alias("scored_ts"),
                      "readmission_probability")
    labels = base.encounters(spark, sf_dir).where(F.col("readmitted_30d").isNotNull()).select(
        "encounter_id", F.date_add("discharge_date", 30).cast("timestamp").alias("label_ts"), "readmitted_30d")
    out = dr.join_late_labels(scores, labels, 60)
    return out.withColumn("scored_ts", F.col("scored_ts").cast("timestamp_ntz")) \
        .withColumn("label_ts", F.col("label_ts").cast("timestamp_ntz"))
