"""Catalog: profiles, evaluation, fairness and slices (registered into ``catalog``)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.operators import evaluate as ev
from carelens.operators import fairness as fa
from carelens.operators import profile as pr
from carelens.operators.prefix import with_row_number
from carelens.plans import base
from carelens.plans.catalog import SQL, register
from carelens.plans.oracle import ENC, FEAT, SCORED, with_ctes
from carelens.schemas import CATEGORICAL_COLUMNS, DEFAULT_CONFIG, NUMERIC_COLUMNS, SLICE_COLUMNS

SC = with_ctes(ENC, FEAT, SCORED)
NUM = [c for c in NUMERIC_COLUMNS if c != "polypharmacy_flag"]
FLOOR = DEFAULT_CONFIG["high_recall_precision_floor"]


def _union_long(src: str, cols: list[str], cast: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {extra}'{c}' AS \"column\", CAST({c} AS {cast}) AS value FROM {src}" for c in cols)


# ---------------------------------------------------------------- profiles

@register("value_shares", with_ctes(ENC, FEAT) + f"""
, lng AS ({_union_long('feat', CATEGORICAL_COLUMNS + ['ethnicity'], 'VARCHAR')}),
cnt AS (SELECT "column", value, count(*) AS count FROM lng WHERE value IS NOT NULL GROUP BY ALL)
SELECT "column", value, count, round(count / CAST(sum(count) OVER (PARTITION BY "column") AS DOUBLE), 6) AS share
FROM cnt""")
def value_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: normalised value counts of every categorical column."""
    return pr.value_shares(base.features(spark, sf_dir), CATEGORICAL_COLUMNS + ["ethnicity"])


@register("describe", with_ctes(ENC, FEAT) + f"""
, lng AS ({_union_long('feat', NUM, 'DOUBLE')})
SELECT "column", count(*) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  min(value) AS min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
  round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max
FROM lng WHERE value IS NOT NULL GROUP BY "column\"""")
def describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: describe() of the numeric features."""
    return pr.describe_numeric(base.features(spark, sf_dir), NUM)


@register("describe_categorical", with_ctes(ENC, FEAT) + f"""
, lng AS ({_union_long('feat', CATEGORICAL_COLUMNS + ['ethnicity'], 'VARCHAR')}),
cnt AS (SELECT "column", value, count(*) AS k FROM lng WHERE value IS NOT NULL GROUP BY ALL)
SELECT "column", CAST(sum(k) AS BIGINT) AS count, count(*) AS unique, arg_min(value, (-k, value)) AS top, max(k) AS freq
FROM cnt GROUP BY "column\"""")
def describe_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: count / unique / top / freq of the categorical columns."""
    return pr.describe_categorical(base.features(spark, sf_dir), CATEGORICAL_COLUMNS + ["ethnicity"])


@register("histogram", with_ctes(ENC, FEAT) + f"""
, lng AS ({_union_long('feat', NUM, 'DOUBLE')}),
rng AS (SELECT "column", min(value) AS lo, max(value) AS hi FROM lng WHERE value IS NOT NULL GROUP BY "column"),
b AS (SELECT l."column", lo, hi, CAST(CASE WHEN hi - lo = 0 THEN 0
        ELSE least(floor((value - lo) * 30.0 / (hi - lo)), 29) END AS INTEGER) AS bin
      FROM lng l JOIN rng USING ("column") WHERE value IS NOT NULL)
SELECT "column", bin, round(lo + (hi - lo) * bin / 30.0, 6) AS lower, round(lo + (hi - lo) * (bin + 1) / 30.0, 6) AS upper,
  count(*) AS count FROM b GROUP BY "column", bin, lo, hi""")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: 30 equal-width bins per numeric feature."""
    return pr.histogram(base.features(spark, sf_dir), NUM, 30)


@register("equal_width_rate", SC + """
, rng AS (SELECT min(y_prob) AS lo, max(y_prob) AS hi FROM scored2),
b AS (SELECT s.*, CAST(CASE WHEN (hi - lo) / 5.0 = 0 THEN 1
        ELSE least(greatest(ceil((y_prob - lo) / ((hi - lo) / 5.0)), 1), 5) END AS INTEGER) AS bin
      FROM scored2 s CROSS JOIN rng WHERE y_prob IS NOT NULL)
SELECT bin, count(*) AS n, round(avg(y_prob), 6) AS mean_value, round(avg(CAST(readmitted_30d AS DOUBLE)), 6) AS rate
FROM b GROUP BY bin""")
def equal_width_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: label rate per 5 equal-width score bins."""
    return pr.equal_width_rate(base.scored(spark, sf_dir), "y_prob", "readmitted_30d", 5)


@register("distinct_encounters", with_ctes(ENC, FEAT) + """
SELECT count(DISTINCT encounter_id) AS distinct_encounter_id, count(*) AS rows FROM feat""")
def distinct_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct encounters in the feature table."""
    return pr.distinct_count(base.features(spark, sf_dir), "encounter_id")


@register("rate_by_prior_admissions", with_ctes(ENC, FEAT) + """
SELECT prior_admissions_12mo, discharge_disposition, count(*) AS n,
       round(avg(CAST(readmitted_30d AS DOUBLE)), 6) AS rate
FROM feat GROUP BY prior_admissions_12mo, discharge_disposition""")
def rate_by_prior_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: label mean by prior admissions and disposition."""
    g = pr.group_rate(base.features(spark, sf_dir), ["prior_admissions_12mo", "discharge_disposition"])
    return g.withColumn("rate", F.round("rate", 6))


@register("head_latest", with_ctes(ENC, FEAT) + """
SELECT encounter_id, discharge_date, age, readmitted_30d FROM feat
ORDER BY discharge_date DESC, encounter_id DESC LIMIT 5""")
def head_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five latest discharges (a top-k report)."""
    f = base.features(spark, sf_dir).select("encounter_id", "discharge_date", "age", "readmitted_30d")
    return pr.head(f, [F.col("discharge_date").desc(), F.col("encounter_id").desc()], 5)


# ---------------------------------------------------------------- evaluation

SCORE_COUNTS = """
, sc AS (SELECT y_prob AS score, count_if(y_true = 1) AS pos, count_if(y_true <> 1) AS neg
         FROM scored2 WHERE y_prob IS NOT NULL AND y_true IS NOT NULL GROUP BY y_prob)"""

HR = f"""
, hrc AS (SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cp,
                 sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cn FROM sc),
hr AS (SELECT round(coalesce(min(score) FILTER (WHERE CAST(cp AS DOUBLE) / (cp + cn) >= {FLOOR}), 0.5), 4) AS threshold
       FROM hrc)"""


@register("roc_auc", SC + SCORE_COUNTS + """
, cum AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                    AS cum_neg FROM sc)
SELECT CAST(sum(pos + neg) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
  round(sum(pos * (cum_neg + CAST(0.5 AS DOUBLE) * neg)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS roc_auc
FROM cum""")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC-AUC of the score against the label (Mann-Whitney on per-score counts)."""
    r = ev.roc_auc(base.scored(spark, sf_dir))
    return r.withColumn("roc_auc", F.round("roc_auc", 6))


@register("average_precision", SC + SCORE_COUNTS + """
, cum AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
                    sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg FROM sc)
SELECT CAST(sum(pos) AS BIGINT) AS n_pos,
  round(sum(pos * (CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg))) / sum(pos), 6) AS average_precision FROM cum""")
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average precision (step sum)."""
    r = ev.average_precision(base.scored(spark, sf_dir))
    return r.withColumn("average_precision", F.round("average_precision", 6))


@register("brier", SC + """
SELECT round(avg(pow(y_prob - y_true, 2)), 6) AS brier_score FROM scored2""")
def brier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brier score."""
    return ev.brier(base.scored(spark, sf_dir)).withColumn("brier_score", F.round("brier_score", 6))


def _rates_sql(src: str) -> str:
    p = "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0)"
    r = "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0)"
    s = "coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0.0)"
    return f"""SELECT *, round({p}, 4) AS precision, round({r}, 4) AS recall, round({s}, 4) AS specificity,
  round(coalesce(2.0 * {p} * {r} / nullif({p} + {r}, 0), 0.0), 4) AS f1 FROM {src}"""


@register("high_recall_threshold", SC + SCORE_COUNTS + HR + "\nSELECT threshold FROM hr")
def high_recall_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lowest score with precision >= 0.30 (max recall)."""
    return ev.high_recall_threshold(base.scored(spark, sf_dir), FLOOR)


@register("threshold_metrics", SC + SCORE_COUNTS + HR + """
, pts AS (
  SELECT 'default' AS operating_point, CAST(0.5 AS DOUBLE) AS threshold,
    CAST(count_if(y_prob < 0.5 AND y_true <> 1) AS BIGINT) AS tn,
    CAST(count_if(y_prob >= 0.5 AND y_true <> 1) AS BIGINT) AS fp,
    CAST(count_if(y_prob < 0.5 AND y_true = 1) AS BIGINT) AS fn,
    CAST(count_if(y_prob >= 0.5 AND y_true = 1) AS BIGINT) AS tp FROM scored2
  UNION ALL
  SELECT 'high_recall', any_value(hr.threshold),
    CAST(count_if(y_prob < hr.threshold AND y_true <> 1) AS BIGINT),
    CAST(count_if(y_prob >= hr.threshold AND y_true <> 1) AS BIGINT),
    CAST(count_if(y_prob < hr.threshold AND y_true = 1) AS BIGINT),
    CAST(count_if(y_prob >= hr.threshold AND y_true = 1) AS BIGINT)
  FROM scored2 CROSS JOIN hr)
""" + _rates_sql("pts"))
def threshold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion counts and rates at the default and high-recall thresholds."""
    return ev.operating_points(base.scored(spark, sf_dir), 0.5, FLOOR)


def _calibration_sql() -> str:
    edges = ev.calibration_edges(10)
    b = " + ".join(f"CAST(y_prob >= CAST('{e!r}' AS DOUBLE) AS INTEGER)" for e in edges[1:-1])
    lowers = ", ".join(repr(round(e, 2)) for e in edges[:-1])
    uppers = ", ".join(repr(round(e, 2)) for e in edges[1:])
    return SC + f"""
, b AS (SELECT ({b}) AS bin, y_prob, y_true FROM scored2 WHERE y_prob IS NOT NULL)
SELECT bin, CAST([{lowers}][bin + 1] AS DOUBLE) AS bin_lower, CAST([{uppers}][bin + 1] AS DOUBLE) AS bin_upper,
  count(*) AS count, round(avg(y_prob), 4) AS mean_predicted, round(avg(CAST(y_true AS DOUBLE)), 4) AS observed_rate
FROM b GROUP BY bin"""


@register("calibration", _calibration_sql())
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: reliability table, 10 left-closed bins."""
    return ev.calibration(base.scored(spark, sf_dir), 10)


@register("evaluation", SC + SCORE_COUNTS + HR + """
, cum AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                    AS cneg_below,
                    sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cp,
                    sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cn FROM sc),
m AS (SELECT sum(pos * (cneg_below + CAST(0.5 AS DOUBLE) * neg)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS auc,
             sum(pos * (CAST(cp AS DOUBLE) / (cp + cn))) / sum(pos) AS ap FROM cum),
o AS (SELECT count(*) AS n_rows, avg(CAST(y_true AS DOUBLE)) AS pr, avg(pow(y_prob - y_true, 2)) AS br FROM scored2)
SELECT n_rows, round(pr, 4) AS positive_rate, round(auc, 4) AS roc_auc, round(ap, 4) AS pr_auc,
  round(br, 4) AS brier_score, CAST(0.5 AS DOUBLE) AS decision_threshold, hr.threshold AS high_recall_threshold,
  round(auc, 4) >= 0.7 AS passes_roc_auc, round(ap, 4) >= 0.35 AS passes_pr_auc, round(br, 4) <= 0.2 AS passes_brier_score
FROM m CROSS JOIN o CROSS JOIN hr""")
def evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E7 + E8: the metric row with gate flags."""
    return ev.evaluate(base.scored(spark, sf_dir))


# ---------------------------------------------------------------- fairness and slices

def _fair_counts_sql(overall: bool) -> str:
    parts = []
    for c in ["sex", "age_band", "ethnicity"]:
        for grp in ([f"CAST({c} AS VARCHAR)"] + (["'__overall__'"] if overall else [])):
            parts.append(
                f"SELECT '{c}' AS attribute, {grp} AS \"group\", count(*) AS n, count_if(y_pred = 1) AS sel, "
                f"count_if(y_pred = 1 AND y_true = 1) AS tp, count_if(y_pred <> 1 AND y_true = 1) AS fn, "
                f"count_if(y_pred = 1 AND y_true <> 1) AS fp, count_if(y_pred <> 1 AND y_true <> 1) AS tn "
                f"FROM scored2 WHERE {c} IS NOT NULL GROUP BY {grp}")
    rates = """SELECT attribute, "group", n,
      coalesce(CAST(sel AS DOUBLE) / nullif(n, 0), 0.0) AS selection_rate,
      coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS tpr,
      coalesce(CAST(fp AS DOUBLE) / nullif(fp + tn, 0), 0.0) AS fpr,
      coalesce(CAST(fn AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS fnr FROM fc"""
    return f", fc AS ({' UNION ALL '.join(parts)}), fr AS ({rates})"


@register("fairness_groups", SC + _fair_counts_sql(True) + """
SELECT attribute, "group", n, round(selection_rate, 4) AS selection_rate, round(tpr, 4) AS tpr,
       round(fpr, 4) AS fpr, round(fnr, 4) AS fnr FROM fr""")
def fairness_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """selection rate, TPR, FPR, FNR per sensitive group and overall."""
    return fa.group_metrics(base.scored(spark, sf_dir))


@register("fairness_differences", SC + _fair_counts_sql(False) + """
SELECT attribute, round(max(selection_rate) - min(selection_rate), 4) AS demographic_parity_difference,
  round(greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)), 4) AS equalized_odds_difference,
  round(greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)), 4) <= 0.1 AS passes_equalized_odds_gate
FROM fr GROUP BY attribute""")
def fairness_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parity and equalised-odds differences with the gate flag."""
    return fa.fairness_differences(base.scored(spark, sf_dir))


@register("promotion_gate", SC + SCORE_COUNTS + _fair_counts_sql(False) + """
, cum AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                    AS cneg_below,
                    sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cp,
                    sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cn FROM sc),
m AS (SELECT round(sum(pos * (cneg_below + CAST(0.5 AS DOUBLE) * neg)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 4) AS roc_auc,
             round(sum(pos * (CAST(cp AS DOUBLE) / (cp + cn))) / sum(pos), 4) AS pr_auc FROM cum),
o AS (SELECT round(avg(pow(y_prob - y_true, 2)), 4) AS brier_score FROM scored2),
d AS (SELECT attribute, round(greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)), 4) AS eod FROM fr GROUP BY attribute),
checks AS (
  SELECT 'roc_auc' AS "check", roc_auc AS value, roc_auc < 0.7 AS failed FROM m
  UNION ALL SELECT 'pr_auc', pr_auc, pr_auc < 0.35 FROM m
  UNION ALL SELECT 'brier_score', brier_score, brier_score > 0.2 FROM o
  UNION ALL SELECT 'equalized_odds_difference[' || attribute || ']', eod, eod > 0.1 FROM d
    WHERE attribute IN ('sex', 'ethnicity'))
SELECT "check", value FROM checks WHERE failed""")
def promotion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed gate checks (metric thresholds + enforced equalised odds)."""
    s = base.scored(spark, sf_dir)
    g = fa.promotion_gate(ev.evaluate(s), fa.fairness_differences(s))
    return g.select("check", "value")


@register("global_error_rate", SC + """
SELECT round(avg(CAST(y_true <> y_pred AS DOUBLE)), 6) AS error_rate FROM scored2""")
def global_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """share of misclassified rows at the default threshold."""
    return fa.error_rate(base.scored(spark, sf_dir)).withColumn("error_rate", F.round("error_rate", 6))


def _slices_sql(min_size: int = 30, factor: float = 1.25) -> str:
    cols = SLICE_COLUMNS
    sets = [f"({c})" for c in cols] + [f"({a}, {b})" for a, b in combinations(cols, 2)]
    g = ", ".join(f"GROUPING({c}) AS g_{c}" for c in cols)
    names = ", ".join(f"CASE WHEN g_{c} = 0 THEN '{c}' END" for c in cols)
    vals = ", ".join(f"CASE WHEN g_{c} = 0 THEN CAST({c} AS VARCHAR) END" for c in cols)
    nact = " + ".join(f"CAST(g_{c} = 0 AS INTEGER)" for c in cols)
    nval = " + ".join(f"CAST(g_{c} = 0 AND {c} IS NOT NULL AS INTEGER)" for c in cols)
    return SC + f"""
, dom AS (SELECT {', '.join(cols)}, count(*) AS _n, sum(CAST(y_true <> y_pred AS BIGINT)) AS _e
          FROM scored2 GROUP BY {', '.join(cols)}),
gs AS (SELECT {', '.join(cols)}, sum(_n) AS n, sum(_e) AS errors, {g} FROM dom GROUP BY GROUPING SETS ({', '.join(sets)})),
gl AS (SELECT avg(CAST(y_true <> y_pred AS DOUBLE)) AS gr FROM scored2),
f AS (SELECT *, ({nact}) AS nact, ({nval}) AS nval, CAST(errors AS DOUBLE) / n AS rate FROM gs CROSS JOIN gl)
SELECT concat_ws(',', {names}) AS slice_columns, concat_ws(',', {vals}) AS slice_values, CAST(n AS BIGINT) AS n,
  round(rate, 4) AS error_rate, round(gr, 4) AS global_error_rate, rate > gr * {factor} AS flagged
FROM f WHERE nact = nval AND n >= {min_size} AND (nact = 1 OR rate > gr * {factor})"""


@register("slices", _slices_sql(DEFAULT_CONFIG["min_slice_size"], DEFAULT_CONFIG["elevation_factor"]))
def slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2, A10, O1: single and flagged pairwise slice error rates."""
    return fa.analyze_slices(base.scored(spark, sf_dir), DEFAULT_CONFIG["min_slice_size"],
                             DEFAULT_CONFIG["elevation_factor"])


@register("slices_ordered", "SELECT row_number() OVER (ORDER BY error_rate DESC, slice_columns, slice_values) AS row_no, * FROM ("
          + SQL["slices"] + ")")
def slices_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: the order of the slice report itself."""
    return with_row_number(slices(spark, sf_dir))
