"""Model evaluation on a scored table (y_true, y_prob): E1-E8, E10, E11, W2, A9, P9.

Every curve metric starts from the per-score aggregate (one row per distinct score,
partial aggregation per task), whose running sums are a distributed prefix sum (range
partitions + per-partition offsets, ``operators.prefix``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.operators.prefix import running_sums


def score_counts(df: DataFrame, y_true: str = "y_true", y_prob: str = "y_prob", by=()) -> DataFrame:
    """(score, pos, neg) per distinct score, within the groups ``by``."""
    return (df.where(F.col(y_prob).isNotNull() & F.col(y_true).isNotNull())
            .groupBy(*by, F.col(y_prob).alias("score"))
            .agg(F.count_if(F.col(y_true) == 1).alias("pos"), F.count_if(F.col(y_true) != 1).alias("neg")))


def cumulative_counts(counts: DataFrame, order: str = "score", cols=("pos", "neg"), by=()) -> DataFrame:
    """Add ``cum_<c>`` = running sum of ``c`` in score order (W2) and ``total_<c>``, by a
    distributed prefix sum."""
    return running_sums(counts, F.col(order).asc(), cols, by)


def curve_table(df: DataFrame, y_true: str = "y_true", y_prob: str = "y_prob", by=()) -> DataFrame:
    """Per-score counts with ascending cumulative sums (inclusive) and class totals:
    score, pos, neg, cum_pos, cum_neg, P, N. Every curve metric is one aggregate over it:
    counts at or above a score are ``P - cum_pos + pos`` (exact integers)."""
    c = cumulative_counts(score_counts(df, y_true, y_prob, by), by=by)
    return c.withColumnRenamed("total_pos", "P").withColumnRenamed("total_neg", "N")


def _tp_fp_at_or_above():
    tp = F.col("P") - F.col("cum_pos") + F.col("pos")
    fp = F.col("N") - F.col("cum_neg") + F.col("neg")
    return tp, fp


def auc_expr() -> Column:
    """Mann-Whitney over the curve table: ties count 1/2; NULL when one class is absent."""
    below = F.col("cum_neg") - F.col("neg")
    return (F.sum(F.col("pos") * (below + F.lit(0.5) * F.col("neg")))
            / F.nullif(F.first("P") * F.first("N"), F.lit(0)))


def ap_expr() -> Column:
    """Average precision: sum over thresholds of (R_n - R_{n-1}) * P_n (step sum)."""
    tp, fp = _tp_fp_at_or_above()
    return F.sum(F.col("pos") * tp / (tp + fp)) / F.nullif(F.first("P"), F.lit(0))


def high_recall_expr(precision_floor: float) -> Column:
    """Lowest score whose precision (predict >= score) reaches the floor; none -> 0.5; rounded to 4."""
    tp, fp = _tp_fp_at_or_above()
    best = F.min(F.when(tp / (tp + fp) >= F.lit(float(precision_floor)), F.col("score")))
    return F.round(F.coalesce(best, F.lit(0.5)), 4)


def roc_auc(df: DataFrame, y_true: str = "y_true", y_prob: str = "y_prob") -> DataFrame:
    """One row (n, n_pos, n_neg, roc_auc). Ties count 1/2; NULL when one class."""
    return curve_table(df, y_true, y_prob).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
        auc_expr().alias("roc_auc"))


def average_precision(df: DataFrame, y_true: str = "y_true", y_prob: str = "y_prob") -> DataFrame:
    """Sum over thresholds of (R_n - R_{n-1}) * P_n (step sum, no interpolation)."""
    return curve_table(df, y_true, y_prob).agg(F.sum("pos").alias("n_pos"), ap_expr().alias("average_precision"))


def average_precision_by(df: DataFrame, by: list[str], y_true: str = "y_true", y_prob: str = "y_prob") -> DataFrame:
    """E2 per group, all groups in one prefix sum."""
    return curve_table(df, y_true, y_prob, by).groupBy(*by).agg(F.sum("pos").alias("n_pos"), ap_expr().alias("average_precision"))


def brier(df: DataFrame, y_true: str = "y_true", y_prob: str = "y_prob") -> DataFrame:
    """Mean squared error of the probability."""
    return df.agg(F.avg(F.pow(F.col(y_prob) - F.col(y_true), 2)).alias("brier_score"))


def confusion(df: DataFrame, threshold: float | Column, y_true: str = "y_true", y_prob: str = "y_prob") -> list[Column]:
    """Tn, fp, fn, tp as aggregate expressions."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = F.col(y_prob) >= t
    y = F.col(y_true) == 1
    return [F.count_if(~pred & ~y).alias("tn"), F.count_if(pred & ~y).alias("fp"),
            F.count_if(~pred & y).alias("fn"), F.count_if(pred & y).alias("tp")]


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def rates_from_confusion(df: DataFrame) -> DataFrame:
    """Precision, recall, specificity, F1 (0 on zero denominators), rounded to 4."""
    p = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    r = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    s = _ratio(F.col("tn"), F.col("tn") + F.col("fp"))
    out = df.withColumn("_p", p).withColumn("_r", r)
    f1 = _ratio(F.lit(2.0) * F.col("_p") * F.col("_r"), F.col("_p") + F.col("_r"))
    return out.select("*", F.round("_p", 4).alias("precision"), F.round("_r", 4).alias("recall"),
                      F.round(s, 4).alias("specificity"), F.round(f1, 4).alias("f1")).drop("_p", "_r")


def threshold_metrics(df: DataFrame, threshold: float, y_true: str = "y_true", y_prob: str = "y_prob") -> DataFrame:
    """E4 at one threshold: one row."""
    c = df.agg(*confusion(df, threshold, y_true, y_prob)).withColumn("threshold", F.lit(float(threshold)))
    return rates_from_confusion(c)


def high_recall_threshold(df: DataFrame, precision_floor: float, y_true: str = "y_true",
                          y_prob: str = "y_prob") -> DataFrame:
    """Lowest observed score whose precision (predict >= score) is >= the floor; that is
    the maximum-recall candidate (first on ties). None qualifies -> 0.5. Rounded to 4."""
    return curve_table(df, y_true, y_prob).agg(high_recall_expr(precision_floor).alias("threshold"))


def calibration_edges(n_bins: int = 10) -> list[float]:
    """Edges as an evenly spaced grid computes them (i * step), last edge exactly 1.0."""
    step = 1.0 / n_bins
    return [i * step for i in range(n_bins)] + [1.0]


def calibration(df: DataFrame, n_bins: int = 10, y_true: str = "y_true", y_prob: str = "y_prob") -> DataFrame:
    """E5: left-closed equal bins on the literal inner edges, 1.0 in the last bin; empty
    bins dropped. Columns: bin, bin_lower, bin_upper, count, mean_predicted, observed_rate."""
    edges = calibration_edges(n_bins)
    inner = edges[1:-1]
    b = sum((F.col(y_prob) >= F.lit(e)).cast("int") for e in inner)
    lower = F.element_at(F.array(*[F.lit(round(e, 2)) for e in edges[:-1]]), F.col("bin") + 1)
    upper = F.element_at(F.array(*[F.lit(round(e, 2)) for e in edges[1:]]), F.col("bin") + 1)
    return (df.where(F.col(y_prob).isNotNull()).groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"), F.avg(y_prob).alias("_mp"),
                 F.avg(F.col(y_true).cast("double")).alias("_or"))
            .select("bin", lower.alias("bin_lower"), upper.alias("bin_upper"), "count",
                    F.round("_mp", 4).alias("mean_predicted"), F.round("_or", 4).alias("observed_rate")))


def evaluate(df: DataFrame, decision_threshold: float = 0.5, precision_floor: float = 0.30,
             min_roc_auc: float = 0.70, min_pr_auc: float = 0.35, max_brier: float = 0.20,
             y_true: str = "y_true", y_prob: str = "y_prob") -> DataFrame:
    """E7 + E8: one metric row with gate columns (the gate compares the rounded values).

    One per-score curve table serves ROC-AUC, AP and the high-recall threshold in a single
    aggregate; rate and Brier are a second aggregate over the rows."""
    curve = curve_table(df, y_true, y_prob).agg(auc_expr().alias("_auc"), ap_expr().alias("_ap"),
                                                high_recall_expr(precision_floor).alias("high_recall_threshold"))
    extra = df.agg(F.avg(F.col(y_true).cast("double")).alias("_pr"), F.count(F.lit(1)).alias("n_rows"),
                   F.avg(F.pow(F.col(y_prob) - F.col(y_true), 2)).alias("_br"))
    out = curve.crossJoin(extra).select(  # one-row tables
        "n_rows", F.round("_pr", 4).alias("positive_rate"), F.round("_auc", 4).alias("roc_auc"),
        F.round("_ap", 4).alias("pr_auc"), F.round("_br", 4).alias("brier_score"),
        F.lit(float(decision_threshold)).alias("decision_threshold"), "high_recall_threshold")
    # a metric that cannot be computed (one class, no rows) does not pass
    return out.select("*", F.coalesce(F.col("roc_auc") >= min_roc_auc, F.lit(False)).alias("passes_roc_auc"),
                      F.coalesce(F.col("pr_auc") >= min_pr_auc, F.lit(False)).alias("passes_pr_auc"),
                      F.coalesce(F.col("brier_score") <= max_brier, F.lit(False)).alias("passes_brier_score"))


def operating_points(df: DataFrame, decision_threshold: float = 0.5, precision_floor: float = 0.30,
                     y_true: str = "y_true", y_prob: str = "y_prob") -> DataFrame:
    """E4 at the default and at the high-recall threshold: two rows, one aggregate pass.

    The high-recall threshold is a one-row table; the confusion counts for both points
    are computed in the same ``agg`` over the scored table.
    """
    hr = high_recall_threshold(df, precision_floor, y_true, y_prob)
    joined = df.crossJoin(F.broadcast(hr))
    d = confusion(joined, decision_threshold, y_true, y_prob)
    h = confusion(joined, F.col("threshold"), y_true, y_prob)
    agg = joined.agg(*[x.alias(f"d_{n}") for x, n in zip(d, ("tn", "fp", "fn", "tp"))],
                     *[x.alias(f"h_{n}") for x, n in zip(h, ("tn", "fp", "fn", "tp"))],
                     F.first("threshold").alias("h_threshold"))
    pts = agg.select(F.explode(F.array(
        F.struct(F.lit("default").alias("operating_point"), F.lit(float(decision_threshold)).alias("threshold"),
                 *[F.col(f"d_{n}").alias(n) for n in ("tn", "fp", "fn", "tp")]),
        F.struct(F.lit("high_recall").alias("operating_point"), F.col("h_threshold").alias("threshold"),
                 *[F.col(f"h_{n}").alias(n) for n in ("tn", "fp", "fn", "tp")]))).alias("p")).select("p.*")
    return rates_from_confusion(pts)


def compare_candidates(metric_rows: DataFrame, name_col: str = "algorithm", metric: str = "roc_auc") -> DataFrame:
    """E10 + O5: side-by-side metric rows and the best candidate by ``metric``."""
    best = metric_rows.agg(F.max_by(name_col, metric).alias("best"))
    return metric_rows.crossJoin(best).withColumn("is_best", F.col(name_col) == F.col("best")).drop("best")
