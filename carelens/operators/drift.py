"""Data drift (PSI, D1-D4, A8, J3, C8) and prediction drift (KS, rolling AUC, D5-D7).

Fused drift: both sides are unpivoted to (side, feature, value) with ``inline`` and counted
once per distinct value (partial aggregation); the baseline's decile edges are read off a
distributed running sum of these counts, and the bin counts are a second, small aggregate of
them. The edges table has one row per feature and is broadcast. No per-feature loop, and no
task holds a whole feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelens.operators.evaluate import cumulative_counts, roc_auc
from carelens.operators.prefix import ks_pvalue, quantiles, running_sums
from carelens.schemas import CATEGORICAL_COLUMNS, MODEL_FEATURE_COLUMNS
from carelens.session import cut_lineage

EPSILON = 1e-4


def quantile_grid(n_bins: int = 10) -> list[float]:
    """Quantile levels i * (1 / n_bins), last exactly 1.0 (as an evenly spaced grid)."""
    step = 1.0 / n_bins
    return [i * step for i in range(n_bins)] + [1.0]


def _long(df: DataFrame, side: str, features: list[str], numeric: bool) -> DataFrame:
    cast = "double" if numeric else "string"
    vals = []
    for f in features:
        v = F.col(f).cast("int").cast(cast) if dict(df.dtypes)[f] == "boolean" and numeric else F.col(f).cast(cast)
        vals.append(F.struct(F.lit(f).alias("feature"), v.alias("value")))
    return df.select(F.lit(side).alias("side"), F.inline(F.array(*vals)))


def _term(c, b):
    """One bin's PSI term with both shares clipped at EPSILON from below."""
    c = F.greatest(c, F.lit(EPSILON))
    b = F.greatest(b, F.lit(EPSILON))
    return (c - b) * F.ln(c / b)


def _psi(counts: DataFrame, keys: list[str]) -> DataFrame:
    """D3 over (keys..., side, n): shares, union of bins (missing = 0), clip, sum.

    ``counts`` is already aggregated (features x sides x bins rows), so the per-side
    totals are a window over it rather than a second pass over the data.
    """
    props = counts.withColumn("_p", F.col("n") / F.sum("n").over(Window.partitionBy(*keys[:-1], "side")))
    wide = props.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col("side") == "baseline", F.col("_p"))), F.lit(0.0)).alias("b"),
        F.coalesce(F.sum(F.when(F.col("side") == "current", F.col("_p"))), F.lit(0.0)).alias("c"))
    return wide.groupBy(*keys[:-1]).agg(F.sum(_term(F.col("c"), F.col("b"))).alias("psi"))


def value_counts(df: DataFrame, side: str, features: list[str], numeric: bool = True) -> DataFrame:
    """(side, feature, value, n) over non-NULL values."""
    long = _long(df, side, features, numeric).where(F.col("value").isNotNull())
    return long.groupBy("side", "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def edges_of(counts: DataFrame, n_bins: int = 10) -> DataFrame:
    """A8 from (feature, value, n): per feature the distinct quantile edges, ascending."""
    q = quantiles(counts, "value", quantile_grid(n_bins), ["feature"])
    return q.select("feature", F.array_distinct(F.array_sort("q")).alias("edges"))


def quantile_edges(baseline: DataFrame, features: list[str], n_bins: int = 10) -> DataFrame:
    """Per feature, distinct baseline quantile edges (linear interpolation), NULLs ignored."""
    return edges_of(value_counts(baseline, "baseline", features), n_bins)


def _bin_col(edges_col: str = "edges") -> F.Column:
    """Right-closed bin index over the inner edges; a feature with fewer than 3 distinct
    edges puts every value in bin 0, which makes its PSI exactly 0."""
    inner = F.slice(F.col(edges_col), 2, F.greatest(F.size(edges_col) - 2, F.lit(0)))
    return F.when(F.size(edges_col) >= 3, F.size(F.filter(inner, lambda e: e < F.col("value")))).otherwise(F.lit(0))


def psi_numeric(baseline: DataFrame, current: DataFrame, features: list[str], n_bins: int = 10) -> DataFrame:
    """PSI per numeric feature; baseline deciles, outer edges +-inf, right-closed bins,
    proportions over non-NULL values; fewer than 3 distinct edges -> 0.

    Each side is read once, for its value counts (edges broadcast: one row per feature)."""
    counts = cut_lineage(value_counts(baseline, "baseline", features)
                         .unionByName(value_counts(current, "current", features)))
    edges = edges_of(counts.where("side = 'baseline'"), n_bins)
    binned = counts.join(F.broadcast(edges), "feature").select("feature", "side", _bin_col().alias("bin"), "n")
    return _psi(binned.groupBy("feature", "side", "bin").agg(F.sum("n").alias("n")), ["feature", "bin"])


def _psi_deltas(c: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """PSI per period from shares: c (_period, keys, pc) and b (keys, pb), keys[0] the feature.

    PSI_p = sum over the baseline's bins of term(eps, b) (a per-feature constant)
          + sum over the period's bins of [term(c, b) - term(eps, b) if b present else term(c, eps)],
    so there is no periods x bins cross product."""
    const = b.groupBy(keys[0]).agg(F.sum(_term(F.lit(0.0), F.col("pb"))).alias("_const"))
    delta = F.when(F.col("pb").isNotNull(), _term(F.col("pc"), F.col("pb")) - _term(F.lit(0.0), F.col("pb"))) \
        .otherwise(_term(F.col("pc"), F.lit(0.0)))
    per = c.join(b, keys, "left").groupBy("_period", keys[0]).agg(F.sum(delta).alias("_d"))
    return per.join(const, keys[0]).select("_period", keys[0], (F.col("_d") + F.col("_const")).alias("psi"))


def psi_numeric_by_period(baseline: DataFrame, current: DataFrame, features: list[str], period: str,
                          n_bins: int = 10) -> DataFrame:
    """D1 per period of the current side (e.g. month), one fused job for every
    (period, feature) with values; edges from the whole baseline. Output: period, feature, psi."""
    base = cut_lineage(value_counts(baseline, "baseline", features))
    edges = edges_of(base, n_bins)
    b = (base.join(F.broadcast(edges), "feature").groupBy("feature", _bin_col().alias("bin"))
         .agg(F.sum("n").alias("n")))
    b = b.select("feature", "bin", (F.col("n") / F.sum("n").over(Window.partitionBy("feature"))).alias("pb"))
    cur_long = current.select(F.col(period).alias("_period"), F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"),
                 (F.col(f).cast("int") if dict(current.dtypes)[f] == "boolean" else F.col(f)).cast("double").alias("value"))
        for f in features]))).where(F.col("value").isNotNull())
    c = cur_long.groupBy("_period", "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    c = (c.join(F.broadcast(edges), "feature").groupBy("_period", "feature", _bin_col().alias("bin"))
         .agg(F.sum("n").alias("n")))
    c = c.select("_period", "feature", "bin",
                 (F.col("n") / F.sum("n").over(Window.partitionBy("_period", "feature"))).alias("pc"))
    return _psi_deltas(c, b, ["feature", "bin"]).withColumnRenamed("_period", period).select(period, "feature", "psi")


def psi_categorical_by_period(baseline: DataFrame, current: DataFrame, features: list[str], period: str) -> DataFrame:
    """D2 per period of the current side; NULL is its own category. Output: period, feature, psi."""
    b = (_long(baseline, "baseline", features, False).withColumn("value", F.coalesce("value", F.lit("None")))
         .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
    b = b.select("feature", "value", (F.col("n") / F.sum("n").over(Window.partitionBy("feature"))).alias("pb"))
    c = current.select(F.col(period).alias("_period"), F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.coalesce(F.col(f).cast("string"), F.lit("None")).alias("value"))
        for f in features]))).groupBy("_period", "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    c = c.select("_period", "feature", "value",
                 (F.col("n") / F.sum("n").over(Window.partitionBy("_period", "feature"))).alias("pc"))
    return _psi_deltas(c, b, ["feature", "value"]).withColumnRenamed("_period", period).select(period, "feature", "psi")


def drift_events_by_period(baseline: DataFrame, current: DataFrame, period: str, features: list[str],
                           psi_threshold: float = 0.2) -> DataFrame:
    """D4 over time: one 'DataDriftReport' event per period (timestamp = period start),
    drift_detected when any feature's PSI exceeds the threshold, over numeric and categorical
    features alike."""
    cats = [f for f in features if f in CATEGORICAL_COLUMNS]
    nums = [f for f in features if f not in CATEGORICAL_COLUMNS]
    parts = [psi_numeric_by_period(baseline, current, nums, period)] if nums else []
    parts += [psi_categorical_by_period(baseline, current, cats, period)] if cats else []
    p = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return p.groupBy(period).agg(F.max((F.col("psi") > psi_threshold).cast("int")).alias("_d"),
                                 F.round(F.max("psi"), 6).alias("max_psi")).select(
        F.col(period).cast("timestamp").alias("timestamp"), F.lit("DataDriftReport").alias("name"),
        (F.col("_d") == 1).alias("drift_detected"), "max_psi")


def psi_categorical(baseline: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """PSI per categorical feature on value shares; NULL is its own category."""
    long = (_long(baseline, "baseline", features, False).unionByName(_long(current, "current", features, False))
            .withColumn("value", F.coalesce(F.col("value"), F.lit("None"))))
    counts = long.groupBy("feature", "side", "value").agg(F.count(F.lit(1)).alias("n"))
    return _psi(counts, ["feature", "value"])


def drift_report(baseline: DataFrame, current: DataFrame, psi_threshold: float = 0.2, n_bins: int = 10,
                 features: list[str] = MODEL_FEATURE_COLUMNS) -> DataFrame:
    """One row per model feature present on both sides: psi (rounded to 4), drifted
    (psi > threshold, unrounded), kind."""
    both = [f for f in features if f in baseline.columns and f in current.columns]
    cats = [f for f in both if f in CATEGORICAL_COLUMNS]
    nums = [f for f in both if f not in CATEGORICAL_COLUMNS]
    parts = []
    if nums:
        parts.append(psi_numeric(baseline, current, nums, n_bins).withColumn("kind", F.lit("numeric")))
    if cats:
        parts.append(psi_categorical(baseline, current, cats).withColumn("kind", F.lit("categorical")))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.select("feature", "kind", F.round("psi", 4).alias("psi"),
                      (F.col("psi") > F.lit(float(psi_threshold))).alias("drifted"))


def drift_summary(report: DataFrame, baseline: DataFrame, current: DataFrame) -> DataFrame:
    """D4 summary row: rows per side, drifted feature list, overall flag."""
    rows = baseline.agg(F.count(F.lit(1)).alias("baseline_rows")).crossJoin(
        current.agg(F.count(F.lit(1)).alias("current_rows")))
    flags = report.agg(F.count(F.lit(1)).alias("features_evaluated"),
                       F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature")))).alias("drifted_features"))
    return rows.crossJoin(flags).withColumn("drift_detected", F.size("drifted_features") > 0)


def _ks_row(d: DataFrame, gap: str, pvalue_threshold: float, keys=()) -> DataFrame:
    # p is computed in its own projection: in a single select, the rounded output alias
    # would shadow the unrounded statistic (lateral column alias resolution).
    d = d.withColumn("_p", ks_pvalue(F.col(gap), F.col("n"), F.col("m")))
    return d.select(*keys, F.col("n").alias("baseline_n"), F.col("m").alias("current_n"),
                    F.round(gap, 4).alias("ks_statistic"), F.round("_p", 6).alias("ks_pvalue"),
                    (F.col("_p") < F.lit(float(pvalue_threshold))).alias("drift_detected"))


def ks_two_sample(baseline: DataFrame, current: DataFrame, column: str, pvalue_threshold: float = 0.01) -> DataFrame:
    """Two-sample KS: D = max gap of the two empirical CDFs over per-value counts, with
    the asymptotic p-value of lambda = D sqrt(nm/(n+m)); D = 0 -> 1. NULLs dropped (C8)."""
    b = baseline.where(F.col(column).isNotNull()).select(F.col(column).alias("score"), F.lit(1).alias("pos"),
                                                          F.lit(0).alias("neg"))
    c = current.where(F.col(column).isNotNull()).select(F.col(column).alias("score"), F.lit(0).alias("pos"),
                                                         F.lit(1).alias("neg"))
    counts = b.unionByName(c).groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    cum = cumulative_counts(counts).withColumnRenamed("total_pos", "n").withColumnRenamed("total_neg", "m")
    gap = cum.select("n", "m", F.abs(F.col("cum_pos") / F.col("n") - F.col("cum_neg") / F.col("m")).alias("gap"))
    return _ks_row(gap.groupBy("n", "m").agg(F.max("gap").alias("_gap")), "_gap", pvalue_threshold)


def ks_by_period(baseline: DataFrame, current: DataFrame, column: str, period: str,
                 pvalue_threshold: float = 0.01) -> DataFrame:
    """D5 per period of the current side.

    Between two scores of a period its own CDF is flat and the baseline's rises, so the largest
    gap stands at a score of the period or just before one: the baseline CDF is needed at the
    periods' scores only. One running sum over the distinct scores gives it there; the periods'
    own CDFs are a second one, grouped by period."""
    b = baseline.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("score")) \
        .agg(F.count(F.lit(1)).alias("pos"))
    c = current.where(F.col(column).isNotNull()).groupBy(F.col(period).alias("_period"), F.col(column).alias("score")) \
        .agg(F.count(F.lit(1)).alias("neg"))
    scores = b.unionByName(c.select("score", F.lit(0).cast("bigint").alias("pos"))).groupBy("score").agg(F.sum("pos").alias("pos"))
    cdf = cumulative_counts(scores, cols=("pos",)).select("score", "pos", "cum_pos", F.col("total_pos").alias("n"))
    own = running_sums(c, F.col("score").asc(), ["neg"], ["_period"]).withColumnRenamed("total_neg", "m")
    j = own.join(cdf, "score")
    at = F.abs(F.col("cum_pos") / F.col("n") - F.col("cum_neg") / F.col("m"))
    just_before = F.abs((F.col("cum_pos") - F.col("pos")) / F.col("n") - (F.col("cum_neg") - F.col("neg")) / F.col("m"))
    d = j.groupBy("_period", "n", "m").agg(F.max(F.greatest(at, just_before)).alias("_gap"))
    return _ks_row(d, "_gap", pvalue_threshold, [F.col("_period").alias(period)])


def rolling_auc(current: DataFrame, prob: str = "readmission_probability", label: str = "readmitted_30d",
                min_roc_auc: float = 0.70, by: list | None = None) -> DataFrame:
    """ROC-AUC over rows whose label has arrived. One row (or one per ``by`` group):
    n_labeled, roc_auc (rounded to 4; NULL when no labels or one class), below_threshold."""
    lab = current.where(F.col(label).isNotNull())
    if by:
        sc = (lab.groupBy(*by, F.col(prob).alias("score"))
              .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")))
        sc = cumulative_counts(sc, cols=("neg",), by=by).withColumn("cum_neg", F.col("cum_neg") - F.col("neg"))
        auc = sc.groupBy(*by).agg(
            F.sum(F.col("pos") + F.col("neg")).alias("n_labeled"),
            (F.sum(F.col("pos") * (F.col("cum_neg") + F.lit(0.5) * F.col("neg")))
             / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("_auc"))
    else:
        auc = roc_auc(lab, y_true=label, y_prob=prob).select(F.col("n").alias("n_labeled"), F.col("roc_auc").alias("_auc"))
    return auc.select(*(by or []), F.coalesce(F.col("n_labeled"), F.lit(0)).alias("n_labeled"),
                      F.round("_auc", 4).alias("roc_auc"),
                      (F.col("_auc") < F.lit(float(min_roc_auc))).alias("below_threshold"))


def model_drift(ks: DataFrame, auc: DataFrame) -> DataFrame:
    """Drift when the KS test flags or the rolling AUC is below the minimum."""
    return ks.crossJoin(auc.select(F.col("n_labeled"), F.col("roc_auc").alias("rolling_roc_auc"),
                                   F.col("below_threshold"))).withColumn(
        "model_drift_detected", F.col("drift_detected") | F.coalesce(F.col("below_threshold"), F.lit(False)))


def join_late_labels(scores: DataFrame, labels: DataFrame, horizon_days: int = 60) -> DataFrame:
    """J8 (batch twin of the streaming interval join): scores (encounter_id, scored_ts, ...)
    left-joined to labels (encounter_id, label_ts, readmitted_30d) that arrive within
    [scored_ts, scored_ts + horizon]. An equi-join on the id with a range filter."""
    s = scores.alias("s")
    lab = labels.alias("l")
    cond = (F.col("s.encounter_id") == F.col("l.encounter_id")) & (F.col("l.label_ts") >= F.col("s.scored_ts")) & \
        (F.col("l.label_ts") <= F.col("s.scored_ts") + F.expr(f"INTERVAL {int(horizon_days)} DAYS"))
    return s.join(lab, cond, "left").select("s.*", "l.label_ts", "l.readmitted_30d")
