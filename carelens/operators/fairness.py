"""Group fairness (F1, F1b, A11), slice error analysis (F2, F3, A10, O1), promotion gate.

Fairness: the sensitive columns are unpivoted with ``stack`` so one ``groupBy(attribute,
group)`` (partial aggregation, tiny output) serves every column at once.

Slices: the scored table is first aggregated to the slice columns' value domain, then
GROUPING SETS (5 singles + 10 pairs) run over that small table, so the Expand x15 never
touches the full row count.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.schemas import FAIRNESS_SENSITIVE_COLUMNS, SLICE_COLUMNS

# Columns whose equalised-odds difference is enforced by the gate.
ENFORCED_FAIRNESS_COLUMNS = ["sex", "ethnicity"]


def _rate(num, den):
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def group_counts(df: DataFrame, sensitive: list[str] = FAIRNESS_SENSITIVE_COLUMNS,
                 y_true: str = "y_true", y_pred: str = "y_pred", include_overall: bool = True) -> DataFrame:
    """Confusion counts per (attribute, group); ``group`` = '__overall__' rows per attribute.

    Absent sensitive columns are skipped; NULL group values are excluded.
    """
    cols = [c for c in sensitive if c in df.columns]
    if not cols:
        raise ValueError("no sensitive column present")
    stacked = df.select(F.col(y_true).alias("_y"), F.col(y_pred).alias("_p"),
                        F.inline(F.array(*[F.struct(F.lit(c).alias("attribute"),
                                                    F.col(c).cast("string").alias("group")) for c in cols])))
    stacked = stacked.where(F.col("group").isNotNull())
    y, p = F.col("_y") == 1, F.col("_p") == 1
    counts = [F.count(F.lit(1)).alias("n"), F.count_if(p).alias("sel"), F.count_if(p & y).alias("tp"),
              F.count_if(~p & y).alias("fn"), F.count_if(p & ~y).alias("fp"), F.count_if(~p & ~y).alias("tn")]
    by_group = stacked.groupBy("attribute", "group").agg(*counts)
    if include_overall:
        overall = stacked.groupBy("attribute").agg(*counts).withColumn("group", F.lit("__overall__"))
        by_group = by_group.unionByName(overall)
    return by_group


def _rates(counts: DataFrame) -> DataFrame:
    return counts.select(
        "attribute", "group", "n",
        _rate(F.col("sel"), F.col("n")).alias("selection_rate"),
        _rate(F.col("tp"), F.col("tp") + F.col("fn")).alias("tpr"),
        _rate(F.col("fp"), F.col("fp") + F.col("tn")).alias("fpr"),
        _rate(F.col("fn"), F.col("tp") + F.col("fn")).alias("fnr"))


def group_metrics(df: DataFrame, sensitive: list[str] = FAIRNESS_SENSITIVE_COLUMNS,
                  y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """per (attribute, group): n, selection_rate, tpr, fpr, fnr, rounded to 4.

    A group with no positives (negatives) gets tpr and fnr (fpr) 0.
    """
    r = _rates(group_counts(df, sensitive, y_true, y_pred))
    return r.select("attribute", "group", "n", *[F.round(c, 4).alias(c) for c in ("selection_rate", "tpr", "fpr", "fnr")])


def fairness_differences(df: DataFrame, sensitive: list[str] = FAIRNESS_SENSITIVE_COLUMNS, max_eod: float = 0.10,
                         y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """A11 + F1b: per attribute, demographic parity difference (range of the selection
    rate), equalised odds difference (max of the TPR and FPR ranges) on unrounded rates,
    then rounded to 4, and the gate flag (<= max_eod on the rounded value)."""
    g = _rates(group_counts(df, sensitive, y_true, y_pred, include_overall=False))
    agg = g.groupBy("attribute").agg(
        (F.max("selection_rate") - F.min("selection_rate")).alias("_dpd"),
        (F.max("tpr") - F.min("tpr")).alias("_tr"), (F.max("fpr") - F.min("fpr")).alias("_fr"))
    eod = F.round(F.greatest("_tr", "_fr"), 4)
    return agg.select("attribute", F.round("_dpd", 4).alias("demographic_parity_difference"),
                      eod.alias("equalized_odds_difference"),
                      (eod <= F.lit(float(max_eod))).alias("passes_equalized_odds_gate"))


def error_rate(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """mean(y_true != y_pred)."""
    return df.agg(F.avg((F.col(y_true) != F.col(y_pred)).cast("double")).alias("error_rate"))


def analyze_slices(df: DataFrame, min_slice_size: int = 30, elevation_factor: float = 1.25,
                   columns: list[str] = SLICE_COLUMNS, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """single-column slices with n >= min (all), column-pair slices only when flagged.

    flagged = slice error rate > elevation_factor * global rate (strict, unrounded).
    Output: slice_columns, slice_values (comma-joined), n, error_rate, global_error_rate
    (rounded to 4), flagged; ordered by error rate, descending (O1).
    """
    cols = [c for c in columns if c in df.columns]
    err = (F.col(y_true) != F.col(y_pred)).cast("long")
    domain = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"), F.sum(err).alias("_e"))
    sets = [[c] for c in cols] + [list(p) for p in combinations(cols, 2)]
    gs = domain.groupingSets(sets, *cols).agg(F.sum("_n").alias("n"), F.sum("_e").alias("errors"),
                                             *[F.grouping(c).alias(f"_g_{c}") for c in cols])
    active = [F.when(F.col(f"_g_{c}") == 0, F.lit(c)) for c in cols]
    values = [F.when(F.col(f"_g_{c}") == 0, F.col(c).cast("string")) for c in cols]
    gs = gs.select("*", F.array_compact(F.array(*active)).alias("_cols"),
                   F.array_compact(F.array(*values)).alias("_vals"))
    # NULL keys are dropped (a slice on a NULL value is not a slice)
    gs = gs.where(F.size("_vals") == F.size("_cols"))
    glob = df.agg(F.avg(err.cast("double")).alias("_global"))
    rate = F.col("errors") / F.col("n")
    out = (gs.crossJoin(F.broadcast(glob))  # one-row global rate
           .withColumn("flagged", rate > F.col("_global") * F.lit(float(elevation_factor)))
           .where((F.col("n") >= min_slice_size) & ((F.size("_cols") == 1) | F.col("flagged"))))
    return out.select(F.array_join("_cols", ",").alias("slice_columns"), F.array_join("_vals", ",").alias("slice_values"),
                      "n", F.round(rate, 4).alias("error_rate"), F.round("_global", 4).alias("global_error_rate"),
                      "flagged").orderBy(F.col("error_rate").desc(), "slice_columns", "slice_values")


def promotion_gate(metrics: DataFrame, differences: DataFrame, min_roc_auc: float = 0.70, min_pr_auc: float = 0.35,
                   max_brier: float = 0.20, max_eod: float = 0.10,
                   enforced: list[str] = ENFORCED_FAIRNESS_COLUMNS) -> DataFrame:
    """One row per failed check with a readable reason (empty table = pass).

    ``metrics`` is the one-row output of ``evaluate``; ``differences`` the output of
    ``fairness_differences``. A value that could not be computed (NULL) fails its check. An
    enforced attribute missing from the table only warns (no row).
    """
    def failed(check, value, limit: float, lowest: bool):
        bad = F.coalesce(value < limit if lowest else value > limit, F.lit(True))
        bound = "minimum" if lowest else "maximum"
        reason = F.when(value.isNull(), F.concat(check, F.lit(" could not be computed"))).otherwise(
            F.concat(check, F.lit(" is "), value.cast("string"), F.lit(f"; the {bound} is {limit}")))
        return F.struct(check.alias("check"), value.alias("value"), bad.alias("failed"), reason.alias("reason"))

    m = metrics.select(F.explode(F.array(
        failed(F.lit("roc_auc"), F.col("roc_auc"), min_roc_auc, True),
        failed(F.lit("pr_auc"), F.col("pr_auc"), min_pr_auc, True),
        failed(F.lit("brier_score"), F.col("brier_score"), max_brier, False))).alias("c")).select("c.*")
    name = F.concat(F.lit("equalized_odds_difference["), F.col("attribute"), F.lit("]"))
    f = differences.where(F.col("attribute").isin(*enforced)).select(
        failed(name, F.col("equalized_odds_difference"), max_eod, False).alias("c")).select("c.*")
    return m.unionByName(f).where("failed").select("check", "value", "reason")
