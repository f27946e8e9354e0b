"""Table profiles: value shares (A2), describe (A3), equal-width bin rates (A4),
histograms (A5), distinct count (A13), group means (A1), head (O6).

Multi-column profiles unpivot with ``inline`` and run one grouped aggregate for all
columns instead of one job per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.operators.prefix import quantiles


def _long(df: DataFrame, columns: list[str], cast: str) -> DataFrame:
    return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(cast).alias("value"))
                                        for c in columns])))


def group_rate(df: DataFrame, by: list[str], target: str = "readmitted_30d") -> DataFrame:
    """A1: mean of the label by group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(target).cast("double")).alias("rate"))


def value_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """A2: (column, value, count, share) per categorical column; share over non-NULL rows."""
    counts = _long(df, columns, "string").where(F.col("value").isNotNull()) \
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy("column").agg(F.sum("count").alias("_t"))
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", "count", F.round(F.col("count") / F.col("_t"), 6).alias("share"))


def describe_numeric(df: DataFrame, columns: list[str], approx: bool = False, accuracy: int = 10_000) -> DataFrame:
    """A3 (numeric): count, mean, std (sample), min, 25/50/75% (linear), max per column.

    Quartiles are exact, read off a distributed running count of distinct values;
    ``approx=True`` uses ``percentile_approx`` (a bounded sketch, one pass)."""
    long = _long(df, columns, "double").where(F.col("value").isNotNull())
    stats = [F.count(F.lit(1)).alias("count"), F.round(F.avg("value"), 6).alias("mean"),
             F.round(F.stddev_samp("value"), 6).alias("std"), F.min("value").alias("min")]
    probs = [0.25, 0.5, 0.75]
    if approx:
        q = F.percentile_approx("value", F.array(*map(F.lit, probs)), accuracy).cast("array<double>")
        g = long.groupBy("column").agg(*stats, F.max("value").alias("max"), q.alias("q"))
    else:
        counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        g = long.groupBy("column").agg(*stats, F.max("value").alias("max")).join(
            quantiles(counts, "value", probs, ["column"]), "column")
    return g.select("column", "count", "mean", "std", "min",
                    *[F.round(F.col("q")[i], 6).alias(f"p{int(p * 100)}") for i, p in enumerate(probs)], "max")


def describe_categorical(df: DataFrame, columns: list[str]) -> DataFrame:
    """A3 (strings): count, unique, top (most frequent; smallest value on ties), freq."""
    counts = _long(df, columns, "string").where(F.col("value").isNotNull()) \
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("k"))
    return counts.groupBy("column").agg(
        F.sum("k").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("k"), F.col("value"))).alias("top"), F.max("k").alias("freq"))


def histogram(df: DataFrame, columns: list[str], bins: int = 30) -> DataFrame:
    """A5: equal-width bins per column between its min and max (last bin closed).

    (column, bin, lower, upper, count); empty bins are not emitted.
    """
    long = _long(df, columns, "double").where(F.col("value").isNotNull())
    rng = long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo"))
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) * F.lit(float(bins)) / width), F.lit(bins - 1))).cast("int")
    # one row per column: a bounded broadcast side
    counts = long.join(F.broadcast(rng), "column").groupBy("column", b.alias("bin"), "lo", "hi") \
        .agg(F.count(F.lit(1)).alias("count"))
    lower = F.col("lo") + width * F.col("bin") / F.lit(float(bins))
    upper = F.col("lo") + width * (F.col("bin") + 1) / F.lit(float(bins))
    return counts.select("column", "bin", F.round(lower, 6).alias("lower"), F.round(upper, 6).alias("upper"), "count")


def equal_width_rate(df: DataFrame, value: str, target: str = "readmitted_30d", bins: int = 5) -> DataFrame:
    """A4: right-closed equal-width bins of ``value`` over [min, max] (min in bin 1);
    count, mean value and mean target per bin."""
    rng = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.greatest(F.ceil((F.col(value) - F.col("lo")) / width), F.lit(1)), F.lit(bins))).cast("int")
    return (df.where(F.col(value).isNotNull()).crossJoin(F.broadcast(rng))  # one-row range
            .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"),
                                         F.round(F.avg(value), 6).alias("mean_value"),
                                         F.round(F.avg(F.col(target).cast("double")), 6).alias("rate")))


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Exact distinct count (two-phase aggregate)."""
    return df.agg(F.count_distinct(column).alias(f"distinct_{column}"), F.count(F.lit(1)).alias("rows"))


def head(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in an explicit order (TakeOrdered, not a full sort)."""
    return df.orderBy(*order_by).limit(n)
