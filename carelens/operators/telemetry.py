"""Telemetry queries (K1-K7) and alert rules (L1-L5), batch form.

Each query takes the telemetry table, an ``as_of`` timestamp and a ``lookback`` (the
KQL ``ago()``); ``lookback=None`` scans the whole table. Bins are tumbling ``window``s
(``window`` on the event-time column is the same expression the streaming twins use).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.operators.prefix import quantiles

# Endpoint name and dependency target matched by the queries.
SCORE_OPERATION = "v1/score"
INFERENCE_TARGET = "inference.ml.azure.com"


def has_term(col: Column, term: str) -> Column:
    """KQL ``has``: ``term`` as a whole token sequence, case-insensitive."""
    import re

    return col.rlike("(?i)(^|[^A-Za-z0-9_])" + re.escape(term) + "($|[^A-Za-z0-9_])")


def startswith_ci(col: Column, prefix: str) -> Column:
    """KQL ``startswith`` (case-insensitive)."""
    return F.lower(col).startswith(prefix.lower())


def dim(col: Column, key: str) -> Column:
    """``tostring(customDimensions[key])`` on a JSON-string dimensions column."""
    return F.get_json_object(col, f"$.{key}")


def dim_bool(col: Column, key: str) -> Column:
    """``tobool(customDimensions[key])``: true / false in any case, or a number (0 is false);
    anything else is NULL."""
    v = F.lower(dim(col, key))
    return F.when(v.isin("true", "false"), v == "true").otherwise(v.try_cast("double") != 0)


def pct(num: Column, den: Column, digits: int) -> Column:
    """round(100 * num / den, digits)."""
    return F.round(F.lit(100.0) * num / den, digits)


def recent(df: DataFrame, as_of: Column | None, lookback: str | None, ts: str = "timestamp") -> DataFrame:
    """``timestamp > as_of - lookback`` (no filter when lookback is None)."""
    if lookback is None:
        return df
    return df.where(F.col(ts) > as_of - F.expr(f"INTERVAL {lookback}"))


def _bin(size: str, ts: str = "timestamp") -> Column:
    return F.window(ts, size).start


def latency_percentiles(requests: DataFrame, as_of: Column | None = None, lookback: str | None = None,
                        bin_size: str = "5 minutes", approx: bool = False, accuracy: int = 10_000) -> DataFrame:
    """K1 + A7: p50/p95/p99 duration and request count per bin. Exact (linear) by default;
    ``approx=True`` uses a ``percentile_approx`` sketch per bin (KQL's own percentile is
    approximate). In time order."""
    r = recent(requests, as_of, lookback).where(has_term(F.col("name"), SCORE_OPERATION))
    r = r.select(_bin(bin_size).alias("timestamp"), "duration")
    probs = [0.5, 0.95, 0.99]
    g = r.groupBy("timestamp")
    if approx:
        out = g.agg(F.count(F.lit(1)).alias("requestCount"),
                    F.percentile_approx("duration", F.array(*map(F.lit, probs)), accuracy).cast("array<double>").alias("q"))
    else:
        counts = r.groupBy("timestamp", "duration").agg(F.count(F.lit(1)).alias("n"))
        out = g.agg(F.count(F.lit(1)).alias("requestCount")).join(
            quantiles(counts, "duration", probs, ["timestamp"]), "timestamp", "left")
    return out.select("timestamp", *[F.round(F.col("q")[i], 6).alias(f"p{int(p * 100)}") for i, p in enumerate(probs)],
                      "requestCount").orderBy("timestamp")


def _binned(rows: DataFrame, bin_size: str, keys: dict[str, Column], aggs: list[Column], ordered: bool,
            derived: dict[str, Column] | None = None) -> DataFrame:
    """One row per (keys, time bin), in time order. Grouped by the window itself, so the same
    code runs on a watermarked stream (which cannot be ordered: ``ordered=False``)."""
    g = rows.groupBy(F.window("timestamp", bin_size).alias("_w"), *[c.alias(k) for k, c in keys.items()]).agg(*aggs)
    names = [c for c in g.columns if c != "_w" and c not in keys]
    start = F.col("_w.start").alias("timestamp")
    out = g.select(*keys, start, *names) if keys else g.select(start, *names)
    for name, c in (derived or {}).items():
        out = out.withColumn(name, c)
    return out.orderBy("timestamp", *keys) if ordered else out


def error_rate_5xx(requests: DataFrame, as_of: Column | None = None, lookback: str | None = None,
                   bin_size: str = "5 minutes", ordered: bool = True) -> DataFrame:
    """K2: total, 5xx errors and error rate (%) per bin."""
    r = recent(requests, as_of, lookback).where(has_term(F.col("name"), SCORE_OPERATION))
    aggs = [F.count(F.lit(1)).alias("total"), F.count_if(startswith_ci(F.col("resultCode"), "5")).alias("errors")]
    return _binned(r, bin_size, {}, aggs, ordered, {"errorRate": pct(F.col("errors"), F.col("total"), 2)})


def failures_by_code(requests: DataFrame, as_of: Column | None = None, lookback: str | None = None,
                     bin_size: str = "5 minutes", ordered: bool = True) -> DataFrame:
    """K3: failed requests by result code and bin."""
    r = recent(requests, as_of, lookback).where(~F.col("success"))
    return _binned(r, bin_size, {"resultCode": F.col("resultCode")}, [F.count(F.lit(1)).alias("count_")], ordered)


def dependency_health(dependencies: DataFrame, as_of: Column | None = None, lookback: str | None = None,
                      bin_size: str = "5 minutes", ordered: bool = True) -> DataFrame:
    """K4: dependency calls to the inference endpoint: total, failures, mean duration."""
    d = recent(dependencies, as_of, lookback).where(has_term(F.col("target"), INFERENCE_TARGET))
    return _binned(d, bin_size, {}, [F.count(F.lit(1)).alias("total"), F.count_if(~F.col("success")).alias("failures"),
                                     F.round(F.avg("duration"), 6).alias("avgDuration")], ordered)


def tier_counts(custom_events: DataFrame, as_of: Column | None = None, lookback: str | None = None,
                bin_size: str = "1 hour", ordered: bool = True) -> DataFrame:
    """K5: scored encounters per risk tier and bin."""
    e = recent(custom_events, as_of, lookback).where(F.col("name") == "ScoringCompleted")
    return _binned(e, bin_size, {"riskTier": dim(F.col("customDimensions"), "risk_tier")},
                   [F.count(F.lit(1)).alias("count_")], ordered)


def throttled_clients(requests: DataFrame, as_of: Column | None = None, lookback: str | None = None,
                      bin_size: str = "5 minutes", ordered: bool = True) -> DataFrame:
    """K6: 429 responses by client application and bin."""
    r = recent(requests, as_of, lookback).where(F.col("resultCode") == "429")
    return _binned(r, bin_size, {"appId": dim(F.col("customDimensions"), "appid")},
                   [F.count(F.lit(1)).alias("count_")], ordered)


def availability(dependencies: DataFrame, as_of: Column | None = None, lookback: str | None = None,
                 bin_size: str = "15 minutes", ordered: bool = True) -> DataFrame:
    """K7: availability % of the inference endpoint per bin."""
    d = recent(dependencies, as_of, lookback).where(has_term(F.col("target"), INFERENCE_TARGET))
    aggs = [F.count(F.lit(1)).alias("total"), F.count_if(F.col("success")).alias("successCount")]
    return _binned(d, bin_size, {}, aggs, ordered, {"availabilityPct": pct(F.col("successCount"), F.col("total"), 3)})


# Alert rule thresholds and windows.
ALERT_RULES = {
    "HighScoringLatencyP95": {"window": "5 minutes", "op": ">", "threshold": 1000.0},
    "HighErrorRate": {"window": "5 minutes", "op": ">", "threshold": 5.0},
    "EndpointAvailabilityDrop": {"window": "15 minutes", "slide": "5 minutes", "op": "<", "threshold": 99.0},
    "DataDriftDetected": {"window": "1 hour", "op": ">", "threshold": 0},
    "ModelDriftDetected": {"window": "1 hour", "op": ">", "threshold": 0},
}


def alerts(requests: DataFrame, dependencies: DataFrame, drift_events: DataFrame | None = None) -> DataFrame:
    """One row per (alert, window) that fires: alert, window_start, window_end, value.

    L1 p95 latency > 1000 ms per 5 min; L2 5xx rate > 5 % per 5 min; L3 availability
    < 99 % over 15 min windows sliding every 5 min; L4/L5 any flagged drift report
    (``drift_events``: timestamp, name, drift_detected) per hour.
    """
    r1, r2, r3 = (ALERT_RULES[k] for k in ("HighScoringLatencyP95", "HighErrorRate", "EndpointAvailabilityDrop"))
    score = requests.where(has_term(F.col("name"), SCORE_OPERATION))
    counts = score.groupBy(F.window("timestamp", r1["window"]).alias("w"), "duration").agg(F.count(F.lit(1)).alias("n"))
    l1 = (quantiles(counts.withColumn("start", F.col("w.start")), "duration", [0.95], ["start"])
          .select(F.struct(F.col("start"), (F.col("start") + F.expr(f"INTERVAL {r1['window']}")).alias("end")).alias("w"),
                  F.col("q")[0].alias("value"))
          .where(F.col("value") > r1["threshold"]).select(F.lit("HighScoringLatencyP95").alias("alert"), "w", "value"))
    l2 = (score.groupBy(F.window("timestamp", r2["window"]).alias("w"))
          .agg((F.lit(100.0) * F.count_if(startswith_ci(F.col("resultCode"), "5")) / F.count(F.lit(1))).alias("value"))
          .where(F.col("value") > r2["threshold"]).select(F.lit("HighErrorRate").alias("alert"), "w", "value"))
    dep = dependencies.where(has_term(F.col("target"), INFERENCE_TARGET))
    l3 = (dep.groupBy(F.window("timestamp", r3["window"], r3["slide"]).alias("w"))
          .agg((F.lit(100.0) * F.count_if(F.col("success")) / F.count(F.lit(1))).alias("value"))
          .where(F.col("value") < r3["threshold"]).select(F.lit("EndpointAvailabilityDrop").alias("alert"), "w", "value"))
    out = l1.unionByName(l2).unionByName(l3).select(
        "alert", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        F.round("value", 6).alias("value"))
    return out if drift_events is None else out.unionByName(drift_alerts(drift_events))


def drift_alerts(drift_events: DataFrame) -> DataFrame:
    """Hourly windows holding at least one flagged drift report event. The flag is the
    ``drift_detected`` entry of the events' ``customDimensions`` (``drift_events``: timestamp,
    name, customDimensions), or a column of that name."""
    if "customDimensions" in drift_events.columns:
        drift_events = drift_events.withColumn("drift_detected", dim_bool(F.col("customDimensions"), "drift_detected"))
    parts = []
    for alert, event in (("DataDriftDetected", "DataDriftReport"), ("ModelDriftDetected", "ModelDriftReport")):
        rule = ALERT_RULES[alert]
        parts.append(drift_events.where((F.col("name") == event) & F.col("drift_detected"))
                     .groupBy(F.window("timestamp", rule["window"]).alias("w"))
                     .agg(F.count(F.lit(1)).cast("double").alias("value"))
                     .where(F.col("value") > rule["threshold"]).select(F.lit(alert).alias("alert"), "w", "value"))
    return parts[0].unionByName(parts[1]).select(
        "alert", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        F.round("value", 6).alias("value"))
