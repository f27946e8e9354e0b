"""Telemetry tables (requests, dependencies, customEvents) derived from the driver's
``events`` table.

Event time arrives as TIMESTAMP_NTZ; watermarks reject that type, so it is cast to
TIMESTAMP (session zone UTC) here, for batch and streaming alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.functions.features import risk_tier
from carelens.sources.tables import table

# Operation name and dependency target of the scoring service.
REQUEST_NAME = "POST /api/v1/score"
DEPENDENCY_TARGET = "ep.inference.ml.azure.com"


def requests_from_events(events: DataFrame) -> DataFrame:
    """timestamp, name, resultCode, success, duration (ms), customDimensions (JSON)."""
    code = F.when(F.col("event_type") == "error", "500").when(F.col("event_type") == "signup", "429").otherwise("200")
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.lit(REQUEST_NAME).alias("name"),
        code.alias("resultCode"), (code == "200").alias("success"),
        (F.col("value") * F.lit(10.0)).alias("duration"),
        F.to_json(F.create_map(F.lit("appid"), F.col("user_id").cast("string"))).alias("customDimensions"))


def dependencies_from_events(events: DataFrame) -> DataFrame:
    """timestamp, target, success, duration (ms)."""
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.lit(DEPENDENCY_TARGET).alias("target"),
        (F.col("event_type") != "error").alias("success"), (F.col("value") * F.lit(10.0)).alias("duration"))


def custom_events_from_events(events: DataFrame) -> DataFrame:
    """timestamp, name ('ScoringCompleted'), customDimensions with the risk tier of k/100."""
    k = F.get_json_object(F.col("props"), "$.k").cast("double")
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.lit("ScoringCompleted").alias("name"),
        F.to_json(F.create_map(F.lit("risk_tier"), risk_tier(k / F.lit(100.0)))).alias("customDimensions"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_from_events(table(spark, sf_dir, "events"))


def dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dependencies_from_events(table(spark, sf_dir, "events"))


def custom_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return custom_events_from_events(table(spark, sf_dir, "events"))
