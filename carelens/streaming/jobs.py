"""Structured Streaming twins of the batch operators.

Each job is a function from a streaming DataFrame to a streaming DataFrame (or a
``foreachBatch`` writer), built from the same column functions as its batch twin, so
the batch query serves as its oracle. Event time must be TIMESTAMP (the telemetry
source casts TIMESTAMP_NTZ); late rows beyond the watermark are dropped.
"""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.operators import quality
from carelens.operators import sketch as sk
from carelens.operators import telemetry as tm
from carelens.schemas import RAW_ENCOUNTER_SCHEMA
from carelens.session import rocksdb_state, scratch_path

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def landing_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1000,
                   glob: str | None = None) -> DataFrame:
    """File stream of a landing folder's parquet files (an ``availableNow`` trigger drains it)."""
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(path)


def events_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000, glob: str | None = None) -> DataFrame:
    """The telemetry events of a landing folder."""
    return landing_stream(spark, path, EVENTS_SCHEMA, files_per_trigger, glob)


def encounters_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """The daily encounter batches of a landing folder."""
    return landing_stream(spark, path, RAW_ENCOUNTER_SCHEMA, files_per_trigger)


def run_available(stream: DataFrame, mode: str, path: str, keyed_state: bool = False) -> list[int]:
    """Runs a stream over all files that are there now, from the checkpoint in ``path``, and returns
    the micro-batches that ran. Each writes a folder of its own (``out/epoch=<id>``), overwriting it
    when replayed, so a replay adds no row twice. ``keyed_state``: the stream has a stateful processor,
    whose state variables and timers need the RocksDB store whatever the session's default is."""
    epochs = []

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/epoch={epoch}")
        epochs.append(epoch)

    with rocksdb_state(stream.sparkSession) if keyed_state else nullcontext():
        q = (stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint")
             .trigger(availableNow=True).start())
    q.awaitTermination()
    return sorted(set(epochs))


def _written(stream: DataFrame, path: str, epochs: list[int]) -> DataFrame:
    spark = stream.sparkSession
    if not epochs:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(*[f"{path}/out/epoch={e}" for e in epochs])


def drain(stream: DataFrame, mode: str, name: str, source: DataFrame | None = None) -> DataFrame:
    """Runs a stream over all files that are there and returns its result. Mode ``complete``: the
    last micro-batch is the result; else all of them are. ``source``: what the stream reads, as a
    table; if it has rows, at least one micro-batch must have run."""
    path = scratch_path(stream.sparkSession, name)
    epochs = run_available(stream, mode, path)
    if not epochs and source is not None and not source.isEmpty():
        raise RuntimeError(f"{name}: the source has rows, but the stream has read none")
    return _written(stream, path, epochs[-1:] if mode == "complete" else epochs)


def drain_deliveries(deliveries: list[DataFrame], job, name: str, keyed_state: bool = False) -> DataFrame:
    """The deliveries (tables of one schema) land one after the other in a folder; after each, the
    append-mode stream ``job(landed)`` is started again on its checkpoint, reads what is new and
    stops. Returns all it has written, as a job that is scheduled daily would have. ``keyed_state`` as
    in ``run_available``."""
    spark = deliveries[0].sparkSession
    path, epochs, stream = scratch_path(spark, name), [], None
    for table in deliveries:
        table.write.mode("append").parquet(f"{path}/landing")
        stream = job(landing_stream(spark, f"{path}/landing", table.schema, 1 << 30))
        epochs += run_available(stream, "append", path, keyed_state)
    return _written(stream, path, sorted(set(epochs)))


def telemetry_stream(name: str, rows: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """T1 (K2-K7): the batch query of this name over a watermarked stream."""
    return getattr(tm, name)(rows.withWatermark("timestamp", watermark), ordered=False)


def latency_stream(requests: DataFrame, watermark: str = "10 minutes", bin_size: str = "5 minutes") -> DataFrame:
    """T1 (K1): per-bin exact percentiles and count; a bin is emitted once the watermark passes
    it. (A stream has no sorted view of a bin, so the percentiles keep the bin's distinct values.)"""
    r = requests.withWatermark("timestamp", watermark).where(tm.has_term(F.col("name"), tm.SCORE_OPERATION))
    return (r.groupBy(F.window("timestamp", bin_size).alias("w"))
            .agg(F.round(F.percentile("duration", F.lit(0.5)), 6).alias("p50"),
                 F.round(F.percentile("duration", F.lit(0.95)), 6).alias("p95"),
                 F.round(F.percentile("duration", F.lit(0.99)), 6).alias("p99"),
                 F.count(F.lit(1)).alias("requestCount"))
            .select(F.col("w.start").alias("timestamp"), "p50", "p95", "p99", "requestCount"))


def latency_sketch_stream(requests: DataFrame, watermark: str = "10 minutes", bin_size: str = "5 minutes",
                          k: int = sk.SKETCH_K) -> DataFrame:
    """T1 (K1) with bounded state: per bin a quantile sketch, read as percentiles within the rank
    error of ``k``, and the request count. The sketches come out as well: ``latency_rollup`` merges
    them into larger bins. This is the form to operate; ``latency_stream`` keeps every distinct
    duration of a bin and fits bins known to be small."""
    r = requests.withWatermark("timestamp", watermark).where(tm.has_term(F.col("name"), tm.SCORE_OPERATION))
    g = r.groupBy(F.window("timestamp", bin_size).alias("w")).agg(sk.sketch("duration", k).alias("sketch"), F.count(F.lit(1)).alias("requestCount"))
    return _percentiles(g.select(F.col("w.start").alias("timestamp"), "sketch", "requestCount"))


def _percentiles(binned: DataFrame) -> DataFrame:
    q = binned.withColumn("_q", sk.quantiles("sketch", [0.5, 0.95, 0.99]))
    return q.select("timestamp", *[F.round(F.col("_q")[i], 6).alias(n) for i, n in enumerate(("p50", "p95", "p99"))], "requestCount", "sketch")


def latency_rollup(sketches: DataFrame, bin_size: str = "1 hour", k: int = sk.SKETCH_K) -> DataFrame:
    """K1 over larger bins from the rows of ``latency_sketch_stream``, without the requests."""
    g = sketches.groupBy(F.window("timestamp", bin_size).start.alias("timestamp")).agg(
        sk.merged("sketch", k).alias("sketch"), F.sum("requestCount").alias("requestCount"))
    return _percentiles(g)


def _alert_stream(name: str, rows: DataFrame, watermark: str, value, read=None) -> DataFrame:
    """``value``: the aggregate of a window; ``read``: from it to the number that is compared."""
    rule = tm.ALERT_RULES[name]
    window = F.window("timestamp", rule["window"], rule["slide"]) if "slide" in rule else F.window("timestamp", rule["window"])
    g = rows.withWatermark("timestamp", watermark).groupBy(window.alias("w")).agg(value.alias("value"))
    if read is not None:
        g = g.withColumn("value", read(F.col("value")))
    fires = F.col("value") > rule["threshold"] if rule["op"] == ">" else F.col("value") < rule["threshold"]
    return g.where(fires).select(F.lit(name).alias("alert"), F.col("w.start").alias("window_start"),
                                 F.col("w.end").alias("window_end"), F.round("value", 6).alias("value"))


def _percent(flag) -> F.Column:
    return F.lit(100.0) * F.count_if(flag) / F.count(F.lit(1))


def latency_alert_stream(requests: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """T1 (L1): p95 latency per window, rows above the threshold."""
    r = requests.where(tm.has_term(F.col("name"), tm.SCORE_OPERATION))
    return _alert_stream("HighScoringLatencyP95", r, watermark, F.percentile("duration", F.lit(0.95)))


def latency_sketch_alert_stream(requests: DataFrame, watermark: str = "10 minutes", k: int = sk.SKETCH_K) -> DataFrame:
    """T1 (L1) with bounded state: the p95 is read from a sketch, so a window fires if its p95 within
    the rank error is above the threshold."""
    r = requests.where(tm.has_term(F.col("name"), tm.SCORE_OPERATION))
    return _alert_stream("HighScoringLatencyP95", r, watermark, sk.sketch("duration", k), lambda s: sk.quantiles(s, [0.95])[0])


def error_rate_alert_stream(requests: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """T1 (L2): share of 5xx responses per window, rows above the threshold."""
    r = requests.where(tm.has_term(F.col("name"), tm.SCORE_OPERATION))
    return _alert_stream("HighErrorRate", r, watermark, _percent(tm.startswith_ci(F.col("resultCode"), "5")))


def availability_alert_stream(dependencies: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """T2 (L3): availability over 15-minute windows sliding every 5 minutes, rows below threshold."""
    d = dependencies.where(tm.has_term(F.col("target"), tm.INFERENCE_TARGET))
    return _alert_stream("EndpointAvailabilityDrop", d, watermark, _percent(F.col("success")))


def split_writer(valid_path: str, quarantine_path: str, check):
    """``foreachBatch`` function; ``check`` adds ``failures`` to a micro-batch. Rows without a
    failure go to the one sink, all others with their codes to the other, each micro-batch into a
    folder of its own (``_epoch=<id>``) that a replay overwrites."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        q = check(batch).persist()  # the micro-batch feeds two sinks; released right after
        try:
            q.where(F.size("failures") == 0).drop("failures").write.mode("overwrite").parquet(f"{valid_path}/_epoch={epoch_id}")
            q.where(F.size("failures") > 0).write.mode("overwrite").parquet(f"{quarantine_path}/_epoch={epoch_id}")
        finally:
            q.unpersist()
    return write


def validate_batch_writer(valid_path: str, quarantine_path: str, suite=quality.ENCOUNTER_SUITE):
    """T3 (Q8): encounters against the row rules of the suite."""
    return split_writer(valid_path, quarantine_path, lambda b: quality.quarantine(b, suite).drop("is_valid"))


def validate_requests_writer(valid_path: str, quarantine_path: str):
    """T3 (P11): scoring request records against the field rules."""
    return split_writer(valid_path, quarantine_path, lambda b: b.withColumn("failures", quality.request_failures(b)))


def dedup_stream(encounters: DataFrame, event_time: str, watermark: str = "1 day", key: str = "encounter_id") -> DataFrame:
    """T4 (C1): first arrival per key within the watermark (state evicted after it)."""
    return encounters.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark([key])


def late_label_join(scores: DataFrame, labels: DataFrame, horizon: str = "60 days",
                    score_watermark: str = "1 day", label_watermark: str = "1 day") -> DataFrame:
    """T6 (J8): scored encounters left-joined to labels arriving within ``horizon`` of
    scoring. scores: encounter_id, scored_ts, readmission_probability; labels:
    encounter_id, label_ts, readmitted_30d. Unmatched scores come out after the watermark."""
    s = scores.withWatermark("scored_ts", score_watermark).alias("s")
    lab = labels.withWatermark("label_ts", label_watermark).alias("l")
    cond = (F.col("s.encounter_id") == F.col("l.encounter_id")) & \
        (F.col("l.label_ts") >= F.col("s.scored_ts")) & \
        (F.col("l.label_ts") <= F.col("s.scored_ts") + F.expr(f"INTERVAL {horizon}"))
    return s.join(lab, cond, "leftOuter").select(
        F.col("s.encounter_id").alias("encounter_id"), "s.scored_ts", "s.readmission_probability",
        "l.label_ts", "l.readmitted_30d")
