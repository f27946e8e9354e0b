"""Catalog: streaming jobs drained over the driver's files, equal to the batch SQL.

Each query starts its stream with an ``availableNow`` trigger, waits for it and returns the
written result. Aggregating streams run in ``complete`` mode here, so that the bins after the
last watermark are part of the result; in operation they append.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.operators import telemetry as tm
from carelens.operators.scoring import score
from carelens.operators.sketch import sketch_bytes, wide_rank_error
from carelens.plans import base
from carelens.plans.catalog import SQL, register
from carelens.plans.catalog_dirty import dirty, faulty_requests
from carelens.plans.catalog_monitor import HAS_SCORE, TEL
from carelens.plans.catalog_models import LINEAR_MEANS, _linear, _rate_limit_sql, _requests_with_holes
from carelens.plans.oracle import with_ctes
from carelens.session import is_folder, scratch_path
from carelens.sources import telemetry as src
from carelens.streaming import jobs
from carelens.streaming.rate_limit import rate_limit_stream


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _events_path(sf_dir)
    if is_folder(spark, path):  # of part files, whose names the filter would have to match
        return jobs.events_stream(spark, path)
    return jobs.events_stream(spark, sf_dir, glob="events.parquet")


def _events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def _drained(spark: SparkSession, sf_dir: str, stream: DataFrame, name: str) -> DataFrame:
    """The result of a complete-mode stream over the events."""
    return jobs.drain(stream, "complete", name, spark.read.parquet(_events_path(sf_dir)))


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


_SOURCES = {
    "error_rate_5xx": src.requests_from_events, "failures_by_code": src.requests_from_events,
    "throttled_clients": src.requests_from_events, "dependency_health": src.dependencies_from_events,
    "availability": src.dependencies_from_events, "tier_counts": src.custom_events_from_events,
}


def _telemetry(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _SOURCES[name](_events(spark, sf_dir))
        return _ntz(_drained(spark, sf_dir, jobs.telemetry_stream(name, rows), f"stream-{name}"), "timestamp")

    query.__doc__ = f"T1: {name} as a stream."
    return query


for _name in _SOURCES:
    register(f"stream_{_name}", SQL[_name])(_telemetry(_name))


@register("stream_latency_percentiles", SQL["latency_percentiles"])
def stream_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 (K1) as a stream."""
    rows = src.requests_from_events(_events(spark, sf_dir))
    return _ntz(_drained(spark, sf_dir, jobs.latency_stream(rows), "stream-latency"), "timestamp")


_SKETCH_K = 200


@register("stream_latency_sketch", with_ctes(TEL) + f"""
SELECT time_bucket(INTERVAL 30 DAY, "timestamp", TIMESTAMP '1970-01-01') AS "timestamp", count(*) AS requestCount,
       true AS p50_in_bound, true AS p95_in_bound, true AS p99_in_bound, true AS state_in_bound FROM req WHERE {HAS_SCORE} GROUP BY 1""")
def stream_latency_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 (K1) from sketch state, by bins of 30 days: whether each percentile's rank among the bin's
    exact durations is within the sketch's error, and its state within the size bound."""
    stream = jobs.latency_sketch_stream(src.requests_from_events(_events(spark, sf_dir)), bin_size="30 days", k=_SKETCH_K)
    bins = _drained(spark, sf_dir, stream, "stream-latency-sketch")
    exact = src.requests(spark, sf_dir).where(tm.has_term(F.col("name"), tm.SCORE_OPERATION))
    exact = exact.select(F.window("timestamp", "30 days").start.alias("timestamp"), "duration")
    joined = exact.join(bins.drop("sketch"), "timestamp")
    probs = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    ranks = joined.groupBy("timestamp").agg(*[x for p in probs for x in (
        (F.count_if(F.col("duration") < F.col(p)) / F.count("duration")).alias(f"{p}_below"),
        (F.count_if(F.col("duration") <= F.col(p)) / F.count("duration")).alias(f"{p}_upto"))])
    bound = wide_rank_error(_SKETCH_K)
    inside = [((F.col(f"{p}_below") <= F.lit(q + bound)) & (F.col(f"{p}_upto") >= F.lit(q - bound))).alias(f"{p}_in_bound") for p, q in probs.items()]
    out = bins.join(ranks, "timestamp").select(
        "timestamp", "requestCount", *inside, (F.octet_length("sketch") <= F.lit(sketch_bytes(_SKETCH_K))).alias("state_in_bound"))
    return _ntz(out, "timestamp")


@register("stream_alerts", SQL["alerts"])
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1, T2 (L1-L3): the three alert streams."""
    def run(job, source):
        return _drained(spark, sf_dir, job(source(_events(spark, sf_dir))), f"stream-{job.__name__}")

    parts = [run(jobs.latency_alert_stream, src.requests_from_events), run(jobs.error_rate_alert_stream, src.requests_from_events),
             run(jobs.availability_alert_stream, src.dependencies_from_events)]
    return _ntz(parts[0].unionByName(parts[1]).unionByName(parts[2]), "window_start", "window_end")


def _landed(df: DataFrame, name: str) -> tuple[str, int]:
    """``df`` as the files of a landing folder, and how many."""
    path = scratch_path(df.sparkSession, f"landing-{name}")
    df.write.parquet(path)
    return path, max(1, len(df.sparkSession.read.parquet(path).inputFiles()))


@register("stream_quarantine", SQL["quarantine_dirty"])
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty encounters as one landing batch, split into valid and quarantined rows."""
    table = dirty(spark, sf_dir)
    path, n = _landed(table, "encounters")
    out = scratch_path(spark, "stream-quarantine")
    stream = jobs.landing_stream(spark, path, table.schema, n)
    q = (stream.writeStream.foreachBatch(jobs.validate_batch_writer(f"{out}/valid", f"{out}/quarantine"))
         .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    bad = spark.read.parquet(f"{out}/quarantine").select("encounter_id", F.array_join("failures", ",").alias("failures"))
    return spark.read.parquet(f"{out}/valid").select("encounter_id", F.lit("").alias("failures")).unionByName(bad)


@register("stream_request_quarantine", SQL["request_validation"])
def stream_request_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty requests as a stream."""
    table = faulty_requests(spark, sf_dir)
    path, n = _landed(table, "requests")
    out = scratch_path(spark, "stream-requests")
    stream = jobs.landing_stream(spark, path, table.schema, n)
    q = (stream.writeStream.foreachBatch(jobs.validate_requests_writer(f"{out}/valid", f"{out}/quarantine"))
         .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    bad = spark.read.parquet(f"{out}/quarantine").select(F.col("k").alias("order_key"), F.array_join("failures", ",").alias("failures"))
    return spark.read.parquet(f"{out}/valid").select(F.col("k").alias("order_key"), F.lit("").alias("failures")).unionByName(bad)


@register("stream_dedup", SQL["dedup_dirty"].rpartition("\nSELECT")[0] + "\nSELECT DISTINCT encounter_id FROM dirty")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 (C1): one row per encounter id of the dirty landing batch."""
    table = dirty(spark, sf_dir).withColumn("landed", F.col("admit_date").cast("timestamp"))
    path, n = _landed(table, "repeated")
    stream = jobs.landing_stream(spark, path, table.schema, n)
    return jobs.drain(jobs.dedup_stream(stream, "landed").select("encounter_id"), "append", "stream-dedup")


@register("stream_late_labels", SQL["late_labels_bounded"])
def stream_late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 (J8): scores and late labels as two streams; a closing row on both moves the watermark
    past all scores, so those without a label come out."""
    p = base.predictions(spark, sf_dir).where(F.col("split") == "test")
    scores = p.select("encounter_id", F.col("discharge_date").cast("timestamp").alias("scored_ts"), "readmission_probability")
    late = (F.lit(10) + F.col("encounter_id").cast("bigint") % 81).cast("int")
    labels = base.encounters(spark, sf_dir).where(F.col("readmitted_30d").isNotNull()).select(
        "encounter_id", F.date_add("discharge_date", late).cast("timestamp").alias("label_ts"), "readmitted_30d")
    streams = []
    for name, table, closing in (("scores", scores, ("closing", dt.datetime(2200, 1, 1), 0.0)), ("labels", labels, ("closing", dt.datetime(2200, 1, 1), 0))):
        path, n = _landed(table, name)
        spark.createDataFrame([closing], table.schema).write.mode("append").parquet(path)
        streams.append(jobs.landing_stream(spark, path, table.schema, n))
    out = jobs.drain(jobs.late_label_join(*streams), "append", "stream-late-labels")
    return _ntz(out.where("encounter_id <> 'closing'"), "scored_ts", "label_ts")


@register("stream_scores", SQL["linear_scores"])
def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorer with a declared linear model over a stream of requests."""
    table = _requests_with_holes(spark, sf_dir)
    path, n = _landed(table, "features")
    scored = score(_linear("a"), jobs.landing_stream(spark, path, table.schema, n), "declared", means=LINEAR_MEANS)
    return jobs.drain(scored.select("encounter_id", "readmission_probability", "risk_tier"), "append", "stream-scores")


_UNTIMED = "event_id % 97 = 0"


def _stream_rate_limit_sql() -> str:
    timed = _rate_limit_sql(2).replace("FROM events)", f"FROM events WHERE NOT ({_UNTIMED}))", 1)
    return timed + f"""
UNION ALL
SELECT CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR), CAST(NULL AS TIMESTAMP), true, CAST(NULL AS INTEGER) FROM events WHERE {_UNTIMED}"""


@register("stream_rate_limit", _stream_rate_limit_sql())
def stream_rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: the request log in four deliveries, up to five minutes out of order and some of it without
    a time, through the stateful limiter (2 requests a minute), which keeps its state between them. A
    closing request moves the watermark past all others."""
    late = F.make_dt_interval(mins=F.abs(F.hash("event_id")) % 5)
    log = spark.read.parquet(_events_path(sf_dir)).select(
        F.col("user_id").cast("string").alias("client"), F.col("event_id").cast("string").alias("request_id"),
        F.when(F.expr(f"NOT ({_UNTIMED})"), F.col("ts").cast("timestamp")).alias("timestamp"), (F.col("ts").cast("timestamp") + late).alias("arrived"))
    lo, hi = log.agg(F.min(F.unix_micros("arrived")), F.max(F.unix_micros("arrived"))).first()
    step = max(1, ((hi or 0) - (lo or 0)) // 4 + 1)
    number = F.floor((F.unix_micros("arrived") - F.lit(lo or 0)) / F.lit(step))
    deliveries = [log.where(number == k).drop("arrived") for k in range(4)]
    closing = spark.createDataFrame([("closing", "closing", dt.datetime(2200, 1, 1))], deliveries[0].schema)
    out = jobs.drain_deliveries([*deliveries, closing], lambda s: rate_limit_stream(s, limit=2, watermark="6 minutes"), "stream-rate-limit", keyed_state=True)
    return _ntz(out, "timestamp")
