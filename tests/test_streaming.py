"""Streaming jobs against their batch twins, and the rate limiter (T5)
against its plain-Python definition."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from carelens.operators import telemetry as tm
from carelens.sources import telemetry as src
from carelens.streaming import jobs, rate_limit as rl

SF = "/root/testdata/sf0.001"


def _later(path, seconds=120):
    """Give the files under ``path`` a later modification time: the file source reads
    oldest first, so the watermark-advancing flush rows come in the last micro-batch."""
    import os
    import time
    t = time.time() + seconds
    for root, _, files in os.walk(str(path)):
        for f in files:
            os.utime(os.path.join(root, f), (t, t))


def _run(stream_df, name, mode="append"):
    q = stream_df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(300)
    return q


def _bursty(n_clients=4, seed=3):
    rnd = random.Random(seed)
    rows, t0 = [], 1_700_000_000.0
    for i in range(1500):
        c = "HOT" if i % 2 == 0 else f"C{rnd.randint(1, n_clients)}"
        rows.append((c, f"R{i:05d}", t0 + rnd.uniform(0, 300) if c == "HOT" else t0 + rnd.uniform(0, 3000)))
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(c, r, dt.datetime.fromtimestamp(t, dt.timezone.utc).replace(tzinfo=None))
                                  for c, r, t in rows], "client string, request_id string, ts timestamp_ntz") \
        .withColumn("timestamp", F.col("ts").cast("timestamp"))


def test_rate_limit_deliveries_run_whatever_the_session_state_store_is(spark):
    from carelens.session import ROCKSDB_STATE, STATE_STORE
    rows = _frame(spark, _bursty()[:200]).select("client", "request_id", "timestamp")
    own = spark.conf.get(STATE_STORE)
    other = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"  # Spark's default
    spark.conf.set(STATE_STORE, other)
    try:
        closing = spark.createDataFrame([("closing", "closing", dt.datetime(2200, 1, 1))], rows.schema)
        out = jobs.drain_deliveries([rows, closing], lambda s: rl.rate_limit_stream(s, limit=20), "test-limit", keyed_state=True)
        assert out.where("client <> 'closing'").count() == 200
        assert spark.conf.get(STATE_STORE) == other
    finally:
        spark.conf.set(STATE_STORE, own)
    assert own == ROCKSDB_STATE


def test_rate_limit_batch_matches_definition(spark):
    rows = _bursty()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")  # hot client spans many chunks
    try:
        got = {r.request_id: (r.admitted, r.retry_after) for r in rl.rate_limit(_frame(spark, rows), limit=20).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    exp = rl.brute_force([(c, r, float(int(t * 1e6)) / 1e6) for c, r, t in rows], limit=20)
    assert got == exp and sum(1 for v in exp.values() if not v[0]) > 100


def test_rate_limit_splits_a_hot_client(spark):
    """A client with long busy and calm stretches: busy segments walk in parallel tasks."""
    rnd = random.Random(9)
    t0, rows = 1_700_000_000, []
    for seg in range(40):
        start = t0 + seg * 400
        for i in range(60 if seg % 2 else 5):
            rows.append(("HOT", f"S{seg:02d}-{i:03d}", float(start + rnd.randint(0, 150))))
    rows += [("EDGE", f"E{k}", float(t0 + k * 60)) for k in range(10)]  # exactly 60 s apart
    out = rl.rate_limit(_frame(spark, rows), limit=7)
    got = {r.request_id: (r.admitted, r.retry_after) for r in out.collect()}
    assert got == rl.brute_force(rows, limit=7) and sum(not v[0] for v in got.values()) > 200
    one = {r.request_id: (r.admitted, r.retry_after) for r in rl.rate_limit(_frame(spark, rows), limit=1).collect()}
    assert one == rl.brute_force(rows, limit=1)


def test_events_in_a_folder_of_part_files_are_streamed(spark, tmp_path):
    from carelens.plans import catalog_streams as cs

    events = spark.read.parquet(f"{SF}/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    query = cs._telemetry("tier_counts")
    got, want = query(spark, str(tmp_path)).collect(), query(spark, SF).collect()
    assert len(want) > 0 and sorted(map(str, got)) == sorted(map(str, want))
    unread = jobs.events_stream(spark, str(tmp_path), glob="nothing").groupBy("event_type").count()
    with pytest.raises(RuntimeError):
        jobs.drain(unread, "complete", "unread", events)


def test_rate_limit_keeps_requests_without_a_time(spark):
    rows = _bursty()
    untimed = [(c, f"N{i}", None) for i, c in enumerate(["HOT"] * 30 + ["C1", None])]
    df = _frame(spark, rows).select("client", "request_id", "timestamp")
    df = df.unionByName(spark.createDataFrame(untimed, "client string, request_id string, timestamp timestamp"))
    out = rl.rate_limit(df, limit=20).collect()
    got = {r.request_id: (r.admitted, r.retry_after) for r in out}
    exp = rl.brute_force([(c, r, float(int(t * 1e6)) / 1e6) for c, r, t in rows], limit=20)
    assert len(out) == len(rows) + len(untimed) and got == exp | {r: (True, None) for _, r, _ in untimed}


def test_rate_limit_stream_matches_batch(spark, tmp_path):
    """Deliveries out of order, requests without a time, a late one, state kept between runs and
    removed when clients fall idle."""
    rnd = random.Random(4)
    rows = _bursty()
    untimed = [(c, f"N{i}", None) for i, c in enumerate(["HOT", "HOT", "C1", None, "never"])]
    timed = _frame(spark, rows).select("client", "request_id", "timestamp")
    arrival = {r: t + rnd.uniform(0, 50) for _, r, t in rows}
    cuts = sorted(arrival.values())[::300][1:]
    part = {r: sum(a >= c for c in cuts) for r, a in arrival.items()}
    schema = timed.schema
    closing = spark.createDataFrame([("closing", "closing", dt.datetime(2100, 1, 1))], schema)
    late = spark.createDataFrame([("HOT", "late", dt.datetime(2023, 11, 14))], schema)
    folder, state, got, epochs = str(tmp_path / "in"), None, [], []
    for k in range(len(cuts) + 2):
        if k <= len(cuts):
            batch = timed.where(F.col("request_id").isin([r for r in part if part[r] == k]))
            if k == 1:
                batch = batch.unionByName(spark.createDataFrame(untimed, schema))
            if k == 3:
                batch = batch.unionByName(late)
        else:
            batch = closing
        batch.write.mode("append").parquet(folder)
        stream = rl.rate_limit_stream(jobs.landing_stream(spark, folder, schema, 1 << 30), limit=20)
        epochs += jobs.run_available(stream, "append", str(tmp_path / "run"))
    out = jobs._written(stream, str(tmp_path / "run"), sorted(set(epochs))).collect()
    got = {r.request_id: (r.admitted, r.retry_after) for r in out}
    exp = rl.brute_force([(c, r, float(int(t * 1e6)) / 1e6) for c, r, t in rows], limit=20)
    assert len(out) == len(rows) + len(untimed)
    assert got == exp | {r: (True, None) for _, r, _ in untimed}
    assert sum(not v[0] for v in got.values()) > 100
    times = {r.request_id: r.timestamp for r in out}
    assert all(times[r.request_id] == r.timestamp for r in timed.collect())
    # the clients' state is gone; only the closing request waits
    state = spark.read.format("statestore").option("path", str(tmp_path / "run/checkpoint")).option("stateVarName", "waiting").load()
    assert [r.key.client for r in state.select("key").collect()] == ["closing"]
    admitted = spark.read.format("statestore").option("path", str(tmp_path / "run/checkpoint")).option("stateVarName", "admitted").load()
    assert admitted.count() == 0


def test_latency_stream_matches_batch(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    days = sorted(r[0] for r in ev.select(F.to_date("ts")).distinct().collect())
    for i, d in enumerate(days):
        ev.where(F.to_date("ts") == F.lit(d)).coalesce(1).write.parquet(str(tmp_path / f"ev/d{i:03d}"))
    # a final row far ahead moves the watermark past every real window
    flush = ev.limit(1).withColumn("ts", F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz"))
    flush.write.parquet(str(tmp_path / "ev/zzz"))
    _later(tmp_path / "ev/zzz")
    stream = spark.readStream.schema(jobs.EVENTS_SCHEMA).option("maxFilesPerTrigger", 5) \
        .option("recursiveFileLookup", "true").parquet(str(tmp_path / "ev"))
    _run(jobs.latency_stream(src.requests_from_events(stream)), "lat_out")
    got = {(r.timestamp, r.p50, r.p95, r.p99, r.requestCount) for r in spark.table("lat_out").collect()}
    batch = tm.latency_percentiles(src.requests_from_events(ev)).collect()
    exp = {(r.timestamp, r.p50, r.p95, r.p99, r.requestCount) for r in batch}
    assert got == exp and len(exp) > 100


def test_availability_alert_stream(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.write.parquet(str(tmp_path / "ev/a"))
    ev.limit(1).withColumn("ts", F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz")).write.parquet(str(tmp_path / "ev/b"))
    _later(tmp_path / "ev/b")
    stream = spark.readStream.schema(jobs.EVENTS_SCHEMA).option("recursiveFileLookup", "true") \
        .option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "ev"))
    _run(jobs.availability_alert_stream(src.dependencies_from_events(stream)), "avail_out")
    got = {(r.window_start, r.value) for r in spark.table("avail_out").collect()}
    batch = tm.alerts(src.requests_from_events(ev), src.dependencies_from_events(ev)).where(
        F.col("alert") == "EndpointAvailabilityDrop").collect()
    assert got == {(r.window_start, r.value) for r in batch}


def test_validate_and_dedup_stream(spark, tmp_path):
    from tests.test_features import _raw
    raw = _raw(spark).withColumn("event_time", F.current_timestamp())
    bad = raw.where("encounter_id = 'ENC-2'").withColumn("age", F.lit(-5)).withColumn("encounter_id", F.lit("ENC-3"))
    raw.write.parquet(str(tmp_path / "in/a"))
    raw.where("encounter_id = 'ENC-1'").unionByName(bad).write.parquet(str(tmp_path / "in/b"))
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    q = jobs.dedup_stream(stream, "event_time").writeStream.foreachBatch(
        jobs.validate_batch_writer(str(tmp_path / "valid"), str(tmp_path / "quarantine"))) \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    valid = spark.read.parquet(str(tmp_path / "valid"))
    assert sorted(r.encounter_id for r in valid.collect()) == ["ENC-1", "ENC-2"]  # duplicates dropped
    bad_rows = spark.read.parquet(str(tmp_path / "quarantine")).collect()
    assert [(r.encounter_id, r.failures) for r in bad_rows] == [("ENC-3", ["between:age"])]
    # a replayed micro-batch overwrites its own folder
    write = jobs.validate_batch_writer(str(tmp_path / "v2"), str(tmp_path / "q2"))
    for _ in range(2):
        write(raw.limit(1), 7)
    assert spark.read.parquet(str(tmp_path / "v2")).count() == 1


def test_late_label_join(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    scores = spark.createDataFrame([("E1", t0, 0.3), ("E2", t0, 0.6), ("E3", t0 + dt.timedelta(days=1), 0.1)],
                                   "encounter_id string, scored_ts timestamp, readmission_probability double")
    labels = spark.createDataFrame([("E1", t0 + dt.timedelta(days=35), 1), ("E2", t0 + dt.timedelta(days=90), 0)],
                                   "encounter_id string, label_ts timestamp, readmitted_30d int")
    flush_s = spark.createDataFrame([("Z", dt.datetime(2025, 1, 1), 0.0)], scores.schema)
    flush_l = spark.createDataFrame([("Z", dt.datetime(2025, 1, 1), 0)], labels.schema)
    scores.coalesce(1).write.parquet(str(tmp_path / "s/a"))
    flush_s.write.parquet(str(tmp_path / "s/b"))
    labels.coalesce(1).write.parquet(str(tmp_path / "l/a"))
    flush_l.write.parquet(str(tmp_path / "l/b"))
    _later(tmp_path / "s/b")
    _later(tmp_path / "l/b")
    s = spark.readStream.schema(scores.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true") \
        .parquet(str(tmp_path / "s"))
    lab = spark.readStream.schema(labels.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true") \
        .parquet(str(tmp_path / "l"))
    _run(jobs.late_label_join(s, lab), "late_out")
    got = {(r.encounter_id, r.readmitted_30d) for r in spark.table("late_out").collect() if r.encounter_id != "Z"}
    assert got == {("E1", 1), ("E2", None), ("E3", None)}


def test_streaming_scoring_matches_batch(spark, tmp_path):
    """The batch scoring function applied to a request stream."""
    from carelens.operators import model as md
    from carelens.operators import scoring as sc
    from carelens.schemas import REQUEST_SCHEMA
    from tests.test_model import planted

    feats = planted(spark, n=600)
    model = md.train_model(feats, None, md.TrainSpec("logreg", {"maxIter": 20}))
    requests = spark.createDataFrame([(f"R{i}", 20 + i % 60, "MF"[i % 2], "A", "Emergency", "SNF", i % 9, i % 4,
                                       float(i % 7), i % 5, i % 3, i % 11, 25.0, 120.0, 100.0, 1.0)
                                      for i in range(200)], REQUEST_SCHEMA)
    requests.repartition(4).write.parquet(str(tmp_path / "req"))
    stream = spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "req"))
    out = sc.score(model, stream, "v1", explain=True, reference=feats)
    _run(out.drop("response_id", "scored_at"), "score_out")
    got = {(r.encounter_id, r.readmission_probability, r.risk_tier, tuple((f.feature, f.shap_value) for f in r.top_factors))
           for r in spark.table("score_out").collect()}
    batch = sc.score(model, requests, "v1", explain=True, reference=feats).collect()
    exp = {(r.encounter_id, r.readmission_probability, r.risk_tier, tuple((f.feature, f.shap_value) for f in r.top_factors))
           for r in batch}
    assert got == exp and len(got) == 200
