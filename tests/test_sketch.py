"""Quantile sketches: rank error, merging, bounded size, and the streams that keep them as state."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from carelens.operators import sketch as sk
from carelens.sources import telemetry as src
from carelens.streaming import jobs

SF = "/root/testdata/sf0.001"


def rank_distance(values, estimate, p):
    """How far ``p`` is from the ranks that ``estimate`` spans, as a share of the rows."""
    values = sorted(values)
    below, upto = bisect.bisect_left(values, estimate) / len(values), bisect.bisect_right(values, estimate) / len(values)
    return max(0.0, p - upto, below - p)


@pytest.mark.parametrize("kind", ["uniform", "ties", "sorted", "heavy"])
def test_quantiles_are_within_the_rank_error(spark, kind):
    rnd = random.Random(3)
    values = {"uniform": [rnd.random() for _ in range(40000)], "ties": [float(rnd.randrange(12)) for _ in range(40000)],
              "sorted": [float(i) for i in range(40000)], "heavy": [rnd.paretovariate(0.7) for _ in range(40000)]}[kind]
    df = spark.createDataFrame([(v, i % 7) for i, v in enumerate(values)], "v double, g int").repartition(16)
    probs = [0.01, 0.25, 0.5, 0.95, 0.99]
    whole = df.agg(sk.sketch("v", 200).alias("s"))
    parts = df.groupBy("g").agg(sk.sketch("v", 200).alias("s")).agg(sk.merged("s", 200).alias("s"))
    for one in (whole, parts):
        r = one.select(sk.quantiles("s", probs).alias("q"), sk.rows_in("s").alias("n"), F.octet_length("s").alias("size")).first()
        assert r.n == len(values) and r["size"] <= sk.sketch_bytes(200)
        assert all(rank_distance(values, q, p) <= sk.wide_rank_error(200) for q, p in zip(r.q, probs, strict=True))


def test_small_and_empty_sketches(spark):
    df = spark.createDataFrame([(1, 3.0), (1, float("nan")), (1, None), (1, 1.0), (2, None)], "g int, v double")
    got = {r.g: (r.n, r.q) for r in df.groupBy("g").agg(sk.sketch("v").alias("s")).select("g", sk.rows_in("s").alias("n"), sk.quantiles("s", [0.0, 1.0]).alias("q")).collect()}
    assert got == {1: (2, [1.0, 3.0]), 2: (0, None)}


def test_sketch_streams_against_the_exact_batch(spark, tmp_path):
    requests = src.requests(spark, SF)
    requests.repartition(3).write.parquet(str(tmp_path / "in"))

    def landed():
        return jobs.landing_stream(spark, str(tmp_path / "in"), requests.schema, 1)

    bins = jobs.drain(jobs.latency_sketch_stream(landed(), bin_size="1 day", k=64), "complete", "sketch-test")
    durations = {}
    for r in requests.select(F.date_trunc("day", "timestamp").alias("d"), "duration").collect():
        durations.setdefault(r.d, []).append(r.duration)
    rows = bins.collect()
    assert {r.timestamp: r.requestCount for r in rows} == {d: len(v) for d, v in durations.items()}
    for r in rows:
        for name, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
            exact = [round(x, 6) for x in durations[r.timestamp]]
            assert rank_distance(exact, r[name], p) <= sk.wide_rank_error(64) + 1 / len(exact)
    every = [round(x, 6) for v in durations.values() for x in v]
    one = jobs.latency_rollup(bins, "36500 days", k=64).collect()
    assert [r.requestCount for r in one] == [len(every)] and rank_distance(every, one[0].p95, 0.95) <= sk.wide_rank_error(64) * 2
    fired = jobs.drain(jobs.latency_sketch_alert_stream(landed()), "complete", "sketch-alerts")
    exact = jobs.drain(jobs.latency_alert_stream(landed()), "complete", "exact-alerts")
    # bins of five minutes hold fewer rows than the sketch keeps: only interpolation differs
    a, b = ({r.window_start for r in x.collect()} for x in (fired, exact))
    assert len(a ^ b) <= 0.05 * max(1, len(a | b))
    assert all(isinstance(r.window_end, dt.datetime) for r in fired.take(1))
