"""Per-client sliding-window rate limit (T5), batch and streaming.

Rule (per client, requests in event-time order): the admitted requests of the last
60 seconds (strictly after ``t - 60``) are counted; when there are ``limit`` of them,
the request is rejected with ``retry_after = max(1, int(60 - (t - oldest)))`` and does
not count; otherwise it is admitted. A decision depends on the client's earlier admissions.

Batch: a minute without requests forgets everything before it, so a client's requests fall
into segments, numbered on the small table of counts per (client, minute). Segments in which
no two neighbouring minutes hold more than ``limit`` requests admit all of them, in the JVM.
Only the others are walked in order, many segments of a client in parallel: rows hash-
partitioned and sorted by (client, segment, time), read in Arrow chunks with at most
``limit`` admitted times carried from one chunk to the next.

A request without a time is admitted and counts for no other (as in the SQL form, where it comes
last and lies in no window).

Streaming: a stateful processor keyed by client. A decision needs all earlier requests of the
client, so a request waits in the state until the watermark has passed its time; an event-time timer
then decides what is due, in time order, however the micro-batches were cut. Requests that arrive
behind the watermark are dropped by Spark (and counted in the query's progress); requests without a
time are admitted at once, as in the batch form. The state of a client is its waiting requests and
at most ``limit`` admitted times; when nothing waits, a timer one window after the newest admission
removes it, so idle clients hold no state.
"""

from __future__ import annotations

import sys
from collections import deque

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

# The handler runs in Python workers: ship this module's code with the job rather than
# requiring the package to be installed on every executor.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUT_SCHEMA = "client string, request_id string, timestamp timestamp, admitted boolean, retry_after int"
WINDOW_SECONDS = 60.0


WINDOW_MICROS = 60_000_000


class Walk:
    """The admitted times (microseconds) of one client, at most ``limit`` of them."""

    def __init__(self, limit: int, admitted=()):
        self.limit, self.times = limit, deque(sorted(admitted))

    def decide(self, t: int) -> int | None:
        """None: admitted; else the seconds to wait."""
        while self.times and self.times[0] <= t - WINDOW_MICROS:
            self.times.popleft()
        if len(self.times) >= self.limit:
            return max(1, (WINDOW_MICROS - (t - self.times[0])) // 1_000_000) if self.times else 60
        self.times.append(t)
        return None

    def forget(self, t: int) -> None:
        """Drops the times that no request after ``t`` can meet in its window."""
        while self.times and self.times[0] <= t - WINDOW_MICROS:
            self.times.popleft()


def _result(client, request_id, timestamp, retry: list) -> pd.DataFrame:
    return pd.DataFrame({"client": client, "request_id": request_id, "timestamp": timestamp,
                         "admitted": [r is None for r in retry], "retry_after": pd.array(retry, dtype="Int32")})


STREAM_SCHEMA = "client string, request_id string, us long, admitted boolean, retry_after int"


class RateLimitProcessor(StatefulProcessor):
    """Streaming handler; state: the requests that wait for the watermark, and the admitted times."""

    def __init__(self, limit: int = 60):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", StructType([StructField("us", LongType()), StructField("request_id", StringType())]))
        self.admitted = handle.getListState("admitted", StructType([StructField("us", LongType())]))

    def handleInputRows(self, key, rows, timerValues):
        earliest = None
        for frame in rows:
            timed = frame["us"].notna()
            untimed = frame.loc[~timed, "request_id"].tolist()
            if untimed:
                yield _decisions(key[0], untimed, [None] * len(untimed), [None] * len(untimed))
            frame = frame[timed]
            if len(frame):
                us = frame["us"].astype("int64")
                self.waiting.appendList(list(zip(us.tolist(), frame["request_id"].tolist())))
                earliest = int(us.min()) if earliest is None else min(earliest, int(us.min()))
        if earliest is not None:
            self.handle.registerTimer(earliest // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = [(int(r[0]), r[1]) for r in self.waiting.get()] if self.waiting.exists() else []
        due = sorted((r for r in waiting if r[0] <= passed), key=lambda r: (r[0], r[1] is not None, r[1] or ""))
        later = [r for r in waiting if r[0] > passed]
        walk = Walk(self.limit, [int(r[0]) for r in self.admitted.get()] if self.admitted.exists() else [])
        retry = [walk.decide(t) for t, _ in due]
        walk.forget(passed)
        if due:
            self.waiting.clear()
            if later:
                self.waiting.put(later)
        self.admitted.clear()
        if walk.times:
            self.admitted.put([(t,) for t in walk.times])
        if later:
            self.handle.registerTimer(min(later)[0] // 1000)
        elif walk.times:
            self.handle.registerTimer((walk.times[-1] + WINDOW_MICROS) // 1000 + 1)
        if due:
            yield _decisions(key[0], [r for _, r in due], [t for t, _ in due], retry)

    def close(self) -> None:
        pass


def _decisions(client, request_id: list, us: list, retry: list) -> pd.DataFrame:
    return pd.DataFrame({"client": client, "request_id": pd.Series(request_id, dtype="object"), "us": pd.array(us, dtype="Int64"),
                         "admitted": [r is None for r in retry], "retry_after": pd.array(retry, dtype="Int32")})


def _columns(requests: DataFrame, client: str, ts: str, request_id: str) -> DataFrame:
    return requests.select(F.col(client).cast("string").alias("client"), F.col(request_id).cast("string").alias("request_id"),
                           F.col(ts).alias("timestamp"), F.unix_micros(F.col(ts)).alias("us"))


def rate_limit(requests: DataFrame, client: str = "client", ts: str = "timestamp", request_id: str = "request_id",
               limit: int = 60) -> DataFrame:
    """Batch twin: one row per request with admitted / retry_after."""
    df = _columns(requests, client, ts, request_id).withColumn("minute", F.floor(F.col("us") / WINDOW_MICROS))
    untimed, df = df.where("us IS NULL"), df.where("us IS NOT NULL")
    counts = df.groupBy("client", "minute").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("client").orderBy("minute")  # one row per client and minute
    near = F.lag("minute").over(w) == F.col("minute") - 1
    counts = counts.withColumn("two", F.col("n") + F.when(near, F.lag("n").over(w)).otherwise(F.lit(0)))
    counts = counts.withColumn("segment", F.sum(F.when(near, 0).otherwise(1)).over(w))
    busy = F.max("two").over(Window.partitionBy("client", "segment")) > F.lit(limit)
    counts = counts.select(F.col("client").alias("c_client"), F.col("minute").alias("c_minute"), "segment", busy.alias("busy"))
    rows = df.join(counts, F.col("client").eqNullSafe(F.col("c_client")) & (F.col("minute") == F.col("c_minute")))
    calm = rows.where(~F.col("busy")).select("client", "request_id", "timestamp")
    calm = calm.unionByName(untimed.select("client", "request_id", "timestamp"))
    calm = calm.select("*", F.lit(True).alias("admitted"), F.lit(None).cast("int").alias("retry_after"))
    hot = rows.where("busy").select("client", "segment", "us", "request_id", "timestamp")
    hot = hot.repartition("client", "segment").sortWithinPartitions("client", "segment", "us", "request_id")

    def walk_rows(frames):
        key, walk = None, Walk(limit)
        for f in frames:
            retry = []
            for c, seg, t in zip(f["client"], f["segment"], f["us"]):
                if (c, seg) != key:
                    key, walk = (c, seg), Walk(limit)
                retry.append(walk.decide(t))
            yield _result(f["client"], f["request_id"], f["timestamp"], retry)

    return calm.unionByName(hot.mapInPandas(walk_rows, OUTPUT_SCHEMA))


def rate_limit_stream(requests: DataFrame, client: str = "client", ts: str = "timestamp",
                      request_id: str = "request_id", limit: int = 60, watermark: str = "1 minute") -> DataFrame:
    """Streaming form: requests are decided in time order once the watermark has passed them, so
    the result is the batch form's whatever order they arrive in, up to a delay of ``watermark``."""
    rows = _columns(requests, client, ts, request_id).withWatermark("timestamp", watermark)
    out = rows.groupBy("client").transformWithStateInPandas(RateLimitProcessor(limit), STREAM_SCHEMA, "Append", "EventTime")
    return out.select("client", "request_id", F.timestamp_micros("us").alias("timestamp"), "admitted", "retry_after")


def brute_force(rows: list[tuple[str, str, float]], limit: int = 60) -> dict[str, tuple[bool, int | None]]:
    """Plain-Python definition for tests: rows of (client, request_id, ts_seconds)."""
    out, logs = {}, {}
    for c, rid, t in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        hist = [x for x in logs.get(c, []) if x > t - WINDOW_SECONDS]
        if len(hist) >= limit:
            out[rid] = (False, max(1, int(WINDOW_SECONDS - (t - min(hist)))))
        else:
            hist.append(t)
            out[rid] = (True, None)
        logs[c] = hist
    return out
