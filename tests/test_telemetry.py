"""Telemetry lookback semantics (P13 `ago()`), KQL string predicates (P14) and JSON
dimensions (P15) on the driver's events, against DuckDB."""

import duckdb
from pyspark.sql import functions as F

from carelens.operators import telemetry as tm
from carelens.sources import telemetry as src

SF = "/root/testdata/sf0.001"


def test_last_hour_latency_matches_duckdb(spark):
    req = src.requests(spark, SF)
    as_of = F.lit(req.agg(F.max("timestamp")).first()[0])
    got = {(r.timestamp, r.requestCount, r.p95) for r in
           tm.latency_percentiles(req, as_of, "1 hour").collect()}
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    exp = set(con.execute(f"""
        WITH e AS (SELECT CAST(ts AS TIMESTAMP) AS t, value * CAST(10.0 AS DOUBLE) AS d
                   FROM read_parquet('{SF}/events.parquet'))
        SELECT time_bucket(INTERVAL '5 minutes', t), count(*), round(quantile_cont(d, 0.95), 6)
        FROM e WHERE t > (SELECT max(t) FROM e) - INTERVAL 1 HOUR GROUP BY 1""").fetchall())
    assert got == exp and 0 < len(exp) <= 13


def test_kql_predicates(spark):
    df = spark.createDataFrame([("POST /api/v1/score",), ("GET /v1/scores",), ("x V1/SCORE y",), ("v1/scorecard",)], "n string")
    assert [r[0] for r in df.select(tm.has_term(F.col("n"), "v1/score")).collect()] == [True, False, True, False]
    codes = spark.createDataFrame([("500",), ("503",), ("429",), (None,)], "c string")
    assert [r[0] for r in codes.select(tm.startswith_ci(F.col("c"), "5")).collect()] == [True, True, False, None]
    dims = spark.createDataFrame([('{"appid": "a1", "risk_tier": "high"}',)], "d string")
    assert dims.select(tm.dim(F.col("d"), "appid"), tm.dim(F.col("d"), "risk_tier")).first() == ("a1", "high")
