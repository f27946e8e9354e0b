"""Catalog: the quality, cleaning and split operators on dirty input, and requests with faults.

The dirty table is the raw encounter table with faults placed by the order key: repeated rows
(with their ingestion order), dates as strings, ages and categories out of range, missing ids,
dates and labels. Its SQL twin places the same faults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.operators import clean, evaluate, quality, split
from carelens.operators import drift as dr
from carelens.plans import base
from carelens.plans.catalog import SQL, register
from carelens.plans.oracle import ALLFEAT, ENC, FEAT, PRED, SCORED, with_ctes
from carelens.schemas import REQUEST_COLUMNS, REQUEST_SCHEMA
from carelens.sources import io

DIRTY = """
dk AS (SELECT *, CAST(encounter_id AS BIGINT) AS k FROM enc),
d2 AS (SELECT *, 0 AS again FROM dk UNION ALL SELECT *, 1 FROM dk WHERE k % 50 = 0),
dirty AS (SELECT * REPLACE (
    CASE WHEN k % 997 = 0 THEN NULL ELSE encounter_id END AS encounter_id,
    CASE WHEN k % 211 = 0 THEN NULL ELSE patient_id END AS patient_id,
    CASE WHEN k % 101 = 0 THEN 150 ELSE age + again END AS age,
    CASE WHEN k % 103 = 0 THEN 'X' ELSE sex END AS sex,
    CASE WHEN k % 500 = 0 THEN NULL ELSE CAST(discharge_date AS VARCHAR) END AS discharge_date,
    CASE WHEN k % 61 = 0 AND again = 0 THEN NULL WHEN k % 89 = 0 THEN 2 ELSE readmitted_30d END AS readmitted_30d),
  2 * k + again AS _ingest_seq FROM d2)"""


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = base.encounters(spark, sf_dir).withColumn("k", F.col("encounter_id").cast("bigint"))
    e = e.withColumn("again", F.explode(F.when(F.col("k") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))

    def unless(n: int, value, otherwise):
        return F.when(F.col("k") % n == 0, value).otherwise(otherwise)

    none = F.lit(None).cast("string")
    label = F.when((F.col("k") % 61 == 0) & (F.col("again") == 0), F.lit(None).cast("int"))
    changed = {
        "encounter_id": unless(997, none, F.col("encounter_id")), "patient_id": unless(211, none, F.col("patient_id")),
        "age": unless(101, F.lit(150), F.col("age") + F.col("again")), "sex": unless(103, F.lit("X"), F.col("sex")),
        "discharge_date": unless(500, none, F.col("discharge_date").cast("string")),
        "readmitted_30d": label.when(F.col("k") % 89 == 0, F.lit(2)).otherwise(F.col("readmitted_30d")),
    }
    kept = [c for c in e.columns if c not in ("k", "again")]
    return e.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in kept],
                    (2 * F.col("k") + F.col("again")).alias("_ingest_seq"))


def _on_dirty(name: str) -> str:
    """The SQL twin of a raw-table query, over the dirty table."""
    sql = SQL[name].replace("FROM enc WHERE", "FROM dirty WHERE").replace("FROM enc)", "FROM dirty)").replace("FROM enc\n", "FROM dirty\n")
    sql = sql.replace("count(*) OVER (PARTITION BY encounter_id) > 1", "encounter_id IS NOT NULL AND count(*) OVER (PARTITION BY encounter_id) > 1")
    if sql.endswith("FROM enc"):
        sql = sql[: -len("enc")] + "dirty"
    sql = sql.replace("FROM enc UNION ALL", "FROM dirty UNION ALL").replace("FROM enc GROUP", "FROM dirty GROUP")
    head = with_ctes(ENC)
    return with_ctes(ENC, DIRTY) + sql[len(head):]


@register("expectations_dirty", _on_dirty("expectations"))
def expectations_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q6 on the dirty table: violated, failed and tolerated expectations."""
    return quality.run_expectations(dirty(spark, sf_dir))


@register("quarantine_dirty", _on_dirty("quarantine"))
def quarantine_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 on the dirty table."""
    q = quality.quarantine(dirty(spark, sf_dir))
    return q.select("encounter_id", F.array_join("failures", ",").alias("failures"))


@register("dedup_dirty", with_ctes(ENC, DIRTY) + """
, first AS (SELECT * FROM dirty QUALIFY row_number() OVER (PARTITION BY encounter_id ORDER BY _ingest_seq) = 1)
SELECT encounter_id, age, admit_date, CAST(discharge_date AS DATE) AS discharge_date, readmitted_30d
FROM first WHERE readmitted_30d IS NOT NULL""")
def dedup_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1, P7, C2 on the dirty table: first ingested row, string dates, NULL labels dropped."""
    c = clean.clean_raw_encounters(dirty(spark, sf_dir))
    return c.select("encounter_id", "age", "admit_date", "discharge_date", "readmitted_30d")


@register("split_with_null_dates", with_ctes(ENC, FEAT) + """
, d AS (SELECT encounter_id, CASE WHEN CAST(encounter_id AS BIGINT) % 500 = 0 THEN NULL ELSE discharge_date END AS day FROM feat),
r AS (SELECT *, row_number() OVER (ORDER BY day NULLS LAST, encounter_id) - 1 AS rk, count(*) OVER () AS n FROM d)
SELECT encounter_id, CASE WHEN rk < CAST(floor(n * 0.70) AS BIGINT) THEN 'train'
  WHEN rk < CAST(floor(n * 0.70) AS BIGINT) + CAST(floor(n * 0.15) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM r""")
def split_with_null_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4, W1 with NULL dates, which come last."""
    f = base.features(spark, sf_dir)
    day = F.when(F.col("encounter_id").cast("bigint") % 500 != 0, F.col("discharge_date"))
    return split.temporal_split(f.withColumn("discharge_date", day), 0.70, 0.15).select("encounter_id", "split")


@register("split_repeated_keys", with_ctes(ENC, FEAT) + """
, d AS (SELECT CASE WHEN k % 48 = 0 THEN NULL ELSE CAST(k // 16 % 40 AS VARCHAR) END AS encounter_id,
               CASE WHEN k % 500 = 0 THEN NULL ELSE CAST(date_trunc('quarter', discharge_date) AS DATE) END AS day
        FROM (SELECT CAST(encounter_id AS BIGINT) AS k, discharge_date FROM feat)),
r AS (SELECT *, row_number() OVER (ORDER BY day NULLS LAST, encounter_id NULLS LAST) - 1 AS rk, count(*) OVER () AS n FROM d)
SELECT encounter_id, day, CASE WHEN rk < CAST(floor(n * 0.70) AS BIGINT) THEN 'train'
  WHEN rk < CAST(floor(n * 0.70) AS BIGINT) + CAST(floor(n * 0.15) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM r""")
def split_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4, W1 on keys that many rows repeat or lack: positions decide, and every row comes out once."""
    f, k = base.features(spark, sf_dir), F.col("encounter_id").cast("bigint")
    key = F.when(k % 48 != 0, F.expr("cast(cast(encounter_id as bigint) div 16 % 40 as string)"))
    day = F.when(k % 500 != 0, F.trunc("discharge_date", "quarter"))
    rows = f.select(key.alias("encounter_id"), day.alias("day"), "length_of_stay", "readmitted_30d")
    return split.temporal_split(rows, 0.70, 0.15, date_col="day").select("encounter_id", "day", "split")


@register("late_labels_bounded", with_ctes(ENC, ALLFEAT, PRED) + """
, s AS (SELECT encounter_id, CAST(discharge_date AS TIMESTAMP) AS scored_ts, readmission_probability FROM pred WHERE split = 'test'),
l AS (SELECT encounter_id, CAST(discharge_date + CAST(10 + CAST(encounter_id AS BIGINT) % 81 AS INTEGER) AS TIMESTAMP) AS label_ts,
             readmitted_30d FROM enc WHERE readmitted_30d IS NOT NULL)
SELECT s.encounter_id, s.scored_ts, s.readmission_probability, l.label_ts, l.readmitted_30d
FROM s LEFT JOIN l ON s.encounter_id = l.encounter_id AND l.label_ts >= s.scored_ts
  AND l.label_ts <= s.scored_ts + INTERVAL 60 DAY""")
def late_labels_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8 with labels 10 to 90 days late: those after the 60-day bound do not count."""
    p = base.predictions(spark, sf_dir).where(F.col("split") == "test")
    scores = p.select("encounter_id", F.col("discharge_date").cast("timestamp").alias("scored_ts"), "readmission_probability")
    late = (F.lit(10) + F.col("encounter_id").cast("bigint") % 81).cast("int")
    labels = base.encounters(spark, sf_dir).where(F.col("readmitted_30d").isNotNull()).select(
        "encounter_id", F.date_add("discharge_date", late).cast("timestamp").alias("label_ts"), "readmitted_30d")
    out = dr.join_late_labels(scores, labels, 60)
    return out.withColumn("scored_ts", F.col("scored_ts").cast("timestamp_ntz")).withColumn("label_ts", F.col("label_ts").cast("timestamp_ntz"))


_RETRO = "round(CAST(0.3 AS DOUBLE) * y_prob + CAST(0.1 AS DOUBLE) * y_true * (CAST(encounter_id AS BIGINT) % 7), 4)"


@register("high_recall_reached", with_ctes(ENC, FEAT, SCORED) + f"""
, t AS (SELECT y_true, {_RETRO} AS y_prob FROM scored),
c AS (SELECT a.y_prob AS threshold, avg(CAST(b.y_true AS DOUBLE)) AS precision
      FROM (SELECT DISTINCT y_prob FROM t) a JOIN t b ON b.y_prob >= a.y_prob GROUP BY 1)
SELECT round(coalesce(min(threshold) FILTER (WHERE precision >= 0.3), 0.5), 4) AS threshold FROM c""")
def high_recall_reached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 on a retrospective score (it knows part of the label), which reaches the precision floor."""
    s = base.scored(spark, sf_dir)
    part = F.lit(0.1) * F.col("y_true") * (F.col("encounter_id").cast("bigint") % 7)
    return evaluate.high_recall_threshold(s.select("y_true", F.round(F.lit(0.3) * F.col("y_prob") + part, 4).alias("y_prob")), 0.3)


# ---------------------------------------------------------------- scoring requests with faults

_FIELDS = ", ".join(f"'{c}': {c}" for c in REQUEST_COLUMNS)
_FAULTY = """
q0 AS (SELECT *, CAST(encounter_id AS BIGINT) AS k FROM enc),
req AS (SELECT k, CASE WHEN k % 131 = 0 THEN NULL ELSE encounter_id END AS encounter_id,
  CASE WHEN k % 53 = 0 THEN 150 ELSE age END AS age, CASE WHEN k % 59 = 0 THEN 'X' ELSE sex END AS sex,
  CASE WHEN k % 137 = 0 THEN NULL ELSE insurance_type END AS insurance_type, admission_type,
  CASE WHEN k % 139 = 0 THEN NULL ELSE discharge_disposition END AS discharge_disposition,
  CASE WHEN k % 67 = 0 THEN -1 ELSE length_of_stay END AS length_of_stay, comorbidity_count, charlson_index,
  prior_admissions_12mo, prior_ed_visits_12mo, num_medications,
  CASE WHEN k % 71 = 0 THEN CAST(100.0 AS DOUBLE) ELSE bmi END AS bmi,
  CASE WHEN k % 73 = 0 THEN NULL ELSE systolic_bp END AS systolic_bp, glucose_level,
  CASE WHEN k % 79 = 0 THEN CAST(0.0 AS DOUBLE) ELSE creatinine END AS creatinine FROM q0)"""


def _request_codes_sql() -> str:
    codes = [f"CASE WHEN {c} IS NULL THEN 'required:{c}' END" for c in quality.REQUEST_REQUIRED]
    for c, kind, args in quality.REQUEST_RULES:
        ok = {"range": f"{c} BETWEEN {args[0]} AND {args[-1]}", "min": f"{c} >= {args[0]}",
              "in": f"{c} IN ({', '.join(repr(a) for a in args)})", "open": f"{c} > {args[0]} AND {c} < {args[-1]}"}[kind]
        codes.append(f"CASE WHEN NOT coalesce({ok}, false) THEN '{kind}:{c}' END")
    return f"concat_ws(',', {', '.join(codes)})"


def faulty_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every encounter as a scoring request, with faults placed by the order key (``k``)."""
    e = base.encounters(spark, sf_dir).select(F.col("encounter_id").cast("bigint").alias("k"), *REQUEST_COLUMNS)
    faults = {"encounter_id": (131, None), "age": (53, 150), "sex": (59, "X"), "insurance_type": (137, None),
              "discharge_disposition": (139, None), "length_of_stay": (67, -1), "bmi": (71, 100.0),
              "systolic_bp": (73, None), "creatinine": (79, 0.0)}
    types = {f.name: f.dataType for f in REQUEST_SCHEMA.fields}
    return e.select("k", *[F.when(F.col("k") % faults[c][0] == 0, F.lit(faults[c][1]).cast(types[c])).otherwise(F.col(c)).alias(c)
                           if c in faults else F.col(c) for c in REQUEST_COLUMNS])


@register("request_validation", with_ctes(ENC, _FAULTY) + f"""
SELECT k AS order_key, {_request_codes_sql()} AS failures FROM req""")
def request_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failure codes of every request record, through JSON documents."""
    docs = faulty_requests(spark, sf_dir).select("k", F.to_json(F.struct(*REQUEST_COLUMNS)).alias("doc"))
    r = io.parse_requests(docs, request_id="k")
    return r.select(F.col("request_id").alias("order_key"), F.array_join("failures", ",").alias("failures"))


@register("request_envelopes", with_ctes(ENC, _FAULTY) + f"""
, coded AS (SELECT k // 128 AS envelope, k, {_request_codes_sql()} AS failures FROM req),
env AS (SELECT envelope, CASE WHEN envelope % 11 = 0 THEN 0 WHEN envelope % 13 = 0 THEN least(count(*), 5) * 25 ELSE count(*) END AS n,
               CASE WHEN envelope % 13 = 0 THEN CAST(arg_min(failures, k) <> '' AS INTEGER)
                    ELSE count(*) FILTER (WHERE failures <> '') END AS bad FROM coded GROUP BY envelope)
SELECT envelope, CASE WHEN n = 0 THEN 'no records in ''data''' WHEN n > 100 THEN CAST(n AS VARCHAR) || ' records; at most 100 per batch' END AS envelope_error,
  CAST(CASE WHEN n = 0 OR n > 100 THEN 0 ELSE n END AS BIGINT) AS records, n > 0 AND n <= 100 AND bad = 0 AS accepted FROM env""")
def request_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of requests (by order key), some empty, some too large: the envelope rule,
    and a batch with any invalid record is rejected as a whole."""
    e = faulty_requests(spark, sf_dir).withColumn("envelope", F.expr("k div 128"))
    g = e.groupBy("envelope").agg(F.sort_array(F.collect_list(F.struct("k", F.struct(*REQUEST_COLUMNS).alias("r")))).alias("rs"))  # at most 128
    records = F.transform("rs", lambda x: x["r"])
    many = F.flatten(F.array_repeat(F.array_repeat(records[0], 25), F.least(F.size("rs"), F.lit(5))))
    data = F.when(F.col("envelope") % 11 == 0, F.slice(records, 1, 0)).when(F.col("envelope") % 13 == 0, many).otherwise(records)
    docs = g.select("envelope", F.to_json(F.struct(data.alias("data"))).alias("doc"))
    parsed = io.parse_requests(docs, request_id="envelope")
    good, bad = io.split_requests(parsed)
    both = good.withColumn("accepted", F.lit(True)).unionByName(bad.withColumn("accepted", F.lit(False)))
    return both.groupBy(F.col("request_id").alias("envelope")).agg(
        F.first("envelope_error").alias("envelope_error"), F.count("item").alias("records"), F.first("accepted").alias("accepted"))
