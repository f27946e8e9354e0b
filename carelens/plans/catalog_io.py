"""Catalog: sources, sinks and stores by way of files (registered into ``catalog``).

Each query writes the derived tables to a scratch folder in the form that the operator reads
(deliveries, request files, CSV, JSON, Parquet, reports) and returns what comes back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.operators import model as md
from carelens.operators import quality, store
from carelens.operators import scoring as sc
from carelens.plans import base
from carelens.plans.catalog import SQL, register
from carelens.plans.catalog_dirty import _FAULTY, _request_codes_sql, dirty, faulty_requests
from carelens.plans.catalog_models import LINEAR_MEANS, _linear, _linear_terms_sql, _prob_sql
from carelens.plans.oracle import ENC, FEAT, SPLIT, with_ctes
from carelens.schemas import LABEL_COLUMN, MODEL_FEATURE_COLUMNS, REQUEST_COLUMNS
from carelens.session import scratch_path
from carelens.sources import io
from carelens.streaming import landing


@register("daily_landing", with_ctes(ENC) + "SELECT * FROM enc")
def daily_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encounters as deliveries by year of admission in two rounds; the second sends two
    years again (under other names and cut into other files), which adds nothing."""
    root = scratch_path(spark, "daily-landing")
    enc = base.encounters(spark, sf_dir)
    years = sorted(r[0] for r in enc.select(F.year("admit_date")).distinct().collect() if r[0] is not None)  # a calendar's years
    half = max(1, len(years) // 2)
    rounds = [[(y, f"{y}") for y in years[:half]], [*[(y, f"{y}") for y in years[half:]], *[(y, f"{y}-again") for y in years[half - 1 : half + 1]]]]
    for deliveries in rounds:
        for year, name in deliveries:
            rows = enc.where(F.year("admit_date") == year)
            (rows.repartition(3) if "again" in name else rows).write.parquet(f"{root}/landing/{name}")
        landing.ingest(spark, f"{root}/landing", f"{root}/raw")
    return landing.raw_rows(spark, f"{root}/raw")


@register("table_roundtrip", with_ctes(ENC, FEAT) + """
SELECT f.*, t.format, (SELECT count(*) FROM feat) AS rows_written
FROM feat f CROSS JOIN (SELECT unnest(['csv', 'json', 'parquet']) AS format) t""")
def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table written and read by suffix in all three formats."""
    root, f = scratch_path(spark, "formats"), base.features(spark, sf_dir)
    out = None
    for fmt in ("csv", "json", "parquet"):
        info = io.write_table(f, io.zone_path(root, "curated", f"features.{fmt}"))
        back = io.read_table(spark, info["path"], f.schema).select(
            *f.columns, F.lit(fmt).alias("format"), F.lit(info["rows"]).cast("bigint").alias("rows_written"))
        out = back if out is None else out.unionByName(back)
    return out


@register("persisted_splits", with_ctes(ENC, FEAT, SPLIT) + """
SELECT encounter_id, split, CASE WHEN split = 'val' THEN 1 - readmitted_30d ELSE readmitted_30d END AS readmitted_30d FROM sfeat""")
def persisted_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split table persisted, then only the validation split again with flipped labels: the
    other splits stay."""
    path = f"{scratch_path(spark, 'splits')}.parquet"
    s = base.split_features(spark, sf_dir)
    io.persist_splits(s, path)
    io.persist_splits(s.where("split = 'val'").withColumn(LABEL_COLUMN, F.lit(1) - F.col(LABEL_COLUMN)), path)
    return spark.read.parquet(path).select("encounter_id", "split", LABEL_COLUMN)


@register("report_roundtrip", SQL["expectations_dirty"])
def report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validation report of the dirty table as JSON, with its NULL columns, read again."""
    path, report = scratch_path(spark, "report"), quality.run_expectations(dirty(spark, sf_dir))
    io.write_report(report, path)
    return io.read_report(spark, path, report)


@register("gate_report", f"""
SELECT 'clean' AS input, CAST(count(*) AS INTEGER) AS failed, coalesce(string_agg(n, ', ' ORDER BY idx), '') AS failures
FROM (SELECT idx, expectation || coalesce('(' || "column" || ')', '') AS n FROM ({SQL['expectations']}) WHERE NOT success)
UNION ALL
SELECT 'dirty', CAST(count(*) AS INTEGER), coalesce(string_agg(n, ', ' ORDER BY idx), '')
FROM (SELECT idx, expectation || coalesce('(' || "column" || ')', '') AS n FROM ({SQL['expectations_dirty']}) WHERE NOT success)""")
def gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: what the gate says of the raw table and of the dirty one."""
    parts = [quality.gate_report(quality.run_expectations(t)).select(F.lit(n).alias("input"), "failed", "failures")
             for n, t in (("clean", base.encounters(spark, sf_dir)), ("dirty", dirty(spark, sf_dir)))]
    return parts[0].unionByName(parts[1])


@register("feature_store_read", with_ctes(ENC, FEAT) + f"""
SELECT encounter_id, {', '.join(MODEL_FEATURE_COLUMNS)}, 'offline' AS read FROM feat
UNION ALL SELECT encounter_id, {', '.join(MODEL_FEATURE_COLUMNS)}, 'online' FROM feat WHERE CAST(encounter_id AS BIGINT) % 7 = 0""")
def feature_store_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored feature table read as a whole and by ids, through the store."""
    path = f"{scratch_path(spark, 'store')}.parquet"
    io.write_table(base.features(spark, sf_dir), path)
    fs = store.FeatureStore(spark, path)
    ids = fs.get_offline_features().select("encounter_id").where(F.col("encounter_id").cast("bigint") % 7 == 0)
    columns = ["encounter_id", *MODEL_FEATURE_COLUMNS]
    return fs.get_offline_features().select(*columns, F.lit("offline").alias("read")).unionByName(
        fs.get_online_features(ids).select(*columns, F.lit("online").alias("read")))


@register("model_input_defaults", with_ctes(ENC, FEAT) + f"""
SELECT encounter_id, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in md.NUMERIC_FEATURES)},
       {', '.join(c for c in MODEL_FEATURE_COLUMNS if c not in md.NUMERIC_FEATURES)}, 0 AS readmitted_30d FROM feat""")
def model_input_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in another order and without a label, aligned to the model's input."""
    f = base.features(spark, sf_dir)
    return md.model_input(f.select(*reversed(MODEL_FEATURE_COLUMNS), "encounter_id"))


def _files_sql() -> str:
    terms = _linear_terms_sql("a")
    by: dict[str, list[str]] = {}
    for (c, x, w), m in zip(terms, LINEAR_MEANS, strict=True):
        by.setdefault(c, []).append(f"CAST('{w!r}' AS DOUBLE) * ({x} - CAST('{m!r}' AS DOUBLE))")
    items = ", ".join(f"{{'k': -abs({' + '.join(v)}), 'pos': {MODEL_FEATURE_COLUMNS.index(c)}, 'feature': '{c}', 'v': {' + '.join(v)}}}" for c, v in by.items())
    return with_ctes(ENC, _FAULTY) + f"""
, coded AS (SELECT *, k % 3 = 0 AS single, k // 8 AS envelope, {_request_codes_sql()} AS failures FROM req),
ok AS (SELECT *, count(*) OVER (PARTITION BY envelope, single) AS n, bool_and(failures = '') OVER (PARTITION BY envelope, single) AS good FROM coded),
p AS (SELECT *, {_prob_sql('a')} AS p, list_sort([{items}]) AS c FROM ok WHERE CASE WHEN single THEN failures = '' ELSE good END)
SELECT encounter_id, NOT single AS is_batch, CAST(CASE WHEN single THEN 1 ELSE n END AS INTEGER) AS results,
       round(p, 4) AS readmission_probability, CASE WHEN p < 0.20 THEN 'low' WHEN p <= 0.50 THEN 'medium' ELSE 'high' END AS risk_tier,
       'declared' AS model_version, c[1].feature AS factor_1, round(c[1].v, 4) AS value_1, c[2].feature AS factor_2 FROM p"""


@register("request_files", _files_sql())
def request_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faulty requests as files (single requests by line, batches by
    line, some batches as indented documents of their own), read, checked, scored with a declared
    model and answered by one response document per accepted request; its results, taken apart."""
    root = scratch_path(spark, "requests")
    e = faulty_requests(spark, sf_dir).withColumn("envelope", F.expr("k div 8"))
    record = F.struct(*REQUEST_COLUMNS)
    e.where("k % 3 = 0").select(F.to_json(record)).write.text(f"{root}/single")
    g = e.where("k % 3 <> 0").groupBy("envelope").agg(F.collect_list(record).alias("data"))  # at most eight
    g.where("envelope % 997 <> 0").select(F.to_json(F.struct("data"))).write.text(f"{root}/batches")
    g.where("envelope % 997 = 0").select("envelope", F.to_json(F.struct("data"), {"pretty": "true"}).alias("doc")).write.partitionBy("envelope").text(f"{root}/indented")
    # a low bound of the size read as a whole: the files of lines are read in splits
    requests = io.parse_requests(io.request_documents(spark, f"{root}/{{single,batches,indented/*}}", whole_bytes=1 << 14))
    documents = io.responses_as_json(sc.score(_linear("a"), requests, "declared", means=LINEAR_MEANS))
    factor = T.ArrayType(T.StructType([T.StructField("feature", T.StringType()), T.StructField("shap_value", T.DoubleType())]))
    result = T.StructType([T.StructField("encounter_id", T.StringType()), T.StructField("model_version", T.StringType()),
                           T.StructField("readmission_probability", T.DoubleType()), T.StructField("risk_tier", T.StringType()), T.StructField("top_factors", factor)])
    whole = T.StructType([*result.fields, T.StructField("results", T.ArrayType(result))])
    d = documents.select(F.from_json("json", whole).alias("d"))
    single = F.array(F.struct(*[F.col(f"d.{f.name}") for f in result.fields]))
    r = d.select(F.col("d.results").isNotNull().alias("is_batch"), F.coalesce("d.results", single).alias("rs"))
    r = r.select("is_batch", F.size("rs").alias("results"), F.explode("rs").alias("r"))
    return r.select("r.encounter_id", "is_batch", "results", "r.readmission_probability", "r.risk_tier", "r.model_version",
                    F.col("r.top_factors")[0]["feature"].alias("factor_1"), F.col("r.top_factors")[0]["shap_value"].alias("value_1"),
                    F.col("r.top_factors")[1]["feature"].alias("factor_2"))
