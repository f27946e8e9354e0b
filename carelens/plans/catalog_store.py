"""Catalog: feature store lookups and the point-in-time join (registered into ``catalog``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.operators import asof, store
from carelens.plans import base
from carelens.plans.catalog import register
from carelens.plans.oracle import ENC, FEAT, with_ctes
from carelens.schemas import MODEL_FEATURE_COLUMNS
from carelens.sources.tables import table

_MODEL_COLS = ", ".join(["encounter_id"] + MODEL_FEATURE_COLUMNS)


@register("feature_lookup", with_ctes(ENC, FEAT) + f"""
SELECT {_MODEL_COLS} FROM feat WHERE encounter_id IN (SELECT encounter_id FROM enc)""")
def feature_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Online lookup of every raw encounter id in the feature table (model columns)."""
    requested = base.encounters(spark, sf_dir).select("encounter_id")
    return store.lookup(base.features(spark, sf_dir), requested)


@register("feature_lookup_missing", with_ctes(ENC, FEAT) + """
SELECT DISTINCT encounter_id FROM enc WHERE encounter_id NOT IN (SELECT encounter_id FROM feat)""")
def feature_lookup_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested ids the feature table does not hold (dropped for a NULL label)."""
    requested = base.encounters(spark, sf_dir).select("encounter_id")
    return store.missing_ids(base.features(spark, sf_dir), requested)


def lab_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utilisation/lab-like events per patient: line items at their ship date."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("patient_id"), F.col("l_shipdate").cast("date").alias("lab_date"),
        F.col("l_quantity").alias("value"), "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("lab_ts"))


@register("asof_features", with_ctes(ENC) + """
, labs AS (SELECT CAST(o_custkey AS VARCHAR) AS patient_id, CAST(l_shipdate AS DATE) AS day,
                  arg_max(l_quantity, (l_shipdate, l_orderkey, l_linenumber, l_quantity)) AS value
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
SELECT e.encounter_id, e.discharge_date, l.day AS asof_day, l.value AS asof_value
FROM enc e ASOF LEFT JOIN labs l ON e.patient_id = l.patient_id AND e.discharge_date >= l.day""")
def asof_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest lab value of the patient on or before the discharge date (point in time)."""
    enc = base.encounters(spark, sf_dir).select("encounter_id", "patient_id", "discharge_date")
    j = asof.asof_join(enc, lab_events(spark, sf_dir), key="patient_id", left_day="discharge_date",
                       right_day="lab_date", values=["value"], tie_break=["lab_ts", "l_orderkey", "l_linenumber", "value"])
    return j.select("encounter_id", "discharge_date", "asof_day", "asof_value")
