"""Raw encounter table derived from the driver's TPC-H-like tables.

orders -> encounters, customer -> patient, line items -> length of stay and severity
counts; look-ahead label and prior use come from the patient-history operator.

Plan shape (sizes grow with the data, nothing is collected):
  lineitem dealt by order --> per-order aggregate (one shuffle of lineitem's four columns)
  orders LEFT JOIN per-order aggregate on order key (sort-merge, co-partitioned)
  written once, bucketed by a key that encodes order, patient and dates: the one
  exchange of wide rows
  narrow rows (key, patient, dates) look up the patient history over a per-(patient, day)
  pre-aggregate (see operators.history) and customer x nation x region (nation/region are
  fixed-size and broadcast by Catalyst's size check; customer grows with the data, so AQE
  decides broadcast vs shuffle at run time and splits a skewed patient)
  bucketed rows LEFT JOIN what was found, on the key (only the narrow side is shuffled)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.operators.history import ATTACH, attach_key, history_lookups
from carelens.schemas import RAW_ENCOUNTER_COLUMNS
from carelens.session import materialize_bucketed
from carelens.sources.tables import table


def line_aggregates(lineitem: DataFrame) -> DataFrame:
    """Per-order line count, returned lines, discount sum, distinct parts.

    The lines are dealt by order once; both steps of the distinct count then find them in place."""
    lines = lineitem.select("l_orderkey", "l_partkey", "l_discount", (F.col("l_returnflag") == "R").alias("returned"))
    return (lines.repartition("l_orderkey").groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.count_if("returned").alias("n_returned"),
                 F.sum("l_discount").alias("discount_sum"),
                 F.count_distinct("l_partkey").alias("n_parts")))


def patient_dimension(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    return (customer.select("c_custkey", "c_nationkey", "c_mktsegment")
            .join(nation.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select("c_custkey", F.col("c_mktsegment").alias("ethnicity"), F.col("r_name").alias("insurance_type")))


def encounter_rows(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Order-level columns of an encounter, before history and patient attributes."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    j = o.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    los = F.coalesce(F.col("n_lines"), F.lit(0)).cast("int")
    admit = F.col("o_orderdate").cast("date")
    key = F.col("o_orderkey")
    adm_type = F.when(F.col("o_orderpriority") == "1-URGENT", "Urgent") \
        .when(F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM"), "Emergency") \
        .otherwise("Elective")
    disposition = F.when(F.col("o_orderstatus") == "F", "Home") \
        .when(F.col("o_orderstatus") == "O", "SNF") \
        .when(F.col("o_orderstatus") == "P", "Rehab")
    sex = F.when(F.col("o_custkey") % 50 == 0, "U").when(F.col("o_custkey") % 2 == 0, "F").otherwise("M")
    return j.select(
        key.cast("string").alias("encounter_id"),
        F.col("o_custkey").alias("_custkey"),
        F.col("o_custkey").cast("string").alias("patient_id"),
        admit.alias("admit_date"),
        F.date_add(admit, los).alias("discharge_date"),
        ((F.col("o_custkey") * 37) % 101).cast("int").alias("age"),
        sex.alias("sex"),
        adm_type.alias("admission_type"),
        disposition.alias("discharge_disposition"),
        los.alias("length_of_stay"),
        F.concat(F.lit("D"), (key % 7).cast("string")).alias("primary_diagnosis_code"),
        F.coalesce(F.col("n_returned"), F.lit(0)).cast("int").alias("comorbidity_count"),
        F.coalesce(F.round(F.col("discount_sum") * F.lit(10.0), 2), F.lit(0.0)).alias("charlson_index"),
        F.coalesce(F.col("n_parts"), F.lit(0)).cast("int").alias("num_medications"),
        (F.lit(18.0) + (key % 25)).cast("double").alias("bmi"),
        (F.lit(90.0) + (key % 91)).cast("double").alias("systolic_bp"),
        (F.lit(70.0) + (key % 181)).cast("double").alias("glucose_level"),
        (F.lit(0.5) + (key % 30) / F.lit(10.0)).cast("double").alias("creatinine"),
    )


def raw_encounters(spark: SparkSession, sf_dir: str, *, materialize_rows: bool = True) -> DataFrame:
    """RawEncounter table (22 columns) from the driver tables.

    The order-level rows feed three branches (the encounter itself and two history
    lookups); they are written once to the shared checkpoint folder so that lineitem,
    the largest table, is scanned and shuffled once rather than once per branch, and bucketed
    by the key of the final join, so that they are not shuffled again.
    """
    lines = line_aggregates(table(spark, sf_dir, "lineitem"))
    rows = encounter_rows(table(spark, sf_dir, "orders"), lines)
    # History keyed on the numeric customer key: cheaper hashing than the string id.
    rows = rows.withColumn(ATTACH, attach_key("encounter_id", "_custkey", "admit_date", "discharge_date"))
    if materialize_rows:
        rows = materialize_bucketed(rows, ATTACH, "encounter_rows")
    dim = patient_dimension(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"),
                            table(spark, sf_dir, "region"))
    found = history_lookups(rows, patient="_custkey").join(dim, F.col("_custkey") == F.col("c_custkey"), "left")
    enc = rows.join(found.drop("_custkey", "c_custkey"), ATTACH, "left")
    return enc.select(*RAW_ENCOUNTER_COLUMNS)
