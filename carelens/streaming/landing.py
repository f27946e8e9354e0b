"""Daily encounter deliveries into the raw zone, each content once.

A delivery is a folder of Parquet files under the landing folder. The file stream reads what is new
since its checkpoint; a manifest in the raw zone names every ingested delivery with the number of its
rows and two order-independent digests over them. A delivery whose content the manifest holds already
(a day that was sent again, under whatever folder and file names) adds nothing. A corrected day has
another content and is added; deduplication (C1) then decides between its rows and the first ones.

Rows and manifest of a micro-batch lie in folders of its own that a replay overwrites, so a job that
is ended half-way and started again neither loses nor repeats a delivery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.schemas import RAW_ENCOUNTER_SCHEMA
from carelens.session import is_folder
from carelens.streaming.jobs import encounters_stream

MANIFEST_SCHEMA = "delivery string, rows long, digest_sum decimal(38,0), digest_xor long, epoch long"
CONTENT = ["rows", "digest_sum", "digest_xor"]


def manifest(spark: SparkSession, raw: str) -> DataFrame:
    """One row per ingested delivery."""
    path = f"{raw.rstrip('/')}/manifest"
    if not is_folder(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def raw_rows(spark: SparkSession, raw: str, schema: T.StructType = RAW_ENCOUNTER_SCHEMA) -> DataFrame:
    """All ingested rows."""
    path = f"{raw.rstrip('/')}/rows"
    if not is_folder(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("epoch", T.LongType())])).parquet(path).drop("epoch")


def folder_of(path: Column) -> Column:
    """The name of the folder that holds a file. Found from the end: it is evaluated for every row, and
    a regular expression that looks for the last folder tries each place of the path in turn."""
    return F.substring_index(F.substring_index(path, "/", -2), "/", 1)


def delivery_digests(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Per ``_delivery`` the number of rows and two digests that do not depend on their order."""
    h = F.xxhash64(*columns)
    return rows.groupBy(F.col("_delivery").alias("delivery")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("digest_sum"),
        F.bit_xor(F.xxhash64(h, F.lit("second"))).alias("digest_xor"))


def ingest(spark: SparkSession, landing: str, raw: str) -> DataFrame:
    """Ingests all deliveries that are new in ``landing``; returns their manifest rows."""
    landing, raw = landing.rstrip("/"), raw.rstrip("/")
    columns = RAW_ENCOUNTER_SCHEMA.fieldNames()
    # a delivery's files are in one micro-batch: it takes all files that are there
    stream = encounters_stream(spark, f"{landing}/*", files_per_trigger=1 << 30).select(
        *columns, folder_of(F.col("_metadata.file_path")).alias("_delivery"))
    ran = []

    def write(batch: DataFrame, epoch: int) -> None:
        own = batch.sparkSession
        found = delivery_digests(batch, columns)
        known = manifest(own, raw).where(F.col("epoch") != epoch).select(*CONTENT)  # a replay decides again
        first = found.groupBy(*CONTENT).agg(F.min("delivery").alias("delivery"))  # sent twice in this batch
        fresh = first.join(known, CONTENT, "left_anti").select("delivery", *CONTENT)
        fresh.write.mode("overwrite").parquet(f"{raw}/manifest/epoch={epoch}")
        kept = own.read.parquet(f"{raw}/manifest/epoch={epoch}").select(F.col("delivery").alias("_delivery"))
        batch.join(kept, "_delivery", "left_semi").select(*columns).write.mode("overwrite").parquet(f"{raw}/rows/epoch={epoch}")
        ran.append(epoch)

    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{raw}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return manifest(spark, raw).where(F.col("epoch").isin(ran)) if ran else manifest(spark, raw).where("false")
