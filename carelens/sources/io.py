"""Table I/O: read/write by suffix (S1, S2), lake paths (S3), report sink (S4),
split persistence (S5), scoring request source (S6) and response sink (S7).

Any Hadoop file system URI works (``file:``, ``hdfs:``, ``s3a:``, ``abfss:``); nothing
here touches the local disk directly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.schemas import REQUEST_SCHEMA
from carelens.session import in_own_session

FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json"}


def _format(path: str) -> str:
    p = path.rstrip("/").lower()
    for suffix, fmt in FORMATS.items():
        if p.endswith(suffix):
            return fmt
    raise ValueError(f"Unsupported file format for {path!r}; expected one of {sorted(FORMATS)}")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read CSV (header) / Parquet / JSON by suffix; a declared schema skips inference."""
    fmt = _format(path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "csv":
        return reader.option("header", True).option("inferSchema", schema is None).csv(path)
    return reader.format(fmt).load(path)


def _counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Runs ``write`` and returns how many rows it wrote, as the write itself observed them (in a
    session of its own, see ``in_own_session``)."""
    seen = Observation()
    write(in_own_session(df).observe(seen, F.count(F.lit(1)).alias("rows")))
    return int(seen.get["rows"])


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                partitions: str = "static") -> dict:
    """Write by suffix; returns {'path', 'rows', 'columns'}; the rows are counted by the write.

    ``partitions='dynamic'``: an overwrite replaces only the partitions that ``df`` has rows of."""
    fmt = _format(path)

    def write(rows: DataFrame) -> None:
        w = rows.write.mode(mode).option("partitionOverwriteMode", partitions)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if fmt == "csv":
            w = w.option("header", True)
        if fmt == "json":
            w = w.option("ignoreNullFields", False)
        w.format(fmt).save(path)

    return {"path": path, "rows": _counted(df, write), "columns": len(df.columns)}


def zone_path(root: str, zone: str, *parts: str) -> str:
    """S3: ``<root>/<zone>/<parts...>`` for any file system root.

    For an ``abfss`` account URL root (``https://<account>.dfs.core.windows.net``) the
    zone is the container: ``abfss://<zone>@<account>.dfs.core.windows.net/<parts>``.
    """
    root = root.rstrip("/")
    tail = "/".join(p.strip("/") for p in parts if p)
    if root.startswith("https://") and ".dfs." in root:
        host = root[len("https://"):]
        return f"abfss://{zone}@{host}/{tail}".rstrip("/")
    return "/".join(x for x in (root, zone, tail) if x)


def write_report(report: DataFrame, path: str, fmt: str = "json") -> None:
    """Long-form report table to JSON lines (or parquet). NULL values are written, so a
    reader finds every column."""
    w = report.write.mode("overwrite").format(fmt)
    (w.option("ignoreNullFields", False) if fmt == "json" else w).save(path)


def read_report(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A JSON report read with the columns and types it was written with."""
    return spark.read.schema(like.schema).json(path)


def persist_splits(df: DataFrame, path: str, split_col: str = "split", replace: str = "given") -> dict:
    """One table partitioned by split (readers prune to the split they need). ``replace='given'``
    rewrites the splits that ``df`` holds and leaves the others, ``'all'`` the whole table."""
    return write_table(df, path.rstrip("/") + ("" if path.endswith(".parquet") else ".parquet"),
                       partition_by=[split_col], partitions="dynamic" if replace == "given" else "static")


ENVELOPE_SCHEMA = T.StructType([T.StructField("data", T.ArrayType(REQUEST_SCHEMA))] + list(REQUEST_SCHEMA.fields))


#: A request file of more bytes is read line by line whatever it holds: a document of at most 100
#: records is far smaller.
WHOLE_BYTES = 16 << 20


def request_documents(spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """One JSON document per row (``doc``, and the ``file`` it is from). A file whose first line is
    JSON holds one document per line (lines that are no JSON stay as they are, and are rejected by
    the envelope rule); any other file that is JSON as a whole is one document.

    Files of up to ``whole_bytes`` are read as a whole to tell; larger ones are only ever read by
    lines, in splits, so no file has to fit a task. The file size prunes the files of either read."""
    size = F.col("_metadata.file_size")
    raw = spark.read.text(path, wholetext=True).where(size <= whole_bytes).select("value", F.col("_metadata.file_path").alias("file"))
    lines = F.filter(F.split("value", "\r?\n"), lambda x: F.trim(x) != "")
    raw = raw.select("value", "file", lines.alias("lines"))
    whole = F.expr("try_parse_json(get(lines, 0)) IS NULL AND try_parse_json(value) IS NOT NULL")
    small = raw.select(F.explode(F.when(whole, F.array("value")).otherwise(F.col("lines"))).alias("doc"), "file")
    large = spark.read.text(path).where(size > whole_bytes).select(F.col("value").alias("doc"), F.col("_metadata.file_path").alias("file"))
    return small.unionByName(large.where(F.trim("doc") != ""))


def parse_requests(docs: DataFrame, max_batch: int = 100, doc: str = "doc", request_id: str | None = None) -> DataFrame:
    """Request documents, each a single request object or ``{"data": [...]}``.

    Output: one row per record with ``request_id`` (per document), ``is_batch``, ``item``
    (position), ``envelope_error`` (no JSON object, or the batch rule), ``accepted`` (neither the
    document nor any of its records has a fault), ``failures`` (codes of the record's fields, empty
    when valid) and the request fields. A document that breaks the
    envelope rule gives one row without a record, so an oversized batch is not unpacked."""
    from carelens.operators.quality import envelope_failures, request_failures

    key = F.col(request_id) if request_id else F.expr("uuid()")
    obj = F.expr(f"try_parse_json({doc})")
    env = docs.select(key.alias("request_id"), F.col(doc).alias("_doc"), F.from_json(F.col(doc), ENVELOPE_SCHEMA).alias("_e"),
                      F.coalesce(F.schema_of_variant(obj).startswith("OBJECT"), F.lit(False)).alias("_object"),
                      F.coalesce(F.array_contains(F.json_object_keys(doc), "data"), F.lit(False)).alias("_has_data"))
    is_batch = F.col("_object") & F.col("_has_data")
    single = F.struct(*[F.col(f"_e.{f.name}") for f in REQUEST_SCHEMA.fields])
    error = F.when(~F.col("_object"), F.lit("not a JSON object")).when(is_batch, envelope_failures(F.col("_e.data"), max_batch))
    env = env.select("request_id", is_batch.alias("is_batch"), error.alias("envelope_error"),
                     F.when(is_batch, F.col("_e.data")).otherwise(F.array(single)).alias("_records"))
    empty = F.array().cast(T.ArrayType(REQUEST_SCHEMA))
    records = F.when(F.col("envelope_error").isNull(), F.col("_records")).otherwise(empty)
    faulty = F.exists(records, lambda r: F.size(request_failures(lambda c: r[c])) > 0)
    out = env.select("request_id", "is_batch", "envelope_error", (F.col("envelope_error").isNull() & ~faulty).alias("accepted"),
                     F.posexplode_outer(records).alias("item", "_r")).select(
        "request_id", "is_batch", "envelope_error", "accepted", "item", "_r.*")
    return out.withColumn("failures", F.when(F.col("envelope_error").isNull(), request_failures(out)).otherwise(F.array().cast("array<string>")))


def read_requests(spark: SparkSession, path: str, max_batch: int = 100) -> DataFrame:
    """``parse_requests`` over the documents of the files in ``path``."""
    return parse_requests(request_documents(spark, path), max_batch)


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): a document with an envelope error or any invalid record is rejected
    as a whole. Accepted documents are bounded by the batch rule, which ``responses_as_json``
    relies on."""
    return requests.where("accepted").drop("accepted"), requests.where("not accepted").drop("accepted")


def responses_as_json(responses: DataFrame) -> DataFrame:
    """One JSON document per request: the single result, or ``{"results": [...]}``.

    Grouping is per request envelope, which P12 caps at ``max_batch`` records, so the
    collected list is bounded.
    """
    body = F.struct("encounter_id", "model_version", "readmission_probability", "risk_tier", "top_factors",
                    F.col("response_id").alias("request_id"), "scored_at")
    grouped = responses.groupBy("request_id", "is_batch").agg(
        F.sort_array(F.collect_list(F.struct("item", body.alias("r")))).alias("_rs"))
    return grouped.select("request_id", F.when(
        F.col("is_batch"), F.to_json(F.struct(F.transform("_rs", lambda x: x["r"]).alias("results"))))
        .otherwise(F.to_json(F.col("_rs")[0]["r"])).alias("json"))


def lake_path(account: str, container: str, *parts: str) -> str:
    """S3: ``abfss://<container>@<account>.dfs.core.windows.net/<parts>``; ``account`` may
    be the bare account name or its https URL."""
    acct = account.replace("https://", "").replace(".dfs.core.windows.net", "").strip("/")
    tail = "/".join(parts)
    base = f"abfss://{container}@{acct}.dfs.core.windows.net"
    return f"{base}/{tail}" if tail else base
