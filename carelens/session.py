"""Spark session helpers.

The library never builds a session on its own inside operators; callers pass one in.
``local_session`` is for tests, the bench and the smoke entry point. On a cluster the
session comes from the platform, and ``checkpoint_dir`` reads the shared folder it names.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours wants, cluster or local.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "carelens") -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CARELENS_DRIVER_MEMORY", "16g"))
        .config(STATE_STORE, ROCKSDB_STATE)
    )
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the session has none (local tests) is a scratch folder created and set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master.startswith("local"):
            conf_dir = tempfile.mkdtemp(prefix="carelens-ckpt-")
        else:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB (a query takes the session's
    settings at its start); the session's own setting is the same again after."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB_STATE)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: Shuffled bytes a task reads while derived tables are built: some five times as much unpacked.
TASK_BYTES = 12 << 20


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution merges partitions up to ``TASK_BYTES`` inside, instead of the 64 MB that wide
    rows unpack to more than a task's memory: aggregates and sorts then stay in memory. A session
    that asks for less keeps its own setting, which holds again after."""
    before = spark.conf.get(ADVISORY, None)
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if before is None or size(before) > TASK_BYTES:
        spark.conf.set(ADVISORY, str(TASK_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ADVISORY)
        else:
            spark.conf.set(ADVISORY, before)


def in_own_session(df: DataFrame) -> DataFrame:
    """The rows of ``df`` in a new session with the same SQL settings, for queries that are observed: in
    this Spark version a session that has observed a query can no longer serialise plans with a
    freshly fitted model. (The global temporary view is a part of the plan once it is read, so it goes at once.)"""
    import uuid

    spark = df.sparkSession
    view = f"carelens_own_{uuid.uuid4().hex}"
    df.createGlobalTempView(view)
    try:
        own = spark.newSession()
        for r in spark.sql("SET").collect():  # this session's settings, a few dozen
            if r["key"].startswith("spark.sql.") and own.conf.isModifiable(r["key"]):
                own.conf.set(r["key"], r["value"])
        return own.table(f"global_temp.{view}")
    finally:
        spark.catalog.dropGlobalTempView(view)


def cut_lineage(df: DataFrame, name: str = "lineage-cut") -> DataFrame:
    """Cut the lineage of ``df`` by writing it to the shared checkpoint folder.

    A parquet table there (rather than ``df.checkpoint()``) keeps column pruning for the
    readers and leaves no RDD scan in later plans; a lost executor recomputes from the
    written files.
    """
    return materialize(df, name)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for ``name`` under the shared checkpoint folder."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/carelens/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet into the shared checkpoint folder and read it back.

    Used where one intermediate feeds several branches of a plan: the readers get
    column pruning and filter pushdown, and the lineage (and any upstream shuffle) is cut,
    so a lost executor recomputes from the written files, not from the raw tables.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


#: Names of the tables that ``materialize_bucketed`` leaves in the session's catalog begin so.
BUCKETED = "carelens_bucketed_"


def materialize_bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """As ``materialize``, as a table bucketed and sorted by ``key`` (its files lie in the checkpoint
    folder): one shuffle here, none in later joins or aggregates on the key."""
    import uuid

    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{BUCKETED}{name}_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
     .option("path", scratch_path(spark, name)).saveAsTable(table))
    return spark.table(table)


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system that holds ``path``, and the path as it knows it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def file_stamp(spark: SparkSession, path: str) -> str:
    """Size and modification time of a file or folder on any file system ('' if it is not there)."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return ""
    return f"{fs.getContentSummary(p).getLength()}:{fs.getFileStatus(p).getModificationTime()}"


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder, on any file system."""
    fs, p = _file_system(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def create_if_absent(spark: SparkSession, path: str) -> bool:
    """Creates an empty file (and its folders); False if there is one already. On file systems with
    an atomic create (HDFS, object stores with conditional puts) one of several callers wins; Hadoop's
    local file system looks first and creates then, so there the operating system creates the file."""
    fs, p = _file_system(spark, path)
    fs.mkdirs(p.getParent())
    folder = fs.resolvePath(p.getParent()).toUri()
    try:
        if folder.getScheme() == "file":
            jvm = spark.sparkContext._jvm
            file = jvm.java.io.File(folder.getPath(), p.getName()).toPath()
            jvm.java.nio.file.Files.createFile(file, spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0))
        else:
            fs.create(p, False).close()
    except Py4JJavaError:
        if not fs.exists(p):
            raise
        return False
    return True


def clear_scratch(spark: SparkSession) -> None:
    """Deletes all tables this library has written to the checkpoint folder; for the owner of a
    run, at its end, when no DataFrame over them is needed any more."""
    for t in spark.catalog.listTables(pattern=f"{BUCKETED}*"):
        spark.sql(f"DROP TABLE IF EXISTS {t.name}")
    fs, pattern = _file_system(spark, f"{checkpoint_dir(spark).rstrip('/')}/carelens*")
    for found in fs.globStatus(pattern) or []:
        fs.delete(found.getPath(), True)
