"""Feature store over a parquet table.

Offline read is a lazy scan (column pruning and filter pushdown reach the files).
Online lookup is a ``left_semi`` join of the requested ids; the missing-id check is a
``left_anti`` join. Catalyst/AQE pick broadcast for a small request and sort-merge for
a batch-sized one; nothing is collected. The missing ids of a failed lookup are a written
table that the error names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.schemas import MODEL_FEATURE_COLUMNS
from carelens.session import scratch_path


class MissingIdsError(KeyError):
    """Requested ids are not in the table; ``ids()`` is the whole list as a DataFrame."""

    def __init__(self, n: int, path: str, spark: SparkSession):
        super().__init__(f"{n} requested encounter id(s) have no features; the list is in {path}")
        self.n, self.path, self._spark = n, path, spark

    def ids(self) -> DataFrame:
        return self._spark.read.parquet(self.path)


class FeatureStore:
    def __init__(self, spark: SparkSession, path: str, key: str = "encounter_id", cache: bool = False):
        self.spark, self.path, self.key, self.cache = spark, path, key, cache
        self._df: DataFrame | None = None

    def get_offline_features(self) -> DataFrame:
        """The whole table (``cache`` only on request)."""
        if self._df is None:
            df = self.spark.read.parquet(self.path)
            self._df = df.cache() if self.cache else df
        return self._df

    def get_online_features(self, ids, columns: list[str] = MODEL_FEATURE_COLUMNS,
                            strict: bool = True) -> DataFrame:
        """J1 (+ J2 when ``strict``): rows of the requested ids, model columns only."""
        return lookup(self.get_offline_features(), _ids_frame(self.spark, ids, self.key), self.key, columns, strict)


def _ids_frame(spark: SparkSession, ids, key: str) -> DataFrame:
    if isinstance(ids, DataFrame):
        return ids.select(F.col(ids.columns[0]).cast("string").alias(key))
    return spark.createDataFrame([(str(i),) for i in ids], f"{key} string")


def missing_ids(table: DataFrame, requested: DataFrame, key: str = "encounter_id") -> DataFrame:
    """Requested ids absent from the table."""
    return requested.select(key).distinct().join(table.select(key), key, "left_anti")


def lookup(table: DataFrame, requested: DataFrame, key: str = "encounter_id",
           columns: list[str] = MODEL_FEATURE_COLUMNS, strict: bool = False) -> DataFrame:
    """Semi-join of the table with the requested ids.

    ``strict``: when any id is absent, write the sorted missing ids to the shared scratch
    folder and raise ``MissingIdsError`` (a ``KeyError``) with their number and the path.
    """
    if strict:
        path = scratch_path(table.sparkSession, "missing-ids")
        missing_ids(table, requested, key).orderBy(key).write.parquet(path)
        n = table.sparkSession.read.parquet(path).count()
        if n:
            raise MissingIdsError(n, path, table.sparkSession)
    cols = [key] + [c for c in columns if c in table.columns and c != key]
    return table.join(requested.select(key).distinct(), key, "left_semi").select(*cols)
