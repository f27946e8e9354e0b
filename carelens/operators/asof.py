"""Point-in-time (as-of) join, J7.

For every left row, the latest right row of the same key with ``right_day <= left_day``.
Spark has no native as-of join, so it is composed from built-ins:

  1. right side reduced to one row per (key, day): ``max_by`` over a tie-break order
     (partial aggregation per task, so a hot key is collapsed before the shuffle);
  2. left side reduced to its distinct (key, day) probes;
  3. union of both, then ``last(..., ignorenulls)`` over a window per key ordered by
     (day, right-before-left). A key's window holds at most two rows per calendar day,
     whatever the row count, so a hot key cannot flood one task;
  4. join of the resolved probes back to the left rows on (key, day).

The resolved probes (key, day and hit only) are written to the checkpoint folder in small tasks, so
the right side's rows are sorted in memory whatever the session lets a task read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelens.session import cut_lineage, small_tasks


def _latest(right: DataFrame, values: list[str], right_day: str, tie_break: list[str]) -> tuple[Column, dict[str, str]]:
    """The aggregate that keeps a day's last row, and where each value lies in it. Values that the order
    holds anyway are read from there, and a date is one per group: rows are as narrow as they can be."""
    first = [] if dict(right.dtypes)[right_day] == "date" else [right_day]
    order = list(dict.fromkeys([*first, *tie_break]))
    if order and set(values) <= set(order):
        return F.max(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(order)])), {v: f"c{order.index(v)}" for v in values}
    packed = F.struct(*[F.col(v).alias(f"c{i}") for i, v in enumerate(values)])
    return F.max_by(packed, F.struct(F.col(right_day), *[F.col(t) for t in tie_break])), {v: f"c{i}" for i, v in enumerate(values)}


def asof_join(left: DataFrame, right: DataFrame, *, key: str, left_day: str, right_day: str,
              values: list[str], tie_break: list[str], prefix: str = "asof_") -> DataFrame:
    """Add ``{prefix}day`` and ``{prefix}<value>`` columns to ``left``."""
    latest, place = _latest(right, values, right_day, tie_break)
    r = (right.groupBy(F.col(key).alias("_k"), F.col(right_day).cast("date").alias("_d"))
         .agg(latest.alias("_v"))
         .select("_k", "_d", F.lit(0).alias("_side"),
                 F.struct(F.col("_d").alias("day"), *[F.col(f"_v.{place[v]}").alias(v) for v in values]).alias("_hit")))
    probes = left.select(F.col(key).alias("_k"), F.col(left_day).cast("date").alias("_d")).distinct() \
        .select("_k", "_d", F.lit(1).alias("_side"), F.lit(None).cast(r.schema["_hit"].dataType).alias("_hit"))
    w = Window.partitionBy("_k").orderBy("_d", "_side").rowsBetween(Window.unboundedPreceding, 0)
    resolved = (r.unionByName(probes)
                .select("_k", "_d", "_side", F.last("_hit", ignorenulls=True).over(w).alias("_hit"))
                .where(F.col("_side") == 1)
                .select(F.col("_k").alias("_pk"), F.col("_d").alias("_pd"), "_hit"))
    with small_tasks(left.sparkSession):
        resolved = cut_lineage(resolved, "asof-hits")
    out = left.join(resolved, (F.col(key) == F.col("_pk")) & (F.col(left_day).cast("date") == F.col("_pd")), "left")
    return out.select(*left.columns, F.col("_hit.day").alias(f"{prefix}day"),
                      *[F.col(f"_hit.{v}").alias(f"{prefix}{v}") for v in values])
