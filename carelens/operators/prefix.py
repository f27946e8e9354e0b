"""Running sums and exact quantiles without a single-task window.

``running_sums`` range-partitions the rows on (group, order key), so many tasks share a
large group, sums within partitions and adds the totals of the partitions before. The
range-partitioned rows are written once, so that the two views agree. ``quantiles`` reads
exact, linearly interpolated quantiles off the running counts of distinct values; no task
holds a whole group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelens.session import cut_lineage


def _same(a: str, b: str, names) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}"))
    return cond


def running_sums(df: DataFrame, order: Column, cols, by=(), inclusive: bool = True) -> DataFrame:
    """``df`` with ``cum_<c>`` (running sum of ``c`` by ``order`` within ``by``) and
    ``total_<c>`` (sum over the group) for every ``c``. ``order`` should be unique per group."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(parts, *by, order).withColumn("_pid", F.spark_partition_id()))
    here = Window.partitionBy("_pid", *by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = ranged.select("*", *[F.coalesce(F.sum(c).over(here), F.lit(0)).alias(f"_l_{c}") for c in cols])
    # one row per partition and group in it
    sums = ranged.groupBy("_pid", *by).agg(*[F.sum(c).alias(f"_s_{c}") for c in cols])
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = sums.select("_pid", *by, *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in cols],
                          *[F.sum(f"_s_{c}").over(whole).alias(f"total_{c}") for c in cols])
    out = local.alias("l").join(offsets.alias("o"), _same("l", "o", ["_pid", *by]))
    return out.select(*[F.col(f"l.{c}") for c in df.columns],
                      *[(F.col(f"l._l_{c}") + F.col(f"o._o_{c}")).alias(f"cum_{c}") for c in cols],
                      *[F.col(f"o.total_{c}") for c in cols])


def quantiles(counts: DataFrame, value: str, probs: list[float], by=(), n: str = "n") -> DataFrame:
    """Per group the array ``q`` of exact quantiles (linear between neighbours) from rows
    (group, distinct value, ``n``); NULL values are ignored."""
    cum = running_sums(counts.where(F.col(value).isNotNull()), F.col(value).asc(), [n], by)
    aggs = []
    for i, p in enumerate(probs):
        at = (F.col(f"total_{n}") - 1) * F.lit(float(p))
        for name, pos in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            hit = (F.col(f"cum_{n}") - F.col(n) <= pos) & (pos < F.col(f"cum_{n}"))
            aggs.append(F.max(F.when(hit, F.col(value))).alias(f"_{name}{i}"))
    g = cum.groupBy(*by).agg(F.max(f"total_{n}").alias("_total"), *aggs)

    def one(i: int, p: float) -> Column:
        at = (F.col("_total") - 1) * F.lit(float(p))
        lo, hi = F.floor(at), F.ceil(at)
        return F.when(lo == hi, F.col(f"_lo{i}")).otherwise((hi - at) * F.col(f"_lo{i}") + (at - lo) * F.col(f"_hi{i}"))

    return g.select(*by, F.array(*[one(i, p) for i, p in enumerate(probs)]).alias("q"))


def with_row_number(ordered: DataFrame, name: str = "row_no") -> DataFrame:
    """``ordered`` (a DataFrame with an ORDER BY) with each row's place from 1 on, without one
    task holding all rows: the sorted rows are written, partition by partition in order."""
    at = F.monotonically_increasing_id()
    rows = cut_lineage(ordered.withColumn("_at", at))
    part = F.shiftrightunsigned("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return rows.join(F.broadcast(starts), part == F.col("_part")).select(*ordered.columns, place.alias(name))


def ks_pvalue(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample KS p-value. lambda**2 = D**2 nm / (n + m). The alternating series
    converges slowly for small lambda, where its theta dual is used: both are exact to double
    precision with a few terms on their side of the switch."""
    l2 = F.pow(statistic, 2) * n * m / (n + m)
    large, small = F.lit(0.0), F.lit(0.0)
    for k in range(1, 9):
        large = large + F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * l2)
        small = small + F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi**2 / 8) / l2)
    p = F.when(l2 < 1.4, F.lit(1.0) - F.sqrt(F.lit(2 * math.pi) / l2) * small).otherwise(large)
    return F.when(statistic == 0, F.lit(1.0)).otherwise(F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))


def ks_pvalue_sql(d: str, n: str, m: str) -> str:
    """The same as SQL over columns."""
    l2 = f"(pow({d}, 2) * {n} * {m} / ({n} + {m}))"
    large = " + ".join(f"CAST({2.0 * (-1) ** (k - 1)!r} AS DOUBLE) * exp(CAST({-2.0 * k * k!r} AS DOUBLE) * {l2})" for k in range(1, 9))
    small = " + ".join(f"exp(CAST({-((2 * k - 1) ** 2) * math.pi**2 / 8!r} AS DOUBLE) / {l2})" for k in range(1, 9))
    return (f"CASE WHEN {d} = 0 THEN 1.0 ELSE least(greatest(CASE WHEN {l2} < 1.4 THEN "
            f"1.0 - sqrt(CAST({2 * math.pi!r} AS DOUBLE) / {l2}) * ({small}) ELSE {large} END, 0.0), 1.0) END")
