"""Splits and sampling: positional slices (W1), temporal split (C4), patient split (C5), sample
(C6), class weight (C7).

A positional slice says for every row between which positions of a total order it lies, without
sorting, shuffling or joining the rows themselves:
  1. counts per first order column (partial aggregates) and their distributed running sums place
     every cut position in one value of it: a row per cut comes to the driver;
  2. only for those values, counts per remaining order columns and row digest, again with running
     sums, place every cut in one group of rows that are alike in all of them;
  3. the slice is then a projection: each row is compared with the cut groups, column by column.
     A projection can neither add nor lose rows, whatever repeats or is NULL.
  4. Rows of a cut group itself are the same in content; they are written and numbered over their
     partitions, and the first so many go to the earlier slice. Only here rows are written, and a
     hot group stays spread over as many tasks as held it.
No window holds a hot value, and the wide rows are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.operators.prefix import running_sums, with_row_number
from carelens.schemas import LABEL_COLUMN
from carelens.session import cut_lineage


def row_digest(df: DataFrame) -> Column:
    """A 64-bit hash of all columns, in which equal rows agree (maps through their JSON text)."""
    fields = [F.to_json(F.struct(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema.fields]
    return F.xxhash64(*fields)


@dataclass
class _Cut:
    """Where a slice ends: rows before ``group`` (order columns and digest), and ``copies`` of its
    rows. ``group`` None: no row lies behind."""

    group: list | None
    copies: int = 0


def _before(columns: list[Column], group: list) -> Column:
    """columns < group, column by column, NULLs last."""
    out = F.lit(False)
    for c, v in reversed(list(zip(columns, group, strict=True))):
        less = c.isNotNull() if v is None else F.coalesce(c < F.lit(v), F.lit(False))
        out = less | (c.eqNullSafe(F.lit(v)) & out)
    return out


def _same_group(columns: list[Column], group: list) -> Column:
    out = F.lit(True)
    for c, v in zip(columns, group, strict=True):
        out = out & c.eqNullSafe(F.lit(v))
    return out


def _cuts(df: DataFrame, order: list[str], ends: Callable[[int], list[int]]) -> list[_Cut]:
    first, rest = order[0], order[1:]
    any_of = lambda conditions: reduce(Column.__or__, conditions, F.lit(False))
    holds = lambda p: (F.col("cum_n") - F.col("n") <= p) & (F.col("cum_n") > p)
    per_value = df.groupBy(F.col(first).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    cum = running_sums(per_value, F.col("v").asc_nulls_last(), ["n"])  # reads the counts it has written
    positions = ends(cum.agg(F.max("total_n")).first()[0] or 0)
    values = cum.where(any_of(map(holds, positions))).select("v", "n", "cum_n").collect()  # one per cut at most
    starts = {p: (r["v"], p - (r["cum_n"] - r["n"])) for p in positions for r in values if r["cum_n"] - r["n"] <= p < r["cum_n"]}
    if not values:
        return [_Cut(None)] * len(positions)
    at_cut = any_of(F.col(first).eqNullSafe(F.lit(r["v"])) for r in values)
    keys = [F.col(c).alias(f"o{i}") for i, c in enumerate(rest)]
    detail = df.where(at_cut).groupBy(F.col(first).alias("v"), *keys, row_digest(df).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    inner = F.struct(*[x for i in range(len(rest)) for x in (F.col(f"o{i}").isNull(), F.col(f"o{i}"))], "digest")
    groups = running_sums(detail.withColumn("at", inner), F.col("at").asc(), ["n"], ["v"])
    wanted = any_of(F.col("v").eqNullSafe(F.lit(v)) & holds(inside) for v, inside in starts.values())
    found = groups.where(wanted).collect()  # one per cut at most

    def cut(p: int) -> _Cut:
        if p not in starts:  # behind the last row
            return _Cut(None)
        v, inside = starts[p]
        g = next(r for r in found if r["v"] == v and r["cum_n"] - r["n"] <= inside < r["cum_n"])
        return _Cut([v, *[g[f"o{i}"] for i in range(len(rest))], g["digest"]], inside - (g["cum_n"] - g["n"]))

    return [cut(p) for p in positions]


def positional_slices(df: DataFrame, order: list[str], ends: Callable[[int], list[int]], names: list[str],
                      slice_col: str = "slice") -> DataFrame:
    """``df`` with ``slice_col``: ``names[k]`` for rows between the k-th and the next end in
    ``order`` (ascending, NULLs last; then by a digest of the whole row, so the order is total up
    to rows that are the same). ``ends``: from the number of rows to the ascending end positions,
    one fewer than names. Each slice has exactly the rows its positions say."""
    cuts = _cuts(df, order, ends)
    columns = [*[F.col(f"`{c}`") for c in order], row_digest(df)]
    split_groups = {tuple(c.group): c.group for c in cuts if c.group is not None and c.copies > 0}

    def label(place: Column | None) -> Column:
        """``place``: the row's number in its cut group, for rows of one."""
        out = F.lit(names[-1])
        for cut, name in reversed(list(zip(cuts, names, strict=False))):
            if cut.group is None:
                earlier = F.lit(True)
            else:
                earlier = _before(columns, cut.group)
                if place is not None:
                    earlier = earlier | (_same_group(columns, cut.group) & (place <= F.lit(cut.copies)))
            out = F.when(earlier, F.lit(name)).otherwise(out)
        return out.alias(slice_col)

    kept = [F.col(f"`{c}`") for c in df.columns if c != slice_col]
    if not split_groups:
        return df.select(*kept, label(None))
    in_group = reduce(Column.__or__, [_same_group(columns, g) for g in split_groups.values()])
    parts = [df.where(~in_group).select(*kept, label(None))]
    for group in split_groups.values():
        numbered = with_row_number(df.where(_same_group(columns, group)), "_place")
        parts.append(numbered.select(*kept, label(F.col("_place"))))
    return reduce(DataFrame.unionByName, parts)


def temporal_split(df: DataFrame, train_fraction: float = 0.70, validation_fraction: float = 0.15,
                   date_col: str = "discharge_date", key: str = "encounter_id",
                   split_col: str = "split") -> DataFrame:
    """C4: rows ordered by (date_col, key), NULLs last: first int(n*train) -> train, next
    int(n*val) -> val, rest -> test. Keys may repeat or be NULL: every row is in one split."""
    def ends(n: int) -> list[int]:
        train = int(n * train_fraction)
        return [train, train + int(n * validation_fraction)]

    return positional_slices(df, [date_col, key], ends, ["train", "val", "test"], split_col)


def patient_split(df: DataFrame, split_col: str = "split", patient: str = "patient_id",
                  date_col: str = "discharge_date", key: str = "encounter_id") -> DataFrame:
    """Every encounter of a patient goes to the split of the patient's first discharge.

    ``df`` must carry a temporal ``split_col``. The per-patient choice is a ``min_by``
    aggregate (partial per task, so a hot patient is collapsed before the shuffle).
    """
    first = (df.groupBy(patient)
             .agg(F.min_by(F.col(split_col), F.struct(F.col(date_col), F.col(key))).alias("_ps")))
    return (df.drop(split_col).join(first, patient, "left")
            .withColumnRenamed("_ps", split_col))


def sample_rows(df: DataFrame, n: int, seed: int = 42, key: str = "encounter_id") -> DataFrame:
    """Deterministic sample of ``n`` rows when there are more (top-n by a seeded hash;
    a TakeOrdered per task, then a merge of n rows per task)."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))), F.col(key)).limit(n)


def class_weight(df: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    """One row ``neg / max(pos, 1)`` over ``df``."""
    return df.agg((F.count_if(F.col(label) == 0) / F.greatest(F.count_if(F.col(label) == 1), F.lit(1)))
                  .alias("class_weight"))


def with_class_weight(df: DataFrame, label: str = LABEL_COLUMN, weight_col: str = "weight") -> DataFrame:
    """Weight column: positives get the class weight, negatives 1 (one-row broadcast)."""
    w = class_weight(df, label)
    return (df.crossJoin(F.broadcast(w))
            .withColumn(weight_col, F.when(F.col(label) == 1, F.col("class_weight")).otherwise(F.lit(1.0)))
            .drop("class_weight"))
