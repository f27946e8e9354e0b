"""Data-quality expectations (Q1-Q8) and request rules.

The suite runs as ONE aggregate job: every not-null / between / in-set expectation is
a ``count_if`` in a single ``agg`` (partial aggregation per task, one tiny shuffle), and
the uniqueness expectation is a second ``groupBy(key)`` job whose partial aggregate also
collapses a hot key. The result is a long-form table, one row per expectation.

Quarantine (Q8) evaluates the same rules per row and returns an array of failure codes,
so bad rows can be split off instead of halting the batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.schemas import ADMISSION_TYPES, DISCHARGE_DISPOSITIONS, RAW_ENCOUNTER_COLUMNS, SEX_VALUES


@dataclass(frozen=True)
class Expectation:
    kind: str  # columns_match_set | not_null | unique | between | in_set
    column: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    value_set: tuple | None = None
    mostly: float = 1.0


# The raw-encounter expectation suite (20 expectations, in suite order).
ENCOUNTER_SUITE: list[Expectation] = [
    Expectation("columns_match_set", value_set=tuple(RAW_ENCOUNTER_COLUMNS)),
    Expectation("not_null", "encounter_id"),
    Expectation("unique", "encounter_id"),
    Expectation("not_null", "patient_id"),
    Expectation("between", "age", 0, 120),
    Expectation("in_set", "sex", value_set=tuple(SEX_VALUES)),
    Expectation("in_set", "admission_type", value_set=tuple(ADMISSION_TYPES)),
    Expectation("in_set", "discharge_disposition", value_set=tuple(DISCHARGE_DISPOSITIONS)),
    Expectation("between", "length_of_stay", 0, 365),
    Expectation("between", "comorbidity_count", 0, 30),
    Expectation("between", "charlson_index", 0, 20),
    Expectation("between", "prior_admissions_12mo", 0, 50),
    Expectation("between", "prior_ed_visits_12mo", 0, 50),
    Expectation("between", "num_medications", 0, 60),
    Expectation("between", "bmi", 5, 100),
    Expectation("between", "systolic_bp", 40, 300),
    Expectation("between", "glucose_level", 20, 1000),
    Expectation("between", "creatinine", 0.1, 20),
    Expectation("in_set", "readmitted_30d", value_set=(0, 1), mostly=0.99),
    Expectation("not_null", "discharge_date", mostly=0.999),
]

# Scoring request field rules (strict bounds are open intervals).
REQUEST_RULES: list[tuple[str, str, tuple]] = [
    ("age", "range", (0, 120)),
    ("sex", "in", tuple(SEX_VALUES)),
    ("admission_type", "in", tuple(ADMISSION_TYPES)),
    ("length_of_stay", "range", (0, 365)),
    ("comorbidity_count", "min", (0,)),
    ("charlson_index", "min", (0,)),
    ("prior_admissions_12mo", "min", (0,)),
    ("prior_ed_visits_12mo", "min", (0,)),
    ("num_medications", "min", (0,)),
    ("bmi", "open", (0, 100)),
    ("systolic_bp", "open", (0, 300)),
    ("glucose_level", "open", (0, 1000)),
    ("creatinine", "open", (0, 20)),
]
REQUEST_REQUIRED = ["encounter_id", "insurance_type", "discharge_disposition"]


def expectation_name(e: Expectation) -> str:
    return {
        "columns_match_set": "expect_table_columns_to_match_set",
        "not_null": "expect_column_values_to_not_be_null",
        "unique": "expect_column_values_to_be_unique",
        "between": "expect_column_values_to_be_between",
        "in_set": "expect_column_values_to_be_in_set",
    }[e.kind]


def _unexpected(e: Expectation) -> Column:
    """Row-level predicate 'this row violates e' (NULL-safe: NULL is not a violation
    except for not_null)."""
    c = F.col(e.column)
    if e.kind == "not_null":
        return c.isNull()
    if e.kind == "between":
        return c.isNotNull() & ~c.between(F.lit(e.min_value), F.lit(e.max_value))
    if e.kind == "in_set":
        return c.isNotNull() & ~c.isin(*e.value_set)
    raise ValueError(e.kind)


def run_expectations(df: DataFrame, suite: list[Expectation] = ENCOUNTER_SUITE) -> DataFrame:
    """Q1-Q6: one result row per expectation.

    Columns: idx, expectation, column, success, element_count, missing_count,
    unexpected_count, unexpected_percent (over non-missing rows; over all rows for
    not_null). Expectations on absent columns fail with NULL counts.

    Plan: one aggregate row with every count (a single scan, partial aggregation per
    task), the uniqueness count from a second grouped aggregate (one row), and an
    ``inline`` of per-expectation structs to turn the row into the report.
    """
    present = set(df.columns)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, e in enumerate(suite):
        if e.kind in ("not_null", "between", "in_set", "unique") and e.column in present:
            aggs.append(F.count_if(F.col(e.column).isNull()).alias(f"m{i}"))
            if e.kind != "unique":
                aggs.append(F.count_if(_unexpected(e)).alias(f"u{i}"))
    totals = df.agg(*aggs)
    for i, e in enumerate(suite):
        if e.kind == "unique" and e.column in present:
            # Every member of a duplicated (non-NULL) key counts as unexpected.
            dup = (df.where(F.col(e.column).isNotNull()).groupBy(e.column).count()
                   .agg(F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0)).alias(f"u{i}")))
            totals = totals.crossJoin(dup)  # one-row tables
    null_long = F.lit(None).cast("bigint")
    rows = []
    for i, e in enumerate(suite):
        name = expectation_name(e)
        if e.kind == "columns_match_set":
            ok = set(e.value_set) <= present
            rows.append((i, name, None, F.lit(ok), null_long, F.lit(len(set(e.value_set) - present)).cast("bigint")))
        elif e.column not in present:
            rows.append((i, name, e.column, F.lit(False), null_long, null_long))
        else:
            miss = F.lit(0).cast("bigint") if e.kind == "not_null" else F.col(f"m{i}")
            unexpected = F.col(f"m{i}") if e.kind == "not_null" else F.col(f"u{i}")
            rows.append((i, name, e.column, F.lit(None).cast("boolean"), miss, unexpected))
    structs = [F.struct(F.lit(i).alias("idx"), F.lit(name).alias("expectation"),
                        F.lit(col).cast("string").alias("column"), ok.alias("success"),
                        F.col("n").alias("element_count"), miss.cast("bigint").alias("missing_count"),
                        unexp.cast("bigint").alias("unexpected_count"))
               for i, name, col, ok, miss, unexp in rows]
    out = totals.select(F.inline(F.array(*structs)))
    mostly = F.element_at(F.array(*[F.lit(float(e.mostly)) for e in suite]), F.col("idx") + 1)
    denom = F.col("element_count") - F.coalesce(F.col("missing_count"), F.lit(0))
    pct = F.when(denom > 0, F.col("unexpected_count") * 100.0 / denom).otherwise(F.lit(0.0))
    ok = F.coalesce(F.col("success"), F.when(denom > 0, (F.lit(1.0) - F.col("unexpected_count") / denom) >= mostly)
                    .otherwise(F.lit(True)))
    return out.select("idx", "expectation", "column", ok.alias("success"), "element_count", "missing_count",
                      "unexpected_count", F.round(pct, 6).alias("unexpected_percent"))


class ValidationError(Exception):
    pass


def gate_report(results: DataFrame) -> DataFrame:
    """Q7: one row (failed, failures): how many expectations failed, and their names in suite order."""
    name = F.concat("expectation", F.coalesce(F.concat(F.lit("("), "column", F.lit(")")), F.lit("")))
    failed = F.array_sort(F.collect_list(F.when(~F.col("success"), F.struct("idx", name.alias("name")))))  # one per expectation at most
    return results.agg(failed.alias("f")).select(F.size("f").alias("failed"), F.array_join(F.col("f.name"), ", ").alias("failures"))


def validation_gate(results: DataFrame) -> DataFrame:
    """Q7: raise when any expectation failed; the result table is tiny (one row each)."""
    r = gate_report(results).first()
    if r["failed"]:
        raise ValidationError(f"{r['failed']} expectation(s) failed: {r['failures']}")
    return results


def failure_codes(df: DataFrame, suite: list[Expectation] = ENCOUNTER_SUITE, key: str = "encounter_id") -> Column:
    """Per-row failure codes of the row-level rules of ``suite`` (not_null, between, in_set)."""
    present = set(df.columns)
    codes = []
    for e in suite:
        if e.kind in ("not_null", "between", "in_set") and e.column in present and e.mostly >= 1.0:
            codes.append(F.when(_unexpected(e), F.lit(f"{e.kind}:{e.column}")))
    return F.array_compact(F.array(*codes)) if codes else F.array().cast("array<string>")


def quarantine(df: DataFrame, suite: list[Expectation] = ENCOUNTER_SUITE, key: str = "encounter_id") -> DataFrame:
    """Q8: add ``failures`` (array of codes, empty when valid) and ``is_valid``.

    Duplicate keys are flagged by joining a per-key count (partial aggregate first, so
    a hot key is collapsed; the join back is a skew-split sort-merge join under AQE).
    """
    out = df.withColumn("failures", failure_codes(df, suite, key))
    if key in df.columns and any(e.kind == "unique" and e.column == key for e in suite):
        dups = df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > 1) \
            .select(F.col(key).alias("_dk"))
        out = (out.join(dups, F.col(key) == F.col("_dk"), "left")
               .withColumn("failures", F.when(F.col("_dk").isNotNull(),
                                              F.concat(F.col("failures"), F.array(F.lit(f"unique:{key}"))))
                           .otherwise(F.col("failures")))
               .drop("_dk"))
    return out.withColumn("is_valid", F.size("failures") == 0)


def request_failures(record: DataFrame | Callable[[str], Column]) -> Column:
    """Array of failure codes of a scoring request record (empty when valid). ``record``: the
    table of records, or a function from a field's name to its value."""
    out_of = F.col if isinstance(record, DataFrame) else record
    codes = []
    for c in REQUEST_REQUIRED:
        codes.append(F.when(out_of(c).isNull(), F.lit(f"required:{c}")))
    for c, kind, args in REQUEST_RULES:
        col = out_of(c)
        if kind == "range":
            bad = col.isNull() | (col < args[0]) | (col > args[1])
        elif kind == "in":
            bad = col.isNull() | ~col.isin(*args)
        elif kind == "min":
            bad = col.isNull() | (col < args[0])
        else:  # open interval
            bad = col.isNull() | (col <= args[0]) | (col >= args[1])
        codes.append(F.when(bad, F.lit(f"{kind}:{c}")))
    return F.array_compact(F.array(*codes))


def envelope_failures(data: Column, max_batch: int = 100) -> Column:
    """The batch envelope ``data`` must be a non-empty array of at most ``max_batch``."""
    return (F.when(data.isNull() | (F.size(data) == 0), F.lit("no records in 'data'"))
            .when(F.size(data) > max_batch, F.concat(F.size(data).cast("string"), F.lit(f" records; at most {max_batch} per batch"))))
