"""Cleaning and the feature projection: C1-C3, P6, P7.

All functions are ``DataFrame -> DataFrame``, lazy but for the repeated keys that
deduplication writes. It keeps one row per key with an aggregate (``min_by`` over an explicit
order), so a key repeated in a third of all rows is collapsed by the map-side partial
aggregate before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from carelens.functions import features as fx
from carelens.schemas import LABEL_COLUMN
from carelens.session import cut_lineage, in_own_session

# Engineered feature column order (without the optional columns).
FEATURE_COLUMNS = [
    "encounter_id", "age", "age_band", "sex", "insurance_type", "admission_type",
    "discharge_disposition", "length_of_stay", "los_bucket", "comorbidity_count",
    "charlson_index", "comorbidity_score", "prior_admissions_12mo", "prior_ed_visits_12mo",
    "prior_utilization_rate", "num_medications", "polypharmacy_flag", "bmi", "systolic_bp",
    "glucose_level", "creatinine",
]


def dedup_first(df: DataFrame, key: str = "encounter_id", order_by: list[str | Column] | None = None) -> DataFrame:
    """Keep the first row per ``key`` under ``order_by``.

    ``order_by`` defaults to an ingestion-order column ``_ingest_seq`` when present, else
    to all columns, which makes the choice deterministic (``dropDuplicates`` is not).

    Plan: a narrow count per key (hash aggregate over the key column only) finds the
    duplicated keys, which are written once; rows with a unique key pass through an anti-join,
    and only rows of duplicated keys go through the ``min_by`` aggregate, whose partial
    aggregation collapses even a key repeated in a third of all rows before the shuffle. The
    written key set has a known size: where it is small it is broadcast and the wide rows are
    never shuffled, and without any duplicate the input is returned as it is.
    NULL keys group together (null-safe joins).
    """
    cols = df.columns
    if order_by is None:
        order_by = ["_ingest_seq"] if "_ingest_seq" in cols else [c for c in cols if c != key]
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])
    packed = F.struct(*[F.col(c) for c in cols])
    dup_keys = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
                .select(F.col(key).alias("_dk")))
    dup_keys = cut_lineage(dup_keys, "repeated-keys")
    if dup_keys.isEmpty():
        return df
    on = F.col(key).eqNullSafe(F.col("_dk"))
    unique_rows = df.join(dup_keys, on, "left_anti")
    repeated = (df.join(dup_keys, on, "left_semi").groupBy(key)
                .agg(F.min_by(packed, order).alias("_row")).select("_row.*"))
    return unique_rows.unionByName(repeated)


def coerce_dates(df: DataFrame) -> DataFrame:
    """``admit_date`` / ``discharge_date`` to DATE when present."""
    for c in ("admit_date", "discharge_date"):
        if c in df.columns:
            df = df.withColumn(c, F.to_date(F.col(c)))
    return df


def drop_null_label(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Drop rows whose label is NULL (only when the label column exists).

    The dropped count is reported through ``observation`` (no second job); the result then belongs to
    a session of its own (``in_own_session``).
    """
    if LABEL_COLUMN not in df.columns:
        return df
    if observation is not None:
        df = in_own_session(df).observe(observation, F.count_if(F.col(LABEL_COLUMN).isNull()).alias("dropped_rows"),
                                        F.count(F.lit(1)).alias("rows_in"))
    return df.where(F.col(LABEL_COLUMN).isNotNull())


def clean_raw_encounters(df: DataFrame, observation: Observation | None = None,
                         order_by: list[str | Column] | None = None) -> DataFrame:
    """C1 -> P7 -> C2 (dedup first, so a first duplicate with NULL label drops the encounter)."""
    return drop_null_label(coerce_dates(dedup_first(df, "encounter_id", order_by)), observation)


def engineer_features(df: DataFrame, *, keep_ethnicity: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Derived features in the fixed column order.

    ``discharge_date`` goes to position 1 when present; ``ethnicity`` is kept when asked
    and present; the label is kept when present. ``carry`` columns (e.g. request
    envelope ids) are appended unchanged.
    """
    derived = {
        "age_band": fx.age_band("age"),
        "los_bucket": fx.los_bucket("length_of_stay"),
        "comorbidity_score": fx.comorbidity_score("comorbidity_count", "charlson_index"),
        "prior_utilization_rate": fx.prior_utilization_rate("prior_admissions_12mo", "prior_ed_visits_12mo"),
        "polypharmacy_flag": fx.polypharmacy_flag("num_medications"),
    }
    cols = list(FEATURE_COLUMNS)
    if keep_ethnicity and "ethnicity" in df.columns:
        cols.append("ethnicity")
    if LABEL_COLUMN in df.columns:
        cols.append(LABEL_COLUMN)
    if "discharge_date" in df.columns:
        cols.insert(1, "discharge_date")
    cols += [c for c in carry if c not in cols]
    return df.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in cols])


def transform(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Clean, then engineer features with ethnicity."""
    return engineer_features(clean_raw_encounters(df, observation), keep_ethnicity=True)
