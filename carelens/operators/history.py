"""Per-patient history: look-ahead readmission label (J4) and prior use counts.

Both are range conditions over the same patient's other encounters. A window
partitioned by patient over raw encounters would put a hot patient (say a third of all
rows) into one task, so the windows run over a per-(patient, day) pre-aggregate instead:
a patient contributes at most one row per calendar day, whatever the data volume. The
pre-aggregate is built with a map-side partial aggregation.

The lookups run on narrow rows (key, patient, admission, discharge); what they find is
attached to the wide rows by one join on a single key, which encodes the identifying
columns without loss (``attach_key``), so repeated or NULL ids neither multiply nor lose
rows. Wide rows from a table that is bucketed by that key (``session.materialize_bucketed``)
are not shuffled for it; others are shuffled once. A key that holds the encounter id is
spread evenly whatever the patients are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelens.session import cut_lineage


def daily_history(enc: DataFrame, *, patient: str, admit: str, discharge: str, emergency: Column,
                  lookback_days: int = 365, horizon_days: int = 30) -> DataFrame:
    """One row per (patient, day) that is an admission or a discharge day.

    Columns: patient, ``day``, ``prior_adm`` / ``prior_ed`` (admissions / emergency
    admissions in [day - lookback, day - 1]) and ``fwd_adm`` (admissions in
    [day, day + horizon]).
    """
    base = enc.select(F.col(patient).alias("_p"), F.col(admit).alias("_a"), F.col(discharge).alias("_d"),
                      emergency.cast("int").alias("_em"))
    admissions = base.select("_p", F.col("_a").alias("day"), F.lit(1).alias("n_adm"),
                             F.coalesce(F.col("_em"), F.lit(0)).alias("n_ed"))
    discharges = base.where(F.col("_d").isNotNull()).select(
        "_p", F.col("_d").alias("day"), F.lit(0).alias("n_adm"), F.lit(0).alias("n_ed"))
    daily = (admissions.unionByName(discharges)
             .groupBy("_p", "day")
             .agg(F.sum("n_adm").alias("n_adm"), F.sum("n_ed").alias("n_ed")))
    w = Window.partitionBy("_p").orderBy(F.unix_date("day"))
    back = w.rangeBetween(-lookback_days, -1)
    fwd = w.rangeBetween(0, horizon_days)
    return daily.select(
        F.col("_p").alias(patient), "day",
        F.coalesce(F.sum("n_adm").over(back), F.lit(0)).cast("int").alias("prior_adm"),
        F.coalesce(F.sum("n_ed").over(back), F.lit(0)).cast("int").alias("prior_ed"),
        F.coalesce(F.sum("n_adm").over(fwd), F.lit(0)).cast("int").alias("fwd_adm"),
    )


ATTACH = "_attach"


def attach_key(*columns: str) -> Column:
    """One string that tells any two different combinations of the columns apart, NULLs included."""
    def part(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.concat(*[part(c) for c in columns])


def history_lookups(enc: DataFrame, *, patient: str = "patient_id", admit: str = "admit_date",
                    discharge: str = "discharge_date", emergency: Column | None = None,
                    follow_up_end: Column | None = None, lookback_days: int = 365, horizon_days: int = 30,
                    label: str = "readmitted_30d", prior_adm: str = "prior_admissions_12mo",
                    prior_ed: str = "prior_ed_visits_12mo", materialize_daily: bool = True) -> DataFrame:
    """One narrow row per ``_attach`` key of ``enc`` (which encodes patient, admission and discharge
    at least): the key, the patient, the label and the prior-use counts."""
    if emergency is None:
        emergency = F.col("admission_type") == "Emergency"
    hist = daily_history(enc, patient=patient, admit=admit, discharge=discharge, emergency=emergency,
                         lookback_days=lookback_days, horizon_days=horizon_days)
    if materialize_daily:
        # both lookups read one written copy (at most two narrow rows per encounter);
        # otherwise column pruning splits the window into two evaluations
        hist = cut_lineage(hist, "daily-history")
    prior = hist.select(F.col(patient).alias("_hp"), F.col("day").alias("_ha"),
                        F.col("prior_adm").alias(prior_adm), F.col("prior_ed").alias(prior_ed))
    ahead = hist.select(F.col(patient).alias("_fp"), F.col("day").alias("_fd"), F.col("fwd_adm").alias("_fwd"))
    rows = enc.select(ATTACH, patient, admit, discharge).dropDuplicates([ATTACH])
    if follow_up_end is None:
        # One-row global aggregate: a bounded broadcast side.
        end = enc.agg(F.max(admit).alias("_end"))
        rows = rows.crossJoin(F.broadcast(end))
        follow_up_end = F.col("_end")
    out = (rows
           .join(prior, (F.col(patient) == F.col("_hp")) & (F.col(admit) == F.col("_ha")), "left")
           .join(ahead, (F.col(patient) == F.col("_fp")) & (F.col(discharge) == F.col("_fd")), "left"))
    # The encounter's own admission lies in its look-ahead range only when it is
    # discharged on the admission day.
    others = F.coalesce(F.col("_fwd"), F.lit(0)) - (F.col(admit) == F.col(discharge)).cast("int")
    lbl = (F.when(others > 0, F.lit(1))
           .when(F.date_add(F.col(discharge), horizon_days) > follow_up_end, F.lit(None))
           .when(F.col(discharge).isNotNull(), F.lit(0))).cast("int")
    return out.select(F.col(ATTACH), F.col(patient), lbl.alias(label), F.coalesce(F.col(prior_adm), F.lit(0)).alias(prior_adm),
                      F.coalesce(F.col(prior_ed), F.lit(0)).alias(prior_ed))


def with_patient_history(enc: DataFrame, *, patient: str = "patient_id", admit: str = "admit_date",
                         discharge: str = "discharge_date", spread: tuple[str, ...] = (), **options) -> DataFrame:
    """Add the look-ahead label and the prior-use counts to ``enc``.

    label = 1 when another encounter of the patient is admitted within
    [discharge, discharge + horizon]; NULL when the follow-up window runs past
    ``follow_up_end`` (default: last admission in ``enc``); else 0. A NULL patient has no
    history. ``spread``: further columns (an id) in the key of the one join that attaches them.
    Options as in ``history_lookups``.
    """
    keyed = enc.withColumn(ATTACH, attach_key(patient, admit, discharge, *spread))
    found = history_lookups(keyed, patient=patient, admit=admit, discharge=discharge, **options).drop(patient)
    return keyed.join(found, ATTACH, "left").drop(ATTACH)
