"""Patient history (J4/J5), splits (C4/C5), as-of join (J7), store (J1/J2): brute force
on small fixtures, including a hot patient holding a third of all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from carelens.operators import asof, split, store
from carelens.operators.history import with_patient_history
from carelens.operators.prefix import with_row_number


def _encounters(seed=0, n=300):
    rnd = random.Random(seed)
    rows = []
    d0 = dt.date(2020, 1, 1)
    for i in range(n):
        p = "HOT" if i % 3 == 0 else f"P{rnd.randint(1, 30)}"
        a = d0 + dt.timedelta(days=rnd.randint(0, 800))
        los = rnd.choice([0, 0, 1, 3, 7])
        rows.append((f"E{i:04d}", p, a, a + dt.timedelta(days=los), rnd.choice(["Emergency", "Elective"])))
    return rows


def _brute(rows, horizon=30, lookback=365):
    end = max(r[2] for r in rows)
    out = {}
    for eid, p, a, d, _ in rows:
        others = [r for r in rows if r[1] == p and r[0] != eid]
        nxt = [r for r in others if d <= r[2] <= d + dt.timedelta(days=horizon)]
        label = 1 if nxt else (None if d + dt.timedelta(days=horizon) > end else 0)
        prior = [r for r in others if a - dt.timedelta(days=lookback) <= r[2] <= a - dt.timedelta(days=1)]
        out[eid] = (label, len(prior), sum(1 for r in prior if r[4] == "Emergency"))
    return out


def test_history_matches_brute_force(spark):
    rows = _encounters()
    df = spark.createDataFrame(rows, "encounter_id string, patient_id string, admit_date date, discharge_date date, "
                                     "admission_type string")
    got = {r.encounter_id: (r.readmitted_30d, r.prior_admissions_12mo, r.prior_ed_visits_12mo)
           for r in with_patient_history(df).collect()}
    assert got == _brute(rows)


def test_temporal_split_sizes_and_order(spark):
    rnd = random.Random(5)
    d0 = dt.date(2021, 1, 1)
    # one hot date with a third of the rows: the boundary falls inside it
    rows = [(f"E{i:04d}", d0 + dt.timedelta(days=(5 if i % 3 == 0 else rnd.randint(0, 20)))) for i in range(600)]
    df = spark.createDataFrame(rows, "encounter_id string, discharge_date date")
    out = split.temporal_split(df, 0.7, 0.15).collect()
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    n = len(rows)
    expect = {}
    for k, r in enumerate(order):
        expect[r[0]] = "train" if k < int(n * 0.7) else "val" if k < int(n * 0.7) + int(n * 0.15) else "test"
    assert {r.encounter_id: r.split for r in out} == expect


def test_row_numbers_over_partitions(spark):
    rows = [(f"K{i:05d}", i % 7) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, g int").repartition(5)
    got = {r.k: r.row_no for r in with_row_number(df.orderBy("g", "k")).collect()}
    assert got == {k: i + 1 for i, (k, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}


def test_patient_split(spark):
    rows = [("E1", "P1", dt.date(2020, 1, 1), "train"), ("E2", "P1", dt.date(2021, 1, 1), "test"),
            ("E3", "P2", dt.date(2021, 2, 1), "val")]
    df = spark.createDataFrame(rows, "encounter_id string, patient_id string, discharge_date date, split string")
    got = {r.encounter_id: r.split for r in split.patient_split(df).collect()}
    assert got == {"E1": "train", "E2": "train", "E3": "val"}


def test_sample_and_class_weight(spark):
    df = spark.createDataFrame([(f"E{i}", i % 4 == 0) for i in range(100)], "encounter_id string, pos boolean") \
        .withColumn("readmitted_30d", F.col("pos").cast("int"))
    s1 = [r[0] for r in split.sample_rows(df, 10).collect()]
    assert len(s1) == 10 and s1 == [r[0] for r in split.sample_rows(df, 10).collect()]
    assert split.class_weight(df).first()[0] == pytest.approx(75 / 25)


def test_asof_join_brute_force(spark):
    rnd = random.Random(9)
    d0 = dt.date(2022, 1, 1)
    left = [(f"E{i}", "HOT" if i % 2 else f"P{i % 5}", d0 + dt.timedelta(days=rnd.randint(0, 60))) for i in range(80)]
    right = [("HOT" if j % 3 else f"P{j % 5}", d0 + dt.timedelta(days=rnd.randint(0, 60)), float(j)) for j in range(200)]
    ldf = spark.createDataFrame(left, "encounter_id string, patient_id string, discharge_date date")
    rdf = spark.createDataFrame(right, "patient_id string, lab_date date, value double")
    got = {r.encounter_id: (r.asof_day, r.asof_value) for r in asof.asof_join(
        ldf, rdf, key="patient_id", left_day="discharge_date", right_day="lab_date", values=["value"],
        tie_break=["value"]).collect()}
    for eid, p, d in left:
        cands = [r for r in right if r[0] == p and r[1] <= d]
        best = max(cands, key=lambda r: (r[1], r[2])) if cands else None
        assert got[eid] == ((best[1], best[2]) if best else (None, None))


def test_asof_join_sorts_the_right_side_in_small_tasks_and_narrow_rows(spark, monkeypatch):
    from carelens.session import ADVISORY, TASK_BYTES

    seen, cut = [], asof.cut_lineage
    monkeypatch.setattr(asof, "cut_lineage", lambda df, name: seen.append((spark.conf.get(ADVISORY), df._jdf.queryExecution().optimizedPlan().toString())) or cut(df, name))
    d = dt.date(2022, 1, 1)
    left = spark.createDataFrame([("E1", "P", d), ("E2", None, d), ("E3", "P", None)], "e string, p string, day date")
    stamp = dt.datetime
    right = spark.createDataFrame(
        [("P", d, stamp(2022, 1, 1, 9), 1, 5.0), ("P", d, stamp(2022, 1, 1, 10), 2, None), ("P", d, None, 9, 7.0), ("Q", d, None, None, 1.0)],
        "p string, day date, at timestamp_ntz, n int, v double")
    before = spark.conf.get(ADVISORY, None)

    def got(values, tie_break, day="day"):
        found = asof.asof_join(left, right, key="p", left_day="day", right_day=day, values=values, tie_break=tie_break)
        return {r.e: tuple(r)[3:] for r in found.collect()}

    assert got(["v"], ["at", "n", "v"]) == {"E1": (d, None), "E2": (None, None), "E3": (None, None)}
    assert "max_by" not in seen[0][1] and seen[0][0] == str(TASK_BYTES)
    assert got(["v"], ["at", "n"]) == {"E1": (d, None), "E2": (None, None), "E3": (None, None)}  # not in the order
    assert got(["v", "n"], ["n", "v"])["E1"] == (d, 7.0, 9)
    assert got(["n"], ["n"], "at")["E1"] == (d, 2)  # a time of day decides first
    assert spark.conf.get(ADVISORY, None) == before


def test_store_lookup_and_missing(spark, tmp_path):
    df = spark.createDataFrame([("E1", 50), ("E2", 60)], "encounter_id string, age int")
    df.write.parquet(str(tmp_path / "fs"))
    fs = store.FeatureStore(spark, str(tmp_path / "fs"))
    assert [r.encounter_id for r in fs.get_online_features(["E2"], columns=["age"]).collect()] == ["E2"]
    with pytest.raises(KeyError, match="1 requested") as ex:
        fs.get_online_features(["E1", "E9"], columns=["age"])


def test_temporal_split_single_hot_date(spark):
    rows = [(f"E{i:04d}", dt.date(2021, 5, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "encounter_id string, discharge_date date")
    got = {r.encounter_id: r.split for r in split.temporal_split(df, 0.7, 0.15).collect()}
    ids = sorted(got)
    assert [got[i] for i in ids] == ["train"] * 350 + ["val"] * 75 + ["test"] * 75


def test_split_puts_null_dates_last(spark):
    rows = [(f"e{i:03d}", None if i < 20 else f"2024-01-{1 + i % 20:02d}") for i in range(100)]
    df = spark.createDataFrame(rows, "encounter_id string, d string").select("encounter_id", F.to_date("d").alias("discharge_date"))
    got = {r["encounter_id"]: r["split"] for r in split.temporal_split(df, 0.70, 0.15).collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or "", r[0]))
    want = {k: "train" if i < 70 else "val" if i < 85 else "test" for i, (k, _) in enumerate(order)}
    assert got == want
    assert split.temporal_split(df.limit(0)).count() == 0


def test_all_missing_ids_are_reported(spark):
    table = spark.createDataFrame([(f"e{i}", 1) for i in range(5)], "encounter_id string, age int")
    wanted = spark.createDataFrame([(f"e{i}",) for i in range(60)], "encounter_id string")
    with pytest.raises(KeyError) as ex:
        store.lookup(table, wanted, columns=["age"], strict=True)
    assert ex.value.n == 55 and [r[0] for r in ex.value.ids().collect()] == sorted(f"e{i}" for i in range(5, 60))


def _expected_sizes(n):
    return {"train": int(n * 0.70), "val": int(n * 0.15), "test": n - int(n * 0.70) - int(n * 0.15)}


def test_split_of_repeated_keys_keeps_every_row(spark):
    rows = [(f"e{i // 2}", dt.date(2024, 1, 1 + i // 4)) for i in range(20)]  # 10 (date, key) pairs, each twice
    df = spark.createDataFrame(rows, "encounter_id string, discharge_date date").repartition(3)
    got = split.temporal_split(df)
    assert {r["split"]: r["count"] for r in got.groupBy("split").count().collect()} == {"train": 14, "val": 3, "test": 3}
    assert sorted((r.encounter_id, r.discharge_date) for r in got.collect()) == sorted(rows)


@pytest.mark.parametrize("seed", range(6))
def test_slices_of_any_rows_equal_a_sorted_list(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, "a", "b", "c"]), rnd.choice([None, *[dt.date(2024, 1, 1 + d) for d in range(3)]]), rnd.choice([None, 1, 2]), {"k": rnd.choice(["x", "y"])})
            for _ in range(rnd.choice([0, 1, 7, 60]))]
    df = spark.createDataFrame(rows, "encounter_id string, discharge_date date, v int, m map<string,string>").repartition(4)
    got = split.temporal_split(df).collect()
    assert sorted(map(repr, ((r.encounter_id, r.discharge_date, r.v, r.m) for r in got))) == sorted(map(repr, rows))
    order = lambda r: (r[1] is None, r[1] or dt.date.min, r[0] is None, r[0] or "")
    want, at = {}, sorted(rows, key=order)
    train, val = int(len(rows) * 0.70), int(len(rows) * 0.15)
    for i, r in enumerate(at):
        name = "train" if i < train else "val" if i < train + val else "test"
        want[order(r), name] = want.get((order(r), name), 0) + 1
    found = {}
    for r in got:
        k = order((r.encounter_id, r.discharge_date)), r.split
        found[k] = found.get(k, 0) + 1
    assert found == want


def test_one_row_repeated_many_times_is_split_by_count(spark):
    df = spark.range(1000).selectExpr("'e' encounter_id", "date'2024-01-01' discharge_date", "1 v").repartition(5)
    got = {r["split"]: r["count"] for r in split.temporal_split(df).groupBy("split").count().collect()}
    assert got == _expected_sizes(1000)


def test_split_never_shuffles_the_rows(spark):
    df = spark.createDataFrame([(f"e{i}", dt.date(2024, 1, 1 + i % 9), i) for i in range(90)], "encounter_id string, discharge_date date, wide int")
    plan = split.temporal_split(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_history_keeps_repeated_and_missing_ids(spark):
    d = dt.date
    rows = [("e1", "p", d(2024, 1, 1), d(2024, 1, 3), "Emergency"), ("e1", "p", d(2024, 1, 1), d(2024, 1, 3), "Emergency"),
            ("e2", "p", d(2024, 1, 10), None, "Elective"), (None, "p", d(2024, 1, 20), d(2024, 1, 20), "Emergency"),
            ("e3", None, d(2024, 1, 5), d(2024, 1, 6), "Emergency"), ("e4", "q", d(2024, 6, 1), d(2024, 6, 2), "Elective")]
    df = spark.createDataFrame(rows, "encounter_id string, patient_id string, admit_date date, discharge_date date, admission_type string")
    for spread in ((), ("encounter_id",)):
        out = with_patient_history(df, spread=spread)
        got = sorted([(r.encounter_id or "", r.patient_id or "", r.readmitted_30d, r.prior_admissions_12mo, r.prior_ed_visits_12mo) for r in out.collect()], key=repr)
        # each e1 row meets the other's admission only before its own discharge; e2's window is open
        assert got == sorted([("e1", "p", 1, 0, 0), ("e1", "p", 1, 0, 0), ("e2", "p", None, 2, 2), ("", "p", 0, 3, 2), ("e3", "", 0, 0, 0), ("e4", "q", None, 0, 0)], key=repr)
        assert out.columns[:5] == df.columns


def test_attach_keys_tell_values_apart(spark):
    df = spark.createDataFrame([("1", "2:3"), ("1:2", "3"), (None, "-"), ("-", None), ("", ""), (None, None), ("12", ""), ("1", "2")], "a string, b string")
    from carelens.operators.history import attach_key

    assert df.select(attach_key("a", "b")).distinct().count() == 8
