"""Models (M1-M6), contributions (F4-F6), scoring (M5, S6, S7) on a planted-signal fixture."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from carelens.operators import contributions as ct
from carelens.operators import evaluate as ev
from carelens.operators import model as md
from carelens.operators import scoring as sc
from carelens.operators.clean import engineer_features
from carelens.sources import io

RAW = ("encounter_id string, age int, sex string, insurance_type string, admission_type string, "
       "discharge_disposition string, length_of_stay int, comorbidity_count int, charlson_index double, "
       "prior_admissions_12mo int, prior_ed_visits_12mo int, num_medications int, bmi double, systolic_bp double, "
       "glucose_level double, creatinine double, ethnicity string, readmitted_30d int")


def planted(spark, n=2000, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        adm, ed = rnd.randint(0, 6), rnd.randint(0, 5)
        ch = round(rnd.uniform(0, 8), 2)
        meds = rnd.randint(0, 12)
        disp = rnd.choice(["Home", "SNF", "Rehab"])
        at = rnd.choice(["Elective", "Emergency", "Urgent"])
        age = rnd.randint(1, 99)
        # planted signal of the tests' own: mostly prior admissions and disposition
        p = 1 / (1 + math.exp(-(0.7 * adm + 0.35 * ed - 3.4 + (1.1 if disp == "SNF" else 0.0) + 0.04 * meds)))
        y = int(rnd.random() < p)
        rows.append((f"E{i}", age, rnd.choice("MFU"), rnd.choice(["A", "B"]), at, disp, rnd.randint(0, 14),
                     rnd.randint(0, 8), ch, adm, ed, meds, 25.0, 120.0, 100.0, 1.0, rnd.choice(["X", "Y"]), y))
    return engineer_features(spark.createDataFrame(rows, RAW))


@pytest.fixture(scope="module")
def data(spark):
    df = planted(spark)
    train = df.where(F.col("encounter_id").substr(2, 10).cast("int") < 1400)
    val = df.where(F.col("encounter_id").substr(2, 10).cast("int").between(1400, 1699))
    test = df.where(F.col("encounter_id").substr(2, 10).cast("int") >= 1700)
    return train, val, test


def test_logreg_auc_and_contributions(spark, data):
    train, val, test = data
    m = md.train_model(train, None, md.TrainSpec("logreg", {"maxIter": 50}))
    scored = md.predict_proba(m, test).select(F.col("readmitted_30d").alias("y_true"), "y_prob")
    assert ev.roc_auc(scored).first()["roc_auc"] > 0.7
    c = ct.linear_contributions(m, test, train)
    r = c.select("margin", "base_value", F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x["value"]).alias("s")).collect()
    assert all(abs(x.base_value + x.s - x.margin) < 1e-9 for x in r)
    imp = ct.global_importance(c).collect()
    assert len(imp) == 20 and [x.mean_abs_contribution for x in imp] == sorted([x.mean_abs_contribution for x in imp], reverse=True)


def test_gbt_early_stop_and_search(spark, data):
    train, val, test = data
    m = md.train_model(train, val, md.TrainSpec("gbt", {"maxIter": 10, "maxDepth": 3}))
    scored = md.predict_proba(m, test).select(F.col("readmitted_30d").alias("y_true"), "y_prob")
    assert ev.roc_auc(scored).first()["roc_auc"] > 0.65
    space = md.SearchSpace(choice={"maxDepth": [2, 3], "maxIter": [4, 5]}, loguniform={"stepSize": (-3, -1)})
    best, metrics = md.search(train, val, trials=2, concurrency=2, space=space)
    assert metrics.count() == 2 and best is not None


def test_top_factors_order(spark):
    df = spark.createDataFrame([([0.5, -0.9, 0.1, 0.3, -0.2],)], "v array<double>")
    arr = F.transform("v", lambda x, i: F.struct(F.concat(F.lit("f"), i.cast("string")).alias("feature"), x.alias("value")))
    got = df.select(ct.top_factors(arr, 3).alias("t")).first().t
    assert [x.feature for x in got] == ["f1", "f0", "f3"] and got[0].shap_value == -0.9


def test_scoring_roundtrip(spark, data, tmp_path):
    train, _, _ = data
    m = md.train_model(train, None, md.TrainSpec("logreg", {"maxIter": 20}))
    rec = {"encounter_id": "ENC-9", "age": 70, "sex": "F", "insurance_type": "A", "admission_type": "Emergency",
           "discharge_disposition": "SNF", "length_of_stay": 5, "comorbidity_count": 2, "charlson_index": 3.0,
           "prior_admissions_12mo": 4, "prior_ed_visits_12mo": 2, "num_medications": 9, "bmi": 27.0,
           "systolic_bp": 130.0, "glucose_level": 110.0, "creatinine": 1.1}
    (tmp_path / "single.json").write_text(json.dumps(rec))
    (tmp_path / "batch.json").write_text(json.dumps({"data": [rec, dict(rec, encounter_id="ENC-10")]}))
    reqs = io.read_requests(spark, str(tmp_path / "*.json"))
    assert reqs.count() == 3
    resp = sc.score(m, reqs, "v1", explain=True, reference=train)
    rows = resp.collect()
    assert {r.encounter_id for r in rows} == {"ENC-9", "ENC-10"}
    assert all(0 <= r.readmission_probability <= 1 and len(r.top_factors) == 3 for r in rows)
    docs = [json.loads(r.json) for r in io.responses_as_json(resp).collect()]
    assert sorted(len(d["results"]) if "results" in d else 1 for d in docs) == [1, 2]


def test_requests_are_checked_before_scoring(spark, tmp_path):
    rec = {"encounter_id": "ENC-9", "age": 70, "sex": "F", "insurance_type": "A", "admission_type": "Emergency",
           "discharge_disposition": "SNF", "length_of_stay": 5, "comorbidity_count": 2, "charlson_index": 3.0,
           "prior_admissions_12mo": 4, "prior_ed_visits_12mo": 2, "num_medications": 9, "bmi": 27.0,
           "systolic_bp": 130.0, "glucose_level": 110.0, "creatinine": 1.1}
    files = {
        "pretty": json.dumps(rec, indent=2), "pretty_batch": json.dumps({"data": [rec, rec]}, indent=1),
        "lines": json.dumps(rec) + "\n\n" + json.dumps(dict(rec, age=150, sex="X")) + "\nno json\n",
        "empty_batch": json.dumps({"data": []}), "large": json.dumps({"data": [rec] * 101}),
        "one_bad": json.dumps({"data": [rec, dict(rec, bmi=None)]}), "array": json.dumps([rec]), "null_data": json.dumps({"data": None}),
    }
    for name, text in files.items():
        (tmp_path / f"{name}.json").write_text(text)
    reqs = io.read_requests(spark, str(tmp_path / "*.json")).cache()
    good, bad = io.split_requests(reqs)
    assert good.groupBy("is_batch").count().orderBy("is_batch").collect() == [(False, 2), (True, 2)]
    assert good.where("encounter_id = 'ENC-9' AND age = 70").count() == 4
    errors = sorted(r.envelope_error for r in bad.where("envelope_error IS NOT NULL").collect())
    assert errors == ["101 records; at most 100 per batch", "no records in 'data'", "no records in 'data'", "not a JSON object", "not a JSON object"]
    assert sorted(tuple(r.failures) for r in bad.where("envelope_error IS NULL").collect()) == [
        (), ("open:bmi",), ("range:age", "in:sex")]


def test_missing_numbers_and_many_categories(spark, data):
    train, val, _ = data
    holes = train.withColumn("bmi", F.when(F.col("encounter_id").endswith("3"), F.lit(None).cast("double")).otherwise(F.col("bmi")))
    wide = holes.withColumn("insurance_type", F.concat(F.lit("plan"), (F.hash("encounter_id") % 40).cast("string")))
    for spec in (md.TrainSpec("logreg", {"maxIter": 10}), md.TrainSpec("gbt", {"maxIter": 3, "maxDepth": 3})):
        m = md.train_model(wide, None, spec)
        p = md.predict_proba(m, wide.withColumn("glucose_level", F.lit(None).cast("double")))
        assert p.where(F.col("y_prob").isNull() | F.isnan("y_prob")).count() == 0


def test_registry_gate(spark, data, tmp_path):
    train, _, _ = data
    m = md.train_model(train, None, md.TrainSpec("logreg", {"maxIter": 5}))
    metrics = spark.createDataFrame([(0.8, 0.5, 0.1)], "roc_auc double, pr_auc double, brier_score double")
    ok = spark.createDataFrame([], "check string, value double, reason string")
    v = sc.register(spark, m, str(tmp_path / "models"), str(tmp_path / "registry"), "readmit", metrics, ok,
                    {"git_sha": "abc"})
    assert v == 1
    assert sc.register(spark, m, str(tmp_path / "models"), str(tmp_path / "registry"), "readmit", metrics, ok) == 2
    models = tmp_path / "models" / "other" / "v1"
    models.mkdir(parents=True)
    (models / "keep").write_text("x")
    with pytest.raises(Exception, match="already exists|exists"):  # a version that is there is never overwritten
        sc.register(spark, m, str(tmp_path / "models"), str(tmp_path / "registry"), "other", metrics, ok)
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):  # a registry that cannot be read is no empty registry
        sc.register(spark, m, str(tmp_path / "models"), str(tmp_path / "broken"), "third", metrics, ok)
    assert not (tmp_path / "models" / "third").exists()
    bad = spark.createDataFrame([("roc_auc", 0.6, "roc_auc is 0.6; the minimum is 0.7")], "check string, value double, reason string")
    with pytest.raises(sc.PromotionGateError):
        sc.register(spark, m, str(tmp_path / "models"), str(tmp_path / "registry"), "readmit", metrics, bad)


def test_io_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    for suffix in (".csv", ".parquet", ".json"):
        info = io.write_table(df, str(tmp_path / f"t{suffix}"))
        assert info["rows"] == 1
        assert io.read_table(spark, str(tmp_path / f"t{suffix}")).count() == 1
    with pytest.raises(ValueError):
        io.read_table(spark, str(tmp_path / "t.txt"))
    assert io.lake_path("https://exampleaccount.dfs.core.windows.net", "curated", "features", "v1") == \
        "abfss://curated@exampleaccount.dfs.core.windows.net/features/v1"
    assert io.lake_path("https://exampleaccount.dfs.core.windows.net", "raw") == "abfss://raw@exampleaccount.dfs.core.windows.net"


def test_compiled_linear_matches_spark_ml(spark, data):
    train, _, test = data
    m = md.train_model(train, None, md.TrainSpec("logreg", {"maxIter": 30}))
    odd = test.withColumn("insurance_type", F.when(F.col("encounter_id") == "E1700", "NEVER-SEEN")
                          .otherwise(F.col("insurance_type")))
    ml = {r.encounter_id: r.y_prob for r in md.predict_proba(md.summary_free(m, spark), odd, compiled=False).collect()}
    c = ct.linear_contributions(m, odd, train).select("encounter_id", (1 / (1 + F.exp(-F.col("margin")))).alias("p"))
    got = {r.encounter_id: r.p for r in c.collect()}
    assert got.keys() == ml.keys() and all(abs(got[k] - ml[k]) < 1e-12 for k in ml)


def test_scorer_matches_score(spark, data):
    from carelens.operators.contributions import contribution_means
    train, _, test = data
    m = md.train_model(train, None, md.TrainSpec("logreg", {"maxIter": 20}))
    means = contribution_means(m, train)
    req = test.drop("readmitted_30d", "ethnicity")
    a = {(r.encounter_id, r.readmission_probability, r.risk_tier, tuple(r.top_factors))
         for r in sc.score(m, req, "v1", means=means).collect()}
    b = {(r.encounter_id, r.readmission_probability, r.risk_tier, tuple(r.top_factors))
         for r in sc.Scorer(m, "v1", means).score(req).collect()}
    assert a == b and len(a) == 300


def test_score_equations_vanish_at_the_optimum_only(spark, data):
    from carelens.operators.split import with_class_weight

    train, _, _ = data
    weighted = with_class_weight(train)
    for reg in (0.0, 0.05):
        m = md.train_model(train, None, md.TrainSpec("logreg", {"maxIter": 500, "regParam": reg, "tol": 1e-12}))
        eq = ct.score_equations(m, weighted, reg_param=reg, weight="weight").collect()
        assert len(eq) == len(ct.compile_linear(m).slots) + 1 and max(abs(r.equation) for r in eq) < 5e-5
    early = md.train_model(train, None, md.TrainSpec("logreg", {"maxIter": 2, "regParam": 0.05}))
    assert max(abs(r.equation) for r in ct.score_equations(early, weighted, reg_param=0.05, weight="weight").collect()) > 1e-3
    off = ct.score_equations(m, weighted, reg_param=0.5, weight="weight")  # another penalty than that of the fit
    assert max(abs(r.equation) for r in off.collect()) > 1e-2
    assert ct.score_equations(m, weighted.where("false"), weight="weight").count() == 0


def test_halving_search_ranks_its_written_scores(spark, data, tmp_path):
    import duckdb

    train, val, _ = data
    space = md.SearchSpace(choice={"maxIter": [9, 18]}, loguniform={"regParam": (-9, 2)})
    found = md.halving_search(train, val, trials=9, eta=3, rungs=3, space=space, algorithm="logreg")
    trials = {r.trial: r for r in found.trials.collect()}
    assert sorted(r.rung for r in trials.values()) == [0] * 6 + [1] * 2 + [2]
    assert sorted(r["rank"] for r in trials.values()) == list(range(1, 10))
    for r in trials.values():
        full = 9 if "('maxIter', 9)" in r.params else 18
        assert r.budget == max(1, round(full / 3 ** (2 - r.rung)))
    found.scores.write.parquet(str(tmp_path / "scores"))
    sql = f"""
    WITH s AS (SELECT * FROM '{tmp_path}/scores/*.parquet'),
    c AS (SELECT trial, rung, y_prob, count_if(y_true = 1) AS pos, count(*) AS n FROM s GROUP BY ALL),
    k AS (SELECT *, sum(pos) OVER w AS tp, sum(n) OVER w AS above, sum(pos) OVER (PARTITION BY trial) AS p FROM c
          WINDOW w AS (PARTITION BY trial ORDER BY y_prob DESC)),
    a AS (SELECT trial, rung, sum(pos / p * tp / above) AS ap FROM k GROUP BY ALL)
    SELECT trial, ap, row_number() OVER (ORDER BY rung DESC, round(ap, 12) DESC, trial) FROM a"""
    for trial, ap, rank in duckdb.connect().execute(sql).fetchall():
        assert trials[trial]["rank"] == rank and trials[trial].pr_auc == pytest.approx(ap, abs=1e-12)
    best = min(trials.values(), key=lambda r: r["rank"])
    scored = md.predict_proba(found.model, val).select(F.col("readmitted_30d").alias("y_true"), "y_prob")
    assert ev.average_precision(scored).first()["average_precision"] == pytest.approx(best.pr_auc, abs=1e-9)


def test_concurrent_registrations_get_versions_of_their_own(spark, data, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    train, _, _ = data
    m = md.train_model(train, None, md.TrainSpec("logreg", {"maxIter": 3}))
    metrics = spark.createDataFrame([(0.8, 0.5, 0.1)], "roc_auc double, pr_auc double, brier_score double")
    ok = spark.createDataFrame([], "check string, value double, reason string")
    root, registry = str(tmp_path / "models"), str(tmp_path / "registry")
    with ThreadPoolExecutor(max_workers=8) as pool:
        got = list(pool.map(lambda i: sc.register(spark, m, root, registry, "risk/model a", metrics, ok, {"git_sha": f"c{i}"}), range(8)))
    assert sorted(got) == list(range(1, 9))
    rows = sc.read_registry(spark, registry).collect()
    assert sorted(r.version for r in rows) == list(range(1, 9)) and {r.git_sha for r in rows} == {f"c{i}" for i in range(8)}
    assert all((tmp_path / "models" / "risk/model a" / f"v{r.version}").is_dir() for r in rows)
    assert sc.claim_version(spark, registry, "risk/model a") == 9 and sc.claim_version(spark, registry, "other") == 1


def test_one_of_several_writers_creates_a_file(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from carelens.session import create_if_absent

    with ThreadPoolExecutor(max_workers=8) as pool:
        for i in range(60):
            won = list(pool.map(lambda _, i=i: create_if_absent(spark, str(tmp_path / f"a b/v{i}")), range(8)))
            assert sum(won) == 1 and (tmp_path / f"a b/v{i}").is_file()
    assert not create_if_absent(spark, f"file://{tmp_path}/a b/v0")
