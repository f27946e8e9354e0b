"""Catalog: attribution, models, scoring and the rate limiter (registered into ``catalog``).

``importance`` and ``top_factors`` explain the deterministic score (fixed linear margin), the
``linear_*`` queries a model with declared coefficients, so they have SQL twins. Trained-model
queries (``batch_scores``, ``candidate_comparison``) are rows-only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.functions import features as fx
from carelens.operators import contributions as ct
from carelens.operators import evaluate as ev
from carelens.operators import model as md
from carelens.operators import scoring as sc
from carelens.operators import split as split_ops
from carelens.operators.prefix import with_row_number
from carelens.plans import base
from carelens.plans.catalog import SQL, register
from carelens.plans.oracle import ENC, FEAT, SPLIT, with_ctes
from carelens.schemas import CATEGORICAL_COLUMNS, MODEL_FEATURE_COLUMNS, REQUEST_COLUMNS
from carelens.session import cut_lineage, scratch_path
from carelens.streaming import rate_limit as rl


def _contrib_sql(src: str = "feat") -> str:
    terms = ", ".join(f"CAST('{w!r}' AS DOUBLE) * ({t}) AS t_{f}" for f, w, t in ct.SYNTHETIC_TERMS)
    means = ", ".join(f"avg(t_{f}) AS m_{f}" for f, _, _ in ct.SYNTHETIC_TERMS)
    active = {f for f, _, _ in ct.SYNTHETIC_TERMS}
    items = ", ".join(
        f"{{'k': -abs({'t_' + f + ' - m_' + f if f in active else 'CAST(0.0 AS DOUBLE)'}), 'pos': {i}, 'feature': '{f}', "
        f"'v': {'t_' + f + ' - m_' + f if f in active else 'CAST(0.0 AS DOUBLE)'}}}"
        for i, f in enumerate(MODEL_FEATURE_COLUMNS))
    return f"""
, tt AS (SELECT encounter_id, {terms} FROM {src}),
mm AS (SELECT {means} FROM tt),
cc AS (SELECT encounter_id, list_sort([{items}]) AS c FROM tt CROSS JOIN mm)"""


@register("importance", with_ctes(ENC, FEAT) + _contrib_sql() + """
, lng AS (SELECT unnest(c, recursive := true) FROM cc)
SELECT feature, round(avg(abs(v)), 4) AS mean_abs_contribution FROM lng GROUP BY feature""")
def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean |contribution| per feature of the score's linear margin."""
    return ct.global_importance(ct.synthetic_contributions(base.features(spark, sf_dir)))


@register("top_factors", with_ctes(ENC, FEAT) + _contrib_sql() + """
SELECT encounter_id, c[1].feature AS factor_1, round(c[1].v, 4) AS value_1, c[2].feature AS factor_2,
       round(c[2].v, 4) AS value_2, c[3].feature AS factor_3, round(c[3].v, 4) AS value_3 FROM cc""")
def top_factors_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three largest |contributions| per encounter (stable on ties)."""
    c = ct.synthetic_contributions(base.features(spark, sf_dir))
    t = c.select("encounter_id", ct.top_factors(F.col("contributions"), 3).alias("t"))
    return t.select("encounter_id", *[x for k in range(3) for x in (
        F.col("t")[k]["feature"].alias(f"factor_{k + 1}"), F.col("t")[k]["shap_value"].alias(f"value_{k + 1}"))])


@register("importance_ordered", with_ctes(ENC, FEAT) + _contrib_sql() + """
, lng AS (SELECT unnest(c, recursive := true) FROM cc),
m AS (SELECT feature, min(pos) AS pos, round(avg(abs(v)), 4) AS mean_abs_contribution FROM lng GROUP BY feature)
SELECT row_number() OVER (ORDER BY mean_abs_contribution DESC, pos) AS row_no, feature, mean_abs_contribution FROM m""")
def importance_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: the order of the importance report itself."""
    return with_row_number(importance(spark, sf_dir))


@register("attribution_sample", with_ctes(ENC, FEAT) + """
, samp AS (SELECT * FROM feat ORDER BY md5(encounter_id || '42'), encounter_id LIMIT 1000)""" + _contrib_sql("samp") + """
SELECT encounter_id, c[1].feature AS factor_1, round(c[1].v, 4) AS value_1, c[2].feature AS factor_2,
       round(c[2].v, 4) AS value_2, c[3].feature AS factor_3, round(c[3].v, 4) AS value_3 FROM cc""")
def attribution_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 + F4/F6: the attribution report's seeded sample of 1000 encounters (the sample
    is the feature: explanation cost is bounded), contributions centred on the sample."""
    from carelens.operators.split import sample_rows
    s = sample_rows(base.features(spark, sf_dir), 1000, seed=42)
    c = ct.synthetic_contributions(s)
    t = c.select("encounter_id", ct.top_factors(F.col("contributions"), 3).alias("t"))
    return t.select("encounter_id", *[x for k in range(3) for x in (
        F.col("t")[k]["feature"].alias(f"factor_{k + 1}"), F.col("t")[k]["shap_value"].alias(f"value_{k + 1}"))])


def _splits(spark: SparkSession, sf_dir: str):
    s = base.split_features(spark, sf_dir)
    return s.where("split = 'train'"), s.where("split = 'val'"), s.where("split = 'test'")


@register("batch_scores")
def batch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic model fit on the train split; the test-period
    encounters scored as requests (features without ethnicity), with tier and top factors."""
    train, _, _ = _splits(spark, sf_dir)
    model = md.train_model(train, None, md.TrainSpec("logreg", {"maxIter": 50, "regParam": 0.01}))
    test_ids = base.split_features(spark, sf_dir).where("split = 'test'").select("encounter_id")
    requests = base.encounters(spark, sf_dir).join(test_ids, "encounter_id", "left_semi").select(*REQUEST_COLUMNS)
    return sc.score(model, requests, "v1", explain=True, reference=train)


@register("candidate_comparison")
def candidate_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic vs boosted trees (early stop on the validation split),
    evaluated on the test split; the best by ROC-AUC flagged."""
    from concurrent.futures import ThreadPoolExecutor

    train, val, test = _splits(spark, sf_dir)
    candidates = (("logreg", {"maxIter": 50, "regParam": 0.01}, None), ("gbt", {"maxIter": 20, "maxDepth": 5}, val))
    # candidates train concurrently (driver threads submit independent Spark jobs)
    with ThreadPoolExecutor(max_workers=len(candidates)) as pool:
        models = list(pool.map(lambda c: md.train_model(train, c[2], md.TrainSpec(c[0], c[1])), candidates))
    rows = None
    for (algo, _, _), m in zip(candidates, models):
        scored = md.predict_proba(m, test).select(F.col("readmitted_30d").cast("int").alias("y_true"), "y_prob")
        r = ev.evaluate(scored).withColumn("algorithm", F.lit(algo))
        rows = r if rows is None else rows.unionByName(r)
    return ev.compare_candidates(rows, "algorithm", "roc_auc")


_SEARCH = md.SearchSpace(choice={"maxIter": [27, 54], "elasticNetParam": [0.0, 0.5, 1.0]}, loguniform={"regParam": (-8, -1)})


@register("model_search")
def model_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: nine logistic trials by successive halving over the curated splits (9, 3, 1 trials); the
    metrics are ranked from the written validation scores."""
    train, val, _ = _splits(spark, sf_dir)
    return md.halving_search(train, val, trials=9, eta=3, rungs=3, space=_SEARCH, algorithm="logreg").trials


@register("registry_versions", "SELECT 'readmission risk' AS model_name, v AS version, e.roc_auc, e.n_rows FROM (" + SQL["evaluation"]
          + ") e CROSS JOIN (SELECT CAST(unnest(range(1, 9)) AS INTEGER) AS v) t")
def registry_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: eight registrations at once get eight versions; the registry with the metrics in it."""
    from concurrent.futures import ThreadPoolExecutor

    root = scratch_path(spark, "registrations")
    train, _, _ = _splits(spark, sf_dir)
    model = md.train_model(train, None, md.TrainSpec("logreg", {"maxIter": 1}))
    metrics = cut_lineage(ev.evaluate(base.scored(spark, sf_dir)), "metrics")
    passed = spark.createDataFrame([], "check string, value double, reason string")
    with ThreadPoolExecutor(max_workers=8) as pool:
        list(pool.map(lambda _: sc.register(spark, model, f"{root}/models", f"{root}/registry", "readmission risk", metrics, passed), range(8)))
    row = F.from_json("metrics", "roc_auc double, n_rows bigint")
    return sc.read_registry(spark, f"{root}/registry").select("model_name", "version", row["roc_auc"].alias("roc_auc"), row["n_rows"].alias("n_rows"))


def _score_equations_sql() -> str:
    numeric = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST(NULL AS VARCHAR) AS level" for c in ["(intercept)", *md.NUMERIC_FEATURES])
    levels = " UNION ALL ".join(
        f"SELECT '{c}', {c} FROM tr WHERE {c} IS NOT NULL GROUP BY {c} UNION ALL SELECT '{c}', '{ct.OTHER}' UNION ALL SELECT '{c}', '{ct.NEVER}'"
        for c in CATEGORICAL_COLUMNS)
    return with_ctes(ENC, FEAT, SPLIT) + f"""
, tr AS (SELECT * FROM sfeat WHERE split = 'train'),
slots AS ({numeric} UNION ALL {levels})
SELECT feature, level, CAST(0.0 AS DOUBLE) AS equation FROM slots"""


@register("fit_score_equations", _score_equations_sql())
def fit_score_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weighted ridge-logistic model fit on the train split, and the equations that its
    optimum solves: one per slot, all zero."""
    train, _, _ = _splits(spark, sf_dir)
    model = md.train_model(train, None, md.TrainSpec("logreg", {"maxIter": 200, "regParam": 0.01, "tol": 1e-9}))
    eq = ct.score_equations(model, split_ops.with_class_weight(train), reg_param=0.01, weight="weight")
    return eq.withColumn("equation", F.round("equation", 4) + F.lit(0.0))


def _rate_limit_sql(limit: int) -> str:
    """Recursion along each client's requests, with the list of admitted times as state."""
    return f"""
WITH RECURSIVE e AS (
  SELECT CAST(user_id AS VARCHAR) AS client, CAST(event_id AS VARCHAR) AS request_id, ts, epoch_us(ts) AS us,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, CAST(event_id AS VARCHAR)) AS rn FROM events),
s AS (SELECT client, request_id, ts, us, rn, CAST([] AS BIGINT[]) AS kept, [us] AS after, NULL::BIGINT AS oldest FROM e WHERE rn = 1
  UNION ALL
  SELECT client, request_id, ts, us, rn, kept,
         CASE WHEN len(kept) >= {limit} THEN kept ELSE list_append(kept, us) END, CASE WHEN len(kept) >= {limit} THEN kept[1] END
  FROM (SELECT e.client, e.request_id, e.ts, e.us, e.rn, [x FOR x IN s.after IF x > e.us - 60000000] AS kept
        FROM s JOIN e ON e.client = s.client AND e.rn = s.rn + 1))
SELECT client, request_id, ts AS "timestamp", oldest IS NULL AS admitted,
  CAST(greatest(1, (60000000 - (us - oldest)) // 1000000) AS INTEGER) AS retry_after
FROM (SELECT *, oldest IS NULL AS ok FROM s)""".replace(
        "CAST(greatest(1, (60000000 - (us - oldest)) // 1000000) AS INTEGER)",
        "CASE WHEN oldest IS NOT NULL THEN CAST(greatest(1, (60000000 - (us - oldest)) // 1000000) AS INTEGER) END")


def _request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev_ = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return ev_.select(F.col("user_id").cast("string").alias("client"), F.col("event_id").cast("string").alias("request_id"),
                      F.col("ts").cast("timestamp").alias("timestamp"))


@register("rate_limit", _rate_limit_sql(60))
def rate_limit_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 batch twin: 60 requests/minute per client over the whole request log."""
    return rl.rate_limit(_request_log(spark, sf_dir), limit=60).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@register("rate_limit_tight", _rate_limit_sql(1))
def rate_limit_tight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 with one request per minute, which rejects rows of this log."""
    return rl.rate_limit(_request_log(spark, sf_dir), limit=1).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


# ---------------------------------------------------------------- declared linear models

LINEAR = {  # a model with declared coefficients: name -> (intercept, numeric, categorical values)
    "a": (-2.1, {"prior_admissions_12mo": 0.31, "charlson_index": 0.07, "length_of_stay": 0.04, "creatinine": -0.11},
          {"admission_type": {"Emergency": 0.42, "Urgent": 0.17}, "sex": {"F": -0.08, "M": 0.05}}),
    "b": (-1.4, {"num_medications": 0.05, "glucose_level": 0.002}, {"los_bucket": {"0-2": -0.3, "6-10": 0.2}}),
    "c": (-2.0, {"age": 0.004, "comorbidity_score": 0.12, "bmi": -0.01}, {"insurance_type": {"ASIA": 0.1}}),
}
# NULL numbers (bmi in every 40th row here) take a declared imputation value.
FILL = 30.0


# What the contributions of model "a" are centred on: one number per slot, in their order.
LINEAR_MEANS = [1.5, 2.0, 4.0, 1.9, 0.4, 0.2, 0.5, 0.5]


def _linear(name: str) -> ct.CompiledLinear:
    intercept, numeric, categories = LINEAR[name]
    slots = [(c, F.coalesce(F.col(c).cast("double"), F.lit(FILL))) for c in numeric]
    slots += [(c, F.coalesce(F.col(c) == F.lit(v), F.lit(False)).cast("double")) for c, vs in categories.items() for v in vs]
    return ct.CompiledLinear(slots, [*numeric.values(), *[w for vs in categories.values() for w in vs.values()]], intercept)


def _linear_terms_sql(name: str) -> list[tuple[str, str, float]]:
    _, numeric, categories = LINEAR[name]
    terms = [(c, f"coalesce(CAST({c} AS DOUBLE), CAST({FILL} AS DOUBLE))", w) for c, w in numeric.items()]
    return terms + [(c, f"CAST(coalesce({c} = '{v}', false) AS DOUBLE)", w) for c, vs in categories.items() for v, w in vs.items()]


def _margin_sql(name: str) -> str:
    parts = [f"CAST('{LINEAR[name][0]!r}' AS DOUBLE)", *[f"CAST('{w!r}' AS DOUBLE) * {x}" for _, x, w in _linear_terms_sql(name)]]
    return "(" + " + ".join(parts) + ")"


def _prob_sql(name: str) -> str:
    return f"(CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + exp(-{_margin_sql(name)})))"


HOLES = """
h AS (SELECT * REPLACE (CASE WHEN CAST(encounter_id AS BIGINT) % 40 = 0 THEN NULL ELSE bmi END AS bmi) FROM feat)"""


def _with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.features(spark, sf_dir).withColumn("bmi", F.when(F.col("encounter_id").cast("bigint") % 40 != 0, F.col("bmi")))


def _requests_with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encounters with a label as scoring requests, some without a bmi."""
    e = base.encounters(spark, sf_dir).where(F.col("readmitted_30d").isNotNull()).select(*REQUEST_COLUMNS)
    return e.withColumn("bmi", F.when(F.col("encounter_id").cast("bigint") % 40 != 0, F.col("bmi")))


def _probability(name: str):
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_linear(name).margin()))


@register("linear_scores", with_ctes(ENC, FEAT, HOLES) + f"""
, p AS (SELECT encounter_id, {_prob_sql('a')} AS p FROM h)
SELECT encounter_id, round(p, 4) AS readmission_probability,
  CASE WHEN p < 0.20 THEN 'low' WHEN p <= 0.50 THEN 'medium' ELSE 'high' END AS risk_tier FROM p""")
def linear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests through the scorer with declared coefficients (response without id
    and time), once with factors and once without."""
    requests = _requests_with_holes(spark, sf_dir)
    with_factors = sc.score(_linear("a"), requests.where("age % 2 = 0"), "declared", means=LINEAR_MEANS)
    plain = sc.score(_linear("a"), requests.where("age % 2 = 1"), "declared", explain=False)
    return with_factors.unionByName(plain).select("encounter_id", "readmission_probability", "risk_tier")


def _linear_factors_sql() -> str:
    terms = _linear_terms_sql("a")
    by: dict[str, list[str]] = {}
    for i, (c, _, w) in enumerate(terms):
        by.setdefault(c, []).append(f"CAST('{w!r}' AS DOUBLE) * (x{i} - m{i})")
    items = ", ".join(f"{{'k': -abs({' + '.join(v)}), 'pos': {MODEL_FEATURE_COLUMNS.index(c)}, 'feature': '{c}', 'v': {' + '.join(v)}}}" for c, v in by.items())
    return with_ctes(ENC, FEAT, HOLES) + f"""
, x AS (SELECT encounter_id, {', '.join(f'{x} AS x{i}' for i, (_, x, _) in enumerate(terms))} FROM h),
m AS (SELECT {', '.join(f'avg(x{i}) AS m{i}' for i in range(len(terms)))} FROM x),
c AS (SELECT encounter_id, list_sort([{items}]) AS c FROM x CROSS JOIN m)
SELECT encounter_id, c[1].feature AS factor_1, round(c[1].v, 4) AS value_1, c[2].feature AS factor_2,
       round(c[2].v, 4) AS value_2, c[3].feature AS factor_3, round(c[3].v, 4) AS value_3 FROM c"""


@register("linear_factors", _linear_factors_sql())
def linear_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """top factors of the declared model, centred on the table's means."""
    h, cl = _with_holes(spark, sf_dir), _linear("a")
    row = h.agg(*[F.avg(x).alias(f"m{i}") for i, (_, x) in enumerate(cl.slots)]).first()
    c = h.select("encounter_id", ct.centred(cl, list(row)).alias("contributions"))
    t = c.select("encounter_id", ct.top_factors(F.col("contributions"), 3).alias("t"))
    return t.select("encounter_id", *[x for k in range(3) for x in (
        F.col("t")[k]["feature"].alias(f"factor_{k + 1}"), F.col("t")[k]["shap_value"].alias(f"value_{k + 1}"))])


def _encoded_sql() -> str:
    codes = ", ".join(f"coalesce((SELECT code FROM codes_{c} v WHERE v.x = h.{c}), (SELECT count(*) FROM codes_{c})) AS {c}" for c in CATEGORICAL_COLUMNS)
    tables = "".join(f", codes_{c} AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS code FROM (SELECT DISTINCT {c} AS x FROM h WHERE {c} IS NOT NULL))" for c in CATEGORICAL_COLUMNS)
    numbers = ", ".join(f"round(coalesce(CAST({c} AS DOUBLE), (SELECT avg(CAST({c} AS DOUBLE)) FROM h)), 6) AS {c}" for c in md.NUMERIC_FEATURES)
    return with_ctes(ENC, FEAT, HOLES) + f"{tables}\nSELECT encounter_id, {codes}, {numbers} FROM h"


@register("encoded_features", _encoded_sql())
def encoded_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: the fitted indexer's codes (alphabetical) of all categorical columns, and the numbers as
    the model gets them (flags as numbers, missing ones imputed)."""
    x = md.model_input(_with_holes(spark, sf_dir))
    stages, _ = md.encoder_stages("gbt")
    for stage in stages:
        x = stage.fit(x).transform(x)
    return x.select("encounter_id", *[F.col(f"{c}__idx").cast("bigint").alias(c) for c in CATEGORICAL_COLUMNS],
                    *[F.round(f"{c}__imp", 6).alias(c) for c in md.NUMERIC_FEATURES])


@register("class_weight", with_ctes(ENC, FEAT) + """
SELECT CAST(count_if(readmitted_30d = 0) AS DOUBLE) / greatest(count_if(readmitted_30d = 1), 1) AS class_weight FROM feat""")
def class_weight_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives per positive."""
    return split_ops.class_weight(base.features(spark, sf_dir))


def _ranking_sql() -> str:
    rows = " UNION ALL ".join(f"SELECT '{n}' AS algorithm, readmitted_30d AS y, round({_prob_sql(n)}, 4) AS p FROM h" for n in LINEAR)
    return with_ctes(ENC, FEAT, HOLES) + f"""
, s AS ({rows}),
c AS (SELECT algorithm, p, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM s GROUP BY 1, 2),
k AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY algorithm ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c),
a AS (SELECT algorithm, round(sum(pos * (below + CAST(0.5 AS DOUBLE) * neg)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 4) AS roc_auc FROM k GROUP BY 1),
b AS (SELECT algorithm, round(avg(pow(p - y, 2)), 4) AS brier_score FROM s GROUP BY 1)
SELECT algorithm, roc_auc, brier_score, algorithm = (SELECT arg_max(algorithm, roc_auc) FROM a) AS is_best FROM a JOIN b USING (algorithm)"""


@register("candidate_ranking", _ranking_sql())
def candidate_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three declared candidates side by side, the best by ROC-AUC flagged."""
    h = _with_holes(spark, sf_dir)
    rows = None
    for name in LINEAR:
        scored = h.select(F.col("readmitted_30d").cast("int").alias("y_true"), F.round(_probability(name), 4).alias("y_prob"))
        r = ev.evaluate(scored).select(F.lit(name).alias("algorithm"), "roc_auc", "brier_score")
        rows = r if rows is None else rows.unionByName(r)
    return ev.compare_candidates(rows, "algorithm", "roc_auc")
