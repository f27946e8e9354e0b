"""Batch scoring (M5, P18) and the model registry (M6).

Scoring is one lazy plan: request rows (S6) -> features without ethnicity (P6) ->
model (M4) -> risk tier on the unrounded probability (P10) -> top factors (F6) ->
response columns (P18). The same function runs on a stream (``foreachBatch`` or
directly, see ``streaming.scoring``); there is no per-row loop.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.functions import features as fx
from carelens.functions.features import risk_tier
from carelens.operators.clean import FEATURE_COLUMNS, engineer_features
from carelens.operators.contributions import centred, compile_linear, contribution_means, top_factors
from carelens.operators.model import predict_proba
from carelens.schemas import TOP_FACTOR_TYPE
from carelens.session import create_if_absent, is_folder
from carelens.sources.io import split_requests

ENVELOPE = ("request_id", "is_batch", "item", "envelope_error")


def score(model: PipelineModel, requests: DataFrame, model_version: str, explain: bool = True,
          reference: DataFrame | None = None, means: list[float] | None = None) -> DataFrame:
    """M5: one response row per request record.

    ``explain`` adds linear top factors (the last stage must be linear). The contributions
    are centred on ``means`` (fitted once, see ``contributions.contribution_means``), else on
    the feature means of ``reference``, else of the batch itself. Requests that carry the
    checks of ``io.read_requests`` are scored only if they are accepted.
    """
    if {"envelope_error", "failures"} <= set(requests.columns):
        requests = split_requests(requests)[0]
    req = requests if "ethnicity" in requests.columns else requests.withColumn("ethnicity", F.lit(None).cast("string"))
    if explain:
        if means is None:
            background = reference if reference is not None else req
            means = contribution_means(model, engineer_features(background, keep_ethnicity=False))
        return Scorer(model, model_version, means).score(req)
    carry = tuple(c for c in ENVELOPE if c in req.columns)
    scored = predict_proba(model, engineer_features(req, keep_ethnicity=False, carry=carry))
    item = F.col("item") if "item" in scored.columns else F.lit(0)
    return scored.select(*[F.col(c) for c in carry], *_response(item, model_version, F.col("y_prob"), F.array().cast(TOP_FACTOR_TYPE)))


def _response(item, model_version: str, prob, factors) -> list:
    """The response columns of one record."""
    return [
        F.coalesce(F.col("encounter_id"), F.concat(F.lit("unknown-"), item.cast("string"))).alias("encounter_id"),
        F.lit(model_version).alias("model_version"), F.round(prob, 4).alias("readmission_probability"),
        risk_tier(prob).alias("risk_tier"), factors.alias("top_factors"), F.expr("uuid()").alias("response_id"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("scored_at")]


class Scorer:
    """A loaded model with its scoring projection built once (an endpoint's init).

    ``score(requests)`` is then three ``select`` calls over the request rows: features,
    compiled linear margin + contributions, response columns. Column objects are
    unresolved expressions, so they are reused across request DataFrames; only the
    small per-request plan is analysed and run.
    """

    def __init__(self, model: PipelineModel, model_version: str, means: list[float], carry: tuple[str, ...] = ENVELOPE):
        cl = compile_linear(model)
        base = cl.intercept + sum(c * m for c, m in zip(cl.coef, means))
        derived = {
            "age_band": fx.age_band("age"), "los_bucket": fx.los_bucket("length_of_stay"),
            "comorbidity_score": fx.comorbidity_score("comorbidity_count", "charlson_index"),
            "prior_utilization_rate": fx.prior_utilization_rate("prior_admissions_12mo", "prior_ed_visits_12mo"),
            "polypharmacy_flag": fx.polypharmacy_flag("num_medications"),
        }
        self.carry = carry
        self._feat = [derived[c].alias(c) if c in derived else F.col(c) for c in FEATURE_COLUMNS]
        self._model = [cl.margin().alias("margin"), centred(cl, means).alias("contributions")]
        prob = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))
        self._out = _response(F.col("_item"), model_version, prob, top_factors(F.col("contributions"), 3))
        self.base_value = base

    def score(self, requests: DataFrame) -> DataFrame:
        carry = [F.col(c) for c in self.carry if c in requests.columns]
        item = (F.col("item") if "item" in requests.columns else F.lit(0)).alias("_item")
        f = requests.select(*carry, item, *self._feat)
        m = f.select(*carry, "_item", "encounter_id", *self._model)
        return m.select(*carry, *self._out)


class PromotionGateError(Exception):
    pass


REGISTRY_SCHEMA = ("model_name string, version int, model_path string, git_sha string, training_run_id string, "
                   "data_version string, metrics string, registered_at timestamp")


def read_registry(spark: SparkSession, registry_path: str) -> DataFrame:
    """M6: all registered versions (an empty table where nothing was registered yet)."""
    if not is_folder(spark, registry_path):
        return spark.createDataFrame([], REGISTRY_SCHEMA)
    # each registration lies in a folder of its own, so that no two writers share a commit
    return spark.read.schema(REGISTRY_SCHEMA).option("recursiveFileLookup", True).parquet(registry_path)


def claim_version(spark: SparkSession, registry_path: str, model_name: str) -> int:
    """The next free version of the model, claimed by creating a marker file that must not exist yet:
    of several writers one gets it, the others try the next number. A writer that fails after its
    claim leaves a gap in the numbers, never a second owner."""
    last = read_registry(spark, registry_path).where(F.col("model_name") == model_name).agg(F.max("version")).first()[0]
    version = (last or 0) + 1
    folder = f"{registry_path.rstrip('/')}/_claims/{quote(model_name, safe='')}"
    while not create_if_absent(spark, f"{folder}/v{version}"):
        version += 1
    return version


def register(spark: SparkSession, model: PipelineModel, model_root: str, registry_path: str, model_name: str,
             metrics: DataFrame, gate_failures: DataFrame, tags: dict | None = None) -> int:
    """M6: when the gate passes, claim a version, save the model and add a registry row; returns the
    version. The registry is a small append-only table (one row per promotion)."""
    reasons = [r["reason"] for r in gate_failures.select("reason").collect()]  # <= a handful of checks
    if reasons:
        raise PromotionGateError("; ".join(reasons))
    version = claim_version(spark, registry_path, model_name)
    path = f"{model_root.rstrip('/')}/{model_name}/v{version}"
    model.save(path)  # fails if the version is there: a registered model is never overwritten
    t = tags or {}
    row = metrics.select(
        F.lit(model_name).alias("model_name"), F.lit(version).alias("version"), F.lit(path).alias("model_path"),
        F.lit(t.get("git_sha", "unknown")).alias("git_sha"), F.lit(t.get("training_run_id", "unknown")).alias("training_run_id"),
        F.lit(t.get("data_version", "unknown")).alias("data_version"),
        F.to_json(F.struct(*metrics.columns)).alias("metrics"), F.current_timestamp().alias("registered_at"))
    row.write.parquet(f"{registry_path.rstrip('/')}/{quote(model_name, safe='')}-v{version}")
    return version
