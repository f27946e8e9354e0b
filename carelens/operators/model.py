"""Modelling on Spark ML: encoding (M1), training (M2, C7), search (M3), prediction
(M4, P17), candidate comparison (E10, O5).

The model is a ``PipelineModel``: mean imputation -> StringIndexers (unseen -> extra index, ``keep``) ->
[OneHotEncoder for the linear model] -> VectorAssembler (fixes the column order) ->
classifier. Training is Spark ML's distributed fit; nothing is collected but the
one-row class-weight aggregate and the small metric rows of a search.
"""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.operators.split import with_class_weight
from carelens.session import cut_lineage, scratch_path
from carelens.schemas import CATEGORICAL_COLUMNS, LABEL_COLUMN, MODEL_FEATURE_COLUMNS

NUMERIC_FEATURES = [c for c in MODEL_FEATURE_COLUMNS if c not in CATEGORICAL_COLUMNS]


def model_input(df: DataFrame, label: bool = True) -> DataFrame:
    """Model columns with numeric types fixed (bool -> double); label as int
    (filled with 0 when absent and ``label``)."""
    cols = [F.col(c).cast("double").alias(c) for c in NUMERIC_FEATURES] + [F.col(c) for c in CATEGORICAL_COLUMNS]
    extra = [c for c in df.columns if c not in MODEL_FEATURE_COLUMNS]
    out = df.select(*[F.col(c) for c in extra], *cols)
    if label:
        out = out.withColumn(LABEL_COLUMN, F.col(LABEL_COLUMN).cast("int") if LABEL_COLUMN in df.columns else F.lit(0))
    return out


def encoder_stages(algorithm: str) -> tuple[list, list[str]]:
    """M1: indexers (+ one-hot for the linear model) and the assembled input columns."""
    # one multi-column indexer: a single pass over the data for all six vocabularies
    imputed = [f"{c}__imp" for c in NUMERIC_FEATURES]  # missing numbers take the training mean
    idx = [Imputer(inputCols=NUMERIC_FEATURES, outputCols=imputed, strategy="mean"), StringIndexer(inputCols=CATEGORICAL_COLUMNS, outputCols=[f"{c}__idx" for c in CATEGORICAL_COLUMNS],
                         handleInvalid="keep", stringOrderType="alphabetAsc")]
    if algorithm == "gbt":
        # native categorical splits: indexed columns carry nominal metadata
        return idx, imputed + [f"{c}__idx" for c in CATEGORICAL_COLUMNS]
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in CATEGORICAL_COLUMNS],
                        outputCols=[f"{c}__ohe" for c in CATEGORICAL_COLUMNS], handleInvalid="keep", dropLast=False)
    return idx + [ohe], imputed + [f"{c}__ohe" for c in CATEGORICAL_COLUMNS]


@dataclass
class TrainSpec:
    algorithm: str = "gbt"  # gbt | logreg
    params: dict = field(default_factory=dict)
    seed: int = 42
    class_weight: bool = True


def build_pipeline(spec: TrainSpec, early_stop: bool = False, categories: int = 0) -> Pipeline:
    """``categories``: the most distinct values of a categorical column (trees need a bin for
    each, and one for unseen values)."""
    stages, inputs = encoder_stages(spec.algorithm)
    asm = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
    p = dict(spec.params)
    common = dict(featuresCol="features", labelCol=LABEL_COLUMN)
    if spec.class_weight:
        common["weightCol"] = "weight"
    if spec.algorithm == "gbt":
        clf = GBTClassifier(seed=spec.seed, maxBins=max(32, categories + 2, p.pop("maxBins", 32)), **common, **p)
        if early_stop:
            clf.setValidationIndicatorCol("is_val")
    elif spec.algorithm == "logreg":
        clf = LogisticRegression(standardization=True, **common, **p)
    else:
        raise ValueError(f"Unsupported algorithm: {spec.algorithm}")
    return Pipeline(stages=stages + [asm, clf])


def train_model(train: DataFrame, val: DataFrame | None, spec: TrainSpec) -> PipelineModel:
    """M2 + C7: fit on train (positives weighted neg/pos); GBT early-stops on ``val``."""
    t = model_input(train).withColumn("is_val", F.lit(False))
    if spec.class_weight:
        t = with_class_weight(t)
    early_stop = val is not None and spec.algorithm == "gbt"
    if early_stop:
        v = model_input(val).withColumn("is_val", F.lit(True))
        if spec.class_weight:
            v = v.withColumn("weight", F.lit(1.0))
        t = t.unionByName(v)
    categories = 0
    if spec.algorithm == "gbt":
        categories = max(t.agg(*[F.count_distinct(c) for c in CATEGORICAL_COLUMNS]).first())
    fitted = build_pipeline(spec, early_stop, categories).fit(t)
    if spec.algorithm == "logreg":
        # scored through compiled column expressions (contributions.compile_linear): no
        # Spark ML UDF ever captures the fitted model
        return fitted
    return summary_free(fitted, train.sparkSession)


def summary_free(model: PipelineModel, spark) -> PipelineModel:
    """Reload ``model`` from the shared folder. A freshly fitted model may keep a training
    summary that references the session; once the session has used observations, plans
    whose UDFs capture such a model cannot be serialised. The reloaded model has none."""
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def predict_proba(model: PipelineModel, df: DataFrame, prob_col: str = "y_prob", compiled: bool = True) -> DataFrame:
    """M4: ``df`` + the probability of class 1 (extra columns are carried through).

    A logistic pipeline is evaluated as compiled column expressions (same arithmetic as
    Spark ML, no UDF); other models through ``model.transform``."""
    keep = [F.col(c) for c in df.columns]
    from carelens.operators.contributions import CompiledLinear, compile_linear

    if isinstance(model, CompiledLinear) or (compiled and isinstance(model.stages[-1], LogisticRegressionModel)):
        margin = compile_linear(model).margin()
        return model_input(df, label=False).select(*keep, (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).alias(prob_col))
    out = model.transform(model_input(df, label=False))
    return out.select(*keep, vector_to_array("probability")[1].alias(prob_col))


# ---------------------------------------------------------------- search (M3)

@dataclass
class SearchSpace:
    """choice: list; uniform: (lo, hi); loguniform: (lo, hi) in natural-log space."""
    choice: dict = field(default_factory=dict)
    uniform: dict = field(default_factory=dict)
    loguniform: dict = field(default_factory=dict)

    def sample(self, rnd: random.Random) -> dict:
        p = {k: rnd.choice(v) for k, v in self.choice.items()}
        p.update({k: rnd.uniform(*v) for k, v in self.uniform.items()})
        p.update({k: math.exp(rnd.uniform(*v)) for k, v in self.loguniform.items()})
        return p


# The search space, mapped onto Spark's GBT parameters
# (leaves -> depth, learning rate -> stepSize, trees -> maxIter, min child -> minInstancesPerNode,
# feature fraction -> featureSubsetStrategy).
DEFAULT_SPACE = SearchSpace(
    choice={"maxDepth": [4, 5, 6, 7], "maxIter": [100, 300, 500], "minInstancesPerNode": [10, 20, 50]},
    uniform={"featureSubsetStrategy": (0.6, 1.0)},
    loguniform={"stepSize": (-4, -1)},
)


@dataclass
class EncodedSplits:
    """Train and validation rows through the encoder once: (features, label, weight, is_val), written
    to the shared folder. All trials of a search read it; only classifiers are fitted on it."""
    encoder: PipelineModel
    rows: DataFrame
    categories: int

    @staticmethod
    def build(train: DataFrame, val: DataFrame, algorithm: str, class_weight: bool = True) -> EncodedSplits:
        stages, inputs = encoder_stages(algorithm)
        t = model_input(train)
        t = with_class_weight(t) if class_weight else t.withColumn("weight", F.lit(1.0))
        asm = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
        encoder = Pipeline(stages=[*stages, asm]).fit(t)
        both = t.withColumn("is_val", F.lit(False)).unionByName(
            model_input(val).withColumns({"weight": F.lit(1.0), "is_val": F.lit(True)}), allowMissingColumns=True)
        categories = max(t.agg(*[F.count_distinct(c) for c in CATEGORICAL_COLUMNS]).first())
        rows = encoder.transform(both).select("features", LABEL_COLUMN, "weight", "is_val")
        return EncodedSplits(encoder, cut_lineage(rows, "encoded-splits"), categories)


#: The parameter that a rung of successive halving gives more of.
BUDGET = "maxIter"


@dataclass
class SearchResult:
    """``trials``: one row per trial (trial, params, rung, budget, pr_auc, rank), ``scores``: the written
    validation scores of each trial's last rung (trial, rung, y_true, y_prob), ``model``: the best."""
    model: PipelineModel
    trials: DataFrame
    scores: DataFrame


def _classifier(algorithm: str, params: dict, seed: int, categories: int):
    p = dict(params)
    common = dict(featuresCol="features", labelCol=LABEL_COLUMN, weightCol="weight")
    if algorithm == "gbt":
        return GBTClassifier(seed=seed, maxBins=max(32, categories + 2, p.pop("maxBins", 32)), **common, **p)
    if algorithm == "logreg":
        return LogisticRegression(standardization=True, **common, **p)
    raise ValueError(f"Unsupported algorithm: {algorithm}")


def halving_search(train: DataFrame, val: DataFrame, trials: int = 20, eta: int = 3, rungs: int = 3, concurrency: int = 4,
                   seed: int = 42, space: SearchSpace = DEFAULT_SPACE, algorithm: str = "gbt") -> SearchResult:
    """M3: seeded candidates by successive halving. All trials run with a small share of their
    iterations; the best ``1 / eta`` of them go on with ``eta`` times as many, up to the full number
    in the last rung. The rows are encoded once, a rung's trials are fitted concurrently (driver
    threads submit Spark jobs), their validation scores are written, and one grouped prefix sum ranks them all by average precision (ties: the earlier trial)."""
    from carelens.operators.evaluate import average_precision_by

    spark = train.sparkSession
    data = EncodedSplits.build(train, val, algorithm)
    fit_rows, val_rows = data.rows.where("not is_val"), data.rows.where("is_val")
    rnd = random.Random(seed)
    candidates = {i: space.sample(rnd) for i in range(trials)}
    for c in candidates.values():
        if "featureSubsetStrategy" in c:
            c["featureSubsetStrategy"] = f"{c['featureSubsetStrategy']:.3f}"
    live, last, fitted = list(candidates), {}, {}
    for rung in range(rungs):
        def run(trial: int, rung: int = rung):
            params = dict(candidates[trial])
            params[BUDGET] = max(1, round(params.get(BUDGET, 100) / eta ** (rungs - 1 - rung)))
            model = _classifier(algorithm, params, seed, data.categories).fit(fit_rows)
            path = scratch_path(spark, "trial-model")
            model.write().save(path)
            model = type(model).load(path)  # without the training summary, which holds the session
            scored = model.transform(val_rows).select(F.lit(trial).alias("trial"), F.lit(rung).alias("rung"),
                                                      F.col(LABEL_COLUMN).cast("int").alias("y_true"), vector_to_array("probability")[1].alias("y_prob"))
            return trial, params[BUDGET], model, cut_lineage(scored, "trial-scores")

        with ThreadPoolExecutor(max_workers=concurrency) as pool:
            done = list(pool.map(run, live))
        written = reduce(DataFrame.unionByName, [d for *_, d in done])
        found = {r["trial"]: r["average_precision"] for r in average_precision_by(written, ["trial"]).collect()}  # one row per trial
        for trial, budget, model, scored in done:
            last[trial] = (rung, budget, found.get(trial), scored)
            fitted[trial] = model
        order = sorted(live, key=lambda t: (-(found.get(t) if found.get(t) is not None else -1.0), t))
        live = order[: max(1, math.ceil(len(order) / eta))] if rung < rungs - 1 else order
    ranked = sorted(last, key=lambda t: (-last[t][0], -(last[t][2] if last[t][2] is not None else -1.0), t))
    rows = [(t, str(sorted(candidates[t].items())), last[t][0], last[t][1], last[t][2], ranked.index(t) + 1) for t in sorted(last)]
    table = spark.createDataFrame(rows, "trial int, params string, rung int, budget int, pr_auc double, rank int")
    scores = reduce(DataFrame.unionByName, [scored for *_, scored in last.values()])
    best = PipelineModel(stages=[*data.encoder.stages, fitted[ranked[0]]])
    return SearchResult(best, table, scores)


def search(train: DataFrame, val: DataFrame, trials: int = 20, concurrency: int = 4, seed: int = 42,
           space: SearchSpace = DEFAULT_SPACE, algorithm: str = "gbt"):
    """M3 without halving: every trial runs in full. Returns (best_model, metrics with one row per
    trial: trial, params, pr_auc)."""
    found = halving_search(train, val, trials, 2, 1, concurrency, seed, space, algorithm)
    return found.model, found.trials.select("trial", "params", "pr_auc")
