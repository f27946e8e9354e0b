"""Per-row feature contributions (F4), global importance (F5, A12, O3) and top
factors (F6, O4).

Re-aimed attribution: exact additive contributions of a linear margin,
``coef_j * (x_j - mean_j)`` per assembled slot, one-hot slots summed back to their
source column, so that ``base_value + sum(contributions) = margin`` for every row.
The fitted pipeline is compiled into plain column expressions (one indicator per learned
category, the coefficients as literals): no UDF, no per-row Python, whole-stage codegen.
The training means come from one aggregate pass, fitted once with the model.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.functions.features import RISK_CENTER, RISK_SLOPE, RISK_TERMS
from carelens.operators.model import model_input
from carelens.schemas import LABEL_COLUMN, MODEL_FEATURE_COLUMNS


def _contrib_array(values: dict[str, Column]) -> Column:
    """array<struct<feature, value>> in model feature order."""
    return F.array(*[F.struct(F.lit(f).alias("feature"), values.get(f, F.lit(0.0)).alias("value"))
                     for f in MODEL_FEATURE_COLUMNS])


@dataclass
class CompiledLinear:
    """A fitted linear pipeline as column expressions: one numeric slot per numeric
    feature; per categorical, one indicator slot per learned category, one for unseen/NULL
    values (the indexer's ``keep`` bucket) and the encoder's own ``keep`` slot, in the
    assembler's slot order."""
    slots: list[tuple[str, Column]]  # (source feature, slot value)
    coef: list[float]
    intercept: float
    levels: list[str | None] = field(default_factory=list)  # the category of an indicator slot

    def margin(self) -> Column:
        return sum((F.lit(c) * x for c, (_, x) in zip(self.coef, self.slots)), F.lit(self.intercept))


#: Levels of the two slots a categorical has besides its learned values.
OTHER, NEVER = "(other)", "(never)"


def compile_linear(model: PipelineModel | CompiledLinear) -> CompiledLinear:
    """Compile imputer + indexer + one-hot + assembler + logistic model into JVM-native expressions
    (a model that is declared as expressions already stays as it is)."""
    if isinstance(model, CompiledLinear):
        return model
    imputer, indexer, encoder, assembler, lr = model.stages
    means = imputer.surrogateDF.first().asDict()  # one row
    source = dict(zip(imputer.getOutputCols(), imputer.getInputCols()))
    labels = dict(zip(indexer.getInputCols(), indexer.labelsArray))
    ohe_src = {o: i.replace("__idx", "") for i, o in zip(encoder.getInputCols(), encoder.getOutputCols())}
    slots: list[tuple[str, Column]] = []
    levels: list[str | None] = []
    for col in assembler.getInputCols():
        if col in ohe_src:
            src = ohe_src[col]
            known = labels[src]
            for lab in known:
                slots.append((src, (F.col(src) == F.lit(lab)).cast("double")))
            # the indexer's keep bucket (unseen or NULL) ...
            slots.append((src, (F.col(src).isNull() | ~F.col(src).isin(*known)).cast("double")))
            # ... and the encoder's own keep slot for out-of-range indices, never set here
            slots.append((src, F.lit(0.0)))
            levels += [*known, OTHER, NEVER]
        else:
            x = F.col(source[col]).cast("double")
            slots.append((source[col], F.coalesce(F.when(~F.isnan(x), x), F.lit(float(means[source[col]])))))
            levels.append(None)
    coef = lr.coefficients.toArray().tolist()
    if len(coef) != len(slots):
        raise ValueError(f"slot count {len(slots)} does not match the model's {len(coef)} coefficients")
    return CompiledLinear(slots, coef, float(lr.intercept), levels)


def contribution_means(model: PipelineModel, train: DataFrame) -> list[float]:
    """Mean of every assembled slot over ``train`` (one aggregate pass). Fitted once with
    the model, like an explainer's background data; reused for every batch."""
    cl = compile_linear(model)
    row = model_input(train, label=False).agg(*[F.avg(x).alias(f"m{i}") for i, (_, x) in enumerate(cl.slots)]).first()
    return [float(row[f"m{i}"]) for i in range(len(cl.slots))]


def score_equations(model: PipelineModel, train: DataFrame, reg_param: float = 0.0, weight: str | None = None) -> DataFrame:
    """M2: the equations a fitted logistic model solves, one row per slot: feature, level (of an
    indicator), equation.

    equation = mean of weight * (p - y) * x / sd(x), plus ``reg_param`` * coefficient * sd(x) (the
    slope of the ridge penalty in standardised units), with x / sd = 1 for the intercept. At the
    optimum all are zero, whichever solver found it and even where the optimum is not unique. A
    constant slot has the equation 0. ``train``: the rows of the fit, with ``weight`` if weighted.

    Two aggregates over the rows (the weighted deviations, then all equations at once)."""
    cl = compile_linear(model)
    w = F.lit(1.0) if weight is None else F.col(weight)
    rows = model_input(train)
    total, squares = F.sum(w), F.sum(w * w)
    first = rows.agg(total.alias("w"), (total - squares / total).alias("d"),
                     *[x for i, (_, v) in enumerate(cl.slots) for x in (F.sum(w * v).alias(f"s{i}"), F.sum(w * v * v).alias(f"q{i}"))]).first()
    if first["w"] is None:
        return rows.sparkSession.createDataFrame([], "feature string, level string, equation double")

    def deviation(i: int) -> float:
        spread = first[f"q{i}"] - first[f"s{i}"] ** 2 / first["w"]
        return (spread / first["d"]) ** 0.5 if spread > 1e-10 * first[f"q{i}"] else 0.0  # below: rounding of a constant

    sd = [deviation(i) for i in range(len(cl.slots))]
    residual = w * (F.lit(1.0) / (F.lit(1.0) + F.exp(-cl.margin())) - F.col(LABEL_COLUMN))
    sums = rows.agg(F.sum(residual).alias("r"), *[F.sum(residual * v).alias(f"r{i}") for i, (_, v) in enumerate(cl.slots)])
    names = [("(intercept)", None), *[(f, lv) for (f, _), lv in zip(cl.slots, cl.levels, strict=True)]]
    values = [F.col("r") / F.lit(first["w"])]
    for i, (c, s) in enumerate(zip(cl.coef, sd, strict=True)):
        values.append(F.col(f"r{i}") / F.lit(first["w"] * s) + F.lit(reg_param * c * s) if s > 0 else F.lit(0.0))
    structs = [F.struct(F.lit(f).alias("feature"), F.lit(lv).cast("string").alias("level"), v.alias("equation")) for (f, lv), v in zip(names, values, strict=True)]
    return sums.select(F.inline(F.array(*structs)))


def centred(cl: CompiledLinear, means: list[float]) -> Column:
    """The contributions ``coef * (x - mean)`` of a compiled model, per source feature."""
    per: dict[str, Column] = {}
    for (src, x), c, m in zip(cl.slots, cl.coef, means):
        term = F.lit(c) * (x - F.lit(m))
        per[src] = per[src] + term if src in per else term
    return _contrib_array(per)


def linear_contributions(model: PipelineModel, df: DataFrame, train: DataFrame | None = None,
                         means: list[float] | None = None) -> DataFrame:
    """F4 for a fitted linear pipeline (indexer, one-hot, assembler, logistic regression).

    Adds ``margin``, ``base_value`` and ``contributions`` in one projection of plain
    column expressions (no vector UDFs): per slot ``coef * (x - mean)``, summed back to
    the source feature. ``means`` (see ``contribution_means``) default to those of
    ``train`` (else of ``df``).
    """
    cl = compile_linear(model)
    mean = means if means is not None else contribution_means(model, train if train is not None else df)
    base = cl.intercept + sum(c * m for c, m in zip(cl.coef, mean))
    inp = model_input(df, label=False)
    return inp.select(*[F.col(c) for c in df.columns], cl.margin().alias("margin"),
                      centred(cl, mean).alias("contributions"), F.lit(float(base)).alias("base_value"))


# The deterministic score's margin terms: slope * weight * term (see functions.features.RISK_TERMS).
SYNTHETIC_TERMS = [(f, RISK_SLOPE * w, t) for f, w, t in RISK_TERMS]


def synthetic_terms() -> dict[str, Column]:
    return {f: F.lit(w) * F.expr(t) for f, w, t in SYNTHETIC_TERMS}


def synthetic_contributions(df: DataFrame) -> DataFrame:
    """F4 for the deterministic score: term - mean(term) over ``df`` (one-row mean,
    broadcast), so base_value + sum = margin = slope * (risk - center)."""
    terms = synthetic_terms()
    means = df.agg(*[F.avg(t).alias(f"_m_{f}") for f, t in terms.items()])
    j = df.crossJoin(F.broadcast(means))
    per = {f: t - F.col(f"_m_{f}") for f, t in terms.items()}
    offset = F.lit(RISK_SLOPE * RISK_CENTER)
    base = sum(F.col(f"_m_{f}") for f in terms) - offset
    return j.select(*[F.col(c) for c in df.columns], base.alias("base_value"),
                    (sum(terms.values()) - offset).alias("margin"), _contrib_array(per).alias("contributions"))


def top_factors(contributions: Column, n: int = 3) -> Column:
    """The ``n`` largest |value| (stable on ties: earlier feature first), values
    rounded to 4: array<struct<feature, shap_value>>."""
    keyed = F.transform(contributions, lambda x, i: F.struct(-F.abs(x["value"]).alias("k"), i.alias("pos"),
                                                             x["feature"].alias("feature"), x["value"].alias("v")))
    top = F.slice(F.sort_array(keyed), 1, n)
    return F.transform(top, lambda x: F.struct(x["feature"].alias("feature"), F.round(x["v"], 4).alias("shap_value")))


def global_importance(df: DataFrame, contributions: str = "contributions") -> DataFrame:
    """Mean |contribution| per feature (rounded to 4), ranked; ties keep
    feature order. Long form via ``inline``; one partial aggregate per feature."""
    pos = F.array_position(F.array(*[F.lit(f) for f in MODEL_FEATURE_COLUMNS]), F.col("feature"))
    long = df.select(F.inline(contributions))
    agg = long.groupBy("feature").agg(F.avg(F.abs("value")).alias("_m"))
    return agg.select("feature", F.round("_m", 4).alias("mean_abs_contribution"), pos.alias("_pos")) \
        .orderBy(F.col("mean_abs_contribution").desc(), "_pos").drop("_pos")
