"""A fitted model as one SQL expression over raw columns.

Any engine with CASE, COALESCE, LN, POW and EXP can then score: medians, powers
and scales become numbers in the text, categories a CASE over their means, a
linear model a sum of products, trees nested CASEs.  The text is as long as the
model has slots, categories and nodes, so this is meant for linear models and
for models of few trees.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, LinearSVCModel, LogisticRegressionModel
from pyspark.sql import functions as F

from ..operators.encoders import ConstantImputer, CrossFitEncoderModel
from ..operators.packed import PackedAssembler, PackedModesModel, PackedNumbers, PackedScalingModel
from .boosting import BoostedTreesModel, parsed
from .training import Trained

# A category's mean is a line of the text.
MAX_CATEGORIES = 10_000


def number(value: float) -> str:
    """A double that both engines read as one, whatever its size."""
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "''") + "'"


def bent(x: str, power: float) -> str:
    up = f"LN(1 + {x})" if abs(power) < 1e-12 else f"(POW(1 + {x}, {number(power)}) - 1) / {number(power)}"
    down = f"-LN(1 - {x})" if abs(2 - power) < 1e-12 else f"-(POW(1 - {x}, {number(2 - power)}) - 1) / {number(2 - power)}"
    return f"CASE WHEN {x} >= 0 THEN {up} WHEN {x} < 0 THEN {down} END"


def _scaled(column: str, of: dict, i: int) -> str:
    known = f"COALESCE(CAST({column} AS DOUBLE), {number(of['median'][i])})"
    straight = f"(({bent(known, of['power'][i])}) - {number(of['mean'][i])}) / {number(of['deviation'][i])}"
    return f"(({straight}) - {number(of['center'][i])}) / {number(of['scale'][i])}"


def _encoded(column: str, missing: str, means: dict[str, float], overall: float) -> str:
    spelt = f"COALESCE(CASE {column} WHEN 'Y' THEN '1' WHEN 'y' THEN '1' WHEN 'N' THEN '0' WHEN 'n' THEN '0' ELSE CAST({column} AS VARCHAR(255)) END, {text(missing)})"
    cases = " ".join(f"WHEN {text(k)} THEN {number(v)}" for k, v in sorted(means.items()))
    return f"CASE {spelt} {cases} ELSE {number(overall)} END" if cases else number(overall)


def _tree(tree: dict, slots: list[str], node: int = 0) -> str:
    feature = tree["feature"][node]
    if feature < 0:
        return number(tree["value"][node])
    left, right = (_tree(tree, slots, tree[side][node]) for side in ("left", "right"))
    return f"CASE WHEN {slots[feature]} <= {number(tree['threshold'][node])} THEN {left} ELSE {right} END"


def _means(model: CrossFitEncoderModel) -> dict[str, dict[str, float]]:
    rows = model.full.limit(MAX_CATEGORIES + 1).collect() if model.full is not None else []
    if len(rows) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} categories do not fit an expression")
    found: dict[str, dict[str, float]] = {}
    for r in rows:
        if r["mean"] is not None:
            found.setdefault(r["column"], {})[r["category"]] = r["mean"]
    return found


def slot_expressions(trained: Trained) -> list[str]:
    """The value of each slot of the vector."""
    values: dict[str, list[str]] = {}
    labels: dict[str, str] = {}
    for stage in trained.model.stages[:-1]:
        if isinstance(stage, PackedScalingModel):
            of = stage.getOrDefault(stage.learned)
            values[stage.getOutputCol()] = [_scaled(c, of, i) for i, c in enumerate(stage.getInputCols())]
        elif isinstance(stage, PackedModesModel):
            mode = stage.getOrDefault(stage.learned)["mode"]
            values[stage.getOutputCol()] = [f"COALESCE(CAST({c} AS DOUBLE), {number(mode[i])})" for i, c in enumerate(stage.getInputCols())]
        elif isinstance(stage, PackedNumbers):
            missing = number(stage.getOrDefault(stage.number))
            values[stage.getOutputCol()] = [f"COALESCE(CAST({c} AS DOUBLE), {missing})" for c in stage.getInputCols()]
        elif isinstance(stage, ConstantImputer):
            labels |= dict.fromkeys(stage.getInputCols(), stage.getOrDefault(stage.label))
        elif isinstance(stage, CrossFitEncoderModel):
            means, overall = _means(stage), stage.getOrDefault(stage.overall)
            for c in stage.getInputCols():
                values[c] = [_encoded(c, labels[c], means.get(c, {}), overall)]
        elif isinstance(stage, PackedAssembler):
            return [v for c in stage.getInputCols() for v in values[c]]
    raise ValueError(f"no vector is assembled for {trained.name}")


def margin_expression(trained: Trained) -> str:
    """What the model adds up: positive for the second class."""
    slots, model = slot_expressions(trained), trained.model.stages[-1]
    if isinstance(model, (LogisticRegressionModel, LinearSVCModel)):
        weights = model.coefficients.toArray()
        return " + ".join([number(model.intercept), *[f"{number(w)} * ({x})" for w, x in zip(weights, slots) if w]])
    if isinstance(model, GBTClassificationModel):
        return " + ".join(f"{number(w)} * ({_tree(parsed(t.toDebugString), slots)})" for w, t in zip(model.treeWeights, model.trees))
    if isinstance(model, BoostedTreesModel):
        step = number(model.getOrDefault(model.stepSize))
        return " + ".join([number(model.getOrDefault(model.start)), *[f"{step} * ({_tree(t, slots)})" for t in model.getOrDefault(model.trees)]])
    raise ValueError(f"{type(model).__name__} has no expression")


def probability_expression(trained: Trained) -> str:
    margin, model = margin_expression(trained), trained.model.stages[-1]
    if isinstance(model, LinearSVCModel):
        return f"(LEAST(GREATEST({margin}, -1), 1) + 1) / 2"
    times = 2 if isinstance(model, GBTClassificationModel) else 1
    return f"1 / (1 + EXP(-{times} * ({margin})))"


def score_by_expression(df, trained: Trained, keep: list[str]):
    """(keep..., probability) by the expression alone, without a stage of the model."""
    return df.select(*keep, F.expr(probability_expression(trained)).alias("probability"))
