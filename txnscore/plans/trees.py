"""Fitted models as SQL text over named feature columns.

A tree ensemble becomes one expression: a nested CASE for each tree, weighted
and added up. The text is what Spark evaluates (``score_compiled``: no vectors, no
model object in the plan) and what any other SQL engine can evaluate on an
exported feature table. Numbers are written as ``cast('...' as double)``, so
both read the same doubles.

A missing (NULL or NaN) feature goes to the right branch, as the model sends NaN.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import invalid_reason
from ..schemas import KEY


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    """Rows with feature <= threshold (or feature among ``values``) go left."""
    feature: int
    left: "Leaf | Split"
    right: "Leaf | Split"
    threshold: float | None = None
    values: tuple[float, ...] = ()


_TREE = re.compile(r"Tree \d+ \(weight ([^)]+)\):")
_IF = re.compile(r"If \(feature (\d+) (?:<= (\S+)|in \{([^}]*)\})\)")


def parse(described: str) -> list[tuple[float, "Leaf | Split"]]:
    """(weight, tree) of every tree in a model's ``toDebugString``."""
    lines = iter([x.strip() for x in described.splitlines() if x.strip()])

    def node(line: str):
        if line.startswith("Predict:"):
            return Leaf(float(line.removeprefix("Predict:")))
        m = _IF.fullmatch(line)
        if not m:
            raise ValueError(f"cannot read tree line {line!r}")
        left = node(next(lines))
        if not next(lines).startswith("Else"):
            raise ValueError(f"no else branch after {line!r}")
        right = node(next(lines))
        values = tuple(float(v) for v in m[3].split(",")) if m[3] else ()
        return Split(int(m[1]), left, right, float(m[2]) if m[2] else None, values)

    out = []
    for line in lines:
        m = _TREE.fullmatch(line)
        if m:
            out.append((float(m[1]), node(next(lines))))
    return out


def number(x: float) -> str:
    return f"cast('{x!r}' as double)"


def tree_sql(node: "Leaf | Split", names: Sequence[str]) -> str:
    if isinstance(node, Leaf):
        return number(node.value)
    name = names[node.feature]
    test = (f"{name} <= {number(node.threshold)}" if node.threshold is not None
            else f"{name} in ({', '.join(map(number, node.values))})")
    return f"case when {test} then {tree_sql(node.left, names)} else {tree_sql(node.right, names)} end"


def ensemble_sql(trees: Sequence[tuple[float, "Leaf | Split"]], names: Sequence[str]) -> str:
    """The weighted sum of all trees."""
    return " + ".join(f"{number(w)} * ({tree_sql(t, names)})" for w, t in trees) or number(0.0)


def linear_sql(weights: Sequence[float], intercept: float, names: Sequence[str]) -> str:
    return " + ".join([number(intercept), *(f"{number(w)} * {n}" for w, n in zip(weights, names))])


def logistic_sql(margin: str, steepness: float = 1.0) -> str:
    return f"{number(1.0)} / ({number(1.0)} + exp({number(-steepness)} * ({margin})))"


def margin_sql(model, names: Sequence[str], quote: str = "`") -> tuple[str, float]:
    """(margin, steepness): the model says fraud where the margin is above 0, with
    probability 1 / (1 + exp(-steepness * margin))."""
    quoted = [f"{quote}{n.replace(quote, 2 * quote)}{quote}" for n in names]
    if isinstance(model, GBTClassificationModel):
        return ensemble_sql(parse(model.toDebugString), quoted), 2.0
    if isinstance(model, LogisticRegressionModel):
        return linear_sql([float(w) for w in model.coefficients.toArray()], float(model.intercept), quoted), 1.0
    raise TypeError(f"no SQL form for {type(model).__name__}")


def probability_sql(model, names: Sequence[str], quote: str = "`") -> str:
    """Probability of fraud over columns ``names`` (the model's inputs in order)."""
    return logistic_sql(*margin_sql(model, names, quote))


def score_compiled(model: PipelineModel, raw: DataFrame, key: str = KEY, keep: tuple = ()) -> DataFrame:
    """What ``models.score`` gives, by compiled expressions over the feature columns:
    one row per input row, NULL scores where an input is missing."""
    from .models import GBT_NAME, LR_NAME, SCORE_INPUTS, _assembler_index
    at = _assembler_index(model)
    names = model.stages[at].getInputCols()
    reason = invalid_reason(raw, [c for c in SCORE_INPUTS if c in raw.columns])
    wide = raw.withColumn("_reason", reason)
    for stage in model.stages[:at]:
        wide = stage.transform(wide)
    out = wide.select(key, *keep, "_reason", *[c for c in names if c not in (key, *keep)])
    scores = []
    for stage in model.stages[at + 1:]:
        name = LR_NAME if isinstance(stage, LogisticRegressionModel) else GBT_NAME
        margin, steepness = margin_sql(stage, names)
        out = out.withColumn(f"_{name}", F.expr(margin))
        m = F.col(f"_{name}")
        scores.append(F.when(F.col("_reason").isNull(), F.struct(
            (F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-steepness) * m))).alias("fraud_probability"),
            (m > 0).cast("int").alias("is_fraud_prediction"))).alias(name))
    return out.select(key, *keep, *scores)
