"""Score expressions (O26 and the linear scorer used as a checkable model)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def linear_score(coefficients: Mapping[str, float], intercept: float) -> Column:
    """Logistic probability ``1/(1+exp(-(b0 + sum b_i x_i)))`` over named columns.

    This is exactly what a fitted binary LogisticRegressionModel computes,
    written as a codegen-friendly expression bound to columns by name.
    """
    margin = F.lit(float(intercept))
    for name, b in coefficients.items():
        margin = margin + F.lit(float(b)) * _c(name)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def positive_probability(prob_col) -> Column:
    """Probability of class 1 from an ML ``probability`` vector."""
    return vector_to_array(_c(prob_col))[1]


def decision(c, threshold: float = 0.5) -> Column:
    """0/1 decision; strictly above the threshold is fraud (as the LR model)."""
    return F.when(_c(c) > F.lit(threshold), 1).otherwise(0)
