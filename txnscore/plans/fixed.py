"""A fixed-coefficient linear scorer: an oracle-checkable stand-in for a
fitted logistic regression (same formula, literal coefficients)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import flag, linear_score, trans_hour
from ..schemas import EVENT_TIME
from .trees import Leaf, Split

# Fixed values (ours, not fitted): intercept and per-column coefficients.
FIXED_INTERCEPT = -5.0
FIXED_COEFFICIENTS = {"amt": 0.03, "cat_purchase": 0.4, "trans_hour": 0.02}
FIXED_MODEL = "fixed_linear"
SCORE_DIGITS = 9


def fixed_score(df: DataFrame) -> DataFrame:
    """Add ``score`` (probability rounded to 9 places, so ties agree across
    engines) over raw transactions."""
    inputs = df.withColumns({"cat_purchase": flag("category", "purchase"),
                             "trans_hour": trans_hour(EVENT_TIME)})
    return inputs.withColumn(
        "score", F.round(linear_score(FIXED_COEFFICIENTS, FIXED_INTERCEPT), SCORE_DIGITS)
    ).drop("cat_purchase", "trans_hour")


# The same score in SQL (double literals, so both engines do IEEE double
# arithmetic in the same order), over amt, category, trans_date_trans_time.
FIXED_SCORE_SQL = (
    "round(1/(1+exp(-(cast(-5.0 as double) + cast(0.03 as double)*amt"
    " + cast(0.4 as double)*(case when category = 'purchase' then 1 else 0 end)"
    " + cast(0.02 as double)*hour(trans_date_trans_time)))), 9)")


def fixed_trees(depth: int = 3, count: int = 12) -> list:
    """A fixed tree ensemble over FIXED_TREE_FEATURES, made by a rule (ours, not
    fitted): the tree at ``k`` splits on features in turn from the k-th on, at
    thresholds that halve the feature's range, and its leaves rise with the path."""
    def node(k: int, level: int, low: float, high: float, lift: float):
        if level == depth:
            return Leaf(round(lift * 0.25 - 0.3 - 0.01 * k, 6))
        name = list(FIXED_TREE_FEATURES)[(k + level) % len(FIXED_TREE_FEATURES)]
        a, z = FIXED_TREE_FEATURES[name]
        at = a + (z - a) * (0.3 + 0.4 * ((k * 7 + level * 3) % 10) / 10)
        return Split((k + level) % len(FIXED_TREE_FEATURES), node(k, level + 1, a, at, lift),
                     node(k, level + 1, at, z, lift + 2.0 ** -level), at)
    return [(1.0 if k == 0 else 0.1, node(k, 0, 0.0, 1.0, 0.0)) for k in range(count)]


# Fixed values (ours): the features of the fixed trees and the ranges that thresholds divide.
FIXED_TREE_FEATURES = {"amt": (0.0, 400.0), "cat_purchase": (0.0, 1.0), "trans_hour": (0.0, 23.0),
                       "city_pop": (1000.0, 60000.0)}
