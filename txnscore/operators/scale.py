"""Quartile range, robust scaling and vector unpacking.

Scaling multiplies by 1/(inter-quartile range) and does not centre, as a
``RobustScaler(withCentering=False, withScaling=True)``; a zero range gives
0.0. ``relative_error > 0`` uses Spark's mergeable quantile sketch
(``approxQuantile``); ``relative_error == 0`` uses the exact distributed
ranks of :func:`exact_quantiles` (never an all-values sketch).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import RobustScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .stats import exact_quantiles

# Fixed value: the default sketch error of Spark's RobustScaler.
DEFAULT_RELATIVE_ERROR = 0.001
Q1, Q3 = 0.25, 0.75


def iqr_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact quartiles per column: ``(column, q1, q3, iqr)``."""
    q = exact_quantiles(df, cols, [Q1, Q3])
    return (q.groupBy("column").agg(
                F.max(F.when(F.col("p") == Q1, F.col("value"))).alias("q1"),
                F.max(F.when(F.col("p") == Q3, F.col("value"))).alias("q3"))
             .withColumn("iqr", F.col("q3") - F.col("q1")))


def iqr(df: DataFrame, cols: Sequence[str],
        relative_error: float = DEFAULT_RELATIVE_ERROR) -> dict[str, float]:
    """Quartile range per column (a handful of numbers on the driver); a column
    without any value is an error."""
    cols = list(cols)
    if relative_error and relative_error > 0:
        qs = df.approxQuantile(cols, [Q1, Q3], float(relative_error))
        got = {c: v[1] - v[0] for c, v in zip(cols, qs) if len(v) == 2}
    else:
        # Exact quartiles pass three times over the columns: derive them once.
        path = scratch_path(df.sparkSession, "quartiles")
        df.select(*cols).write.parquet(path)
        stored = df.sparkSession.read.parquet(path)
        got = {r["column"]: float(r["iqr"]) for r in iqr_table(stored, cols).collect()}
    if empty := [c for c in cols if c not in got]:
        raise ValueError(f"no quartiles: columns without a value: {empty}")
    return got


def scale_factor(r: float) -> float:
    """Multiplier for a range: ``1/r``, or 0.0 for a zero range (as RobustScaler)."""
    return 0.0 if r == 0 else 1.0 / float(r)


def scale_columns(df: DataFrame, ranges: Mapping[str, float], suffix: str = "_scaled",
                  drop_source: bool = True) -> DataFrame:
    """``x * (1/iqr)`` (``x * 0.0`` for a zero range) in one projection."""
    new = {f"{c}{suffix}": F.col(c).cast("double") * F.lit(scale_factor(r))
           for c, r in ranges.items()}
    out = df.withColumns(new)
    return out.drop(*ranges.keys()) if drop_source else out


def robust_scale(df: DataFrame, cols: Sequence[str],
                 relative_error: float = DEFAULT_RELATIVE_ERROR,
                 suffix: str = "_scaled", drop_source: bool = True) -> DataFrame:
    """Fit the quartile ranges of ``cols`` and scale them in one projection."""
    return scale_columns(df, iqr(df, cols, relative_error), suffix, drop_source)


def unpack(df: DataFrame, vec_col: str, names: Sequence[str], drop: bool = True) -> DataFrame:
    """Vector column -> array -> one scalar column per name (by position)."""
    arr = vector_to_array(F.col(vec_col))
    out = df.withColumns({n: arr[i] for i, n in enumerate(names)})
    return out.drop(vec_col) if drop else out


def robust_scale_vector(df: DataFrame, cols: Sequence[str],
                        relative_error: float = DEFAULT_RELATIVE_ERROR,
                        suffix: str = "_scaled") -> DataFrame:
    """The same scaling through Spark ML's vector stages: assemble, fit a
    ``RobustScaler(withCentering=False)`` and unpack the scaled vector.

    Use a non-zero ``relative_error`` on large data: with 0 the scaler's
    quantile summaries keep every value of a column in one buffer.
    """
    cols = list(cols)
    vec = VectorAssembler(inputCols=cols, outputCol="_to_scale", handleInvalid="error").transform(df)
    model = RobustScaler(inputCol="_to_scale", outputCol="_scaled", withCentering=False,
                         withScaling=True, relativeError=relative_error).fit(vec)
    out = unpack(model.transform(vec).drop("_to_scale"), "_scaled", [c + suffix for c in cols])
    return out.drop(*cols)
