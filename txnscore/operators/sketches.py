"""Quartiles from stored sketches (O34, O41): a new day does not reread the history.

Each landed part gets one mergeable KLL sketch a column, written once beside the
data. At fit time the sketches of all parts are merged: the history is read as a
few hundred kilobytes a part, whatever its size. A merged sketch answers a
quantile within ``RANK_ERROR`` of its rank (``K`` items a level; the published
99 % bound is below 0.1 % at this size). A part that is landed again replaces its
sketches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Items a sketch keeps per level, and the rank error to count on.
K, RANK_ERROR = 4096, 0.002

STORED = "part string, column string, n long, sketch binary"


def part_sketches(df: DataFrame, cols: Sequence[str], part_col: str | None = None, part: str = "all") -> DataFrame:
    """Rows of STORED: one per part and column, in one aggregate over ``df`` (parts by
    ``part_col``, or the one named ``part``). NULL and NaN are not counted."""
    clean = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols]
    name = F.col(part_col).cast("string") if part_col else F.lit(part)
    aggs = [a for i, c in enumerate(clean) for a in (F.count(c).alias(f"n{i}"), F.kll_sketch_agg_double(c, K).alias(f"s{i}"))]
    wide = df.groupBy(name.alias("part")).agg(*aggs)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("sketch"))
                               for i, c in enumerate(cols)])).alias("x")
    return wide.select("part", each).select("part", "x.column", "x.n", "x.sketch")


def store_sketches(sketches: DataFrame, path: str) -> str:
    """Write sketches to a folder per part, replacing those of the same parts only."""
    (sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path))
    return path


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(path)


def merged_quantiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(column, p, value) from all parts' sketches; a column without values has none."""
    merged = sketches.where("n > 0").groupBy("column").agg(F.kll_merge_agg_double("sketch", K).alias("s"))
    each = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("s", F.lit(float(p))).alias("value"))
                               for p in probs])).alias("q")
    return merged.select("column", each).select("column", "q.p", "q.value")


def iqr_from_sketches(spark: SparkSession, path: str, cols: Sequence[str]) -> dict[str, float]:
    """Quartile range of each column from the stored sketches (two numbers a column
    reach the driver)."""
    found: Mapping = {(r["column"], r["p"]): r["value"]
                      for r in merged_quantiles(stored_sketches(spark, path), (0.25, 0.75)).collect()}
    missing = [c for c in cols if (c, 0.25) not in found]
    if missing:
        raise ValueError(f"no sketches of {missing} in {path}")
    return {c: float(found[c, 0.75] - found[c, 0.25]) for c in cols}
