"""Scoring requests (O11): name -> value records as typed columns, bound by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_requests(df: DataFrame, features: Sequence[str], id_col: str,
                request_id: str = "request_id") -> DataFrame:
    """Build (request_id, features map<string,double>) rows from a feature table."""
    pairs = []
    for c in features:
        pairs += [F.lit(c), F.col(c).cast("double")]
    return df.select(F.col(id_col).cast("string").alias(request_id),
                     F.create_map(*pairs).alias("features"))


def expand_requests(df: DataFrame, features: Sequence[str], map_col: str = "features",
                    keep: Sequence[str] = ("request_id",)) -> DataFrame:
    """One typed column per model feature, looked up **by name**; a missing
    name gives NULL (and so a reject downstream); unknown names are ignored."""
    m = F.col(map_col)
    return df.select(*[F.col(k) for k in keep],
                     *[F.try_element_at(m, F.lit(name)).alias(name) for name in features])
