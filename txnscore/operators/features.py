"""Feature projections.

All of them add Column expressions in one projection; Catalyst folds them
into the scan's whole-stage-codegen span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean_name, flag, haversine_km, trans_day_of_week, trans_hour
from ..schemas import EVENT_TIME, LABEL

# Columns that are never features (identity, raw text, raw
# coordinates, the raw event time, and intermediates of the distance).
NON_FEATURE_COLUMNS = [
    "_c0", "Unnamed: 0", "trans_date_trans_time", "merchant", "first", "last",
    "street", "city", "state", "zip", "job", "dob", "trans_num", "lat", "long",
    "merch_lat", "merch_long", "category", "gender",
    "lat1", "lon1", "lat2", "lon2", "dlat", "dlon",
]
# The coordinate columns of holder and merchant.
COORDS = ("lat", "long", "merch_lat", "merch_long")
CATEGORY_PREFIX = "cat_"
DEFAULT_MAX_CATEGORIES = 10_000


def add_time_features(df: DataFrame, src: str = EVENT_TIME) -> DataFrame:
    """Add trans_hour and trans_day_of_week from the event time."""
    return df.withColumns({"trans_hour": trans_hour(src),
                           "trans_day_of_week": trans_day_of_week(src)})


def add_distance(df: DataFrame, coords: Sequence[str] = COORDS,
                 out: str = "distance_km") -> DataFrame:
    """Add the holder-merchant great-circle distance in km."""
    return df.withColumn(out, haversine_km(*coords))


def add_flag(df: DataFrame, src: str = "gender", value: str = "M",
             out: str = "gender_M") -> DataFrame:
    """Flag column, only when the source column exists."""
    if src not in df.columns:
        return df
    return df.withColumn(out, flag(src, value))


def fit_vocabulary(df: DataFrame, col: str = "category",
                   max_size: int = DEFAULT_MAX_CATEGORIES) -> list[str]:
    """Sorted distinct non-NULL values; the first is the dropped baseline.

    The distinct runs as a partial + final aggregate; only the vocabulary
    (at most ``max_size`` values, checked) reaches the driver. Two values that
    clean to one column name are an error (they would overwrite each other).
    """
    rows = (df.select(F.col(col)).where(F.col(col).isNotNull()).distinct()
              .orderBy(col).limit(max_size + 1).collect())
    vocab = [r[0] for r in rows]
    if len(vocab) > max_size:
        raise ValueError(f"column {col!r} has more than {max_size} distinct values")
    check_name_clash(vocab)
    return vocab


def check_name_clash(vocab: Sequence[str], prefix: str = CATEGORY_PREFIX) -> None:
    seen: dict[str, str] = {}
    for v in vocab:
        name = prefix + clean_name(v)
        if name in seen:
            raise ValueError(f"categories {seen[name]!r} and {v!r} both map to column {name!r}")
        seen[name] = v


def one_hot_columns(col: str, vocab: Sequence[str], drop_first: bool = True,
                    prefix: str = CATEGORY_PREFIX) -> dict[str, Column]:
    """Name -> 0/1 expression for every kept category (the baseline dropped)."""
    kept = list(vocab)[1:] if drop_first else list(vocab)
    return {prefix + clean_name(v): flag(col, v) for v in kept}


def one_hot(df: DataFrame, col: str, vocab: Sequence[str], drop_first: bool = True,
            prefix: str = CATEGORY_PREFIX) -> DataFrame:
    """k-1 0/1 columns in a single projection (NULL or unseen -> all 0)."""
    return df.withColumns(one_hot_columns(col, vocab, drop_first, prefix))


def drop_columns(df: DataFrame, names: Sequence[str] = NON_FEATURE_COLUMNS) -> DataFrame:
    """Drop the listed columns that exist (absent names are ignored)."""
    return df.drop(*[n for n in names if n in df.columns])


def feature_columns(df: DataFrame, label: str = LABEL,
                    allow: Sequence[str] | None = None) -> list[str]:
    """Model inputs: the allow-list when given (in its order), else all but the label."""
    if allow is not None:
        missing = [c for c in allow if c not in df.columns]
        if missing:
            raise ValueError(f"feature columns missing: {missing}")
        return list(allow)
    return [c for c in df.columns if c != label]


def base_features(df: DataFrame) -> DataFrame:
    """Time, distance and gender flag on raw transactions (no fitted state)."""
    out = df.withColumns({
        "trans_hour": trans_hour(EVENT_TIME),
        "trans_day_of_week": trans_day_of_week(EVENT_TIME),
        "distance_km": haversine_km(*COORDS),
    })
    return add_flag(out)


# ---------------------------------------------------------------- validity

def invalid_reason(df: DataFrame, cols: Sequence[str], label: str | None = None) -> Column:
    """Comma-separated names of the columns that are NULL (or NaN, for
    floating columns); with a label, ``label`` is reported when it is not 0
    or 1. NULL when the row is valid."""
    fractional = {f.name for f in df.schema.fields
                  if f.dataType.typeName() in ("double", "float")}
    parts = []
    for c in cols:
        x = F.col(c)
        bad = (x.isNull() | F.isnan(x)) if c in fractional else x.isNull()
        parts.append(F.when(bad, F.lit(c)))
    if label is not None:
        parts.append(F.when(~F.coalesce(F.col(label).isin(0, 1), F.lit(False)), F.lit(label)))
    r = F.concat_ws(",", *parts)
    return F.when(r != "", r)


def split_invalid(df: DataFrame, cols: Sequence[str], label: str | None = None,
                  reason_col: str = "reason") -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects with a reason). Both are lazy filters of one scan."""
    tagged = df.withColumn(reason_col, invalid_reason(df, cols, label))
    valid = tagged.where(F.col(reason_col).isNull()).drop(reason_col)
    rejects = tagged.where(F.col(reason_col).isNotNull())
    return valid, rejects


def valid_rows(df: DataFrame, cols: Sequence[str], on_invalid: str = "reject",
               label: str | None = None) -> DataFrame:
    """Rows whose ``cols`` are neither NULL nor NaN.

    ``skip`` and ``reject`` drop bad rows (``reject_rows`` returns them);
    ``error`` fails the job at the first bad row.
    """
    if on_invalid in ("skip", "reject"):
        return split_invalid(df, cols, label)[0]
    if on_invalid == "error":
        reason = invalid_reason(df, cols, label)
        guard = F.when(reason.isNotNull(),
                       F.raise_error(F.concat(F.lit("invalid value in: "), reason)))
        return df.withColumn("_guard", guard).where(F.col("_guard").isNull()).drop("_guard")
    raise ValueError(f"on_invalid must be skip, reject or error, not {on_invalid!r}")


def reject_rows(df: DataFrame, cols: Sequence[str], label: str | None = None) -> DataFrame:
    """Rows with a NULL/NaN checked column or a bad label, with the reason."""
    return split_invalid(df, cols, label)[1]

