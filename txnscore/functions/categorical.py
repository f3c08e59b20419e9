"""Flags, category names and class names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters replaced in category names, and their replacement.
NAME_CHARS = " /"
NAME_REPLACEMENT = "_"
# Class names of a 0/1 decision.
FRAUD, GENUINE = "fraud", "genuine"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(c, value) -> Column:
    """1 where the column equals ``value``, else 0 (NULL gives 0)."""
    return F.when(_c(c) == F.lit(value), 1).otherwise(0)


def clean_name(s: str) -> str:
    """Category value -> column-name-safe text (space and '/' become '_')."""
    out = str(s)
    for ch in NAME_CHARS:
        out = out.replace(ch, NAME_REPLACEMENT)
    return out


def clean_value(c) -> Column:
    """The same cleaning as a Column expression."""
    return F.translate(_c(c), NAME_CHARS, NAME_REPLACEMENT * len(NAME_CHARS))


def class_name(c) -> Column:
    """'fraud' for a 1 decision, 'genuine' otherwise."""
    return F.when(_c(c) == 1, F.lit(FRAUD)).otherwise(F.lit(GENUINE))
