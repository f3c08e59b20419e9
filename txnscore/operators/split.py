"""Train/test splits."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import KEY
from .stats import ORDER, cut_after, with_order

# Salt of the split draw, and 2^32 (the range of 8 hex digits).
SPLIT_SALT = ":split"
HEX8_RANGE = 4294967296.0


def hash_unit(key: str, salt: str) -> Column:
    """A uniform number in [0, 1) from md5(key || salt): the first 8 hex
    digits read as an unsigned integer over 2^32. Deterministic across runs,
    engines and partitionings."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(salt)))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(HEX8_RANGE)


def split_hash(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), key: str = KEY,
               salt: str = SPLIT_SALT) -> list[DataFrame]:
    """Key-hash split: narrow (no shuffle), repeatable, sides disjoint by key.

    Rows with a NULL key belong to no side: reject them first
    (``features.split_invalid`` with the key among the checked columns).
    """
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        acc += w / total
        bounds.append(acc)
    u = hash_unit(key, salt)
    out, lo = [], 0.0
    for i, hi in enumerate(bounds):
        cond = u >= F.lit(lo) if i else F.lit(True)
        if i < len(bounds) - 1:
            cond = cond & (u < F.lit(hi))
        out.append(df.where(cond))
        lo = hi
    return out


def split_side(df: DataFrame, train_fraction: float = 0.8, key: str = KEY,
               salt: str = SPLIT_SALT, side_col: str = "side") -> DataFrame:
    """The same split as a column ('train' / 'test')."""
    return df.withColumn(side_col, F.when(hash_unit(key, salt) < F.lit(train_fraction), "train")
                                   .otherwise("test"))


def split_random(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """``randomSplit`` as the reference (sizes depend on partitioning)."""
    return df.randomSplit(list(weights), seed=seed)


def split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), mode: str = "hash",
          key: str = KEY, seed: int = 42) -> list[DataFrame]:
    """Train/test split: ``hash`` (default, repeatable) or ``random`` (randomSplit)."""
    if mode == "hash":
        return split_hash(df, weights, key)
    if mode == "random":
        return split_random(df, weights, seed)
    raise ValueError(f"mode must be hash or random, not {mode!r}")


def split_stratified(df: DataFrame, label: str, train_fraction: float = 0.8, key: str = KEY,
                     salt: str = SPLIT_SALT, side_col: str = "side", max_classes: int = 100) -> DataFrame:
    """Add ``side``: of every class exactly the share ``train_fraction`` of its rows
    (rounded half up) is 'train', those with the smallest key hashes, ties by key.

    Class counts and each class's cut reach the driver (``max_classes`` classes at
    most); the rows are only projected. Equal rows at a cut are dealt by number."""
    counts = df.groupBy(F.col(label).alias("c")).agg(F.count(F.lit(1)).alias("n")).limit(max_classes + 1).collect()
    if len(counts) > max_classes:
        raise ValueError(f"{label} has more than {max_classes} classes")
    ordered, side, equal, out = with_order(df, key, salt), F.lit("test"), F.lit(False), []
    for c, n in counts:
        own = F.col(label).eqNullSafe(F.lit(c))
        cut = cut_after(ordered.where(own), math.floor(train_fraction * n + 0.5))
        side = F.when(own & (cut.before() | (cut.at() & F.lit(cut.taken == cut.of))), "train").otherwise(side)
        if cut.taken < cut.of:
            equal = equal | (own & cut.at())
            one = ordered.where(own & cut.at()).dropDuplicates(list(ORDER))
            for name, times in (("train", cut.taken), ("test", cut.of - cut.taken)):
                out.append(one.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("_n")
                           .withColumn(side_col, F.lit(name)))
    whole = ordered.where(~equal).withColumn(side_col, side)
    for part in out:
        whole = whole.unionByName(part)
    return whole.drop(*ORDER)
