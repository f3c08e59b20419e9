"""Class filters, class balance and oversampling."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import KEY, LABEL
from .split import hash_unit
from .stats import ORDER, cut_after, default_parallelism, with_order

# Fixed value: salt appended to the key for the oversampling draw.
OVERSAMPLE_SALT = ":os"


def by_class(df: DataFrame, value: int, label: str = LABEL) -> DataFrame:
    """Rows of one class."""
    return df.where(F.col(label) == F.lit(value))


def class_counts_columns(label: str = LABEL) -> list[Column]:
    y = F.col(label)
    return [F.count(F.when(y == 0, 1)).alias("legit"),
            F.count(F.when(y == 1, 1)).alias("fraud")]


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: legit, fraud and ratio legit/fraud (NULL when there is no fraud).

    A single partial + final aggregate over one scan (not one job per class).
    """
    c = df.agg(*class_counts_columns(label))
    return c.withColumn("ratio", F.when(F.col("fraud") > 0,
                                        F.col("legit").cast("double") / F.col("fraud")))


def oversample_ratio(df: DataFrame, label: str = LABEL) -> float:
    """legit / fraud, from one aggregate (one row reaches the driver)."""
    row = class_balance(df, label).first()
    if not row["fraud"]:
        raise ValueError("no minority (fraud) rows: the oversampling ratio is undefined")
    return float(row["legit"]) / float(row["fraud"])


def copies_column(ratio: float, key: str = KEY, salt: str = OVERSAMPLE_SALT) -> Column:
    """floor(r) copies, plus one more where the key's hash falls below frac(r).

    The expected count is r per row and the draw is a pure function of the
    key, so reruns and retries produce the same rows on any partitioning.
    """
    whole = math.floor(ratio)
    frac = ratio - whole
    return (F.lit(whole) + F.when(hash_unit(key, salt) < F.lit(frac), 1).otherwise(0)).cast("int")


# Rows per task after the fan-out of the minority copies, and the most
# copies of one row expanded in one task.
ROWS_PER_SPREAD_PARTITION = 2_000_000
COPY_CHUNK = 100_000


def oversample(df: DataFrame, label: str = LABEL, mode: str = "exact", seed: int = 42,
               key: str = KEY, ratio: float | None = None, minority: int = 1,
               minority_rows: int | None = None, spread_partitions: int | None = None,
               copy_col: str | None = "copy", majority_rows: int | None = None) -> DataFrame:
    """Minority rows repeated to the majority's size (down-sampled when r < 1).

    ``equal``: exactly the majority's size. Every row is copied floor(r) times and
    the remainder goes to the rows with the smallest key hashes; the cut is found
    by narrowing histograms of the hash, without a sort.

    ``exact``: a hash-decided number of copies per key. Before the fan-out
    the (small) minority class is spread round-robin over enough tasks for
    the expected output (``minority_rows * ratio`` rows, at least one task
    per core of the cluster), so neither a
    partition that happens to hold many minority rows nor a repeated key can
    turn into one huge task. Round-robin is retry-safe: Spark sorts each
    partition before assigning rows (``sortBeforeRepartition``).
    ``poisson``: ``sample(withReplacement=True, ratio, seed)`` as the
    reference; its size is only expected, and depends on partitioning.
    """
    spark = df.sparkSession
    if ratio is None or minority_rows is None:
        row = class_balance(df, label).first()
        if not row["fraud"]:
            raise ValueError("no minority (fraud) rows: the oversampling ratio is undefined")
        majority_rows = int(row["legit"]) if ratio is None else majority_rows
        ratio = float(row["legit"]) / float(row["fraud"]) if ratio is None else ratio
        minority_rows = int(row["fraud"]) if minority_rows is None else minority_rows
    minor = by_class(df, minority, label)
    if mode == "poisson":
        out = minor.sample(withReplacement=True, fraction=ratio, seed=seed)
        return out.withColumn(copy_col, F.lit(None).cast("int")) if copy_col else out
    n = spread_partitions or max(
        default_parallelism(spark),
        math.ceil(minority_rows * max(ratio, 1.0) / ROWS_PER_SPREAD_PARTITION))
    if mode == "equal":
        return _expand(_equal_copies(minor, majority_rows if majority_rows is not None else round(ratio * minority_rows),
                                     minority_rows, key), n, copy_col)
    if mode != "exact":
        raise ValueError(f"mode must be equal, exact or poisson, not {mode!r}")
    return _expand(minor.withColumn("_copies", copies_column(ratio, key)), n, copy_col)


def _equal_copies(minor: DataFrame, majority_rows: int, minority_rows: int, key: str) -> DataFrame:
    """``_copies`` that add up to ``majority_rows``: the whole ratio for every row, and
    one more for the rows with the smallest key hashes (ties by key). Of equal rows
    at the cut one stands for all."""
    whole, rest = divmod(majority_rows, minority_rows)
    ordered = with_order(minor, key, OVERSAMPLE_SALT)
    cut = cut_after(ordered, rest)
    copies = (F.lit(whole) + cut.before().cast("int")).cast("long")
    out = ordered.where(~cut.at()).withColumn("_copies", copies)
    if cut.of:
        one = ordered.where(cut.at()).dropDuplicates(list(ORDER)).withColumn("_copies", F.lit(whole * cut.of + cut.taken).cast("long"))
        out = out.unionByName(one)
    return out.drop(*ORDER)


def _expand(counted: DataFrame, n: int, copy_col: str | None) -> DataFrame:
    """Every row ``_copies`` times, spread over ``n`` tasks first."""
    # A huge ratio would put all copies of one row into one task: cut each
    # row's copies into chunks, spread the chunks, then expand them.
    chunks = counted.where(F.col("_copies") > 0).withColumn("_chunk", F.explode(F.sequence(
        F.lit(0), ((F.col("_copies") - 1) / F.lit(COPY_CHUNK)).cast("int"))))
    spread = chunks.repartition(n)
    lo = (F.col("_chunk") * F.lit(COPY_CHUNK) + 1).cast("int")
    hi = F.least(F.col("_chunk") * F.lit(COPY_CHUNK) + F.lit(COPY_CHUNK), F.col("_copies")).cast("int")
    out = spread.withColumn("_copy", F.explode(F.sequence(lo, hi))).drop("_chunk")
    out = out.drop("_copies")
    return out.withColumnRenamed("_copy", copy_col) if copy_col else out.drop("_copy")


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union keeping duplicates, matched by column name (not position); a column
    that only one side has is an error."""
    return a.unionByName(b)


def balance(df: DataFrame, label: str = LABEL, mode: str = "exact", seed: int = 42,
            key: str = KEY, copy_col: str | None = "copy",
            counts: tuple[int, int] | None = None) -> DataFrame:
    """Majority rows plus oversampled minority rows.

    ``counts`` = (legit, fraud) of ``df`` when the caller already has them
    (e.g. from a combined gate aggregate); otherwise one counting job runs.
    """
    if counts is None:
        row = class_balance(df, label).first()
        counts = (int(row["legit"]), int(row["fraud"]))
    legit_n, fraud_n = counts
    if not fraud_n:
        raise ValueError("no minority (fraud) rows: the oversampling ratio is undefined")
    ratio = float(legit_n) / float(fraud_n)
    legit = by_class(df, 0, label)
    if copy_col:
        legit = legit.withColumn(copy_col, F.lit(1))
    return union_all(legit, oversample(df, label, mode, seed, key, ratio, minority_rows=fraud_n,
                                       copy_col=copy_col, majority_rows=legit_n))
