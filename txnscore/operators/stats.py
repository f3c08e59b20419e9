"""Distributed running sums and exact quantiles.

A window ``sum(...) over (order by x)`` without PARTITION BY moves the whole
table into one task. ``running_totals`` computes the same inclusive running
sums as a prefix sum over ranges instead:

1. range bounds are fixed once, from a quantile sketch of the order key, so a
   row's range is a pure function of its key in every later pass;
2. totals per range -> at most ``ranges x groups`` rows;
3. exclusive offsets of those totals (a window over that small table);
4. a window per range, plus its offset: the only shuffle of the rows.

Order keys must be unique within a group: aggregate first (``groupBy(key)``
with map-side partial aggregation), which also absorbs any hot key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

_RANGE = "_range"
# Ranges per task slot: several small ones even out where their hashes fall.
RANGES_PER_SLOT = 4


def default_parallelism(spark) -> int:
    """Total task slots of the cluster (falls back to the shuffle setting)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # e.g. no SparkContext access on a remote session
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_bounds(df: DataFrame, col: str, n: int) -> list[float]:
    """At most ``n - 1`` distinct inner bounds that cut ``col`` into even ranges."""
    if n < 2:
        return []
    key = F.col(col).cast("double")
    probs = [i / n for i in range(1, n)]
    found = df.select(key.alias("k")).where(~F.isnan("k")).approxQuantile("k", probs, 1 / (4 * n))
    return sorted(set(found))


def with_range(df: DataFrame, col: str, bounds: Sequence[float], out: str = _RANGE) -> DataFrame:
    """Add the index of the range that ``col`` falls into (increasing with it;
    NULL and NaN form a range of their own, the last)."""
    if not bounds:
        return df.withColumn(out, F.lit(0.0))
    key = f"{out}_key"
    cut = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol=key, outputCol=out, handleInvalid="keep")
    return cut.transform(df.withColumn(key, F.col(col).cast("double"))).drop(key)


def running_totals(df: DataFrame, order_col: str, sum_cols: Sequence[str],
                   group_cols: Sequence[str] = (), descending: bool = False,
                   num_partitions: int | None = None,
                   cum_prefix: str = "cum_", total_prefix: str = "total_") -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum in key order) and ``total_<c>``
    (group total) for every ``c`` in ``sum_cols``. The order key is numeric."""
    n = num_partitions or RANGES_PER_SLOT * default_parallelism(df.sparkSession)
    group_cols = list(group_cols)
    parted = with_range(df, order_col, range_bounds(df, order_col, n))

    def order(c):
        return F.col(c).desc() if descending else F.col(c).asc()

    tot = parted.groupBy(*group_cols, _RANGE).agg(
        *[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    before = Window.partitionBy(*group_cols).orderBy(order(_RANGE)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*group_cols)
    offsets = tot.select(
        *group_cols, _RANGE,
        *[(F.sum(f"_t_{c}").over(before) - F.col(f"_t_{c}")).alias(f"_o_{c}") for c in sum_cols],
        *[F.sum(f"_t_{c}").over(whole).alias(f"{total_prefix}{c}") for c in sum_cols])

    inner = (Window.partitionBy(*group_cols, _RANGE).orderBy(order(order_col))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = parted.select("*", *[F.sum(c).over(inner).alias(f"_in_{c}") for c in sum_cols])
    joined = summed.join(offsets, [*group_cols, _RANGE])
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"_in_{c}") + F.col(f"_o_{c}")).alias(f"{cum_prefix}{c}") for c in sum_cols],
        *[F.col(f"{total_prefix}{c}") for c in sum_cols])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a small grouped table to the shared folder and read it back, so that
    what it was grouped from is read once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def long_values(df: DataFrame, cols: Sequence[str], name_col: str = "column",
                value_col: str = "value") -> DataFrame:
    """Unpivot numeric columns to (column, value) as doubles, dropping NULL and NaN."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias(name_col), F.col(c).cast("double").alias(value_col))
        for c in cols])).alias("_kv")
    v = F.col(value_col)
    return df.select(pairs).select("_kv.*").where(v.isNotNull() & ~F.isnan(v))


# Sketch error used to bracket exact quantiles (rank error at most eps * n).
BAND_EPS = 0.001


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    num_partitions: int | None = None, method: str = "band",
                    eps: float = BAND_EPS) -> DataFrame:
    """Discrete quantiles: for each column and p, the smallest value whose
    cumulative share reaches p (rank ceil(p*n), as SQL ``percentile_disc``).

    Returns rows ``(column, p, value)``; NULL and NaN are ignored. No value
    list is gathered in one task.

    ``band`` (default): a mergeable sketch (``approxQuantile``, rank error at
    most ``eps * n``) gives values L and U whose ranks bracket the target
    rank; a second pass counts the rows below L and keeps those inside [L, U]
    (about ``6 * eps`` of the data per quantile), which are written and ranked
    exactly. The data are read twice. ``full``: rank every distinct value (one shuffle of
    all values; kept as the reference for tests).
    """
    cols, probs = list(cols), [float(q) for q in probs]
    if method == "full":
        return _quantiles_by_rank(long_values(df, cols), probs, num_partitions)
    if method != "band":
        raise ValueError(f"method must be band or full, not {method!r}")

    clean = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c)
                        for c in cols])
    # The sketch's answer for q has rank within eps*n of q*n, so asking for
    # q -/+ 3 eps brackets rank ceil(q*n) with a margin of 2 eps*n ranks.
    lo_p = [max(q - 3 * eps, 0.0) for q in probs]
    hi_p = [min(q + 3 * eps, 1.0) for q in probs]
    sketch = clean.approxQuantile(cols, lo_p + hi_p, eps)     # len(cols) x 2 len(probs) numbers
    bounds = {}
    for c, vals in zip(cols, sketch):
        for i, q in enumerate(probs):
            lo = None if lo_p[i] <= 0.0 or not vals else vals[i]
            hi = None if hi_p[i] >= 1.0 or not vals else vals[len(probs) + i]
            bounds[(c, q)] = (lo, hi)

    # One pass for both: every row adds to a counter of its columns' values by the bands
    # they lie below (at most len(probs) + 1 of a column), and rows inside a band are
    # kept with their value. The few grouped rows are written; all else reads those.
    entries = []
    for c in cols:
        below = F.lit(0)
        for i, q in enumerate(probs):
            lo, hi = bounds[(c, q)]
            cond = F.col(c).isNotNull()
            if lo is not None:
                below = below + F.when(F.col(c) < F.lit(lo), 1 << i).otherwise(0)
                cond = cond & (F.col(c) >= F.lit(lo))
            if hi is not None:
                cond = cond & (F.col(c) <= F.lit(hi))
            entries.append(F.when(cond, F.struct(F.lit(c).alias("column"), F.lit(q).alias("p"), F.col(c).alias("value"),
                                                 F.lit(0).alias("below"))))
        entries.append(F.when(F.col(c).isNotNull(), F.struct(
            F.lit(c).alias("column"), F.lit(None).cast("double").alias("p"), F.lit(None).cast("double").alias("value"),
            below.alias("below"))))
    each = clean.select(F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull())).alias("b")).select("b.*")
    found = stored(each.groupBy("column", "p", "value", "below").agg(F.count(F.lit(1)).alias("n")), "quantile-bands")
    counts: dict = {}
    for r in found.where("p is null").collect():
        counts[f"n::{r['column']}"] = counts.get(f"n::{r['column']}", 0) + r["n"]
        for i, q in enumerate(probs):
            k = f"below::{r['column']}::{q!r}"
            counts[k] = counts.get(k, 0) + (r["n"] if r["below"] >> i & 1 else 0)
    bounds = {b: v for b, v in bounds.items() if f"n::{b[0]}" in counts}
    grouped = found.where("p is not null").select("column", "p", "value", "n")
    cum = running_totals(grouped, "value", ["n"], group_cols=["column", "p"],
                         num_partitions=num_partitions)
    # Target rank inside the band: ceil(p * n) minus the rows below it.
    target = F.lit(0)
    for (c, q) in bounds:
        n = counts[f"n::{c}"]
        r = max(math.ceil(q * n), 1) - counts[f"below::{c}::{q!r}"]
        target = F.when((F.col("column") == c) & (F.col("p") == q), F.lit(r)).otherwise(target)
    return (cum.where((F.col("cum_n") >= target) & (F.col("cum_n") - F.col("n") < target))
               .select("column", "p", "value"))


def _quantiles_by_rank(values: DataFrame, probs: Sequence[float], num_partitions: int | None) -> DataFrame:
    counts = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    cum = running_totals(counts, "value", ["n"], group_cols=["column"],
                         num_partitions=num_partitions)
    p = F.col("p")
    rank = F.greatest(F.ceil(p * F.col("total_n")), F.lit(1))
    return (cum.select("column", "value", "n", "cum_n", "total_n",
                       F.explode(F.array(*[F.lit(float(q)) for q in probs])).alias("p"))
               .where((F.col("cum_n") >= rank) & (F.col("cum_n") - F.col("n") < rank))
               .select("column", "p", "value"))


# The first ranks of a hashed order: buckets per narrowing step, rows that need none.
CUT_BUCKETS, CUT_ROWS = 4096, 20_000


@dataclass(frozen=True)
class Cut:
    """Where the first ``k`` rows in the order (hash of key, key, hash of row) end:
    ``taken`` of the ``of`` equal rows at the cut belong to them."""
    unit: float | None
    key: str
    row: int
    taken: int
    of: int

    def before(self) -> Column:
        """Rows ahead of the cut (over the columns of ``with_order``)."""
        if self.unit is None:
            return F.lit(False)
        u, k, r = (F.col(c) for c in ORDER)
        return (u < self.unit) | ((u == self.unit) & ((k < self.key) | ((k == self.key) & (r < self.row))))

    def at(self) -> Column:
        if self.unit is None:
            return F.lit(False)
        u, k, r = (F.col(c) for c in ORDER)
        return (u == self.unit) & (k == self.key) & (r == self.row)


ORDER = ("_unit", "_order_key", "_row_hash")


def with_order(df: DataFrame, key: str, salt: str) -> DataFrame:
    """Add the hashed order: a uniform number from the key, the key, a hash of the
    whole row. Rows equal in all three are equal rows (NULL keys read as empty)."""
    from .split import hash_unit
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    out = df.withColumn("_row_hash", F.xxhash64(*df.columns)).withColumn("_order_key", text)
    return out.withColumn("_unit", hash_unit("_order_key", salt)).select(*df.columns, *ORDER)


def _narrow(df: DataFrame, col: str, low: float, high: float, need: int) -> tuple[float, float, int]:
    """The part of [low, high) in which the ``need``-th smallest value of ``col`` lies,
    small enough to list, and its rank there. Each step is one aggregate of at most
    CUT_BUCKETS rows; widths are powers of two, so bounds are exact."""
    while True:
        c = F.col(col)
        width = (high - low) / CUT_BUCKETS
        inside = df.where((c >= low) & (c < high))
        counts = dict(inside.groupBy(F.floor((c - low) / width).alias("b")).agg(F.count(F.lit(1))).collect())
        if sum(counts.values()) <= CUT_ROWS or low + width == low:
            return low, high, need
        for b in sorted(counts):
            if need <= counts[b]:
                low, high = low + b * width, low + (b + 1) * width
                break
            need -= counts[b]
        if width <= 2.0 ** -52:  # no doubles in between
            return low, high, need


def _walk(rows, need: int):
    """The row of a sorted listing in whose count the ``need``-th falls, and its rank there."""
    for r in rows:
        if need <= r["n"]:
            return r, need
        need -= r["n"]
    raise ValueError("fewer rows than ranks asked for")


def cut_after(ordered: DataFrame, k: int) -> Cut:
    """The cut after the first ``k`` rows of ``with_order``'s order, found by
    narrowing histograms: no sort, and one key may hold any share of the rows."""
    if k <= 0:
        return Cut(None, "", 0, 0, 0)
    unit, key, row = ORDER
    n = F.count(F.lit(1)).alias("n")
    low, high, need = _narrow(ordered, unit, 0.0, 1.0, k)
    inside = ordered.where((F.col(unit) >= low) & (F.col(unit) < high))
    at, need = _walk(inside.groupBy(unit, key).agg(n).orderBy(unit, key).collect(), need)
    same = ordered.where((F.col(unit) == at[unit]) & (F.col(key) == at[key]))
    # rows of one key, by the hash of the row (scaled to [0, 1) for narrowing)
    scaled = same.withColumn("_scaled", F.col(row) / F.lit(2.0 ** 64) + 0.5)
    low, high, need = _narrow(scaled, "_scaled", 0.0, 1.0, need)
    inside = scaled.where((F.col("_scaled") >= low) & (F.col("_scaled") < high))
    last, need = _walk(inside.groupBy(row).agg(n).orderBy(row).collect(), need)
    return Cut(at[unit], at[key], last[row], need, last["n"])
