"""Which keys differ between a source and its log, without shuffling either.

Each side is added up into an invertible Bloom lookup table: every key falls into
three cells (one of each third of the table), and a cell keeps the number of its
rows, the sum of their 60-bit key ids and the sum of the ids' check values, source
rows counted +1 and log rows -1. Keys that both sides hold equally often cancel. A
cell that is left with one differing key shows it (its sums divide by its count
and agree with the check); taking that key out of its other cells frees the next
ones. Both sides are read by one aggregate of at most ``cells`` rows, whatever
their size; it decodes while the differing keys are fewer than about 0.8 x cells,
and otherwise the exact join names them.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cells of the table (rounded to three equal parts); 24,576 name up to some 19,000 keys.
CELLS = 3 * 8192

DIFFERING = "key string, in_source long, in_log long"


def _hex_number(digest: Column, at: int, n: int) -> Column:
    return F.conv(F.substring(digest, at, n), 16, 10).cast("long")


def key_id(key: str) -> Column:
    """60 bits of a key's md5; NULL is a key of its own."""
    return _hex_number(F.md5(F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit(""))), 1, 15)


def _derived(digest: str, size: int) -> tuple[int, list[int]]:
    return int(digest[:15], 16), [j * size + int(digest[15 + 5 * j:20 + 5 * j], 16) % size for j in range(3)]


def check_and_cells(key_id_: int, size: int) -> tuple[int, list[int]]:
    """Check value and cells of an id, as the aggregate derives them."""
    return _derived(hashlib.md5(str(key_id_).encode()).hexdigest(), size)


def cell_sums(source: DataFrame, log: DataFrame, key: str, log_key: str, size: int) -> DataFrame:
    """(cell, src, log, ids, checks): at most 3 * size rows."""
    both = source.select(key_id(key).alias("id"), F.lit(1).alias("s")).unionByName(
        log.select(key_id(log_key).alias("id"), F.lit(-1).alias("s")))
    digest = both.withColumn("d", F.md5(F.col("id").cast("string")))
    cells = F.array(*[F.lit(j * size) + _hex_number(F.col("d"), 16 + 5 * j, 5) % size for j in range(3)])
    wide, sign = "decimal(38,0)", F.col("s").cast("decimal(2,0)")
    rows = digest.select("id", "s", _hex_number(F.col("d"), 1, 15).alias("check"), F.explode(cells).alias("cell"))
    return rows.groupBy("cell").agg(
        F.count(F.when(F.col("s") > 0, 1)).alias("src"), F.count(F.when(F.col("s") < 0, 1)).alias("log"),
        F.sum((F.col("id").cast("decimal(20,0)") * sign).cast(wide)).alias("ids"),
        F.sum((F.col("check").cast("decimal(20,0)") * sign).cast(wide)).alias("checks"))


def peel(cells: dict[int, tuple[int, int, int]], size: int) -> dict[int, int] | None:
    """{id: source rows minus log rows} of all differing keys from the cells' (net
    count, id sum, check sum); None when some stay hidden."""
    left = {c: list(v) for c, v in cells.items() if any(v)}
    found: dict[int, int] = {}
    todo = list(left)
    while todo:
        cell = todo.pop()
        n, ids, checks = left.get(cell, (0, 0, 0))
        if not n or ids % n or not 0 <= ids // n < 1 << 60:
            continue
        one = ids // n
        check, places = check_and_cells(one, size)
        if checks != n * check or cell not in places:
            continue
        found[one] = found.get(one, 0) + n
        for c in places:
            v = left.setdefault(c, [0, 0, 0])
            v[0] -= n
            v[1] -= n * one
            v[2] -= n * check
            if any(v):
                todo.append(c)
            else:
                del left[c]
    return None if left else {k: n for k, n in found.items() if n}


@dataclass
class Reconciled:
    """Row counts of both sides, the differing keys (rows of DIFFERING), and
    whether the table named them (else the exact join did)."""
    source_rows: int
    log_rows: int
    keys: DataFrame
    decoded: bool


def reconcile(source: DataFrame, log: DataFrame, key: str, log_key: str | None = None,
              cells: int = CELLS) -> Reconciled:
    """Keys that source and log do not hold equally often, and how often each does."""
    log_key, size = log_key or key, max(cells // 3, 1)
    rows = cell_sums(source, log, key, log_key, size).collect()
    first = [r for r in rows if r["cell"] < size]  # every key has one cell in each third
    src, got = sum(r["src"] for r in first), sum(r["log"] for r in first)
    found = peel({r["cell"]: (r["src"] - r["log"], int(r["ids"]), int(r["checks"])) for r in rows}, size)
    if found is None:
        return Reconciled(src, got, differing_by_join(source, log, key, log_key), False)
    spark = source.sparkSession
    ids = spark.createDataFrame([(k,) for k in found], "id long")  # fewer than the cells

    def named(side: DataFrame, k: str, flag: int) -> DataFrame:
        rows = side.select(F.col(k).cast("string").alias("key"), key_id(k).alias("id"))
        return rows.join(F.broadcast(ids), "id").groupBy("id").agg(
            F.min("key").alias("key"), F.count(F.lit(1)).alias("n")).withColumn("src", F.lit(flag))

    both = named(source, key, 1).unionByName(named(log, log_key, 0))
    n = F.col("n")
    out = both.groupBy("id").agg(
        F.min("key").alias("key"), F.coalesce(F.sum(F.when(F.col("src") == 1, n)), F.lit(0)).alias("in_source"),
        F.coalesce(F.sum(F.when(F.col("src") == 0, n)), F.lit(0)).alias("in_log")).drop("id")
    return Reconciled(src, got, out, True)


def differing_by_join(source: DataFrame, log: DataFrame, key: str, log_key: str) -> DataFrame:
    """The same keys by counting each side per key and joining the counts."""
    s = source.groupBy(F.col(key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("ns"))
    g = log.groupBy(F.col(log_key).cast("string").alias("other")).agg(F.count(F.lit(1)).alias("ng"))
    j = s.join(g, F.col("key").eqNullSafe(F.col("other")), "full_outer")
    return j.select(F.coalesce("key", "other").alias("key"), F.coalesce("ns", F.lit(0)).alias("in_source"),
                    F.coalesce("ng", F.lit(0)).alias("in_log")).where("in_source != in_log")
