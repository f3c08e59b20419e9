"""Packing token sequences by cutting-stock column generation.

1. Every text is encoded once (``llm.bpe``) and ends with ``EOS``. It is cut
   into full sequences, one main piece of whole grains (``GRAIN`` tokens) and
   a tail shorter than a grain, so piece lengths fall into at most
   ``CAPACITY / GRAIN + GRAIN`` classes whatever the corpus holds.
2. The length histogram (one row per class) goes to the driver. A linear
   program over packing patterns is solved by column generation: a basis of
   patterns, its dual prices, and a knapsack dynamic program that prices the
   best new pattern. Patterns are rounded down; what is left (less than one
   pattern per class) is filled greedily.
3. Pieces are ranked inside their class (in salted groups whose counts are
   summed up, so no class passes through one task) and the rank alone gives
   sequence and offset from the plan, a table of a few hundred rows.

Defined results: null or empty text is one piece with the id ``EOS``; an empty
table gives no rows; repeated rows are packed each; a text of any length is
cut, never dropped; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnscore.llm.bpe import chunked, vocabulary_path
from txnscore.llm.common import ship, written

CAPACITY, GRAIN, EOS = 4096, 32, 2
#: Pieces per salted ranking group.
GROUP_ROWS = 20_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLAN = "length long, first long, last long, copies long, sequence long, offset long"


def cuts(tokens: int) -> list[int]:
    """Piece boundaries of a text: full sequences, whole grains, tail."""
    full = tokens // CAPACITY * CAPACITY
    main = full + (tokens - full) // GRAIN * GRAIN
    return sorted({*range(0, full + 1, CAPACITY), main, tokens})


def pieces(docs: DataFrame, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """The pieces of every text; with ``keep_ids`` also their token ids."""
    ship(docs.sparkSession)
    schema = PIECES + (", ids array<int>" if keep_ids else "")

    def task(batches):
        coder = chunked(path or vocabulary_path())
        end = struct.pack("<I", EOS)
        for b in coder.blocks(batches):
            out = []
            for doc, values in zip(b.column("doc_id").to_pylist(), coder.block(b.column("text").to_pylist())):
                raw = memoryview(b"".join([*values, end]))
                tokens = len(raw) // 4
                at = cuts(tokens)
                for a, z in zip(at, at[1:]):
                    part = raw[4 * a:4 * z]
                    row = (doc, a, z - a, zlib.crc32(part), tokens)
                    out.append((*row, np.frombuffer(part, "<i4")) if keep_ids else row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.list_(pa.int32()) if k == 5 else pa.int64()) for k, c in enumerate(zip(*out))],
                names=[x.split()[0] for x in schema.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(task, schema)


def best_pattern(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of the highest total price."""
    value, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = np.flatnonzero(lengths <= room)
        value[room] = value[room - 1]
        if len(fits):
            v = value[room - lengths[fits]] + prices[fits]
            k = int(v.argmax())
            if v[k] > value[room] + 1e-12:
                value[room], take[room] = v[k], fits[k]
    out, room = np.zeros(len(lengths)), capacity
    while room > 0:
        if take[room] < 0:
            room -= 1
        else:
            out[take[room]] += 1
            room -= lengths[take[room]]
    return value[capacity], out


def column_generation(lengths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 400):
    """Patterns (columns) and their amounts of the cutting-stock linear program.

    Any round ends with a feasible basis; it stops when the amounts are within
    0.2 % of the total length, which no packing can beat."""
    basis = np.diag((capacity // lengths).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    least = float(lengths @ demand) / capacity
    for _ in range(rounds):
        amounts = np.maximum(inverse @ demand, 0)
        if amounts.sum() <= least * 1.002 + 0.5:
            break
        value, new = best_pattern(lengths, inverse.sum(axis=0), capacity)
        if value <= 1 + 1e-9:
            break
        direction = inverse @ new
        up = direction > 1e-9
        ratio = np.full(len(demand), np.inf)
        ratio[up] = amounts[up] / direction[up]
        out = int(ratio.argmin())
        basis[:, out] = new
        pivot = inverse[out] / direction[out]  # the inverse follows the exchanged column
        inverse -= np.outer(direction, pivot)
        inverse[out] = pivot
    return basis, np.maximum(inverse @ demand, 0)


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Rounded patterns ({length: copies}, repeats) that hold every piece exactly once."""
    left = {n: c for n, c in histogram.items() if c}
    if not left:
        return []
    lengths = np.array(sorted(left))
    unit = int(np.gcd.reduce([*lengths, capacity]))
    columns, amounts = column_generation(
        lengths // unit, np.array([left[int(n)] for n in lengths], float), capacity // unit)
    out = []

    def use(pattern: dict[int, int], most: int) -> None:
        times = min([most, *(left[n] // a for n, a in pattern.items())])
        if times > 0:
            out.append((pattern, times))
            for n, a in pattern.items():
                left[n] -= a * times

    held = [({int(n): round(a) for n, a in zip(lengths, column) if a}, x) for column, x in zip(columns.T, amounts)]
    for pattern, x in held:
        use(pattern, int(x + 1e-6))
    for pattern, _ in sorted(held, key=lambda h: h[1] % 1, reverse=True):
        use(pattern, 1)  # the largest fractions first, where their pieces are still left
    while any(left.values()):  # less than a pattern's worth of each class
        pattern, room = {}, capacity
        for n in sorted(left, reverse=True):
            if a := min(left[n], room // n):
                pattern[n] = a
                room -= a * n
        use(pattern, max(left.values()))
    return out


def plan(histogram: dict[int, int]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows of PLAN: ranks first..last (exclusive) of a class go, ``copies`` to
    each, to the sequences from ``sequence`` on, at ``offset``."""
    small = {n: c for n, c in histogram.items() if n < GRAIN}
    rest = {n: c for n, c in histogram.items() if GRAIN <= n < CAPACITY}
    found = [({CAPACITY: 1}, histogram[CAPACITY])] if histogram.get(CAPACITY) else []
    found += patterns(rest, CAPACITY) + patterns(small, CAPACITY)
    out, used, sequence = [], dict.fromkeys(histogram, 0), 0
    for pattern, times in found:
        offset = 0
        for n, copies in sorted(pattern.items(), reverse=True):
            out.append((n, used[n], used[n] + copies * times, copies, sequence, offset))
            used[n] += copies * times
            offset += copies * n
        sequence += times
    return out


def pack(cut: DataFrame) -> DataFrame:
    """sequence_id and offset for every row of PIECES (a stored table: it is read
    more than once)."""
    spark = cut.sparkSession
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    salts = sum(histogram.values()) // GROUP_ROWS + 1
    key = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts))
    salted = cut.withColumn("salt", key)
    counted = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = (salted.withColumn("row", F.row_number().over(inside) - 1).join(offsets, ["length", "salt"])
              .withColumn("rank", F.col("before") + F.col("row")))
    p = spark.createDataFrame(plan(histogram), PLAN).alias("p")
    r = ranked.alias("r")
    hit = ((F.col("r.length") == F.col("p.length")) & (F.col("rank") >= F.col("p.first"))
           & (F.col("rank") < F.col("p.last")))
    nth = F.col("rank") - F.col("p.first")
    return r.join(F.broadcast(p), hit).select(
        "r.doc_id", "r.start", "r.length", "r.ids_crc32", "r.doc_tokens",
        (F.col("p.sequence") + F.floor(nth / F.col("p.copies"))).cast("long").alias("sequence_id"),
        (F.col("p.offset") + F.pmod(nth, F.col("p.copies")) * F.col("r.length")).cast("long").alias("offset"))


def op9(spark, sf_dir: str) -> DataFrame:
    return pack(written(pieces(spark.read.parquet(f"{sf_dir}/documents.parquet")), "packing-pieces"))
