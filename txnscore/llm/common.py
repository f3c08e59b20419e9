"""What the text operators share: shipping the package to executors, written
intermediate tables, and splitting and hashing words of whole Arrow columns.

Words are runs of bytes other than space and \\t..\\r. They are found and
hashed for many texts at once on the UTF-8 bytes that Arrow delivers; a text is
never cut short.
"""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscore.session import scratch_path

#: Text bytes handled at a time inside a task (a longer text is a block alone).
BLOCK_BYTES = 2 << 20
#: The same where a block's arrays are many times its bytes (scores by word, letter steps).
SMALL_BLOCK = 1 << 19
#: Bytes of rows that Spark hands to a task's Python at a time, unless the session says otherwise.
#: Without it a batch is 10,000 rows, however long their texts, in the JVM and in Python.
ARROW_BYTES, ARROW_CONF = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
_BASE, _MOD = 0x9E3779B97F4A7C15, 1 << 64
_MIX = np.array([0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)
_POWERS: dict[str, np.ndarray] = {}


#: Bytes that part words when only letters matter (all but ASCII letters and non-ASCII).
NON_LETTERS = np.ones(256, bool)
NON_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that tasks
    can import it wherever they run, and bound the bytes of the session's Arrow batches."""
    sc = spark.sparkContext
    if spark.conf.get(ARROW_CONF, None) is None:
        spark.conf.set(ARROW_CONF, ARROW_BYTES)
    if getattr(sc, "_txnscore_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = os.path.join(tempfile.mkdtemp(prefix="txnscore-code-"), "txnscore_code.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "txnscore")):
            for n in names:
                if n.endswith(".py"):
                    p = os.path.join(folder, n)
                    z.write(p, os.path.relpath(p, root))
    sc.addPyFile(out)
    sc._txnscore_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: later stages start from files
    that survive a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def blocks(batches, text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``limit`` text bytes, at least one row each."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < n:
            base = size[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(size, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n+1 offsets of its rows (null: empty)."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte stays."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def find_words(data: np.ndarray, offsets: np.ndarray,
               gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the n+1 word offsets of the rows;
    ``gaps``: for each byte value, whether it parts words."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    gap = gaps[data]
    first, last = ~gap, ~gap
    first[1:] &= gap[:-1]
    last[:-1] &= gap[1:]
    begin = offsets[:-1][offsets[:-1] < offsets[1:]]
    end = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    first[begin] = ~gap[begin]
    last[end] = ~gap[end]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SMALL_BLOCK, min(1 << n.bit_length(), BLOCK_BYTES))
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, _MOD))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[key] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[0]
    x ^= x >> np.uint64(29)
    x *= _MIX[1]
    x ^= x >> np.uint64(32)
    return x


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, the same wherever the span stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    weight = _BYTE[data]
    weight *= up
    np.cumsum(weight, out=total[1:])
    del weight
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hash_ngrams(words: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows inside rows, and the word index each starts at.

    ``words``: word hashes; ``rows``: the word offsets of the rows."""
    room = np.maximum(np.diff(rows) - (n - 1), 0)
    total = int(room.sum())
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.arange(total) + np.repeat(rows[:-1] - (np.cumsum(room) - room), room)
    out = np.zeros(total, np.uint64)
    for k in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[at + k]
    return mix(out), at


@contextmanager
def uncollected():
    """Without cyclic garbage collection: a block's work makes no cycles, and going
    through large caches again and again costs more than the work."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class HashTable:
    """A fixed-size slot table from 64-bit hashes to numbers (0: not there).

    A key whose slot is taken goes to the next free one; the whole key is compared,
    so a hash that was not put in is not found. Of equal keys the first counts."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: int):
        while len(keys) * 4 > 1 << bits:
            bits += 1
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, np.int32)
        self.probes, one = 0, np.uint64(1)
        keys, first = np.unique(keys, return_index=True)
        values, slot = values[first], keys & self.mask
        while len(keys):
            self.probes += 1
            free = self.values[slot] == 0
            _, take = np.unique(np.where(free, slot, slot | (one << np.uint64(63))), return_index=True)
            take = take[free[take]]
            self.keys[slot[take]], self.values[slot[take]] = keys[take], values[take]
            left = np.ones(len(keys), bool)
            left[take] = False
            keys, values, slot = keys[left], values[left], (slot[left] + one) & self.mask

    def find(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes & self.mask
        out = np.where(self.keys[slot] == hashes, self.values[slot], 0)
        for k in range(1, self.probes):
            slot = (hashes + np.uint64(k)) & self.mask
            out = np.where(self.keys[slot] == hashes, self.values[slot], out)
        return out


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes as Spark longs."""
    return x.view(np.int64)


def crc_bucket(col, n: int):
    """crc32 of an id as text, modulo ``n``: the fold rule of the held-out rows."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n
