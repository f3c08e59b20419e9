"""Document fingerprints by locally consistent parsing.

The bytes of a text are parsed into phrases, phrases into longer phrases, level
by level. Borders come from deterministic coin tossing: a symbol is replaced by
the lowest bit in which it differs from the symbol on its left, and that bit's
value, until labels are below six; a phrase begins at each local maximum. A
border so depends on a few neighbours only, and equal substrings are parsed
alike inside, wherever they stand. A phrase is named by the hash of its bytes.

The fingerprint lists the ``KEEP`` least names of the phrases of ``LEVEL``, in
hex; the likeness of two fingerprints estimates the Jaccard similarity of their
phrase sets from the least names of both (exact for short texts).

Defined results: null or empty text has the empty fingerprint, alike (1.0) only
to another empty one; equal texts have equal fingerprints; rows are ordered by
doc_id descending, null last, equal ids by text; the only document of a table
follows itself; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscore.llm.common import BLOCK_BYTES, hash_spans, ship, utf8

LEVEL, KEEP, NAME_BYTES = 3, 48, 5
_EDGE = 255  # stands left of a text's first symbol; no byte and no label has it


def _toss_table() -> np.ndarray:
    """New label of each (left, own) pair of labels below 256."""
    left, own = np.meshgrid(np.arange(256), np.arange(256), indexing="ij")
    low = (left ^ own) & -(left ^ own)
    bit = np.where(low > 0, np.bitwise_count(np.maximum(low, 1) - 1), 0)
    return (2 * bit + ((own >> bit) & 1)).astype(np.uint8).ravel()


_TOSS = _toss_table()


def _toss(labels: np.ndarray, heads: np.ndarray) -> np.ndarray:
    left = np.empty(len(labels), np.uint16)
    left[1:] = labels[:-1]
    left[heads] = _EDGE
    return _TOSS[(left << np.uint16(8)) | labels]


def _borders(labels: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Where phrases begin: at text heads and at inner local maxima of the labels."""
    out = np.zeros(len(labels), bool)
    if len(labels) > 2:
        out[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    ends = heads[1:] - 1
    out[ends] = False
    out[heads] = True
    return out


def phrases(column: pa.Array, level: int = LEVEL) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of every text at ``level``, and the n+1 offsets of the
    texts. A text too short to have a border there is one phrase, so its
    fingerprint is like that of an equal text only."""
    data, offsets = utf8(column)
    texts = np.flatnonzero(np.diff(offsets))
    if not len(texts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts = offsets[:-1][texts]  # first byte of every phrase; each byte is one at level 0
    heads = starts
    bytes_labels = data
    first = np.ones(len(data), bool)
    first[1:] = data[1:] != data[:-1]  # a run of equal symbols counts as one
    first[heads] = True
    at = np.flatnonzero(first)
    labels = bytes_labels[at]
    head = np.searchsorted(at, heads)
    for _ in range(3):
        labels = _toss(labels, head)
    at = at[_borders(labels, head)]
    for _ in range(level - 1):
        names = hash_spans(data, at, np.append(at[1:], len(data)))
        head = np.searchsorted(at, heads)
        first = np.ones(len(at), bool)
        first[1:] = names[1:] != names[:-1]
        first[head] = True
        at, names = at[first], names[first]
        head = np.searchsorted(at, heads)
        differ = np.empty(len(names), np.uint64)
        differ[1:] = names[1:] ^ names[:-1]
        differ[head] = ~np.uint64(0)
        bit = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype(np.uint64)
        labels = (2 * bit + ((names >> bit) & np.uint64(1))).astype(np.uint8)
        for _ in range(3):
            labels = _toss(labels, head)
        at = at[_borders(labels, head)]
    names = hash_spans(data, at, np.append(at[1:], len(data)))
    return names, np.searchsorted(at, offsets)


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprint of each text."""
    names, rows = phrases(pa.array(texts, pa.large_string()))
    names = names >> np.uint64(64 - 8 * NAME_BYTES)
    doc = np.repeat(np.arange(len(texts)), np.diff(rows))
    order = np.lexsort((names, doc))
    names, doc = names[order], doc[order]
    once = np.ones(len(names), bool)
    once[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
    names, doc = names[once], doc[once]
    at = np.searchsorted(doc, np.arange(len(texts) + 1))
    raw = names.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - NAME_BYTES:]
    return [raw[a:min(a + KEEP, z)].tobytes().hex() for a, z in zip(at, at[1:])]


def likeness(one: str, other: str) -> float:
    """Estimated Jaccard similarity of the phrase sets behind two fingerprints."""
    if one == other:
        return 1.0
    size = 2 * NAME_BYTES
    a, b = ({f[k:k + size] for k in range(0, len(f), size)} for f in (one, other))
    least = sorted(a | b)
    if len(a) >= KEEP or len(b) >= KEEP:
        least = least[:KEEP]
    return sum(x in a and x in b for x in least) / len(least)


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id, text, key, bucket and tail: every bucket, sorted by (tail, key
    descending, text) in one partition, is a run of the whole descending order,
    and ends with a tail row, the document that follows it."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key"))
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select(F.col("key").cast("double").alias("at"))
    cuts = sorted(set(ids.approxQuantile("at", [k / n for k in range(1, n)], 1 / (4 * n))))
    if not cuts:
        return rows.selectExpr("doc_id", "text", "key", "0 as bucket", "false as tail")
    splits = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="at", outputCol="bucket")
    rows = splits.transform(rows.withColumn("at", F.col("key").cast("double"))).drop("at")
    rows = rows.withColumn("bucket", F.col("bucket").cast("int"))
    heads = sorted((r["bucket"], r["head"]) for r in rows.groupBy("bucket").agg(F.max("key").alias("head")).collect())
    # the row after a bucket's last one is the head of the next lower bucket, or of the highest
    after = [(heads[i - 1][1], bucket) for i, (bucket, _) in enumerate(heads)]
    tails = F.broadcast(spark.createDataFrame(after, "key long, target int"))  # one row a bucket
    tail = rows.join(tails, "key").select("doc_id", "text", "key", F.col("target").alias("bucket"), F.lit(True).alias("tail"))
    return (rows.select("*", F.lit(False).alias("tail")).unionByName(tail).repartition("bucket")
            .sortWithinPartitions("bucket", "tail", F.desc("key"), "text"))


def fingerprint(docs: DataFrame) -> DataFrame:
    """RESULT for every row of ``docs`` (doc_id, text): its fingerprint, that of
    its edited text (the second half replaced by the next document's beginning)
    and their likeness."""
    ship(docs.sparkSession)

    def work(rows: list[tuple]) -> pa.RecordBatch:
        """All rows but the last (or the tails) against the row behind each."""
        use = [i for i in range(len(rows) - 1) if not rows[i][1]]
        texts = [r[3] for r in rows]
        edited = [texts[i][:len(texts[i]) - len(texts[i]) // 2] + texts[i + 1][:len(texts[i]) // 2] for i in use]
        own, changed = fingerprints(texts), fingerprints(edited)
        columns = ([rows[i][2] for i in use], [len(texts[i]) for i in use],
                   [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in edited], [own[i] for i in use], changed,
                   [likeness(own[i], c) for i, c in zip(use, changed)], [likeness(own[i], own[i + 1]) for i in use])
        kind = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
        names, kinds = zip(*(c.split() for c in RESULT.split(", ")))
        return pa.RecordBatch.from_arrays([pa.array(c, kind[k]) for c, k in zip(columns, kinds)], names=names)

    def task(batches):
        held, size = [], 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                held.append(row)
                size += len(row[3])
                if size >= BLOCK_BYTES:
                    yield work(held)
                    held, size = held[-1:], len(row[3])
        if len(held) > 1:
            yield work(held)

    return in_order(docs).select("bucket", "tail", "doc_id", "text").mapInArrow(task, RESULT)


def op5(spark, sf_dir: str) -> DataFrame:
    return fingerprint(spark.read.parquet(f"{sf_dir}/documents.parquet"))
