"""Continuous scoring and running prediction counts.

Scores are a stateless projection of the stream (any fitted PipelineModel
transforms a streaming DataFrame). The counter is an event-time windowed
aggregate without a watermark: a prediction of any age is counted, and the
state is a few rows per window (classes x models). Each micro-batch's updated
windows are written idempotently under ``batch_id=<n>`` and the current table
is the latest value per window, class and model.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import class_name
from ..functions.time import instant_to_wall, wall_to_instant
from ..schemas import EVENT_TIME

COUNT_KEYS = ["window_start", "window_end", "prediction_class", "model_name"]


def windowed_prediction_counts(scored: DataFrame, model_cols: Sequence[str],
                               window: str = "1 day", time_col: str = EVENT_TIME) -> DataFrame:
    """Counts per (event-time window, class, model); rows without an event time
    are counted under a NULL window.

    A wall-clock (``timestamp_ntz``) event time is read as a UTC instant and the
    window bounds are turned back into wall clocks, so windows are whole days in
    any session time zone.
    """
    ntz = dict(scored.dtypes)[time_col] == "timestamp_ntz"
    ev = wall_to_instant(time_col) if ntz else F.col(time_col)
    stacked = scored.select(ev.alias("_ev"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("model_name"), F.col(m)["is_fraud_prediction"].alias("p"))
        for m in model_cols])).alias("s"))
    # window() leaves out rows without a time; they are counted beside it.
    timed = stacked.withColumn("w", F.when(F.col("_ev").isNotNull(), _tumbling(F.col("_ev"), window)))
    counts = (timed.groupBy("w", class_name("s.p").alias("prediction_class"),
                            F.col("s.model_name").alias("model_name"))
                   .agg(F.count(F.lit(1)).alias("n")))
    back = instant_to_wall if ntz else (lambda c: c)
    return counts.select(back(F.col("w.start")).alias("window_start"),
                         back(F.col("w.end")).alias("window_end"),
                         "prediction_class", "model_name", "n")


def _tumbling(at: Column, window: str) -> Column:
    """struct<start, end> of the tumbling window that ``at`` falls into."""
    span = F.expr(f"interval {window}")
    size = F.unix_micros(F.timestamp_micros(F.lit(0)) + span)
    start = F.unix_micros(at) - F.pmod(F.unix_micros(at), size)
    return F.struct(F.timestamp_micros(start).alias("start"), F.timestamp_micros(start + size).alias("end"))


def _batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        # Overwriting the batch's own folder makes a replayed batch idempotent.
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def run_counts(counts: DataFrame, path: str, checkpoint: str,
               available_now: bool = True) -> StreamingQuery:
    """Start the counter: update mode, one idempotent folder per micro-batch.
    State partitions are the session's shuffle partitions when the query first
    starts (give the stream a session of its own to choose fewer)."""
    w = (counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
               .foreachBatch(_batch_writer(path)))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


SNAPSHOTS = "_snapshots"


def _latest_snapshot(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """(batch id covered, folder) of the newest snapshot, if any."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(f"{path}/{SNAPSHOTS}")
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return None
    best = None
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith("upto=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            n = int(name.split("=", 1)[1])
            if best is None or n > best[0]:
                best = (n, st.getPath().toString())
    return best


def _counts(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """Latest count per key from the newest snapshot plus the later batches
    (up to ``upto``); older batch folders are pruned by the partition filter."""
    df = spark.read.parquet(path)
    snap = _latest_snapshot(spark, path)
    cond = F.lit(True) if snap is None else F.col("batch_id") > F.lit(snap[0])
    if upto is not None:
        cond = cond & (F.col("batch_id") <= F.lit(upto))
    df = df.where(cond)
    if snap is not None:
        taken = spark.read.parquet(snap[1]).withColumn(
            "batch_id", F.lit(snap[0]).cast(df.schema["batch_id"].dataType))
        df = df.unionByName(taken)
    return df.groupBy(*COUNT_KEYS).agg(F.max_by("n", "batch_id").alias("n"))


def current_counts(spark: SparkSession, path: str) -> DataFrame:
    """Latest count per (window, class, model)."""
    return _counts(spark, path)


def current_totals(spark: SparkSession, path: str) -> DataFrame:
    """Sum per (window, class, model) over batches that hold their own rows'
    counts (as ``jobs.score_stream`` writes them)."""
    return spark.read.parquet(path).groupBy(*COUNT_KEYS).agg(F.sum("n").alias("n"))


def compact_counts(spark: SparkSession, path: str) -> str:
    """Fold every batch written so far into a snapshot under
    ``_snapshots/upto=<n>`` (hidden from partition discovery); later reads
    skip the folded batch folders, which an operator may then remove. Only
    committed batches are visible to the read, so the stream can keep
    writing meanwhile."""
    upto = spark.read.parquet(path).agg(F.max("batch_id")).first()[0]
    if upto is None:
        raise ValueError(f"no count batches under {path}")
    snap = _latest_snapshot(spark, path)
    if snap is not None and snap[0] >= upto:
        return snap[1]
    out = f"{path}/{SNAPSHOTS}/upto={upto}"
    _counts(spark, path, upto).write.mode("overwrite").parquet(out)
    return out
