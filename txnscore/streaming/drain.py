"""Bounded or continuous drain of a message log.

The consumer loop of the old pipeline becomes a streaming query: offsets
live in the checkpoint (exactly-once with the file sink), a failure fails the
query and a restart resumes from the checkpoint. ``available_now=True``
drains what is there and stops; ``False`` keeps the same query running.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import KEY, MESSAGE
from ..sources.files import csv_options
from ..sources.messages import decode_messages


def message_stream(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                   options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming (key, value) source: a Kafka topic (``fmt='kafka'``, with
    ``subscribe`` and ``kafka.bootstrap.servers`` in ``options``; add
    ``minPartitions`` to split a crowded topic partition over several tasks
    and ``maxOffsetsPerTrigger`` to bound micro-batches) read from the
    earliest offset, or a folder of message files."""
    if fmt == "kafka":
        r = spark.readStream.format("kafka").option("startingOffsets", "earliest")
        return r.options(**_kafka_read_options(options)).load().selectExpr(
            "cast(key as string) as key", "cast(value as string) as value")
    r = spark.readStream.format(fmt).schema(MESSAGE).options(**(options or {}))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _kafka_read_options(options: dict | None) -> dict:
    """Reading needs ``subscribe``; a writer's ``topic`` option names the same topic."""
    opts = dict(options or {})
    if not ({"subscribe", "assign", "subscribePattern"} & set(opts)) and "topic" in opts:
        opts["subscribe"] = opts.pop("topic")
    return opts


def _kafka_batch(spark: SparkSession, options: dict | None, starting: str = "earliest") -> DataFrame:
    r = (spark.read.format("kafka").option("startingOffsets", starting)
              .option("endingOffsets", "latest"))
    return r.options(**_kafka_read_options(options)).load()


def log_position(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                 options: dict | None = None):
    """Where a log ends now: its message files, or the next offset of every
    topic partition as ``startingOffsets`` text (one row a partition)."""
    if fmt == "kafka":
        ends = (_kafka_batch(spark, options).groupBy("topic", "partition")
                .agg((F.max("offset") + 1).alias("next")).collect())
        return kafka_offsets((r["topic"], r["partition"], r["next"]) for r in ends)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return frozenset()
    return frozenset(_files(spark, path, fmt, options))


def kafka_offsets(ends) -> str:
    """(topic, partition, next offset) rows as ``startingOffsets`` text; an empty
    topic starts at the earliest offset."""
    out: dict = {}
    for topic, partition, following in ends:
        out.setdefault(topic, {})[str(partition)] = int(following)
    return json.dumps(out, sort_keys=True) if out else "earliest"


def _files(spark: SparkSession, path: str, fmt: str, options: dict | None) -> list[str]:
    return spark.read.format(fmt).schema(MESSAGE).options(**(options or {})).load(path).inputFiles()


def read_log(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
             options: dict | None = None, since=None) -> DataFrame:
    """The log as a batch (key, value) table: every offset of a Kafka topic
    (earliest to latest) or every message file; with ``since`` (a
    ``log_position``) only what was published after it."""
    if fmt == "kafka":
        return _kafka_batch(spark, options, since or "earliest").selectExpr(
            "cast(key as string) as key", "cast(value as string) as value")
    r = spark.read.format(fmt).schema(MESSAGE).options(**(options or {}))
    if since is None:
        return r.load(path)
    new = sorted(set(_files(spark, path, fmt, options)) - since)
    return r.load(new) if new else spark.createDataFrame([], MESSAGE)


def decoded_stream(messages: DataFrame, dedupe_within: str | None = None) -> DataFrame:
    """Typed transactions; with ``dedupe_within`` (e.g. '1 day') a key re-sent
    within that time of its arrival is dropped (state is bounded). The watermark
    runs on arrival time, so no row is ever late; rows without a key (malformed
    messages) are never duplicates of one another."""
    rows = decode_messages(messages)
    if dedupe_within:
        own = F.coalesce(F.concat(F.lit("k"), F.col(KEY)), F.expr("uuid()"))
        rows = (rows.withColumns({"_at": F.current_timestamp(), "_key": own})
                    .withWatermark("_at", dedupe_within)
                    .dropDuplicatesWithinWatermark(["_key"]).drop("_at", "_key"))
    return rows


def land(rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
         available_now: bool = True, processing_time: str | None = None,
         partition_by: list[str] | None = None) -> StreamingQuery:
    """Append rows to a dataset with the exactly-once file sink; with
    ``partition_by`` (e.g. an event-date column) later reads prune folders."""
    w = rows.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.options(**csv_options())
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(path)


def drain(spark: SparkSession, source: str, out_path: str, checkpoint: str,
          fmt: str = "parquet", out_fmt: str = "parquet", dedupe_within: str | None = None,
          options: dict | None = None, max_files_per_trigger: int | None = None) -> str:
    """Drain everything available now from the log into ``out_path``
    (in micro-batches of at most ``max_files_per_trigger`` files, or
    ``maxOffsetsPerTrigger`` in ``options`` for Kafka)."""
    stream = message_stream(spark, source, fmt, options, max_files_per_trigger)
    q = land(decoded_stream(stream, dedupe_within), out_path, checkpoint, out_fmt,
             available_now=True)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return out_path

