"""File scans and sinks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TXN
from ..session import scratch_path

# Fixed value: text form of event times in CSV files (keeps microseconds).
CSV_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
# Most rows of one partition of a spread table; a table of no more rows stays as it lies.
SPREAD_ROWS = 500_000
# Files of a stored table per task slot: several small ones pack into even tasks.
FILES_PER_SLOT = 4


def csv_options(header: bool = True) -> dict[str, str]:
    return {"header": str(header).lower(), "timestampNTZFormat": CSV_TIME_FORMAT,
            "timestampFormat": CSV_TIME_FORMAT, "mode": "PERMISSIVE"}


def read_transactions(spark: SparkSession, path: str, fmt: str = "csv",
                      schema: T.StructType | None = TXN, infer: bool = False) -> DataFrame:
    """Raw transactions.

    CSV columns are bound **by header name**, not by position: the file is
    read as text columns and each schema field is ``try_cast`` from the
    column of the same name (unparsable values become NULL and go to the
    rejects; extra columns such as a nameless index are ignored; a missing
    column is left out so the schema gate reports it). All files of one read
    must have the same header. ``infer`` asks for
    Spark's type inference instead (a full extra pass; keys may turn into
    numbers).
    """
    if fmt == "csv":
        r = spark.read.options(**csv_options())
        if infer or schema is None:
            return r.option("inferSchema", "true").csv(path)
        # Every file's header is held against the first one's: a file with its
        # columns in another order fails instead of being read by position.
        text = r.option("enforceSchema", "false").csv(path)
        present = set(text.columns)
        return text.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
                             for f in schema.fields if f.name in present])
    r = spark.read.format(fmt)
    if schema is not None and fmt not in ("parquet", "orc"):
        r = r.schema(schema)
    return r.load(path)


def read_dataset(spark: SparkSession, path: str, fmt: str = "parquet",
                 schema: T.StructType | None = None) -> DataFrame:
    """A dataset directory of many part files. Give ``schema`` for a folder with
    partition columns: their types are otherwise guessed from the folder names
    (a category ``05`` would become the number 5)."""
    if fmt == "csv":
        return read_transactions(spark, path, "csv", schema or TXN)
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    """Write in parallel (one file per task, no ``coalesce(1)``)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.options(**csv_options())
    if partition_by:
        # Few tasks per folder, large folders split: no task x value small files.
        w = (df.hint("rebalance", *partition_by).write.mode(mode).format(fmt)
             .partitionBy(*partition_by))
        if fmt == "csv":
            w = w.options(**csv_options())
    w.save(path)
    return path


def spread(df: DataFrame, rows: int | None = None, per_slot: int = 1) -> DataFrame:
    """The same rows dealt round-robin to partitions of even size, at most
    ``SPREAD_ROWS`` rows each and ``per_slot`` or more per task slot, however the
    source lies (a file is read by one task per row group). Spark sorts each partition
    before dealing it, so a retried task deals the same."""
    rows = df.count() if rows is None else rows
    if rows <= SPREAD_ROWS:
        return df
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(per_slot * slots, math.ceil(rows / SPREAD_ROWS)))


def stored_evenly(df: DataFrame, name: str) -> DataFrame:
    """``df`` spread, written to the shared folder and read back: for tables that
    are read many times, from a source of few large parts."""
    even = spread(df, per_slot=FILES_PER_SLOT)
    if even is df:
        return df
    path = scratch_path(df.sparkSession, name)
    write_dataset(even, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
