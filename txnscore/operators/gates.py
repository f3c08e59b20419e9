"""Data-quality gates (O46-O50) as DataFrames of (gate, observed, expected, passed).

Each gate is computed by Spark over the table it guards; ``enforce`` turns
failed rows into an exception (a handful of rows reach the driver).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import KEY, LABEL
from .reconcile import reconcile


def _gate(name: str, observed: Column, expected: Column, passed: Column) -> Column:
    return F.struct(F.lit(name).alias("gate"), observed.cast("long").alias("observed"),
                    expected.cast("long").alias("expected"), passed.alias("passed"))


def _rows(agg: DataFrame, gates: Sequence[Column]) -> DataFrame:
    return agg.select(F.explode(F.array(*gates)).alias("g")).select("g.*")


def gate_schema(df: DataFrame, required: Sequence[str], name: str = "schema") -> DataFrame:
    """Required columns present (observed = present count) and input not empty."""
    present = sum(1 for c in required if c in df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("rows"))
    return _rows(agg, [
        _gate(f"{name}_columns", F.lit(present), F.lit(len(required)), F.lit(present == len(required))),
        _gate(f"{name}_rows", F.col("rows"), F.lit(1), F.col("rows") >= 1),
    ])


def gate_nonempty(df: DataFrame, name: str = "nonempty") -> DataFrame:
    """At least one row."""
    agg = df.agg(F.count(F.lit(1)).alias("rows"))
    return _rows(agg, [_gate(name, F.col("rows"), F.lit(1), F.col("rows") >= 1)])


def gate_class_present(df: DataFrame, label: str = LABEL, minority: int = 1,
                       name: str = "class_present") -> DataFrame:
    """At least one minority-class row (else the oversampling ratio is undefined)."""
    agg = df.agg(F.count(F.when(F.col(label) == minority, 1)).alias("minority"))
    return _rows(agg, [_gate(name, F.col("minority"), F.lit(1), F.col("minority") >= 1)])


def gate_reconcile(source: DataFrame, log: DataFrame, key: str = KEY,
                   log_key: str | None = None, mode: str = "exact") -> DataFrame:
    """Published count equals input count, and no key is missing either way.

    ``exact``: each side is first counted per key (partial aggregation, so a
    repeated key is one row before the shuffle), then the two are
    full-outer joined on the key (one-to-one after the counts, no pairs are
    emitted) and a single aggregate yields the four numbers.
    ``checksum``: no shuffle at all; each side is reduced to its count and
    two order-independent sums of 64-bit key hashes. Equal multisets of keys
    give equal sums; a difference is detected with near certainty but not
    located (``missing``/``unknown`` report 0/1 for equal/different sums).
    ``located``: no shuffle of either side, and the differing keys are known: an
    invertible Bloom lookup table (``reconcile``), or the exact join where more keys
    differ than it can name.
    """
    log_key = log_key or key
    if mode == "located":
        r = reconcile(source, log, key, log_key)
        n = r.keys.agg(F.count(F.when(F.col("in_log") == 0, 1)), F.count(F.when(F.col("in_source") == 0, 1))).first()
        return gate_table(source.sparkSession, [
            ("published_count", r.log_rows, r.source_rows, r.log_rows == r.source_rows),
            ("missing_in_log", n[0], 0, n[0] == 0), ("unknown_in_log", n[1], 0, n[1] == 0)])
    if mode == "checksum":
        return _reconcile_checksum(source, log, key, log_key)
    if mode != "exact":
        raise ValueError(f"mode must be exact, located or checksum, not {mode!r}")
    s = source.groupBy(F.col(key).cast("string").alias("_k")).agg(F.count(F.lit(1)).alias("ns"))
    g = log.groupBy(F.col(log_key).cast("string").alias("_k")).agg(F.count(F.lit(1)).alias("ng"))
    # NULL keys count as one key of their own, equal on both sides.
    j = s.join(g.withColumnRenamed("_k", "_g"), F.col("_k").eqNullSafe(F.col("_g")), "full_outer")
    agg = j.agg(F.coalesce(F.sum("ns"), F.lit(0)).alias("src"),
                F.coalesce(F.sum("ng"), F.lit(0)).alias("log"),
                F.count(F.when(F.col("ng").isNull(), 1)).alias("missing"),
                F.count(F.when(F.col("ns").isNull(), 1)).alias("extra"))
    return _rows(agg, [
        _gate("published_count", F.col("log"), F.col("src"), F.col("log") == F.col("src")),
        _gate("missing_in_log", F.col("missing"), F.lit(0), F.col("missing") == 0),
        _gate("unknown_in_log", F.col("extra"), F.lit(0), F.col("extra") == 0),
    ])


def _key_digest(df: DataFrame, key: str) -> DataFrame:
    k = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit(""))
    wide = "decimal(38,0)"
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64(k).cast(wide)).alias("h1"),
                  F.sum(F.xxhash64(F.concat(k, F.lit("#"))).cast(wide)).alias("h2"))


def _reconcile_checksum(source: DataFrame, log: DataFrame, key: str, log_key: str) -> DataFrame:
    a = _key_digest(source, key).first()
    b = _key_digest(log, log_key).first()
    same = a["h1"] == b["h1"] and a["h2"] == b["h2"]
    diff = 0 if same else 1
    spark = source.sparkSession
    rows = [("published_count", int(b["n"]), int(a["n"]), b["n"] == a["n"]),
            ("missing_in_log", diff, 0, same), ("unknown_in_log", diff, 0, same)]
    return spark.createDataFrame(rows, "gate string, observed long, expected long, passed boolean")


def gate_table(spark, rows) -> DataFrame:
    """Gate rows from numbers already computed by a combined aggregate."""
    return spark.createDataFrame(
        [(g, int(o), int(e), bool(p)) for g, o, e, p in rows],
        "gate string, observed long, expected long, passed boolean")


class GateFailed(RuntimeError):
    pass


def enforce(gates: DataFrame) -> DataFrame:
    """Raise when any gate failed; return the gate rows otherwise."""
    failed = gates.where(~F.col("passed")).collect()
    if failed:
        msg = "; ".join(f"{r['gate']}: observed {r['observed']}, expected {r['expected']}"
                        for r in failed)
        raise GateFailed(msg)
    return gates
