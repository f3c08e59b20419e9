"""End-to-end jobs: ingest, prepare, train, score (batch and stream).

Each job is one function a scheduler can call; the order of the old DAG
(publish -> drain -> prepare -> train -> score) is the order of these calls.
Gates are DataFrames checked with ``enforce``. Stage row counts are read
back from the written parquet datasets (footer metadata, no data pass).
``metrics.profile`` (``observe()``) is not used inside these jobs: on Spark
4.1 a session that has run an observed query later fails to serialise the
RDD closures of the ML evaluators.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import balance as B
from ..operators import features as FE
from ..operators import gates as G
from ..operators import metrics as M
from ..operators.split import SPLIT_SALT, hash_unit, split
from ..schemas import EVENT_TIME, KEY, LABEL, TXN
from ..sources.files import read_dataset, read_transactions, write_dataset
from ..sources.messages import encode_messages, publish
from ..streaming import drain as D
from ..streaming import scoring as SS
from . import models as MD
from .featurize import feature_table, fit_features

REQUIRED_COLUMNS = ["trans_num", "trans_date_trans_time", "category", "amt", "lat", "long",
                    "merch_lat", "merch_long", "is_fraud"]
TRAIN_FRACTION = 0.8


def ingest(spark: SparkSession, csv_path: str, log_path: str | None, fmt: str = "parquet",
           options: dict | None = None, id_col: str | None = None,
           rejects_path: str | None = None) -> DataFrame:
    """Publish a CSV of transactions to the log (a Kafka topic or message
    files), read back what this call published and reconcile counts and keys.

    The key is ``trans_num``, or ``id_col`` where that column is absent. Rows
    with a NULL key are not published: they go to ``rejects_path``, without
    which they fail the run before anything is published.
    """
    src = read_transactions(spark, csv_path, "csv", None if id_col else TXN)
    key = KEY if KEY in src.columns or id_col is None else id_col
    required = [c if c != KEY else key for c in REQUIRED_COLUMNS]
    G.enforce(G.gate_schema(src, required))
    nameless = src.where(F.col(key).isNull())
    if rejects_path:
        write_dataset(nameless.withColumn("reason", F.lit(key)), rejects_path)
    else:
        n = nameless.count()
        G.enforce(G.gate_table(spark, [("null_keys", n, 0, n == 0)]))
    src = src.where(F.col(key).isNotNull())
    since = D.log_position(spark, log_path, fmt, options)
    publish(encode_messages(src, id_col=id_col), fmt, log_path, options)
    log = D.read_log(spark, log_path, fmt, options, since)
    return G.enforce(G.gate_reconcile(src, log, key, "key"))


def checkpoint_of(out_path: str) -> str:
    """The stream checkpoint that belongs to an output: the same on every run,
    so a later run goes on where the last one stopped."""
    return out_path.rstrip("/") + "_checkpoint"


def drain_log(spark: SparkSession, log_path: str | None, landed: str, checkpoint: str | None = None,
              dedupe_within: str | None = None, fmt: str = "parquet", options: dict | None = None,
              max_files_per_trigger: int | None = None) -> DataFrame:
    """Drain everything available into the landed dataset; fail if it is empty
    or does not hold as many rows as the log (as its keys, when deduplicating:
    then re-sent keys may be missing, so landed rows lie between the two)."""
    D.drain(spark, log_path, landed, checkpoint or checkpoint_of(landed), fmt,
            dedupe_within=dedupe_within, options=options,
            max_files_per_trigger=max_files_per_trigger)
    rows = read_dataset(spark, landed).count()
    log = D.read_log(spark, log_path, fmt, options)
    if dedupe_within:
        keys = log.select("key").distinct().count()
        whole = ("landed_rows", rows, keys, keys <= rows <= log.count())
    else:
        n = log.count()
        whole = ("landed_rows", rows, n, rows == n)
    return G.enforce(G.gate_table(spark, [("drained_nonempty", rows, 1, rows >= 1), whole]))


@dataclass
class Prepared:
    """Output of ``prepare``: fitted feature stages, dataset paths and row counts."""
    features: PipelineModel
    train_path: str
    test_path: str
    rejects_path: str
    counts: dict
    balance_mode: str = "exact"
    reference_order: bool = False


def prepare(spark: SparkSession, landed: str, out_dir: str, relative_error: float = 0.001,
            balance_mode: str = "exact", reference_order: bool = False) -> Prepared:
    """Validate, hash-split, fit the feature stages on the training side,
    balance the training side only and write train / test / rejects datasets.
    ``reference_order``: fit and balance on everything, then split at random.

    The schema, non-empty and class-present gates and the class counts of the
    training side come from one aggregate over the landed data.
    """
    raw = read_dataset(spark, landed)
    missing = [c for c in REQUIRED_COLUMNS if c not in raw.columns]
    present = len(REQUIRED_COLUMNS) - len(missing)
    G.enforce(G.gate_table(spark, [("schema_columns", present, len(REQUIRED_COLUMNS), not missing)]))
    tagged = raw.withColumn("reason", FE.invalid_reason(raw, MD.VALIDATED, LABEL))
    ok, y = F.col("reason").isNull(), F.col(LABEL)
    # The old order fits and balances on everything, copies included.
    if reference_order:
        return _prepare_reference(spark, tagged, out_dir, relative_error, balance_mode)
    train = hash_unit(KEY, SPLIT_SALT) < F.lit(TRAIN_FRACTION)
    c = tagged.agg(F.count(F.lit(1)).alias("rows"),
                   F.count(F.when(ok & (y == 1), 1)).alias("fraud"),
                   F.count(F.when(ok & train & (y == 0), 1)).alias("legit_train"),
                   F.count(F.when(ok & train & (y == 1), 1)).alias("fraud_train")).first()
    G.enforce(G.gate_table(spark, [
        ("schema_rows", c["rows"], 1, c["rows"] >= 1),
        ("class_present", c["fraud"], 1, c["fraud"] >= 1),
        ("class_present_train", c["fraud_train"], 1, c["fraud_train"] >= 1)]))
    valid = tagged.where(ok).drop("reason")
    rejects = tagged.where(~ok)
    train_raw = valid.where(train)
    feats = fit_features(train_raw, relative_error)

    # One dataset partitioned by side, written by one job: legit training
    # rows and all test rows pass straight through; only the training side's
    # fraud rows are spread and repeated (test rows are never oversampled).
    ratio = c["legit_train"] / c["fraud_train"]
    plain = valid.where(~(train & (y == 1)))
    copies = B.oversample(train_raw, mode=balance_mode, ratio=ratio,
                          minority_rows=c["fraud_train"], copy_col=None)
    sided = B.union_all(plain, copies).withColumn(
        "side", F.when(train, F.lit("train")).otherwise(F.lit("test")))
    features_path = os.path.join(out_dir, "features")
    write_dataset(feature_table(feats, sided, [KEY, LABEL, "side"]), features_path,
                  partition_by=["side"])
    return _prepared(spark, feats, rejects, out_dir, balance_mode, False)


def _prepare_reference(spark: SparkSession, tagged: DataFrame, out_dir: str, relative_error: float,
                       balance_mode: str) -> Prepared:
    """Feature stages and balance over all valid rows, then a random split."""
    ok = F.col("reason").isNull()
    valid = tagged.where(ok).drop("reason")
    G.enforce(G.gate_class_present(valid))
    feats = fit_features(valid, relative_error)
    train, test = split(B.balance(valid, mode=balance_mode, copy_col=None), MD.SPLIT_WEIGHTS, "random")
    sided = B.union_all(train.withColumn("side", F.lit("train")), test.withColumn("side", F.lit("test")))
    write_dataset(feature_table(feats, sided, [KEY, LABEL, "side"]), os.path.join(out_dir, "features"),
                  partition_by=["side"])
    return _prepared(spark, feats, tagged.where(~ok), out_dir, balance_mode, True)


def _prepared(spark: SparkSession, feats: PipelineModel, rejects: DataFrame, out_dir: str,
              balance_mode: str, reference_order: bool) -> Prepared:
    """Write rejects, feature stages and settings; read the counts back."""
    features_path = os.path.join(out_dir, "features")
    rejects_path = write_dataset(rejects, os.path.join(out_dir, "rejects"))
    spark.createDataFrame([(balance_mode, reference_order)], SETTINGS).write.mode("overwrite").parquet(
        os.path.join(out_dir, "settings"))
    paths = {"train": f"{features_path}/side=train", "test": f"{features_path}/side=test",
             "rejects": rejects_path}
    observed = {r["side"]: r["count"] for r in
                read_dataset(spark, features_path).groupBy("side").count().collect()}
    observed["rejects"] = read_dataset(spark, rejects_path).count()
    for side in ("train", "test"):
        observed.setdefault(side, 0)
    feats.write().overwrite().save(os.path.join(out_dir, "feature_model"))
    G.enforce(G.gate_table(spark, [("train_nonempty", observed["train"], 1, observed["train"] >= 1)]))
    return Prepared(feats, paths["train"], paths["test"], paths["rejects"], observed,
                    balance_mode, reference_order)


SETTINGS = "balance_mode string, reference_order boolean"


def load_prepared(spark: SparkSession, out_dir: str) -> Prepared:
    """What ``prepare`` wrote under ``out_dir``."""
    settings = spark.read.schema(SETTINGS).parquet(os.path.join(out_dir, "settings")).first()
    side = os.path.join(out_dir, "features", "side=")
    return Prepared(PipelineModel.load(os.path.join(out_dir, "feature_model")), f"{side}train", f"{side}test",
                    os.path.join(out_dir, "rejects"), {}, settings["balance_mode"], settings["reference_order"])


def train_and_log(spark: SparkSession, prepared: Prepared, model_dir: str, runs_path: str,
                  seed: int = 42) -> MD.Trained:
    """Fit both models from the written train table of ``prepare``, evaluate
    on its written test table, log the runs and save one scorer (raw rows in,
    both models' scores out)."""
    t = MD.train_from_tables(prepared.features, read_dataset(spark, prepared.train_path),
                             read_dataset(spark, prepared.test_path), seed=seed,
                             split_mode="random" if prepared.reference_order else "hash",
                             balance_mode=prepared.balance_mode,
                             train_order="reference" if prepared.reference_order else "split_first")
    MD.log_run(MD.runs(t, "txn"), runs_path)
    MD.save_model(t.scorer(), model_dir)
    return t


def score_table(spark: SparkSession, model_dir: str, raw: DataFrame, out: str) -> DataFrame:
    """Score raw transactions with every saved model (rows that cannot be
    scored go to ``<out>_rejects``); return prediction counts."""
    scored, rejects = MD.score_checked(MD.load_model(model_dir), raw)
    return _write_scores(spark, scored, rejects, out, KEY)


def score_request_table(spark: SparkSession, model_dir: str, requests: DataFrame, out: str,
                        id_col: str = "request_id") -> DataFrame:
    """Score requests (name -> value maps) with every saved model; requests that
    lack a feature go to ``<out>_rejects`` with its name. Prediction counts."""
    scored, rejects = MD.score_requests(MD.load_model(model_dir), requests, id_col)
    return _write_scores(spark, scored, rejects, out, id_col)


def _write_scores(spark: SparkSession, scored: DataFrame, rejects: DataFrame, out: str, key: str) -> DataFrame:
    write_dataset(scored, out)
    write_dataset(rejects, out.rstrip("/") + "_rejects")
    written = read_dataset(spark, out)
    return M.prediction_counts(written, [c for c in written.columns if c != key])


def score_stream(spark: SparkSession, model_dir: str, log_path: str | None, scores_out: str,
                 counts_out: str, checkpoint: str | None = None, available_now: bool = True,
                 window: str = "1 day", fmt: str = "parquet", options: dict | None = None,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Continuous scoring of a message log plus running prediction counts.

    One query: each micro-batch is decoded and scored once, and its scores, its
    rejects (with a reason) and its counts per window, class and model are
    written under ``batch_id=<n>``, which a replayed batch overwrites.
    ``current_totals`` sums the counts; a prediction of any age is counted.
    """
    model = MD.load_model(model_dir)
    rows = D.decoded_stream(D.message_stream(spark, log_path, fmt, options, max_files_per_trigger))
    rejects_out = scores_out.rstrip("/") + "_rejects"

    def write(batch: DataFrame, batch_id: int) -> None:
        part = f"batch_id={batch_id}"
        whole = MD.tagged_scores(model, batch, keep=(EVENT_TIME,)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ok = F.col("reason").isNull()
            scored = whole.where(ok).drop("reason")
            models = [c for c in scored.columns if c not in (KEY, EVENT_TIME)]
            write_dataset(scored, f"{scores_out}/{part}")
            write_dataset(whole.where(~ok).select(KEY, EVENT_TIME, "reason"), f"{rejects_out}/{part}")
            write_dataset(SS.windowed_prediction_counts(scored, models, window), f"{counts_out}/{part}")
        finally:
            whole.unpersist()

    w = rows.writeStream.option("checkpointLocation", checkpoint or checkpoint_of(scores_out)).foreachBatch(write)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
