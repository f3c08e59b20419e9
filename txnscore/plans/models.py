"""Training, evaluation, persistence and scoring.

Order of work (default, leak-free): hash split -> fit feature stages on the
training side -> balance the training side only -> fit both models ->
evaluate on the untouched test side. ``reference_order=True`` reproduces the
old order (fit and balance on everything, then split) for comparison.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import positive_probability
from ..operators import balance as B
from ..operators import metrics as M
from ..operators.features import invalid_reason, split_invalid
from ..operators.split import split
from ..schemas import KEY, LABEL, RUN
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources.files import spread
from .featurize import fit_features

# Model names (as the scoring response and counter labels) and
# the reference's hyper-parameters.
LR_NAME, GBT_NAME = "logistic_regression", "gbt_classifier"
LR_MAX_ITER = 100
GBT_MAX_ITER, GBT_MAX_DEPTH = 20, 5
SPLIT_WEIGHTS = (0.8, 0.2)

# Raw columns the saved scorer reads: a NULL or NaN in one makes a reject.
SCORE_INPUTS = ["trans_date_trans_time", "amt", "city_pop", "lat", "long", "merch_lat",
                "merch_long"]
# A NULL key would give a NULL split bucket and vanish from both sides.
VALIDATED = [KEY, *SCORE_INPUTS]


def _cols(prefix: str) -> dict[str, str]:
    return {"raw": f"{prefix}_raw", "probability": f"{prefix}_probability",
            "prediction": f"{prefix}_prediction"}


def lr_estimator(features_col: str = "features") -> LogisticRegression:
    """LogisticRegression with its own output column names."""
    c = _cols("lr")
    return LogisticRegression(featuresCol=features_col, labelCol=LABEL, maxIter=LR_MAX_ITER,
                              rawPredictionCol=c["raw"], probabilityCol=c["probability"],
                              predictionCol=c["prediction"])


def gbt_estimator(features_col: str = "features", seed: int = 42) -> GBTClassifier:
    """GBTClassifier with its own output column names."""
    c = _cols("gbt")
    g = GBTClassifier(featuresCol=features_col, labelCol=LABEL, maxIter=GBT_MAX_ITER,
                      maxDepth=GBT_MAX_DEPTH, seed=seed, predictionCol=c["prediction"],
                      checkpointInterval=10)
    return g.setRawPredictionCol(c["raw"]).setProbabilityCol(c["probability"])


def score_struct(prefix: str):
    """struct<fraud_probability, is_fraud_prediction> of one model."""
    c = _cols(prefix)
    return F.struct(positive_probability(c["probability"]).alias("fraud_probability"),
                    F.col(c["prediction"]).cast("int").alias("is_fraud_prediction"))


@dataclass
class Trained:
    """Fitted feature stages and models, with the rows they were fitted and tested on."""
    features: PipelineModel
    lr: object
    gbt: object | None
    train: DataFrame
    test: DataFrame
    split_mode: str
    balance_mode: str
    pipeline_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    # Stages that turn ``test`` rows into model input: every feature stage for
    # raw rows, only the assembler for an already written feature table.
    eval_stages: list | None = None
    # "split_first" (leak-free default) or "reference" (fit and balance on
    # everything, then split).
    train_order: str = "split_first"
    # Rows both fits read, and the rows set aside before them.
    train_rows: int | None = None
    rejects: DataFrame | None = None

    def test_stages(self) -> list:
        return list(self.features.stages) if self.eval_stages is None else list(self.eval_stages)

    def scorer(self) -> PipelineModel:
        """One saved object from raw rows to both models' outputs."""
        stages = list(self.features.stages) + [self.lr] + ([self.gbt] if self.gbt else [])
        return PipelineModel(stages=stages)


def train(df: DataFrame, split_mode: str | None = None, balance_mode: str = "exact",
          relative_error: float = 0.001, with_gbt: bool = True, seed: int = 42,
          reference_order: bool = False) -> Trained:
    """Fit the feature stages and both models.

    Rows that cannot train (a NULL or NaN input, a NULL key, a label other than
    0 or 1) are set aside in ``rejects`` with a reason. ``split_mode`` defaults
    to ``hash``; with ``reference_order`` it defaults
    to ``random`` so that, as in the old order, copies of one fraud row can
    land on both sides (a key-hash split would keep them together).
    """
    if split_mode is None:
        split_mode = "random" if reference_order else "hash"
    df, rejects = split_invalid(df, [c for c in VALIDATED if c in df.columns], LABEL)
    if reference_order:
        feats = fit_features(df, relative_error)
        balanced = B.balance(df, mode=balance_mode, seed=seed, copy_col=None)
        train_raw, test_raw = split(balanced, SPLIT_WEIGHTS, split_mode, seed=seed)
    else:
        train_raw, test_raw = split(df, SPLIT_WEIGHTS, split_mode, seed=seed)
        feats = fit_features(train_raw, relative_error)
        train_raw = B.balance(train_raw, mode=balance_mode, seed=seed, copy_col=None)
    lr, gbt, rows = fit_models(feats.transform(train_raw), with_gbt, seed)
    return Trained(feats, lr, gbt, train_raw, test_raw, split_mode, balance_mode,
                   train_order="reference" if reference_order else "split_first",
                   train_rows=rows, rejects=rejects)


def fit_models(assembled: DataFrame, with_gbt: bool = True, seed: int = 42):
    """Fit LR (and GBT) on rows that carry the ``features`` vector; also the
    number of rows."""
    # GBT cuts its lineage every 10 trees into the session's checkpoint folder.
    ensure_checkpoint_dir(assembled.sparkSession)
    # Every pass of a fit (~100 of L-BFGS, one per tree level of GBT) takes as
    # long as its largest partition: the rows are spread evenly first. Each fit
    # turns the slice into a cached form of its own in a few passes, so the slice
    # itself is kept on disk and leaves the memory to those. Both fits run
    # at once from two driver threads (as CrossValidator's ``parallelism``):
    # their jobs interleave on the cluster, and each model is the same as
    # when fitted alone.
    rows = assembled.count()
    train_set = spread(assembled.select("features", LABEL), rows).persist(StorageLevel.DISK_ONLY)
    try:
        train_set.count()  # fills the cache that both fits read
        if not with_gbt:
            return train_lr(train_set), None, rows
        with ThreadPoolExecutor(max_workers=2) as pool:
            lr = pool.submit(train_lr, train_set)
            gbt = pool.submit(train_gbt, train_set, seed)
            return lr.result(), gbt.result(), rows
    finally:
        train_set.unpersist()


def train_from_tables(features: PipelineModel, train_table: DataFrame, test_table: DataFrame,
                      with_gbt: bool = True, seed: int = 42, split_mode: str = "hash",
                      balance_mode: str = "exact", train_order: str = "split_first") -> Trained:
    """Fit both models from written feature tables (the output of
    ``jobs.prepare``): the lineage of every training pass starts at those
    files in the shared folder, not at the split and the oversampling."""
    assembler = features.stages[-1]
    lr, gbt, rows = fit_models(assembler.transform(train_table), with_gbt, seed)
    return Trained(features, lr, gbt, train_table, test_table, split_mode, balance_mode,
                   eval_stages=[assembler], train_order=train_order, train_rows=rows)


def train_lr(assembled: DataFrame):
    """Logistic regression, 100 iterations, on rows with a ``features`` vector."""
    return lr_estimator().fit(assembled)


def train_gbt(assembled: DataFrame, seed: int = 42):
    """Gradient-boosted trees, 20 trees of depth 5, on rows with ``features``."""
    return gbt_estimator(seed=seed).fit(assembled)


def unpack_scores(transformed: DataFrame) -> list:
    """One struct<fraud_probability, is_fraud_prediction> column per model
    found in a transformed DataFrame (probability of class 1, 0/1 decision)."""
    structs = []
    if "lr_probability" in transformed.columns:
        structs.append(score_struct("lr").alias(LR_NAME))
    if "gbt_probability" in transformed.columns:
        structs.append(score_struct("gbt").alias(GBT_NAME))
    return structs


def tagged_scores(model: PipelineModel, raw: DataFrame, key: str = KEY, keep: tuple = ()) -> DataFrame:
    """key, one struct<fraud_probability, is_fraud_prediction> per model, and
    ``reason``: the inputs that are NULL or NaN (NULL if none). Every row stays;
    a row with a reason has NULL scores."""
    reason = "_reason"
    out = model.transform(raw.withColumn(
        reason, invalid_reason(raw, [c for c in SCORE_INPUTS if c in raw.columns])))
    ok = F.col(reason).isNull()
    names = unpack_scores(out)
    plain = out.select(key, *keep, *names, reason)
    models = plain.columns[1 + len(keep):-1]
    return plain.select(key, *keep, *[F.when(ok, F.col(m)).alias(m) for m in models],
                        F.col(reason).alias("reason"))


def score(model: PipelineModel, raw: DataFrame, key: str = KEY, keep: tuple = ()) -> DataFrame:
    """Score raw transactions with every model in ``model``: one row per input
    row, with NULL scores where an input is missing (see ``tagged_scores``)."""
    return tagged_scores(model, raw, key, keep).drop("reason")


def score_checked(model: PipelineModel, raw: DataFrame, key: str = KEY,
                  keep: tuple = ()) -> tuple[DataFrame, DataFrame]:
    """(scores, rejects): rows that cannot be scored are reported, not lost."""
    out = tagged_scores(model, raw, key, keep)
    ok = F.col("reason").isNull()
    return out.where(ok).drop("reason"), out.where(~ok).select(key, *keep, "reason")


def evaluate(pred: DataFrame, prefix: str, num_bins: int = 1000) -> dict[str, float]:
    """PR-AUC (evaluator; 1,000 bins by default, 0 = every distinct score),
    label-weighted F1 and fraud-class F1 of one model's scored rows."""
    c = _cols(prefix)
    pr = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol=c["raw"],
                                       metricName="areaUnderPR", numBins=num_bins).evaluate(pred)
    # Both F1 values from one confusion-count aggregate; the label-weighted
    # one equals MulticlassClassificationEvaluator("f1") (tests check it),
    # without a second pass over the scored test rows.
    rep = M.f1_report(pred, LABEL, c["prediction"]).first()
    return {"pr_auc": float(pr), "f1": float(rep["f1"]),
            "f1_fraud": float(rep["f1_fraud"]) if rep["f1_fraud"] is not None else None}


def runs(t: Trained, run_prefix: str = "run", num_bins: int = 1000) -> DataFrame:
    """A runs table (one row per model) for the trained pair. The test side is
    scored once by both models and written; the metrics read that table."""
    spark = t.train.sparkSession
    models = [(name, prefix, m) for name, prefix, m in
              ((LR_NAME, "lr", t.lr), (GBT_NAME, "gbt", t.gbt)) if m is not None]
    scored = PipelineModel(stages=t.test_stages() + [m for _, _, m in models]).transform(t.test)
    path = scratch_path(spark, "evaluated")
    scored.select(LABEL, *[_cols(p)[c] for _, p, _ in models for c in ("raw", "prediction")]).write.parquet(path)
    scored = spark.read.parquet(path)
    test_rows = scored.count()
    train_rows = t.train_rows if t.train_rows is not None else t.train.count()
    with ThreadPoolExecutor(max_workers=len(models)) as pool:
        mets = [pool.submit(evaluate, scored, prefix, num_bins) for _, prefix, m in models]
        rows = [(f"{run_prefix}_{name}", type(m).__name__, t.pipeline_id, met["pr_auc"],
                 met["f1"], met["f1_fraud"], t.split_mode, t.balance_mode, t.train_order,
                 train_rows, test_rows)
                for (name, _, m), met in zip(models, [f.result() for f in mets])]
    return spark.createDataFrame(rows, RUN)


def log_run(run_rows: DataFrame, path: str) -> DataFrame:
    """Append to the runs dataset (one small file per run)."""
    run_rows.write.mode("append").parquet(path)
    return run_rows.sparkSession.read.parquet(path)


def save_model(model: PipelineModel, path: str) -> str:
    """Save a PipelineModel (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """The saved scorer: feature stages and both models in one PipelineModel."""
    return PipelineModel.load(path)


def _assembler_index(model: PipelineModel) -> int:
    from pyspark.ml.feature import VectorAssembler as VA
    for i, s in enumerate(model.stages):
        if isinstance(s, VA):
            return i
    raise ValueError("the model has no feature assembler stage")


def model_inputs(model: PipelineModel) -> list[str]:
    """The saved allow-list of feature names, in the model's order."""
    return list(model.stages[_assembler_index(model)].getInputCols())


def score_requests(model: PipelineModel, requests: DataFrame, id_col: str = "request_id",
                   map_col: str = "features") -> tuple[DataFrame, DataFrame]:
    """Score requests that carry engineered features as name -> value maps.

    Features are looked up **by name** from the model's saved allow-list
    (unknown names are ignored, order never matters). A request missing a
    feature goes to the rejects (with the missing names) instead of being
    silently dropped or mis-bound. Returns (scores, rejects).
    """
    from ..sources.requests import expand_requests
    names = model_inputs(model)
    wide = expand_requests(requests, names, map_col, keep=(id_col,))
    valid, rejects = split_invalid(wide, names)
    idx = _assembler_index(model)
    out = PipelineModel(stages=list(model.stages[idx:])).transform(valid)
    return out.select(id_col, *unpack_scores(out)), rejects.select(id_col, "reason")
