"""Counts and evaluation metrics.

All metrics are computed from grouped tables: the confusion matrix from a
``groupBy(label, prediction)`` (four rows), the PR curve from one row per
distinct score with range-partitioned running sums (no global window).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import class_name
from ..schemas import LABEL
from .stats import running_totals, stored


def profile(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count of a stage collected while the stage runs (no extra job).

    Caveat (Spark 4.1): after an observed query has run, the ML evaluators'
    RDD closures fail to serialise in that session; the jobs therefore count
    written datasets instead.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def stage_counts(df: DataFrame, valid: Column, train: Column, label: str = LABEL) -> DataFrame:
    """Counts of the pipeline stages in one aggregate: rows (stage, n)."""
    y = F.col(label)
    agg = df.agg(
        F.count(F.lit(1)).alias("input"),
        F.count(F.when(valid, 1)).alias("valid"),
        F.count(F.when(valid & (y == 0), 1)).alias("legit"),
        F.count(F.when(valid & (y == 1), 1)).alias("fraud"),
        F.count(F.when(valid & train, 1)).alias("train"),
        F.count(F.when(valid & ~train, 1)).alias("test"))
    names = ["input", "valid", "legit", "fraud", "train", "test"]
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("stage"), F.col(n).cast("long").alias("n")) for n in names
    ])).alias("s")).select("s.*")


def prediction_counts(scored: DataFrame, model_cols: Sequence[str],
                      prediction_field: str = "is_fraud_prediction") -> DataFrame:
    """(prediction_class, model_name, n) over score structs, one per model.

    Models are stacked with an explode of a fixed-size array, then counted
    with a partial (map-side) + final aggregate of at most 2 x models keys.
    """
    stacked = scored.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("model_name"), F.col(m)[prediction_field].alias("p"))
        for m in model_cols])).alias("s")).select("s.*")
    return (stacked.groupBy(class_name("p").alias("prediction_class"), "model_name")
                   .agg(F.count(F.lit(1)).alias("n")))


def confusion(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    return (pred.groupBy(F.col(label).cast("int").alias("y"),
                         F.col(prediction).cast("int").alias("p"))
                .agg(F.count(F.lit(1)).cast("double").alias("n")))


def f1_report(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """One row: label-weighted F1 (as MulticlassClassificationEvaluator 'f1')
    and the fraud-class F1, from the confusion counts.

    Each confusion cell (y, p, n) counts toward label y as actual (and as a
    hit when y == p) and toward label p as predicted: one regroup by label,
    no join. Only labels that occur as actual values carry weight.
    """
    k = confusion(pred, label, prediction)
    roles = k.select(F.explode(F.array(
        F.struct(F.col("y").alias("lab"), F.col("n").alias("act"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0.0).alias("tp"),
                 F.lit(0.0).alias("prd")),
        F.struct(F.col("p").alias("lab"), F.lit(0.0).alias("act"), F.lit(0.0).alias("tp"),
                 F.col("n").alias("prd")))).alias("r")).select("r.*")
    per = roles.groupBy("lab").agg(F.sum("act").alias("act"), F.sum("tp").alias("tp"),
                                   F.sum("prd").alias("prd")).where(F.col("act") > 0)
    f1_l = F.col("act") * 2 * F.col("tp") / (F.col("act") + F.col("prd"))
    fraud_f1 = 2 * F.col("tp") / (F.col("act") + F.col("prd"))
    return per.agg((F.sum(f1_l) / F.sum("act")).alias("f1"),
                   F.max(F.when(F.col("lab") == 1, fraud_f1)).alias("f1_fraud"))


def pr_points(scored: DataFrame, score: str = "score", label: str = LABEL,
              num_partitions: int | None = None) -> DataFrame:
    """One row per distinct non-NULL score (descending threshold) with running
    true positives and predicted positives: score, tp, n, cum_tp, cum_n, total_tp."""
    g = (scored.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("score"))
               .agg(F.sum(F.col(label).cast("double")).alias("tp"),
                    F.count(F.lit(1)).cast("double").alias("n")))
    # written, so the scores are read and grouped once for the range bounds and the sums
    return running_totals(stored(g, "pr-scores"), "score", ["tp", "n"], descending=True, num_partitions=num_partitions)


def pr_curve(scored: DataFrame, score: str = "score", label: str = LABEL,
             num_partitions: int | None = None) -> DataFrame:
    """(threshold, recall, precision) at every distinct score."""
    pts = pr_points(scored, score, label, num_partitions)
    return pts.select(F.col("score").alias("threshold"),
                      (F.col("cum_tp") / F.col("total_tp")).alias("recall"),
                      (F.col("cum_tp") / F.col("cum_n")).alias("precision"))


def pr_auc(scored: DataFrame, score: str = "score", label: str = LABEL,
           num_partitions: int | None = None) -> DataFrame:
    """Area under the PR curve by trapezoids over distinct scores; the first
    point's precision is carried back to recall 0 (as Spark's evaluator with
    ``numBins=0``). The previous point is recovered from the running sums
    minus the row's own counts, so no ordered ``lag`` is needed."""
    pts = pr_points(scored, score, label, num_partitions)
    P = F.col("total_tp")
    r, pr = F.col("cum_tp") / P, F.col("cum_tp") / F.col("cum_n")
    prev_tp, prev_n = F.col("cum_tp") - F.col("tp"), F.col("cum_n") - F.col("n")
    r0 = prev_tp / P
    p0 = F.when(prev_n > 0, prev_tp / prev_n).otherwise(pr)
    return pts.agg(F.sum((r - r0) * (pr + p0) / 2).alias("pr_auc"))


# Cells of the score histogram that equi-depth bins are made of.
SCORE_CELLS = 1 << 16


def score_histogram(scored: DataFrame, score: str = "score", label: str = LABEL) -> DataFrame:
    """(cell, tp, n): positives and rows per score cell, at most SCORE_CELLS rows
    however many distinct scores there are. Histograms of parts add up. Scores are
    probabilities; those outside [0, 1] fall into the outer cells, NaN into the
    highest, NULL into none."""
    s = F.col(score)
    cell = F.when(F.isnan(s), F.lit(SCORE_CELLS - 1)).otherwise(
        F.greatest(F.least(F.floor(s * SCORE_CELLS), F.lit(SCORE_CELLS - 1)), F.lit(0)))
    return (scored.where(s.isNotNull()).groupBy(cell.cast("int").alias("cell"))
            .agg(F.sum(F.col(label).cast("long")).alias("tp"), F.count(F.lit(1)).alias("n")))


def pr_auc_binned(scored: DataFrame, bins: int = 1000, score: str = "score", label: str = LABEL) -> DataFrame:
    """(pr_auc, area_error): the area under the PR curve by trapezoids over about
    ``bins`` equi-depth bins, and how far the exact area can be from it.

    One narrow aggregate of the rows; the running sums are over histogram rows only
    (at most SCORE_CELLS, then ``bins``). Inside a bin that takes the counts from (TP, N)
    by t positives and f others, every point's precision lies between
    TP / (N + f) and (TP + t) / (N + t): the error sums recall step x that range."""
    cells = running_totals(stored(score_histogram(scored, score, label), "pr-cells"), "cell", ["n"], descending=True)
    ahead_of = F.col("cum_n") - F.col("n")
    binned = cells.select("tp", "n", F.floor(ahead_of * bins / F.col("total_n")).alias("bin"))
    per = binned.groupBy("bin").agg(F.sum("tp").cast("double").alias("t"), F.sum("n").cast("double").alias("n"))
    pts = running_totals(stored(per, "pr-bins"), "bin", ["t", "n"])
    t, f, step = F.col("t"), F.col("n") - F.col("t"), F.col("t") / F.col("total_t")
    tp, n = F.col("cum_t") - t, F.col("cum_n") - F.col("n")
    after = (tp + t) / (n + t + f)
    ahead = F.when(n > 0, tp / n).otherwise(after)
    low = F.when(n + f > 0, tp / (n + f)).otherwise(1.0)
    high = F.when(n + t > 0, (tp + t) / (n + t)).otherwise(0.0)
    return pts.agg(F.sum(step * (ahead + after) / 2).alias("pr_auc"), F.sum(step * (high - low)).alias("area_error"))
