"""Distributed running sums, exact quantiles and PR metrics against brute force."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from txnscore.operators import metrics as M
from txnscore.operators.scale import iqr, iqr_table
from txnscore.operators.stats import exact_quantiles, running_totals


def brute_pr_auc(pairs):
    """Trapezoids over distinct scores, first precision carried to recall 0."""
    scores = sorted({s for s, _ in pairs}, reverse=True)
    P = sum(y for _, y in pairs)
    tp = n = 0
    area, r0, p0 = 0.0, 0.0, None
    for s in scores:
        tp += sum(y for x, y in pairs if x == s)
        n += sum(1 for x, _ in pairs if x == s)
        r, p = tp / P, tp / n
        area += (r - r0) * (p + (p if p0 is None else p0)) / 2
        r0, p0 = r, p
    return area


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 5)), min_size=1, max_size=200),
       st.integers(1, 7), st.booleans())
def test_running_totals_equal_cumsum(spark, rows, parts, desc):
    # one row per distinct key (the documented precondition)
    uniq = {}
    for k, v in rows:
        uniq[k] = v
    data = sorted(uniq.items(), reverse=desc)
    df = spark.createDataFrame(data, "k long, v long")
    got = {r["k"]: (r["cum_v"], r["total_v"]) for r in
           running_totals(df, "k", ["v"], descending=desc, num_partitions=parts).collect()}
    acc, total = 0, sum(v for _, v in data)
    for k, v in data:
        acc += v
        assert got[k] == (acc, total)


def test_running_totals_grouped(spark):
    rnd = random.Random(3)
    data = [(g, k, rnd.randint(0, 9)) for g in ("a", "b", "c") for k in range(300)]
    df = spark.createDataFrame(data, "g string, k long, v long")
    got = {(r["g"], r["k"]): r["cum_v"] for r in
           running_totals(df, "k", ["v"], group_cols=["g"], num_partitions=5).collect()}
    for g in ("a", "b", "c"):
        acc = 0
        for _, k, v in [d for d in data if d[0] == g]:
            acc += v
            assert got[(g, k)] == acc


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_running_totals_with_other_columns_and_without_exchange_reuse(spark, reuse):
    """A row's range is a function of its key, whatever else the row holds and
    whether or not Spark shares an exchange."""
    n = 60_000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.lit(1).alias("v"), F.rand(3).alias("other"),
                               F.col("id").cast("string").alias("text"))
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        out = running_totals(df, "k", ["v"])
        assert out.columns == ["k", "v", "other", "text", "cum_v", "total_v"]
        wrong = out.where((F.col("cum_v") != F.col("k") + 1) | (F.col("total_v") != n))
        assert out.count() == n and wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)


def test_running_totals_shuffle_rows_once(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v"), F.lit("x").alias("text"))
    plan = running_totals(df, "k", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in plan.splitlines() if "Exchange" in x and "text" in x]) <= 1
    assert "BroadcastNestedLoopJoin" not in plan


def test_a_column_without_values_has_no_quartiles(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    for error in (0.0, 0.001):
        with pytest.raises(ValueError, match="'a'"):
            iqr(df, ["a", "b"], error)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 10, 101, 1000])
def test_exact_quantiles_are_percentile_disc(spark, n):
    rnd = random.Random(n)
    vals = [float(rnd.randint(0, 50)) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r["p"]: r["value"] for r in exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.75, 1.0]).collect()}
    s = sorted(vals)
    for p, v in got.items():
        assert v == s[max(math.ceil(p * n), 1) - 1]


def test_iqr_ignores_nan_and_handles_constant(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (2.0,)], "amt double")
    assert iqr(df, ["amt"], 0.0) == {"amt": 2.0}
    assert iqr(df, ["amt"], 0.001) == {"amt": 2.0}      # the sketch skips NaN too
    const = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (9.0,)], "amt double")
    assert iqr(const, ["amt"], 0.0) == {"amt": 0.0}
    assert iqr_table(const, ["amt"]).first()["iqr"] == 0.0
    from txnscore.operators.scale import robust_scale, robust_scale_vector
    for scaled in (robust_scale(const, ["amt"], 0.0), robust_scale_vector(const, ["amt"], 0.0)):
        assert [r["amt_scaled"] for r in scaled.collect()] == [0.0, 0.0, 0.0, 0.0]


def test_pr_auc_matches_brute_force_and_evaluator(spark):
    rnd = random.Random(7)
    pairs = [(round(rnd.random(), 2), 1 if rnd.random() < 0.3 else 0) for _ in range(500)]
    df = spark.createDataFrame(pairs, "score double, is_fraud int")
    got = M.pr_auc(df, num_partitions=6).first()["pr_auc"]
    assert got == pytest.approx(brute_pr_auc(pairs), abs=1e-12)
    ev_df = df.select(array_to_vector(F.array(1 - F.col("score"), F.col("score"))).alias("raw"),
                      F.col("is_fraud").cast("double").alias("label"))
    ev = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label",
                                       metricName="areaUnderPR", numBins=0).evaluate(ev_df)
    assert got == pytest.approx(ev, abs=1e-9)


def test_weighted_f1_matches_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rnd = random.Random(11)
    rows = [(float(rnd.random() < 0.2), float(rnd.random() < 0.25)) for _ in range(400)]
    df = spark.createDataFrame(rows, "is_fraud double, prediction double")
    rep = M.f1_report(df).first()
    ev = MulticlassClassificationEvaluator(labelCol="is_fraud", predictionCol="prediction",
                                           metricName="f1").evaluate(df)
    assert rep["f1"] == pytest.approx(ev, abs=1e-12)
    tp = sum(1 for y, p in rows if y == 1 and p == 1)
    act = sum(1 for y, _ in rows if y == 1)
    prd = sum(1 for _, p in rows if p == 1)
    assert rep["f1_fraud"] == pytest.approx(2 * tp / (act + prd))
    assert np.isfinite(rep["f1"])


def test_vector_scaler_equals_column_scaler(spark):
    from txnscore.operators.features import add_distance
    from txnscore.operators.scale import robust_scale, robust_scale_vector
    from txnscore.views import transactions
    t = add_distance(transactions(spark, "/root/testdata/sf0.001")).select("trans_num", "amt", "distance_km")
    a = robust_scale(t, ["amt", "distance_km"], 0.0)
    b = robust_scale_vector(t, ["amt", "distance_km"], 0.0)
    j = a.join(b.withColumnsRenamed({"amt_scaled": "a2", "distance_km_scaled": "d2"}), "trans_num")
    worst = j.agg(F.max(F.abs(F.col("amt_scaled") - F.col("a2"))),
                  F.max(F.abs(F.col("distance_km_scaled") - F.col("d2")))).first()
    assert j.count() == 1000 and worst[0] < 1e-12 and worst[1] < 1e-12


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.integers(-50, 50).map(float), st.just(float("nan"))), min_size=1,
                max_size=300),
       st.sampled_from([0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]))
def test_band_quantiles_equal_full_rank(spark, vals, p):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    band = {r["p"]: r["value"] for r in exact_quantiles(df, ["x"], [p], eps=0.01).collect()}
    clean = sorted(v for v in vals if v == v)
    if not clean:
        assert band == {}
        return
    assert band == {p: clean[max(math.ceil(p * len(clean)), 1) - 1]}


def test_band_quantiles_large_with_hot_value(spark):
    df = spark.range(200000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise((F.col("id") * 7919 % 100003).cast("double")).alias("x"),
        (F.col("id") % 1000).cast("double").alias("y"))
    probs = [0.25, 0.5, 0.75]
    a = {(r["column"], r["p"]): r["value"] for r in exact_quantiles(df, ["x", "y"], probs).collect()}
    b = {(r["column"], r["p"]): r["value"] for r in
         exact_quantiles(df, ["x", "y"], probs, method="full").collect()}
    assert a == b and len(a) == 6
