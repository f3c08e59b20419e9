"""Property tests for the rows-only (random / model) operators and the
measured fixture values of FIXTURES.md."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL
from txnscore.functions import linear_score
from txnscore.operators import balance as B
from txnscore.operators.scale import iqr
from txnscore.operators.split import split_hash, split_random
from txnscore.plans import catalog_models as CM
from txnscore.plans import models as MD
from txnscore.plans.featurize import model_features
from txnscore.operators.features import add_distance
from txnscore.views import transactions


def test_fixture_counts(spark):
    t = transactions(spark, SF_ORACLE)
    row = B.class_balance(t).first()
    assert (row["legit"], row["fraud"]) == (9823, 177)
    tr, te = split_hash(t)
    got = {(side, r["is_fraud"]): r["count"] for side, d in (("train", tr), ("test", te))
           for r in d.groupBy("is_fraud").count().collect()}
    assert got == {("train", 0): 7851, ("train", 1): 144, ("test", 0): 1972, ("test", 1): 33}
    assert B.oversample(t, mode="exact").count() == 9831
    r = iqr(add_distance(t), ["amt", "distance_km"], 0.0)
    assert r["amt"] == pytest.approx(54.58)
    assert round(r["distance_km"], 6) == pytest.approx(41.760705)


def test_sketch_iqr_close_to_exact(spark):
    t = transactions(spark, SF_ORACLE)
    exact = iqr(t, ["amt"], 0.0)["amt"]
    approx = iqr(t, ["amt"], 0.001)["amt"]
    assert abs(exact - approx) < 0.5


def test_poisson_size_within_five_sigma(spark):
    t = transactions(spark, SF_ORACLE)
    ratio = B.oversample_ratio(t)
    n = B.oversample(t, mode="poisson", seed=42).count()
    mean = 177 * ratio
    assert abs(n - mean) < 5 * math.sqrt(mean)


def test_random_split_sizes_and_disjoint(spark):
    t = transactions(spark, SF_ORACLE).select("trans_num")
    tr, te = split_random(t)
    a, b = tr.count(), te.count()
    assert a + b == 10000 and abs(a / 10000 - 0.8) < 0.03
    assert tr.join(te, "trans_num").count() == 0


def test_hash_split_is_partitioning_independent(spark):
    t = transactions(spark, SF_SMALL)
    a = {r[0] for r in split_hash(t)[0].select("trans_num").collect()}
    b = {r[0] for r in split_hash(t.repartition(7))[0].select("trans_num").collect()}
    assert a == b


def test_no_key_on_both_sides_by_default(spark):
    t = CM.trained(spark, SF_SMALL)
    both = t.train.select("trans_num").distinct().join(t.test.select("trans_num"), "trans_num")
    assert both.count() == 0


def test_lr_equals_linear_score_with_its_coefficients(spark):
    t = CM.trained(spark, SF_SMALL)
    names = model_features(t.features)
    coefs = dict(zip(names, t.lr.coefficients.toArray().tolist()))
    raw = transactions(spark, SF_SMALL)
    feats = raw
    for s in t.features.stages[:-1]:
        feats = s.transform(feats)
    mine = feats.select("trans_num", linear_score(coefs, t.lr.intercept).alias("p"))
    theirs = MD.score(t.scorer(), raw).select("trans_num", F.col(f"{MD.LR_NAME}.fraud_probability").alias("q"))
    worst = mine.join(theirs, "trans_num").agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0]
    assert worst < 1e-9


def test_column_order_does_not_change_scores(spark):
    t = CM.trained(spark, SF_SMALL)
    raw = transactions(spark, SF_SMALL)
    permuted = raw.select(*reversed(raw.columns))
    a = MD.score(t.scorer(), raw)
    b = MD.score(t.scorer(), permuted)
    diff = a.join(b.withColumnsRenamed({MD.LR_NAME: "l2", MD.GBT_NAME: "g2"}), "trans_num").where(
        (F.col(MD.LR_NAME) != F.col("l2")) | (F.col(MD.GBT_NAME) != F.col("g2")))
    assert diff.count() == 0


def test_model_roundtrip_same_scores(spark):
    out = CM.q_model_roundtrip(spark, SF_SMALL)
    assert out.where(~F.col("lr_same") | ~F.col("gbt_same")).count() == 0
    assert out.count() == CM.trained(spark, SF_SMALL).test.count()


def test_stream_scores_equal_batch(spark, tmp_path):
    from txnscore.schemas import TXN
    t = CM.trained(spark, SF_SMALL)
    raw = transactions(spark, SF_SMALL)
    src = str(tmp_path / "src")
    raw.write.parquet(src)
    stream = spark.readStream.schema(TXN).parquet(src)
    scored = MD.score(t.scorer(), stream)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    q = scored.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out)
    q.awaitTermination()
    s = spark.read.parquet(out)
    b = MD.score(t.scorer(), raw)
    assert s.count() == b.count() == 1000
    assert s.exceptAll(b).count() == 0


def test_runs_table_and_flagship(spark):
    import __spark_entry__ as E
    runs = CM.q_runs_table(spark, SF_SMALL).collect()
    assert {r["model_type"] for r in runs} == {"LogisticRegressionModel", "GBTClassificationModel"}
    assert all(0 <= r["pr_auc"] <= 1 and 0 <= r["f1"] <= 1 for r in runs)
    counts = E.entry(spark).collect()
    assert sum(r["n"] for r in counts) == 2000
    assert {r["model_name"] for r in counts} == {MD.LR_NAME, MD.GBT_NAME}


def test_every_query_runs(spark):
    import __spark_entry__ as E
    for name in ("encode_messages", "oversample_poisson", "split_random", "train_lr",
                 "train_gbt", "score_batch"):
        df = E.queries()[name](spark, SF_SMALL)
        assert df.count() > 0, name


def test_request_scores_equal_raw_scores(spark):
    t = CM.trained(spark, SF_SMALL)
    via_requests = CM.q_score_model_requests(spark, SF_SMALL).withColumnRenamed("request_id", "trans_num")
    raw = MD.score(t.scorer(), transactions(spark, SF_SMALL))
    assert via_requests.count() == 1000
    assert via_requests.exceptAll(raw).count() == 0


def test_payload_requests_missing_names_are_rejected(spark):
    """The two payloads of the old smoke calls (21 names each) against a model
    trained on our categories: unknown names are ignored, missing ones reject."""
    t = CM.trained(spark, SF_SMALL)
    # The category feature names carried by the old request payloads.
    cats = ["cat_grocery_pos", "cat_entertainment", "cat_gas_transport", "cat_grocery_net",
            "cat_shopping_net", "cat_shopping_pos", "cat_travel", "cat_misc_pos",
            "cat_health_fitness", "cat_kids_pets", "cat_home", "cat_personal_care",
            "cat_food_dining", "cat_misc_net"]
    common = ["trans_hour", "trans_day_of_week", "age", "city_pop", "amt_scaled",
              "distance_km_scaled", "gender_M"]
    p1 = dict.fromkeys(common + cats, 0.0)
    p1.update(trans_hour=14, trans_day_of_week=3, age=35, city_pop=55000, amt_scaled=2.5,
              distance_km_scaled=0.1, gender_M=1, cat_entertainment=1)
    p2 = dict.fromkeys(common + cats, 0.0)
    p2.update(trans_hour=10, trans_day_of_week=2, age=42, city_pop=120000, amt_scaled=-0.15,
              distance_km_scaled=0.02, cat_grocery_pos=1)
    reqs = spark.createDataFrame([("entertainment", {k: float(v) for k, v in p1.items()}),
                                  ("genuine", {k: float(v) for k, v in p2.items()})],
                                 "request_id string, features map<string,double>")
    scores, rejects = MD.score_requests(t.scorer(), reqs)
    assert scores.count() == 0
    reasons = {r["request_id"]: r["reason"] for r in rejects.collect()}
    assert set(reasons) == {"entertainment", "genuine"}
    assert "cat_purchase" in reasons["genuine"]
    # With the model's own names present, the same request scores.
    names = MD.model_inputs(t.scorer())
    full = spark.createDataFrame([("ok", {n: p1.get(n, 0.0) * 1.0 for n in names})],
                                 "request_id string, features map<string,double>")
    s2, r2 = MD.score_requests(t.scorer(), full)
    assert s2.count() == 1 and r2.count() == 0


def test_account_number_is_never_a_feature(spark):
    t = CM.trained(spark, SF_SMALL)
    names = model_features(t.features)
    assert "cc_num" not in names and "trans_num" not in names and "is_fraud" not in names
    assert names[:4] == ["trans_hour", "trans_day_of_week", "city_pop", "gender_M"]


def test_reference_order_leaks_copies_across_sides(spark):
    """Old order (balance, then random split): copies of one fraud row sit on
    both sides; the default order never does (see test_no_key_on_both_sides)."""
    t = transactions(spark, SF_SMALL)
    bal = B.balance(t, mode="exact", copy_col=None)
    tr, te = split_random(bal, (0.8, 0.2), seed=42)
    shared = (tr.where("is_fraud = 1").select("trans_num").distinct()
                .join(te.where("is_fraud = 1").select("trans_num").distinct(), "trans_num"))
    assert shared.count() > 0


def test_reconcile_checksum_mode(spark):
    from txnscore.operators.gates import gate_reconcile
    from txnscore.sources.messages import encode_messages
    t = transactions(spark, SF_SMALL)
    log = encode_messages(t)
    ok = {r["gate"]: r["passed"] for r in gate_reconcile(t, log, "trans_num", "key", "checksum").collect()}
    assert all(ok.values())
    changed = log.where("key <> '5'").unionByName(log.where("key = '5'").selectExpr("'x5' as key", "value"))
    bad = {r["gate"]: r for r in gate_reconcile(t, changed, "trans_num", "key", "checksum").collect()}
    assert bad["published_count"]["passed"] and not bad["missing_in_log"]["passed"]
    exact = {r["gate"]: r["observed"] for r in gate_reconcile(t, changed, "trans_num", "key").collect()}
    assert exact == {"published_count": 1000, "missing_in_log": 1, "unknown_in_log": 1}


def test_stream_model_counts_equal_batch_counts(spark):
    from txnscore.operators.metrics import prediction_counts
    s = CM.q_stream_model_counts(spark, SF_SMALL)
    per_model = {(r["prediction_class"], r["model_name"]): r["n"] for r in
                 s.groupBy("prediction_class", "model_name").agg(F.sum("n").alias("n")).collect()}
    batch = prediction_counts(MD.score(CM.trained(spark, SF_SMALL).scorer(), transactions(spark, SF_SMALL)),
                              [MD.LR_NAME, MD.GBT_NAME])
    assert per_model == {(r["prediction_class"], r["model_name"]): r["n"] for r in batch.collect()}


def test_run_metrics_equal_spark_evaluators(spark):
    from pyspark.ml import PipelineModel
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    t = CM.trained(spark, SF_SMALL)
    model = PipelineModel(stages=list(t.features.stages) + [t.lr])
    met = MD.evaluate(model.transform(t.test), "lr")
    f1 = MulticlassClassificationEvaluator(labelCol="is_fraud", predictionCol="lr_prediction",
                                           metricName="f1").evaluate(model.transform(t.test))
    assert met["f1"] == pytest.approx(f1, abs=1e-12)


def test_reference_order_training_runs_and_leaks(spark):
    t = MD.train(transactions(spark, SF_SMALL), reference_order=True, with_gbt=False)
    assert t.split_mode == "random"
    shared = (t.train.where("is_fraud = 1").select("trans_num").distinct()
                .join(t.test.where("is_fraud = 1").select("trans_num").distinct(), "trans_num"))
    assert shared.count() > 0
    runs = MD.runs(t, "old").collect()
    assert len(runs) == 1 and runs[0]["train_order"] == "reference"
