"""Checked decoding, stored sketches and observed streams."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnscore.operators import sketches as SK
from txnscore.plans import models as MD
from txnscore.plans.featurize import SPARSE_COL, fit_features
from txnscore.schemas import EVENT_TIME, KEY, LABEL, TXN
from txnscore.session import scratch_path
from txnscore.sources.files import write_dataset
from txnscore.sources.messages import decode_checked, decode_messages, encode_messages, split_decoded
from txnscore.streaming import drain as D
from txnscore.streaming import observed as O
from txnscore.views import transactions

SF_SMALL = "/root/testdata/sf0.001"

SMALL = T.StructType([T.StructField(KEY, T.StringType()), T.StructField(EVENT_TIME, T.TimestampNTZType()),
                      T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType())])
HEAD = f'{{"{KEY}":"k","{EVENT_TIME}":"2020-01-02 03:04:05"'


@pytest.mark.parametrize("value,reason", [
    (HEAD + ',"n":1,"x":2.5}', None), (HEAD + ',"n":null,"x":null}', None), (HEAD + "}", None), (HEAD + ',"x":NaN}', None),
    (HEAD + ',"x":"NaN"}', None), (HEAD + ',"x": -Infinity }', None), (HEAD + ',"x":1e300}', None), (HEAD + ',"more":[1]}', None),
    (HEAD + ',"x":7}', None), (HEAD + ',"n":3000000000}', "type:n"), (HEAD + ',"n":1.5}', "type:n"), (HEAD + ',"n":"1"}', "type:n"),
    (HEAD + ',"n":true,"x":{}}', "type:n,type:x"), (HEAD + ',"x":"2.5"}', "type:x"), (HEAD + ',"n":1', "bad_json"), ("", "bad_json"),
    ("x", "bad_json"), (None, "no_value"), ("[]", "not_object"), ("3", "not_object"), ("null", "not_object"),
    ("{}", f"missing:{KEY},missing:{EVENT_TIME}"), (f'{{"{KEY}":5,"{EVENT_TIME}":"soon"}}', f"type:{KEY},type:{EVENT_TIME}")])
def test_reasons_of_messages(spark, value, reason):
    r = decode_checked(spark.createDataFrame([("k", value)], "key string, value string"), SMALL).first()
    assert r["reason"] == reason and r["value"] == value


def test_good_and_rejected_messages_are_all_messages(spark):
    t = transactions(spark, SF_SMALL)
    log = encode_messages(t).withColumn("value", F.when(F.col("key").cast("long") % 3 != 0, F.col("value")).otherwise(
        F.substring("value", 1, 30)))
    good, rejects = split_decoded(log, required=TXN.fieldNames())
    assert good.count() + rejects.count() == t.count() and {r[0] for r in rejects.select("reason").collect()} == {"bad_json"}
    plain = decode_messages(log).where(f"{KEY} is not null")
    assert good.exceptAll(plain).count() == plain.exceptAll(good).count() == 0
    none = split_decoded(log.limit(0))
    assert none[0].count() == none[1].count() == 0 and none[0].schema == T.StructType(TXN.fields)


def test_a_message_is_parsed_once(spark):
    _, rejects = split_decoded(encode_messages(transactions(spark, SF_SMALL)))
    plan = rejects._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("tryParseJson") + plan.count("try_parse_json") + plan.count("parseJson") <= 2


def test_merged_sketches_keep_the_rank_error(spark):
    rng = np.random.default_rng(3)
    n = 60_000
    cols = {"a": rng.normal(size=n), "b": np.round(rng.exponential(size=n), 1), "c": np.where(rng.random(n) < 0.3, 7.0, rng.random(n))}
    rows = list(zip(*(v.tolist() for v in cols.values()), (rng.integers(0, 12, n)).tolist()))
    df = spark.createDataFrame(rows, "a double, b double, c double, part int").repartition(8)
    path = SK.store_sketches(SK.part_sketches(df, ["a", "b", "c"], "part"), scratch_path(spark, "sk"))
    stored = SK.stored_sketches(spark, path)
    assert stored.agg(F.sum("n")).first()[0] == 3 * n and stored.count() == 36
    for r in SK.merged_quantiles(stored, (0.05, 0.25, 0.5, 0.75, 0.99)).collect():
        v = cols[r["column"]]
        assert (v < r["value"]).mean() <= r["p"] + SK.RANK_ERROR and (v <= r["value"]).mean() >= r["p"] - SK.RANK_ERROR
    ranges = SK.iqr_from_sketches(spark, path, ["a", "b"])
    assert abs(ranges["a"] - (np.quantile(cols["a"], 0.75) - np.quantile(cols["a"], 0.25))) < 0.02


def test_a_new_part_does_not_read_the_old_rows(spark):
    one = spark.createDataFrame([(float(k),) for k in range(1000)], "x double")
    path = SK.store_sketches(SK.part_sketches(one, ["x"], part="mon"), scratch_path(spark, "sk"))
    two = spark.createDataFrame([(float(k),) for k in range(1000, 3000)] + [(None,), (float("nan"),)], "x double")
    SK.store_sketches(SK.part_sketches(two, ["x"], part="tue"), path)
    stored = SK.stored_sketches(spark, path)
    assert {r["part"]: r["n"] for r in stored.collect()} == {"mon": 1000, "tue": 2000}
    merged = SK.merged_quantiles(stored, (0.5,))
    assert abs(merged.first()["value"] - 1500) < 10
    assert merged.inputFiles() and all(path in f for f in merged.inputFiles())  # the rows are not among them
    SK.store_sketches(SK.part_sketches(one.limit(10), ["x"], part="tue"), path)  # landed again: replaced
    assert {r["part"]: r["n"] for r in SK.stored_sketches(spark, path).collect()} == {"mon": 1000, "tue": 10}
    with pytest.raises(ValueError):
        SK.iqr_from_sketches(spark, path, ["y"])


def test_listener_counts_and_the_evaluators_afterwards(spark):
    rows = transactions(spark, SF_SMALL).repartition(5)
    log = write_dataset(encode_messages(rows), scratch_path(spark, "log"))
    landed = scratch_path(spark, "landed")

    def start(own):
        stream = D.decoded_stream(D.message_stream(own, log, max_files_per_trigger=2))
        return D.land(O.observed(stream, F.col("amt") > 100), landed, scratch_path(spark, "ckpt"))
    counts = O.run_observed(spark, start)
    ok = rows.where("amt > 100")
    assert counts == {"input": rows.count(), "valid": ok.count(), "legit": ok.where(f"{LABEL} = 0").count(),
                      "fraud": ok.where(f"{LABEL} = 1").count()}
    assert spark.read.parquet(landed).count() == counts["input"]
    scored = rows.select(F.col(LABEL).cast("double").alias(LABEL), "amt")
    area = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="amt", metricName="areaUnderPR").evaluate(scored)
    assert 0 < area <= 1


def test_a_replayed_batch_counts_once():
    from types import SimpleNamespace as N

    from pyspark.sql import Row
    listener = O.StageCounts()
    for batch in (0, 1, 1):
        listener.onQueryProgress(N(progress=N(id="q", batchId=batch, observedMetrics={O.STAGES: Row(input=5)})))
    listener.onQueryProgress(N(progress=N(id="q", batchId=2, observedMetrics={})))
    listener.onQueryTerminated(N(id="q"))
    assert listener.counts(N(id="q")) == {"input": 10}
    with pytest.raises(TimeoutError):
        listener.counts(N(id="other"), timeout=0.01)


def test_a_category_of_thousands_of_values_fits_saves_and_scores(spark):
    t = transactions(spark, SF_SMALL).withColumn("category", F.concat(F.lit("c"), F.lpad((F.col("trans_num").cast("long") % 997).cast("string"), 5, "0")))
    many = t.unionByName(t.limit(1).select(*[F.explode(F.array(*[F.lit(f"d{k:05d}") for k in range(5000)])).alias("category") if c == "category"
                                             else F.col(c) for c in t.columns]))
    fitted = fit_features(many, one_hot="sparse")
    model = PipelineModel(stages=[*fitted.stages, MD.lr_estimator().setMaxIter(3).fit(fitted.transform(many))])
    path = MD.save_model(model, scratch_path(spark, "sparse-model"))
    odd = t.limit(3).withColumn("category", F.element_at(F.array(F.lit(None), F.lit("new"), F.lit("c00000")),
                                                         (F.row_number().over(Window.orderBy(KEY))).cast("int")))
    loaded = MD.load_model(path)
    for v in loaded.transform(odd).select(SPARSE_COL).collect():  # NULL, unseen and baseline: no entry
        assert v[0].size == 5996 and len(v[0].indices) == 0
    before, after = ({r[KEY]: r[1] for r in MD.score(m, t).collect()} for m in (model, loaded))
    assert before == after and len(after) == t.count()
    some = loaded.transform(many.where("category = 'd00000'")).select(SPARSE_COL, "features").first()
    assert some[0].indices.tolist() == [996] and some[0].values.tolist() == [1.0]
    with pytest.raises(ValueError):
        fit_features(t, one_hot="other")
