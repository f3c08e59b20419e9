"""The whole flow: CSV -> log -> drain -> prepare -> train -> score (batch and stream)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from txnscore.plans import jobs as J
from txnscore.sources.files import write_dataset
from txnscore.views import transactions


def test_end_to_end(spark, tmp_path):
    d = lambda n: str(tmp_path / n)
    raw = transactions(spark, SF_SMALL)
    write_dataset(raw, d("csv"), fmt="csv")
    gates = J.ingest(spark, d("csv"), d("log"))
    assert all(r["passed"] for r in gates.collect())
    J.drain_log(spark, d("log"), d("landed"), d("ck-drain"))
    prep = J.prepare(spark, d("landed"), d("prepared"))
    assert prep.counts["rejects"] == 0
    assert prep.counts["test"] + 0 > 0 and prep.counts["train"] > prep.counts["test"]
    t = J.train_and_log(spark, prep, d("model"), d("runs"))
    assert spark.read.parquet(d("runs")).count() == 2
    counts = J.score_table(spark, d("model"), raw, d("scores"))
    assert counts.agg(F.sum("n")).first()[0] == 2000
    from txnscore.schemas import MESSAGE
    from txnscore.streaming.scoring import current_totals
    for more in (0, 3):  # a second run goes on from its checkpoint; bad messages are rejects
        if more:
            bad = spark.createDataFrame([("k", "{"), (None, None), ("z", "[1]")], MESSAGE)
            bad.write.mode("append").parquet(d("log"))
        J.score_stream(spark, d("model"), d("log"), d("stream-scores"), d("stream-counts")).awaitTermination()
        assert spark.read.parquet(d("stream-scores")).count() == 1000
        assert spark.read.parquet(d("stream-scores_rejects")).count() == more
        total = current_totals(spark, d("stream-counts")).agg(F.sum("n")).first()[0]
        assert total == 2000
    assert t.gbt is not None


def test_command_line_stages(spark, tmp_path):
    from txnscore.__main__ import main
    d = lambda n: str(tmp_path / n)
    write_dataset(transactions(spark, SF_SMALL), d("csv"), fmt="csv")
    assert main(["ingest", "--csv", d("csv"), "--log", d("log")]) == 0
    assert main(["drain", "--log", d("log"), "--landed", d("landed")]) == 0
    assert main(["prepare", "--landed", d("landed"), "--out", d("prep")]) == 0
    assert main(["train", "--prepared", d("prep"), "--model", d("model"), "--runs", d("runs")]) == 0
    assert main(["score", "--model", d("model"), "--input", d("landed"), "--out", d("scores")]) == 0
    assert spark.read.parquet(d("scores")).count() == 1000
    # a second ingest and drain add to the first
    assert main(["ingest", "--csv", d("csv"), "--log", d("log"), "--rejects", d("bad")]) == 0
    assert main(["drain", "--log", d("log"), "--landed", d("landed")]) == 0
    assert spark.read.parquet(d("landed")).count() == 2000
    # requests by name; one lacks a feature
    from txnscore.plans import models as MD
    names = MD.model_inputs(MD.load_model(d("model")))
    reqs = spark.createDataFrame([("a", {n: 1.0 for n in names}), ("b", {n: 1.0 for n in names[1:]})],
                                 "request_id string, features map<string,double>")
    reqs.write.parquet(d("requests"))
    assert main(["score-requests", "--model", d("model"), "--input", d("requests"), "--out", d("answers")]) == 0
    assert [r["request_id"] for r in spark.read.parquet(d("answers")).collect()] == ["a"]
    assert [tuple(r) for r in spark.read.parquet(d("answers_rejects")).collect()] == [("b", names[0])]
    assert main(["score-stream", "--model", d("model"), "--log", d("log"), "--out", d("ss"), "--counts", d("sc")]) == 0
    assert spark.read.parquet(d("ss")).count() == 2000


def test_prepare_in_the_old_order(spark, tmp_path):
    write_dataset(transactions(spark, SF_SMALL), str(tmp_path / "landed"))
    J.prepare(spark, str(tmp_path / "landed"), str(tmp_path / "prep"), balance_mode="poisson", reference_order=True)
    prep = J.load_prepared(spark, str(tmp_path / "prep"))
    assert (prep.balance_mode, prep.reference_order) == ("poisson", True)
    # copies of one fraud row lie on both sides: the leak the order is kept for
    sides = [spark.read.parquet(p).where("is_fraud = 1").select("trans_num").distinct()
             for p in (prep.train_path, prep.test_path)]
    assert sides[0].join(sides[1], "trans_num").count() > 0


def test_null_keys_are_not_published(spark, tmp_path):
    import pytest
    from txnscore.operators.gates import GateFailed
    d = lambda n: str(tmp_path / n)
    raw = transactions(spark, SF_SMALL).withColumn(
        "trans_num", F.when(F.col("cc_num") % 10 != 0, F.col("trans_num")))
    n = raw.where("trans_num is null").count()
    write_dataset(raw, d("csv"), fmt="csv")
    with pytest.raises(GateFailed, match="null_keys"):
        J.ingest(spark, d("csv"), d("log"))
    assert not (tmp_path / "log").exists()
    J.ingest(spark, d("csv"), d("log"), rejects_path=d("bad"))
    assert spark.read.parquet(d("bad")).count() == n > 0
    assert spark.read.parquet(d("log")).count() == 1000 - n


def test_an_id_column_is_the_key_where_there_is_no_number(spark, tmp_path):
    d = lambda n: str(tmp_path / n)
    write_dataset(transactions(spark, SF_SMALL).withColumnRenamed("trans_num", "row_id"), d("csv"), fmt="csv")
    J.ingest(spark, d("csv"), d("log"), id_col="row_id")
    assert spark.read.parquet(d("log")).select("key").distinct().count() == 1000


def test_a_drain_with_a_foreign_checkpoint_fails(spark, tmp_path):
    """A fresh checkpoint over an old output loses rows; the gate says so."""
    import pytest
    from txnscore.operators.gates import GateFailed
    from txnscore.sources.messages import encode_messages, publish
    d = lambda n: str(tmp_path / n)
    rows = encode_messages(transactions(spark, SF_SMALL))
    publish(rows.where("key < '5'"), "parquet", d("log"))
    J.drain_log(spark, d("log"), d("landed"))
    publish(rows.where("key >= '5'"), "parquet", d("log"))
    with pytest.raises(GateFailed, match="landed_rows"):
        J.drain_log(spark, d("log"), d("landed"), d("other-checkpoint"))


def test_kafka_positions_and_options():
    from txnscore.streaming import drain as D
    assert D.kafka_offsets([("t", 0, 5), ("t", 1, 9)]) == '{"t": {"0": 5, "1": 9}}'
    assert D.kafka_offsets([]) == "earliest"
    assert D._kafka_read_options({"topic": "t", "kafka.bootstrap.servers": "h"}) == {
        "subscribe": "t", "kafka.bootstrap.servers": "h"}


def test_prepare_rejects_and_gates(spark, tmp_path):
    import pytest
    from txnscore.operators.gates import GateFailed
    raw = transactions(spark, SF_SMALL)
    bad = raw.withColumn("amt", F.when(F.col("trans_num").isin("1", "2", "3"), None).otherwise(F.col("amt")))
    write_dataset(bad, str(tmp_path / "landed"))
    prep = J.prepare(spark, str(tmp_path / "landed"), str(tmp_path / "prep"))
    assert prep.counts["rejects"] == 3
    rej = spark.read.parquet(prep.rejects_path)
    assert sorted(r["trans_num"] for r in rej.collect()) == ["1", "2", "3"]
    assert {r["reason"] for r in rej.collect()} == {"amt"}
    test_keys = spark.read.parquet(prep.test_path).select("trans_num")
    train_keys = spark.read.parquet(prep.train_path).select("trans_num").distinct()
    assert test_keys.join(train_keys, "trans_num").count() == 0
    no_fraud = raw.withColumn("is_fraud", F.lit(0))
    write_dataset(no_fraud, str(tmp_path / "landed2"))
    with pytest.raises(GateFailed, match="class_present"):
        J.prepare(spark, str(tmp_path / "landed2"), str(tmp_path / "prep2"))
