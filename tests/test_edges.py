"""Hand-made edge tables (FIXTURES.md section 5)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from txnscore.functions import haversine_km, parse_time
from txnscore.operators import balance as B
from txnscore.operators import features as FE
from txnscore.operators import gates as G
from txnscore.schemas import TXN
from txnscore.sources.messages import decode_messages, encode_messages

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def txn_rows(spark, rows):
    """Transactions from partial dicts (missing fields NULL)."""
    names = TXN.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], TXN)


def base(i, **kw):
    r = dict(trans_num=str(i), trans_date_trans_time=dt.datetime(2024, 1, 1, 10, 0, 0),
             cc_num=1, category="purchase", amt=10.0, gender="M", city_pop=100,
             lat=40.0, long=-100.0, merch_lat=40.5, merch_long=-100.5, is_fraud=0)
    r.update(kw)
    return r


def test_bad_time_gives_null(spark):
    df = spark.createDataFrame([("x",), ("2020-01-01 00:00:00",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_time("s")).collect()]
    assert got == [None, dt.datetime(2020, 1, 1), None]


def test_null_flags_and_vocabulary(spark):
    df = txn_rows(spark, [base(1, gender=None, category=None), base(2, category="a")])
    vocab = FE.fit_vocabulary(df, "category")
    assert vocab == ["a"]
    out = FE.add_flag(df).collect()
    assert [r["gender_M"] for r in out] == [0, 1]
    oh = FE.one_hot(df, "category", ["a", "b"]).collect()
    assert [r["cat_b"] for r in oh] == [0, 0]


def test_name_clash_fails(spark):
    df = txn_rows(spark, [base(1, category="a b"), base(2, category="a/b")])
    with pytest.raises(ValueError, match="a b.*a/b"):
        FE.fit_vocabulary(df, "category")


def test_vocabulary_size_guard(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("category"))
    with pytest.raises(ValueError, match="more than 10"):
        FE.fit_vocabulary(df, "category", max_size=10)


def test_null_coordinate_rejects_and_error_mode(spark):
    df = txn_rows(spark, [base(1), base(2, merch_lat=None), base(3, amt=float("nan"))])
    cols = ["amt", "lat", "long", "merch_lat", "merch_long"]
    rej = {r["trans_num"]: r["reason"] for r in FE.reject_rows(df, cols).collect()}
    assert rej == {"2": "merch_lat", "3": "amt"}
    assert [r["trans_num"] for r in FE.valid_rows(df, cols, "skip").collect()] == ["1"]
    with pytest.raises(Exception, match="invalid value"):
        FE.valid_rows(df, cols, "error").collect()


def test_odd_labels(spark):
    df = txn_rows(spark, [base(1, is_fraud=0), base(2, is_fraud=1), base(3, is_fraud=2),
                          base(4, is_fraud=None)])
    valid, rej = FE.split_invalid(df, ["amt"], label="is_fraud")
    assert sorted(r["trans_num"] for r in valid.collect()) == ["1", "2"]
    assert sorted((r["trans_num"], r["reason"]) for r in rej.collect()) == [("3", "is_fraud"),
                                                                           ("4", "is_fraud")]


def test_no_fraud_gate_fails(spark):
    df = txn_rows(spark, [base(i) for i in range(5)])
    g = G.gate_class_present(df)
    assert g.first()["passed"] is False
    with pytest.raises(G.GateFailed):
        G.enforce(g)
    with pytest.raises(ValueError):
        B.oversample_ratio(df)


def test_fraud_majority_downsamples(spark):
    rows = [base(i, is_fraud=0) for i in range(200)] + [base(1000 + i, is_fraud=1) for i in range(800)]
    df = txn_rows(spark, rows)
    assert B.oversample_ratio(df) == 0.25
    n = B.oversample(df, mode="exact").count()
    assert 150 <= n <= 250      # about a quarter of the 800 fraud rows


def test_bad_json(spark):
    msgs = spark.createDataFrame([("1", "{bad"), ("2", '{"amt":NaN}'), ("3", '{"amt":"NaN"}')],
                                 "key string, value string")
    got = {r["key"]: r for r in decode_messages(msgs, keep_key=True).collect()}
    assert got["1"]["amt"] is None and got["1"]["trans_num"] is None
    assert got["2"]["amt"] != got["2"]["amt"]      # NaN
    assert got["3"]["amt"] != got["3"]["amt"]
    rej = FE.reject_rows(decode_messages(msgs, keep_key=True), ["amt", "trans_num"])
    assert sorted(r["key"] for r in rej.collect()) == ["1", "2", "3"]


def test_micro_time_round_trip(spark):
    ts = dt.datetime(2024, 5, 6, 7, 8, 9, 123456)
    df = txn_rows(spark, [base(1, trans_date_trans_time=ts)])
    back = decode_messages(encode_messages(df)).first()
    assert back["trans_date_trans_time"] == ts
    assert back.asDict() == df.first().asDict()


def test_null_key_falls_back_only_when_column_absent(spark):
    df = txn_rows(spark, [base(1, trans_num=None)])
    assert encode_messages(df).first()["key"] is None
    no_key = df.drop("trans_num").withColumn("row_id", F.lit(7))
    assert encode_messages(no_key, id_col="row_id").first()["key"] == "7"
    decoded = decode_messages(encode_messages(df), keep_key=True).first()
    assert decoded["key"] == ""


def test_same_point_and_antipodes(spark):
    df = spark.createDataFrame([(10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 180.0),
                                (45.0, 30.0, -45.0, -150.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert got[0] == 0.0
    assert got[1] == pytest.approx(20015.087, abs=1e-3)
    assert got[2] == pytest.approx(20015.087, abs=1e-3)


def test_duplicate_message_dedupe(spark, tmp_path):
    from txnscore.streaming.drain import drain
    df = txn_rows(spark, [base(1), base(1), base(2)])
    log = str(tmp_path / "log")
    encode_messages(df).write.parquet(log)
    plain = drain(spark, log, str(tmp_path / "o1"), str(tmp_path / "c1"))
    assert spark.read.parquet(plain).count() == 3
    dd = drain(spark, log, str(tmp_path / "o2"), str(tmp_path / "c2"), dedupe_within="1 day")
    assert spark.read.parquet(dd).count() == 2


def test_stream_windows_ignore_session_zone(spark):
    import __spark_entry__ as E
    from oracle import compare
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        for name in ("stream_score_counts", "parse_time", "time_features", "decode_messages"):
            ok, _, detail = compare(spark, name, E.queries()[name], E.oracle_sql()[name],
                                    "/root/testdata/sf0.001")
            assert ok, (name, detail)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_huge_ratio_copies_are_chunked(spark, monkeypatch):
    monkeypatch.setattr(B, "COPY_CHUNK", 7)
    rows = [base(i, is_fraud=0) for i in range(100)] + [base(1000 + i, is_fraud=1) for i in range(4)]
    df = txn_rows(spark, rows)
    out = B.oversample(df, mode="exact").collect()
    by_key = {}
    for r in out:
        by_key.setdefault(r["trans_num"], []).append(r["copy"])
    assert sum(len(v) for v in by_key.values()) == 100      # ratio 25 exactly
    for copies in by_key.values():
        assert sorted(copies) == list(range(1, 26))


def test_drain_in_several_micro_batches(spark, tmp_path):
    from txnscore.streaming.drain import drain
    df = txn_rows(spark, [base(i) for i in range(30)])
    log = str(tmp_path / "log")
    encode_messages(df).repartition(6).write.parquet(log)
    out = drain(spark, log, str(tmp_path / "o"), str(tmp_path / "c"), max_files_per_trigger=2)
    assert spark.read.parquet(out).count() == 30


def test_csv_binds_columns_by_header_name(spark, tmp_path):
    from txnscore.sources.files import read_transactions
    p = tmp_path / "raw.csv"
    p.write_text(
        "Unnamed: 0,merchant,is_fraud,amt,trans_num,trans_date_trans_time,category,gender,"
        "city_pop,lat,long,merch_lat,merch_long,cc_num\n"
        "0,shop,1,12.5,0001,2019-01-01 00:00:18,misc_net,F,1200,40.5,-80.25,40.75,-80.5,1111222233334444\n"
        "1,shop,0,bad,0002,not a time,grocery_pos,M,300,45.0,-110.0,45.5,-110.5,5555666677778888\n")
    rows = {r["trans_num"]: r for r in read_transactions(spark, str(p)).collect()}
    assert set(rows) == {"0001", "0002"}          # text key keeps its leading zeros
    a, b = rows["0001"], rows["0002"]
    assert a["amt"] == 12.5 and a["is_fraud"] == 1 and a["category"] == "misc_net"
    assert a["trans_date_trans_time"] == dt.datetime(2019, 1, 1, 0, 0, 18)
    assert a["cc_num"] == 1111222233334444
    assert b["amt"] is None and b["trans_date_trans_time"] is None   # to rejects, no failure
    assert "merchant" not in read_transactions(spark, str(p)).columns


def test_unscorable_rows_go_to_rejects(spark):
    from txnscore.plans import catalog_models as CM
    from txnscore.plans import models as MD
    t = CM.trained(spark, "/root/testdata/sf0.001")
    df = txn_rows(spark, [base(1), base(2, city_pop=None), base(3, merch_long=float("nan"))])
    scores, rejects = MD.score_checked(t.scorer(), df)
    assert [r["trans_num"] for r in scores.collect()] == ["1"]
    assert sorted((r["trans_num"], r["reason"]) for r in rejects.collect()) == [
        ("2", "city_pop"), ("3", "merch_long")]


def test_drop_columns_and_feature_columns(spark):
    df = txn_rows(spark, [base(1)]).withColumn("Unnamed: 0", F.lit(0))
    kept = FE.drop_columns(FE.base_features(df))
    assert "Unnamed: 0" not in kept.columns and "trans_num" not in kept.columns
    assert {"trans_hour", "distance_km", "gender_M", "amt", "is_fraud", "cc_num"} <= set(kept.columns)
    # the old rule: every remaining column but the label (an account number slips in)
    assert "cc_num" in FE.feature_columns(kept)
    assert "is_fraud" not in FE.feature_columns(kept)
    # the allow-list keeps its order and refuses missing names
    assert FE.feature_columns(kept, allow=["amt", "trans_hour"]) == ["amt", "trans_hour"]
    with pytest.raises(ValueError, match="age"):
        FE.feature_columns(kept, allow=["age"])


def test_profile_counts_rows_while_writing(tmp_path):
    """observe() in its own process: on Spark 4.1 an observed query leaves the
    session unable to serialise the ML evaluators' closures afterwards."""
    import subprocess
    import sys
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from txnscore.session import get_spark
from txnscore.operators.metrics import profile
from txnscore.views import transactions
s = get_spark("local[2]", extra={{"spark.ui.showConsoleProgress": "false"}})
df, obs = profile(transactions(s, "/root/testdata/sf0.001"), "input")
df.write.parquet({str(tmp_path / "out")!r})
print("ROWS", obs.get["rows"])
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "ROWS 1000" in out.stdout, out.stderr[-2000:]


def test_land_partitioned_by_event_date(spark, tmp_path):
    from txnscore.streaming.drain import decoded_stream, land, message_stream
    df = txn_rows(spark, [base(1), base(2, trans_date_trans_time=dt.datetime(2024, 1, 2, 3))])
    encode_messages(df).write.parquet(str(tmp_path / "log"))
    rows = decoded_stream(message_stream(spark, str(tmp_path / "log"))).withColumn(
        "event_date", F.to_date("trans_date_trans_time"))
    land(rows, str(tmp_path / "out"), str(tmp_path / "ck"), partition_by=["event_date"]).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["trans_num"] for r in out.where("event_date = '2024-01-02'").collect()) == ["2"]


def test_optional_gender_and_category_columns(spark):
    from txnscore.plans import models as MD
    from txnscore.plans.featurize import fit_features
    from txnscore.views import transactions
    raw = transactions(spark, "/root/testdata/sf0.001").drop("gender", "category")
    feats = fit_features(raw)
    names = feats.stages[-1].getInputCols()
    assert "gender_M" not in names and not [n for n in names if n.startswith("cat_")]
    t = MD.train(raw, with_gbt=False)
    assert MD.score(t.scorer(), raw).count() == 1000


def test_files_with_other_headers_fail(spark, tmp_path):
    from txnscore.sources.files import read_transactions
    d = tmp_path / "csv"
    d.mkdir()
    (d / "a.csv").write_text("trans_num,amt,lat\n1,2.5,33.0\n")
    (d / "b.csv").write_text("trans_num,lat,amt\n2,33.0,2.5\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_transactions(spark, str(d)).collect()


def test_partition_columns_keep_their_type(spark, tmp_path):
    from txnscore.schemas import TXN
    from txnscore.sources.files import read_dataset, write_dataset
    df = txn_rows(spark, [base(1, category="05"), base(2, category="07")])
    path = write_dataset(df, str(tmp_path / "p"), partition_by=["category"])
    assert sorted(r["category"] for r in read_dataset(spark, path, schema=TXN).collect()) == ["05", "07"]


def test_union_of_different_columns_fails(spark):
    a = txn_rows(spark, [base(1)])
    with pytest.raises(Exception, match="(?i)column"):
        B.union_all(a, a.drop("amt")).collect()


def test_scores_keep_every_row(spark):
    from txnscore.plans import catalog_models as CM
    from txnscore.plans import models as MD
    t = CM.trained(spark, "/root/testdata/sf0.001")
    df = txn_rows(spark, [base(1), base(2, amt=None), base(3, lat=float("nan"))])
    got = {r["trans_num"]: r["gbt_classifier"] for r in MD.score(t.scorer(), df).collect()}
    assert set(got) == {"1", "2", "3"} and got["1"] and got["2"] is None and got["3"] is None


def test_training_sets_odd_rows_aside(spark):
    from txnscore.plans import models as MD
    from txnscore.views import transactions
    raw = transactions(spark, "/root/testdata/sf0.001")
    bad = raw.withColumns({"city_pop": F.when(F.col("cc_num") % 3 != 0, F.col("city_pop")),
                           "is_fraud": F.when(F.col("cc_num") % 7 == 0, 5).otherwise(F.col("is_fraud"))})
    t = MD.train(bad, with_gbt=False)
    used = bad.where("city_pop is not null and is_fraud in (0, 1)").count()
    assert t.rejects.count() + used == 1000 and t.test.count() + t.train.select("trans_num").distinct().count() == used
    assert t.train_rows == t.train.count()


def test_a_cluster_must_name_its_shared_folder(monkeypatch, spark):
    from txnscore import session

    class Nothing:
        def isEmpty(self):
            return True

    class Sc:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: Nothing()})()})()

        def getConf(self):
            return type("C", (), {"get": lambda self, k, d=None: d})()

    class Session:
        sparkContext = Sc()
        conf = type("C", (), {"get": lambda self, k, d=None: d})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_messages_without_a_key_are_no_duplicates(spark, tmp_path):
    from txnscore.schemas import MESSAGE
    from txnscore.streaming.drain import drain
    log = str(tmp_path / "log")
    encode_messages(txn_rows(spark, [base(i) for i in range(10)] * 2)).write.parquet(log)
    spark.createDataFrame([("x", "{broken")] * 20, MESSAGE).write.mode("append").parquet(log)
    out = drain(spark, log, str(tmp_path / "o"), str(tmp_path / "c"), dedupe_within="1 day")
    assert spark.read.parquet(out).count() == 30
