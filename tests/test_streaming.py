"""Continuous stream behaviour: running counts update batch by batch, rows of
any age are counted, duplicates go and malformed messages stay."""

import datetime as dt

from pyspark.sql import functions as F

from txnscore.schemas import TXN
from txnscore.streaming import scoring as SS


def _rows(spark, items):
    names = TXN.fieldNames()
    out = []
    for i, (ts, amt) in enumerate(items):
        r = dict(trans_num=f"{ts:%d%H}-{i}-{amt}", trans_date_trans_time=ts, cc_num=1, category="purchase",
                 amt=amt, gender="M", city_pop=1, lat=1.0, long=1.0, merch_lat=1.0, merch_long=1.0, is_fraud=0)
        out.append(tuple(r[n] for n in names))
    return spark.createDataFrame(out, TXN)


def _scored(stream):
    p = F.when(F.col("amt") > 100, 1).otherwise(0)
    return stream.select("trans_date_trans_time", F.struct(
        F.lit(0.5).alias("fraud_probability"), p.alias("is_fraud_prediction")).alias("m"))


def test_running_counts_and_late_rows(spark, tmp_path):
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ck")
    day = lambda d, h=12: dt.datetime(2024, 1, d, h)
    _rows(spark, [(day(1), 10.0), (day(1), 500.0)]).write.mode("append").parquet(src)
    stream = spark.readStream.schema(TXN).option("maxFilesPerTrigger", 1).parquet(src)
    counts = SS.windowed_prediction_counts(_scored(stream), ["m"], window="1 day")
    q = SS.run_counts(counts, out, ck, available_now=False)
    try:
        q.processAllAvailable()
        cur = {(r["window_start"].day, r["prediction_class"]): r["n"]
               for r in SS.current_counts(spark, out).collect()}
        assert cur == {(1, "genuine"): 1, (1, "fraud"): 1}
        # a day-1 row that comes after day 5 is counted too
        _rows(spark, [(day(5), 20.0)]).write.mode("append").parquet(src)
        q.processAllAvailable()
        _rows(spark, [(day(1), 30.0), (day(5), 40.0)]).write.mode("append").parquet(src)
        q.processAllAvailable()
        cur = {(r["window_start"].day, r["prediction_class"]): r["n"]
               for r in SS.current_counts(spark, out).collect()}
        assert cur == {(1, "genuine"): 2, (1, "fraud"): 1, (5, "genuine"): 2}
    finally:
        q.stop()


def test_compaction_keeps_current_counts(spark, tmp_path):
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ck")
    day = lambda d: dt.datetime(2024, 1, d, 12)
    _rows(spark, [(day(1), 10.0)]).write.mode("append").parquet(src)
    stream = spark.readStream.schema(TXN).option("maxFilesPerTrigger", 1).parquet(src)
    q = SS.run_counts(SS.windowed_prediction_counts(_scored(stream), ["m"]), out, ck,
                      available_now=False)
    try:
        q.processAllAvailable()
        _rows(spark, [(day(1), 20.0), (day(2), 500.0)]).write.mode("append").parquet(src)
        q.processAllAvailable()
        before = sorted(tuple(r) for r in SS.current_counts(spark, out).collect())
        snap = SS.compact_counts(spark, out)
        assert "_snapshots/upto=" in snap
        assert sorted(tuple(r) for r in SS.current_counts(spark, out).collect()) == before
        _rows(spark, [(day(2), 600.0)]).write.mode("append").parquet(src)
        q.processAllAvailable()
        cur = {(r["window_start"].day, r["prediction_class"]): r["n"]
               for r in SS.current_counts(spark, out).collect()}
        assert cur == {(1, "genuine"): 2, (2, "fraud"): 2}
    finally:
        q.stop()
