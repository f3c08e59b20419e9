"""Queries over sources, sinks, messages and streams.

Each query writes what it needs under a fresh folder of the shared
checkpoint location (``spark.checkpoint.dir``) and reads it back, so the
result is the whole table after a real write/read or stream run.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gates as G
from ..schemas import EVENT_TIME, KEY, TXN
from ..session import scratch_path
from ..sources.files import read_dataset, read_transactions, write_dataset
from ..sources.messages import decode_messages, encode_messages, publish
from ..streaming import drain as D
from ..streaming import scoring as SS
from ..views import transactions, with_transactions
from .catalog import TX_SQL_LONG, tx_long
from .fixed import FIXED_MODEL, FIXED_SCORE_SQL, fixed_score
from .registry import query

TX_ORACLE = with_transactions() + f"select {TX_SQL_LONG} from transactions"


@query("scan_csv", TX_ORACLE)
def q_scan_csv(spark, d):
    path = write_dataset(transactions(spark, d), scratch_path(spark, "csv"), fmt="csv")
    return tx_long(read_transactions(spark, path, "csv", TXN))


@query("scan_dataset", TX_ORACLE)
def q_scan_dataset(spark, d):
    t = transactions(spark, d)
    # A dataset of many files in one folder per category, read back with
    # partition discovery under the stated types.
    path = write_dataset(t, scratch_path(spark, "dataset"), partition_by=["category"])
    return tx_long(read_dataset(spark, path, schema=TXN).select(*TXN.fieldNames()))


@query("encode_messages", with_transactions() + """
select trans_num as key,
       cast(json_object('trans_num', trans_num,
                        'trans_date_trans_time', cast(trans_date_trans_time as varchar),
                        'cc_num', cc_num, 'category', category, 'amt', amt, 'gender', gender,
                        'city_pop', city_pop, 'lat', lat, 'long', long, 'merch_lat', merch_lat,
                        'merch_long', merch_long, 'is_fraud', is_fraud) as varchar) as value
from transactions""")
def q_encode_messages(spark, d):
    """The JSON text itself is compared: field order, number and time formats."""
    return encode_messages(transactions(spark, d))


@query("decode_messages", TX_ORACLE)
def q_decode_messages(spark, d):
    return tx_long(decode_messages(encode_messages(transactions(spark, d))))


def _published_log(spark, d) -> str:
    """Encode the whole table and publish it to a file log (the Kafka record shape)."""
    path = scratch_path(spark, "log")
    publish(encode_messages(transactions(spark, d)), "parquet", path)
    return path


@query("stream_drain", TX_ORACLE)
def q_stream_drain(spark, d):
    log = _published_log(spark, d)
    out = D.drain(spark, log, scratch_path(spark, "landed"), scratch_path(spark, "ckpt"))
    return tx_long(read_dataset(spark, out))


@query("stream_land", TX_ORACLE)
def q_stream_land(spark, d):
    """Drain the log and land it as a CSV dataset (the old consumer's output
    format), then read it with the explicit schema."""
    log = _published_log(spark, d)
    out = D.drain(spark, log, scratch_path(spark, "landed-csv"), scratch_path(spark, "ckpt"),
                  out_fmt="csv")
    return tx_long(read_transactions(spark, out, "csv", TXN))


@query("gate_reconcile", with_transactions() + """
select 'published_count' as gate, cast(count(*) as bigint) as observed,
       cast(count(*) as bigint) as expected, true as passed from transactions
union all select 'missing_in_log', cast(0 as bigint), cast(0 as bigint), true
union all select 'unknown_in_log', cast(0 as bigint), cast(0 as bigint), true""")
def q_gate_reconcile(spark, d):
    log = spark.read.parquet(_published_log(spark, d))
    return G.gate_reconcile(transactions(spark, d), log, KEY, "key")


@query("stream_score_counts", with_transactions(f"""
pp as (select trans_date_trans_time as ts, {FIXED_SCORE_SQL} as sc from transactions)""") + f"""
select date_trunc('day', ts) as window_start, date_trunc('day', ts) + interval 1 day as window_end,
       case when sc > 0.5 then 'fraud' else 'genuine' end as prediction_class,
       '{FIXED_MODEL}' as model_name, cast(count(*) as bigint) as n
from pp group by all""")
def q_stream_score_counts(spark, d):
    src = write_dataset(transactions(spark, d), scratch_path(spark, "raw-stream"))
    stream = spark.readStream.schema(TXN).parquet(src)
    scored = fixed_score(stream).select(EVENT_TIME, F.struct(
        F.col("score").alias("fraud_probability"),
        F.when(F.col("score") > 0.5, 1).otherwise(0).alias("is_fraud_prediction")).alias(FIXED_MODEL))
    counts = SS.windowed_prediction_counts(scored, [FIXED_MODEL])
    out = scratch_path(spark, "counts")
    q = SS.run_counts(counts, out, scratch_path(spark, "ckpt"))
    q.awaitTermination()
    return SS.current_counts(spark, out).withColumn("n", F.col("n").cast("long"))

