"""Explicit schemas (never inferred at the edge: a key like trans_num must stay text)."""

from pyspark.sql import types as T

# Raw transaction as produced and consumed by the pipeline.
TXN = T.StructType([
    T.StructField("trans_num", T.StringType()),
    T.StructField("trans_date_trans_time", T.TimestampNTZType()),
    T.StructField("cc_num", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("amt", T.DoubleType()),
    T.StructField("gender", T.StringType()),
    T.StructField("city_pop", T.LongType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
    T.StructField("merch_lat", T.DoubleType()),
    T.StructField("merch_long", T.DoubleType()),
    T.StructField("is_fraud", T.IntegerType()),
])

# Message log record (same two columns as a Kafka record's key/value).
MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

SCORE = T.StructType([
    T.StructField("fraud_probability", T.DoubleType()),
    T.StructField("is_fraud_prediction", T.IntegerType()),
])

RUN = T.StructType([
    T.StructField("run_name", T.StringType()),
    T.StructField("model_type", T.StringType()),
    T.StructField("pipeline_id", T.StringType()),
    T.StructField("pr_auc", T.DoubleType()),
    T.StructField("f1", T.DoubleType()),
    T.StructField("f1_fraud", T.DoubleType()),
    T.StructField("split_mode", T.StringType()),
    T.StructField("balance_mode", T.StringType()),
    T.StructField("train_order", T.StringType()),
    T.StructField("train_rows", T.LongType()),
    T.StructField("test_rows", T.LongType()),
])

GATE = T.StructType([
    T.StructField("gate", T.StringType()),
    T.StructField("observed", T.LongType()),
    T.StructField("expected", T.LongType()),
    T.StructField("passed", T.BooleanType()),
])

REQUEST = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("features", T.MapType(T.StringType(), T.DoubleType())),
])

LABEL = "is_fraud"
KEY = "trans_num"
EVENT_TIME = "trans_date_trans_time"
