"""Checked decoding, stored sketches and observed streams."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import sketches as SK
from ..operators.features import add_distance, invalid_reason
from ..schemas import EVENT_TIME, KEY, LABEL, TXN
from ..session import scratch_path
from ..sources.files import write_dataset
from ..sources.messages import decode_checked, encode_messages, split_decoded
from ..streaming import drain as D
from ..streaming import observed as O
from ..views import transactions, with_transactions
from .catalog import TX_SQL_LONG, tx_long
from .featurize import SPARSE_COL, SPARSE_MAX_CATEGORIES, sparse_one_hot
from .registry import query


# ------------------------------------------------------------------ checked decoding

def faulty_messages(spark, d) -> DataFrame:
    """Every transaction's message; by key some are cut, mistyped or incomplete."""
    g, v = F.col("key").cast("long") % 13, F.col("value")
    changed = (F.when(g == 1, F.expr("substring(value, 1, length(value) div 2)"))
               .when(g == 2, F.regexp_replace(v, '"amt":[^,}]+', '"amt":"n/a"'))
               .when(g == 3, F.regexp_replace(v, '"city_pop":[^,}]+,', ""))
               .when(g == 4, F.regexp_replace(F.regexp_replace(v, '"gender":[^,}]+,', ""), '"is_fraud":[^,}]+', '"is_fraud":1.5'))
               .when(g == 5, F.lit("[1, 2]")).when(g == 6, F.lit(None).cast("string"))
               .when(g == 7, F.regexp_replace(v, f'"{EVENT_TIME}":"[^"]+"', f'"{EVENT_TIME}":"some day"'))
               .when(g == 8, F.regexp_replace(v, '"amt":[^,}]+', '"amt":null')).otherwise(v))
    return encode_messages(transactions(spark, d)).withColumn("value", changed)


_REASON_SQL = f"""case cast(trans_num as bigint) % 13 when 1 then 'bad_json' when 2 then 'type:amt' when 3 then 'missing:city_pop'
  when 4 then 'missing:gender,type:is_fraud' when 5 then 'not_object' when 6 then 'no_value'
  when 7 then 'type:{EVENT_TIME}' end"""


@query("decode_rejects", with_transactions() + f"""
select trans_num as key, {_REASON_SQL} as reason from transactions where {_REASON_SQL} is not null""")
def q_decode_rejects(spark, d):
    """Why a message cannot be taken."""
    _, rejects = split_decoded(faulty_messages(spark, d), required=TXN.fieldNames())
    return rejects.select("key", "reason")


@query("decode_good", with_transactions(f"""
t as (select * replace (case when cast(trans_num as bigint) % 13 = 8 then null else amt end as amt) from transactions
      where {_REASON_SQL} is null)""") + f"select {TX_SQL_LONG} from t")
def q_decode_good(spark, d):
    """The other messages, typed."""
    good, _ = split_decoded(faulty_messages(spark, d), required=TXN.fieldNames())
    return tx_long(good)


@query("decode_totals", with_transactions() + f"""
select cast(count(*) as bigint) as messages, cast(count(*) filter (where {_REASON_SQL} is null) as bigint) as good,
       cast(count({_REASON_SQL}) as bigint) as rejected from transactions""")
def q_decode_totals(spark, d):
    """Good and rejected messages together are all messages."""
    out = decode_checked(faulty_messages(spark, d), required=TXN.fieldNames())
    return out.agg(F.count(F.lit(1)).alias("messages"), F.count(F.when(F.col("reason").isNull(), 1)).alias("good"),
                   F.count("reason").alias("rejected"))


# ------------------------------------------------------------------ quartiles from stored sketches

SKETCHED = ["amt", "distance_km", "city_pop"]


def sketched(spark, d) -> str:
    """The sketches of every month of the table, stored as if each month had landed."""
    t = add_distance(transactions(spark, d)).withColumn("month", F.date_format(EVENT_TIME, "yyyy-MM"))
    return SK.store_sketches(SK.part_sketches(t, SKETCHED, "month"), scratch_path(spark, "sketches"))


@query("iqr_sketched", """
select c as "column", cast(p as double) as p, true as within from (values ('amt'), ('distance_km'), ('city_pop')) a(c),
       (values (0.25), (0.5), (0.75)) b(p)""")
def q_iqr_sketched(spark, d):
    """Quantiles of the merged sketches lie within the stated rank error."""
    found = SK.merged_quantiles(SK.stored_sketches(spark, sketched(spark, d)), (0.25, 0.5, 0.75)).collect()
    t = add_distance(transactions(spark, d))
    ranks = [F.struct(F.lit(r["column"]).alias("column"), F.lit(r["p"]).alias("p"), F.avg((F.col(r["column"]) < r["value"]).cast("double")).alias("below"),
                      F.avg((F.col(r["column"]) <= r["value"]).cast("double")).alias("upto")) for r in found]
    rows = t.agg(F.array(*ranks).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    e = SK.RANK_ERROR
    return rows.select("column", "p", ((F.col("below") <= F.col("p") + e) & (F.col("upto") >= F.col("p") - e)).alias("within"))


@query("sketch_parts", with_transactions() + """
select strftime(trans_date_trans_time, '%Y-%m') as part, c as "column", cast(count(*) as bigint) as n
from transactions, (values ('amt'), ('distance_km'), ('city_pop')) a(c) group by all""")
def q_sketch_parts(spark, d):
    """What is stored: a sketch per month and column, over all of its rows."""
    return SK.stored_sketches(spark, sketched(spark, d)).select("part", "column", "n")


# ------------------------------------------------------------------ sparse one-hot

@query("one_hot_sparse", with_transactions("""
c as (select distinct cast(cc_num as varchar) as card from transactions)""", """
v as (select card, row_number() over (order by card) as r from c)""") + """
select trans_num, cast(case when r > 1 then r - 2 end as bigint) as slot from transactions join v on cast(cc_num as varchar) = card""")
def q_one_hot_sparse(spark, d):
    """Every card number as a category: the one slot of its sparse vector (NULL for
    the baseline)."""
    t = transactions(spark, d).select(KEY, F.col("cc_num").cast("string").alias("category"))
    out = PipelineModel(stages=sparse_one_hot(FE.fit_vocabulary(t, "category", SPARSE_MAX_CATEGORIES))).transform(t)
    # a vector's JSON is (type, size, indices, values)
    entry = F.from_json(F.to_json(F.struct(F.col(SPARSE_COL).alias("v"))), "v struct<indices array<long>>")
    return out.select(KEY, F.get(entry["v"]["indices"], F.lit(0)).alias("slot"))


# ------------------------------------------------------------------ observed streams

@query("stream_stage_counts", with_transactions(f"""
v as (select *, cc_num % 3 <> 0 as valid from transactions)""") + """
select s as stage, cast(n as bigint) as n from (
  select count(*) as input, count(*) filter (where valid) as valid, count(*) filter (where valid and is_fraud = 0) as legit,
         count(*) filter (where valid and is_fraud = 1) as fraud from v) unpivot (n for s in (input, valid, legit, fraud))""")
def q_stream_stage_counts(spark, d):
    """Stage counts of a drain, told by the listener while it runs (some rows have no
    amount); afterwards this session still evaluates models."""
    rows = transactions(spark, d).withColumn("amt", F.when(F.col("cc_num") % 3 != 0, F.col("amt")))
    log = write_dataset(encode_messages(rows), scratch_path(spark, "log"))
    out, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "ckpt")

    def start(own):
        stream = D.decoded_stream(D.message_stream(own, log, max_files_per_trigger=1))
        return D.land(O.observed(stream, invalid_reason(stream, [KEY, "amt"], LABEL).isNull()), out, checkpoint)
    counts = O.run_observed(spark, start)
    return spark.createDataFrame(sorted(counts.items()), "stage string, n long")
