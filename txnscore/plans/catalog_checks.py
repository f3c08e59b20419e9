"""Queries that hold an operator to an invariant or to faulty rows, with SQL for both sides.

The fitted models have no SQL of their own, but what must be true of their
output has; and gates, rejects and streams are only tested by rows that fail.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import linear_score
from ..operators import balance as B
from ..operators import features as FE
from ..operators import gates as G
from ..operators import scale as S
from ..operators.split import split_random
from ..schemas import EVENT_TIME, KEY, LABEL, TXN
from ..session import scratch_path
from ..sources.files import read_dataset, write_dataset
from ..sources.messages import encode_messages, publish
from ..sources.requests import to_requests
from ..streaming import drain as D
from ..streaming import scoring as SS
from ..views import transactions, with_transactions
from . import jobs as J
from . import models as MD
from .catalog import DIST_SQL, HASH_SQL, tx_long
from .catalog_io import TX_ORACLE
from .catalog_models import FEATURE_SQL, even_transactions, exact_features, trained
from .featurize import feature_table
from .fixed import FIXED_MODEL, FIXED_SCORE_SQL, fixed_score
from .registry import query

# The fixture with holes: amounts, city populations and keys missing, odd labels.
HOLES_SQL = """
holed as (
  select case when cc_num % 11 = 0 then null else trans_num end as trans_num, trans_num as id,
         trans_date_trans_time, case when cc_num % 3 = 0 then null else amt end as amt,
         case when cc_num % 5 = 0 then null else city_pop end as city_pop,
         case when cc_num % 7 = 0 then 2 else is_fraud end as is_fraud
  from transactions)"""


def holed(spark, d) -> DataFrame:
    def without(c, n):
        return F.when(F.col("cc_num") % n != 0, F.col(c))
    return transactions(spark, d).withColumns({
        "id": F.col(KEY), KEY: without(KEY, 11), "amt": without("amt", 3), "city_pop": without("city_pop", 5),
        LABEL: F.when(F.col("cc_num") % 7 == 0, 2).otherwise(F.col(LABEL))})


REASON_SQL = """nullif(concat_ws(',', case when trans_num is null then 'trans_num' end,
  case when amt is null or isnan(amt) then 'amt' end, case when city_pop is null then 'city_pop' end,
  case when is_fraud not in (0, 1) then 'is_fraud' end), '')"""


@query("valid_rows_holed", with_transactions(HOLES_SQL) + f"""
select id, trans_num, cast(is_fraud as bigint) as is_fraud from holed where {REASON_SQL} is null""")
def q_valid_holed(spark, d):
    return FE.valid_rows(holed(spark, d), MD.VALIDATED, label=LABEL).select(
        "id", KEY, F.col(LABEL).cast("long").alias(LABEL))


@query("reject_rows_holed", with_transactions(HOLES_SQL) + f"""
select id, {REASON_SQL} as reason from holed where {REASON_SQL} is not null""")
def q_reject_holed(spark, d):
    return FE.reject_rows(holed(spark, d), MD.VALIDATED, LABEL).select("id", "reason")


SCORE_REASON_SQL = """nullif(concat_ws(',', case when amt is null or isnan(amt) then 'amt' end,
  case when city_pop is null then 'city_pop' end), '')"""


@query("score_batch_holed", with_transactions(HOLES_SQL) + f"""
select id, {SCORE_REASON_SQL} as reason, {SCORE_REASON_SQL} is null as lr_scored,
       {SCORE_REASON_SQL} is null as gbt_scored from holed""")
def q_score_holed(spark, d):
    """Scored and rejected rows together are the input rows."""
    out = MD.tagged_scores(trained(spark, d).scorer(), holed(spark, d), key="id")
    return out.select("id", "reason", F.col(MD.LR_NAME).isNotNull().alias("lr_scored"),
                      F.col(MD.GBT_NAME).isNotNull().alias("gbt_scored"))


@query("score_batch_valid", with_transactions() + """
select trans_num, true as lr_valid, true as gbt_valid from transactions""")
def q_score_valid(spark, d):
    """Every key once, probabilities in [0, 1], decisions that follow from them."""
    def valid(m):
        p = F.col(f"{m}.fraud_probability")
        return p.between(0, 1) & (F.col(f"{m}.is_fraud_prediction") == (p > 0.5).cast("int"))
    out = MD.score(trained(spark, d).scorer(), transactions(spark, d))
    return out.select(KEY, valid(MD.LR_NAME).alias("lr_valid"), valid(MD.GBT_NAME).alias("gbt_valid"))


@query("train_lr_linear", with_transactions() + f"""
select trans_num, true as same from transactions where {HASH_SQL.format(k='trans_num', salt=':split')} >= 0.8""")
def q_lr_linear(spark, d):
    """The logistic model is the linear score of its coefficients, on test rows."""
    t = trained(spark, d)
    names = MD.model_inputs(t.features)
    weights = dict(zip(names, (float(w) for w in t.lr.coefficients.toArray())))
    raw = feature_table(t.features, t.test, keep=[KEY])
    plain = raw.select(KEY, linear_score(weights, float(t.lr.intercept)).alias("p"))
    scored = MD.score(MD.PipelineModel(stages=[*t.features.stages, t.lr]), t.test)
    return plain.join(scored, KEY).select(
        KEY, (F.abs(F.col("p") - F.col(f"{MD.LR_NAME}.fraud_probability")) < 1e-9).alias("same"))


@query("requests_equal_batch", with_transactions() + """
select trans_num, true as lr_same, true as gbt_same from transactions""")
def q_requests_equal_batch(spark, d):
    """Requests scored by name give what the batch scorer gives."""
    t = trained(spark, d)
    scores, _ = MD.score_requests(t.scorer(), stored_requests(spark, d, t))
    whole = MD.score(t.scorer(), even_transactions(spark, d))
    both = scores.withColumnsRenamed({MD.LR_NAME: "a", MD.GBT_NAME: "b"}).join(
        whole, F.col("request_id") == F.col(KEY))
    return both.select(KEY, (F.col("a") == F.col(MD.LR_NAME)).alias("lr_same"),
                       (F.col("b") == F.col(MD.GBT_NAME)).alias("gbt_same"))


def stored_requests(spark, d, t) -> DataFrame:
    """Every transaction's features as a stored request, as requests arrive."""
    ft = feature_table(t.features, even_transactions(spark, d), keep=[KEY])
    reqs = to_requests(ft, list(reversed(MD.model_inputs(t.scorer()))), KEY)
    return read_dataset(spark, write_dataset(reqs, scratch_path(spark, "requests")))


@query("runs_shape", with_transactions(f"""
t as (select count(*) as n from transactions where {HASH_SQL.format(k='trans_num', salt=':split')} >= 0.8)""") + """
select m as run_name, c as model_type, 'hash' as split_mode, 'exact' as balance_mode,
       'split_first' as train_order, cast(n as bigint) as test_rows, true as metrics_valid
from t, (values ('txn_logistic_regression', 'LogisticRegressionModel'),
                ('txn_gbt_classifier', 'GBTClassificationModel')) v(m, c)""")
def q_runs_shape(spark, d):
    runs = MD.log_run(MD.runs(trained(spark, d), "txn"), scratch_path(spark, "runs"))
    ok = F.col("pr_auc").between(0, 1) & F.col("f1").between(0, 1) & F.col("f1_fraud").between(0, 1)
    return runs.select("run_name", "model_type", "split_mode", "balance_mode", "train_order",
                       F.col("test_rows").cast("long").alias("test_rows"), (ok & (F.col("train_rows") > 0)).alias("metrics_valid"))


@query("split_random_keys", with_transactions() + """
select trans_num, cast(1 as bigint) as sides from transactions""")
def q_split_random_keys(spark, d):
    """Both sides together hold every key once."""
    tr, te = split_random(transactions(spark, d).select(KEY), (0.8, 0.2), seed=42)
    return tr.unionByName(te).groupBy(KEY).agg(F.count(F.lit(1)).alias("sides"))


@query("oversample_poisson_size", with_transactions() + """
select cast(sum(1 - is_fraud) as bigint) as legit, true as fraud_in_band from transactions""")
def q_poisson_size(spark, d):
    """The majority as it is, the minority within six deviations of it."""
    t = transactions(spark, d).select(KEY, LABEL)
    n = B.class_balance(B.balance(t, mode="poisson", seed=42, copy_col=None))
    ratio = F.lit(B.oversample_ratio(t))
    near = F.abs(F.col("fraud") - F.col("legit")) <= 6 * F.sqrt(ratio * F.col("legit")) + 6
    return n.select(F.col("legit").cast("long").alias("legit"), near.alias("fraud_in_band"))


@query("robust_scale_vector_close", with_transactions(f"""
feat as (select *, {DIST_SQL} as distance_km from transactions)""") + """
select trans_num, true as amt_close, true as distance_close from feat""")
def q_vector_close(spark, d):
    """Scaling through the vector stages agrees with the exact quartiles to 2 %."""
    t = FE.add_distance(transactions(spark, d)).select(KEY, "amt", "distance_km")
    ranges = S.iqr(t, ["amt", "distance_km"], 0.0)
    out = S.robust_scale_vector(t, ["amt", "distance_km"]).join(t, KEY)

    def close(c):
        exact = F.col(c) / F.lit(ranges[c])
        return F.abs(F.col(f"{c}_scaled") - exact) <= 0.02 * F.abs(exact) + 1e-9
    return out.select(KEY, close("amt").alias("amt_close"), close("distance_km").alias("distance_close"))


@query("gate_reconcile_faults", with_transactions("""
src as (select case when cast(trans_num as bigint) % 10 = 2 then null else trans_num end as k,
               cast(trans_num as bigint) % 10 as g from transactions),
log as (select k, g from src where g <> 0 union all select k, g from src where g = 1
        union all select 'x' || k, g from src where g = 3)""", """
s as (select coalesce(k, '') as k, count(*) as n from src group by 1),
l as (select coalesce(k, '') as k, count(*) as n from log group by 1)""") + """
select 'published_count' as gate, cast((select sum(n) from l) as bigint) as observed,
       cast((select sum(n) from s) as bigint) as expected,
       (select sum(n) from l) = (select sum(n) from s) as passed
union all select 'missing_in_log', cast(count(*) as bigint), cast(0 as bigint), count(*) = 0
  from s where k not in (select k from l)
union all select 'unknown_in_log', cast(count(*) as bigint), cast(0 as bigint), count(*) = 0
  from l where k not in (select k from s)""")
def q_reconcile_faults(spark, d):
    """Lost, repeated, unknown and NULL keys, counted on both sides."""
    g = F.col(KEY).cast("long") % 10
    src = transactions(spark, d).select(F.when(g != 2, F.col(KEY)).alias(KEY), g.alias("g"))
    log = src.where("g != 0").unionByName(src.where("g = 1")).unionByName(
        src.where("g = 3").withColumn(KEY, F.concat(F.lit("x"), F.col(KEY))))
    return G.gate_reconcile(src, log, KEY)


def _half(spark, d, odd: int) -> DataFrame:
    return transactions(spark, d).where(F.col(KEY).cast("long") % 2 == odd)


@query("stream_drain_resumed", TX_ORACLE)
def q_drain_resumed(spark, d):
    """Publish, drain, publish more, drain again with the default checkpoint."""
    log, landed = scratch_path(spark, "log"), scratch_path(spark, "landed")
    for odd in (0, 1):
        publish(encode_messages(_half(spark, d, odd)), "parquet", log)
        J.drain_log(spark, log, landed)
    return tx_long(read_dataset(spark, landed))


@query("ingest_twice", with_transactions() + """
select 'published_count' as gate, cast(count(*) as bigint) as observed, cast(count(*) as bigint) as expected,
       true as passed from transactions where cast(trans_num as bigint) % 2 = 1
union all select 'missing_in_log', cast(0 as bigint), cast(0 as bigint), true
union all select 'unknown_in_log', cast(0 as bigint), cast(0 as bigint), true""")
def q_ingest_twice(spark, d):
    """The second run into one log is held against its own rows."""
    log = scratch_path(spark, "log")
    for odd in (0, 1):
        csv = write_dataset(_half(spark, d, odd), scratch_path(spark, "csv"), fmt="csv")
        gates = J.ingest(spark, csv, log)
    return gates


@query("stream_drain_malformed", with_transactions() + """
select trans_num, cast(count(*) as bigint) as n
from (select case when cc_num % 7 = 0 then null else trans_num end as trans_num from transactions) group by 1""")
def q_drain_malformed(spark, d):
    """Cut-off messages land with NULL fields, each of them, also when
    duplicates are dropped (every good message is sent twice)."""
    t = transactions(spark, d)
    good = encode_messages(t.where("cc_num % 7 != 0"))
    bad = encode_messages(t.where("cc_num % 7 = 0")).withColumn("value", F.substring("value", 1, 20))
    log = scratch_path(spark, "log")
    for part in (good, good, bad):
        publish(part, "parquet", log)
    out = D.drain(spark, log, scratch_path(spark, "landed"), scratch_path(spark, "ckpt"), dedupe_within="1 day")
    return read_dataset(spark, out).groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))


COUNTS_SQL = f"""
select date_trunc('day', ts) as window_start, date_trunc('day', ts) + interval 1 day as window_end,
       case when sc > 0.5 then 'fraud' else 'genuine' end as prediction_class,
       '{FIXED_MODEL}' as model_name, cast(count(*) as bigint) as n
from pp group by all"""


@query("stream_counts_out_of_order", with_transactions(f"""
pp as (select trans_date_trans_time as ts, {FIXED_SCORE_SQL} as sc from transactions)""") + COUNTS_SQL)
def q_counts_out_of_order(spark, d):
    """The latest events come first, each third published and drained before the
    next: every prediction counts."""
    src, out, checkpoint = scratch_path(spark, "raw-stream"), scratch_path(spark, "counts"), scratch_path(spark, "ckpt")
    rows = transactions(spark, d)
    at = F.unix_micros(F.col(EVENT_TIME).cast("timestamp"))
    cuts = rows.select(at.alias("t")).approxQuantile("t", [0.33, 0.66], 0.01)
    for lo, hi in ((cuts[1], None), (cuts[0], cuts[1]), (None, cuts[0])):
        part = rows if lo is None else rows.where(at >= lo)
        write_dataset(part if hi is None else part.where(at < hi), src, mode="append")
        scored = fixed_score(spark.readStream.schema(TXN).parquet(src)).select(EVENT_TIME, F.struct(
            F.col("score").alias("fraud_probability"),
            F.when(F.col("score") > 0.5, 1).otherwise(0).alias("is_fraud_prediction")).alias(FIXED_MODEL))
        SS.run_counts(SS.windowed_prediction_counts(scored, [FIXED_MODEL]), out, checkpoint).awaitTermination()
    return SS.current_counts(spark, out).withColumn("n", F.col("n").cast("long"))


@query("score_stream_totals", with_transactions() + f"""
select date_trunc('day', trans_date_trans_time) as window_start, m as model_name, cast(count(*) as bigint) as n
from transactions, (values ('{MD.LR_NAME}'), ('{MD.GBT_NAME}')) v(m) group by all""")
def q_score_stream_totals(spark, d):
    """The stream job counts every row once per model and day."""
    model = MD.save_model(trained(spark, d).scorer(), scratch_path(spark, "model"))
    log, out = scratch_path(spark, "log"), scratch_path(spark, "scores")
    publish(encode_messages(even_transactions(spark, d)), "parquet", log)
    counts = scratch_path(spark, "counts")
    J.score_stream(spark, model, log, out, counts).awaitTermination()
    return SS.current_totals(spark, counts).groupBy("window_start", "model_name").agg(F.sum("n").alias("n"))


@query("drop_columns", with_transactions(f"""
feat as (select *, {DIST_SQL} as distance_km from transactions)""") + """
select cc_num, amt, cast(city_pop as bigint) as city_pop, cast(is_fraud as bigint) as is_fraud,
       cast(hour(trans_date_trans_time) as bigint) as trans_hour,
       cast(dayofweek(trans_date_trans_time) + 1 as bigint) as trans_day_of_week,
       round(distance_km, 6) as distance_km,
       cast(case when gender = 'M' then 1 else 0 end as bigint) as gender_M
from feat""")
def q_drop_columns(spark, d):
    """Derived features without identity, raw text and raw coordinates."""
    out = FE.drop_columns(FE.base_features(transactions(spark, d)))
    return out.select(*[F.round(c, 6).alias(c) if c == "distance_km" else c if c == "amt" else F.col(c).cast("long").alias(c)
                        for c in out.columns])


@query("feature_list", with_transactions("""
c as (select distinct category from transactions where category is not null)""", """
v as (select category, row_number() over (order by category) as r from c)""", """
f as (select * from (values (1, 'trans_hour'), (2, 'trans_day_of_week'), (3, 'city_pop'), (4, 'gender_M')) t(p, name)
      union all select 3 + r, 'cat_' || category from v where r > 1
      union all select 4 + (select count(*) from c), 'amt_scaled'
      union all select 5 + (select count(*) from c), 'distance_km_scaled')""") + """
select cast(p as bigint) as position, name from f""")
def q_feature_list(spark, d):
    """The model's inputs in order: the allow-list of the fitted stages, and all
    but key and label of the table it makes."""
    fm = exact_features(spark, d)
    names = MD.model_inputs(fm)
    ft = feature_table(fm, transactions(spark, d), keep=[LABEL])
    if FE.feature_columns(ft) != names or FE.feature_columns(ft, allow=names) != names:
        raise ValueError("the allow-list and the feature table differ")
    rows = FE.feature_columns(ft)
    return spark.range(len(rows)).select(
        (F.col("id") + 1).alias("position"), F.element_at(F.array(*map(F.lit, rows)), (F.col("id") + 1).cast("int")).alias("name"))


@query("assembled_vector", with_transactions(FEATURE_SQL) + """
select trans_num, cast(trans_hour as double) as trans_hour, round(amt_scaled, 6) as amt_scaled,
       round(distance_km_scaled, 6) as distance_km_scaled, cast(cat_view as double) as cat_view
from ft""")
def q_assembled(spark, d):
    """The assembled vector, unpacked by position, holds the named features."""
    fm = exact_features(spark, d)
    out = S.unpack(fm.transform(transactions(spark, d)).select(KEY, "features"), "features", MD.model_inputs(fm))
    return out.select(KEY, "trans_hour", F.round("amt_scaled", 6).alias("amt_scaled"),
                      F.round("distance_km_scaled", 6).alias("distance_km_scaled"), "cat_view")
