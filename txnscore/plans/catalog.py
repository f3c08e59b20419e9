"""Named queries over the driver tables, each with its DuckDB oracle text.

Every query reads whole tables (``transactions`` is a projection of the whole
``events`` table). Doubles are rounded to 6 places and integers widened to
long on both sides so the two engines can be compared value by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean_value, decision, parse_time, to_radians_terms
from ..operators import balance as B
from ..operators import features as FE
from ..operators import gates as G
from ..operators import metrics as M
from ..operators import scale as S
from ..operators.split import SPLIT_SALT, hash_unit, split_side
from ..schemas import EVENT_TIME, KEY, LABEL
from ..views import table, transactions, with_transactions
from .fixed import FIXED_MODEL, FIXED_SCORE_SQL, fixed_score
from .registry import query, r6

TX_SQL_LONG = ("trans_num, trans_date_trans_time, cc_num, category, amt, gender, city_pop, "
               "lat, long, merch_lat, merch_long, cast(is_fraud as bigint) as is_fraud")


def tx_long(df: DataFrame) -> DataFrame:
    return df.withColumn(LABEL, F.col(LABEL).cast("long"))


# ------------------------------------------------------------------ projections

@query("parse_time", with_transactions() + """
select trans_num, cast(trans_date_trans_time as varchar) as time_text,
       try_cast(cast(trans_date_trans_time as varchar) as timestamp) as parsed
from transactions""")
def q_parse_time(spark, d):
    t = transactions(spark, d).select(KEY, F.col(EVENT_TIME).cast("string").alias("time_text"))
    return t.withColumn("parsed", parse_time("time_text"))


@query("time_features", with_transactions() + """
select trans_num, cast(hour(trans_date_trans_time) as bigint) as trans_hour,
       cast(dayofweek(trans_date_trans_time) + 1 as bigint) as trans_day_of_week
from transactions""")
def q_time_features(spark, d):
    t = FE.add_time_features(transactions(spark, d))
    return t.select(KEY, F.col("trans_hour").cast("long"), F.col("trans_day_of_week").cast("long"))


GEO_SQL = """
geo as (
  select trans_num, radians(lat) as lat1, radians(long) as lon1,
         radians(merch_lat) as lat2, radians(merch_long) as lon2
  from transactions),
terms as (select *, lat2 - lat1 as dlat, lon2 - lon1 as dlon from geo),
hav as (
  select *, least(pow(sin(dlat / 2), 2) + cos(lat1) * cos(lat2) * pow(sin(dlon / 2), 2), 1.0) as a
  from terms)"""


@query("geo_terms", with_transactions(GEO_SQL) + """
select trans_num, round(lat1, 6) as lat1, round(lon1, 6) as lon1, round(lat2, 6) as lat2,
       round(lon2, 6) as lon2, round(dlat, 6) as dlat, round(dlon, 6) as dlon
from terms""")
def q_geo_terms(spark, d):
    t = transactions(spark, d)
    terms = to_radians_terms("lat", "long", "merch_lat", "merch_long")
    return t.select(KEY, *[r6(v).alias(k) for k, v in terms.items()])


@query("haversine_km", with_transactions(GEO_SQL) + """
select trans_num, round(12742.0 * asin(sqrt(a)), 6) as distance_km from hav""")
def q_haversine(spark, d):
    t = FE.add_distance(transactions(spark, d))
    return t.select(KEY, r6("distance_km").alias("distance_km"))


@query("binary_flag", with_transactions() + """
select trans_num, cast(case when gender = 'M' then 1 else 0 end as bigint) as gender_M
from transactions""")
def q_binary_flag(spark, d):
    t = FE.add_flag(transactions(spark, d))
    return t.select(KEY, F.col("gender_M").cast("long"))


@query("category_vocabulary", with_transactions() + """
select category, cast(row_number() over (order by category) - 1 as bigint) as position,
       row_number() over (order by category) = 1 as baseline
from (select distinct category from transactions where category is not null)""")
def q_category_vocabulary(spark, d):
    t = transactions(spark, d)
    vocab = FE.fit_vocabulary(t, "category")
    # The (size-checked) vocabulary is a literal array; each distinct value
    # looks up its position in it.
    pos = F.array_position(F.array(*[F.lit(v) for v in vocab]), F.col("category")) - 1
    return (t.select("category").where(F.col("category").isNotNull()).distinct()
             .select("category", pos.cast("long").alias("position"))
             .withColumn("baseline", F.col("position") == 0))


ONE_HOT_SQL = """
select trans_num,
       cast(case when category = 'error' then 1 else 0 end as bigint) as cat_error,
       cast(case when category = 'purchase' then 1 else 0 end as bigint) as cat_purchase,
       cast(case when category = 'signup' then 1 else 0 end as bigint) as cat_signup,
       cast(case when category = 'view' then 1 else 0 end as bigint) as cat_view
from transactions"""


@query("one_hot", with_transactions() + ONE_HOT_SQL)
def q_one_hot(spark, d):
    t = transactions(spark, d)
    vocab = FE.fit_vocabulary(t, "category")
    cols = FE.one_hot_columns("category", vocab)
    return t.select(KEY, *[c.cast("long").alias(n) for n, c in cols.items()])


@query("clean_names", """
select p_partkey, p_name, 'cat_' || replace(replace(p_name, ' ', '_'), '/', '_') as column_name
from part""")
def q_clean_names(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", "p_name",
                    F.concat(F.lit("cat_"), clean_value("p_name")).alias("column_name"))


# ------------------------------------------------------------------ filters, sets

@query("class_filter", with_transactions() + """
select trans_num, amt, cast(is_fraud as bigint) as is_fraud from transactions where is_fraud = 1""")
def q_class_filter(spark, d):
    return tx_long(B.by_class(transactions(spark, d), 1).select(KEY, "amt", LABEL))


VALID_COLS = ["trans_num", "amt", "lat", "long", "merch_lat", "merch_long", "trans_date_trans_time",
              "category"]
_FLOAT_COLS = {"amt", "lat", "long", "merch_lat", "merch_long"}


def _bad_sql(c: str) -> str:
    return f"{c} is null or isnan({c})" if c in _FLOAT_COLS else f"{c} is null"


# The reject reason in SQL: names of the bad columns, comma-separated.
_VALID_SQL_REASON = ("concat_ws(',', "
                     + ", ".join(f"case when {_bad_sql(c)} then '{c}' end" for c in VALID_COLS)
                     + ", case when is_fraud is null or is_fraud not in (0, 1) then 'is_fraud' end)")


@query("valid_rows", with_transactions() + f"""
select trans_num, amt, cast(is_fraud as bigint) as is_fraud from transactions
where {_VALID_SQL_REASON} = ''""")
def q_valid_rows(spark, d):
    v = FE.valid_rows(transactions(spark, d), VALID_COLS, "reject", label=LABEL)
    return tx_long(v.select(KEY, "amt", LABEL))


@query("reject_rows", with_transactions() + f"""
select trans_num, {_VALID_SQL_REASON} as reason from transactions
where {_VALID_SQL_REASON} <> ''""")
def q_reject_rows(spark, d):
    r = FE.reject_rows(transactions(spark, d), VALID_COLS, label=LABEL)
    return r.select(KEY, "reason")


@query("union_classes", with_transactions() + """
select trans_num, cast(is_fraud as bigint) as is_fraud from transactions where is_fraud = 0
union all
select trans_num, cast(is_fraud as bigint) as is_fraud from transactions where is_fraud = 1""")
def q_union_classes(spark, d):
    t = transactions(spark, d).select(KEY, LABEL)
    return tx_long(B.union_all(B.by_class(t, 0), B.by_class(t, 1)))


# ------------------------------------------------------------------ aggregates

HASH_SQL = "cast(cast('0x' || substr(md5({k} || '{salt}'), 1, 8) as bigint) as double) / 4294967296.0"


@query("stage_counts", with_transactions(f"""
f as (select *, {_VALID_SQL_REASON} = '' as valid,
             {HASH_SQL.format(k='trans_num', salt=':split')} < 0.8 as train from transactions),
a as (select count(*) as input, count(*) filter (where valid) as valid,
             count(*) filter (where valid and is_fraud = 0) as legit,
             count(*) filter (where valid and is_fraud = 1) as fraud,
             count(*) filter (where valid and train) as train,
             count(*) filter (where valid and not train) as test from f)""") + """
select 'input' as stage, cast(input as bigint) as n from a union all
select 'valid', cast(valid as bigint) from a union all
select 'legit', cast(legit as bigint) from a union all
select 'fraud', cast(fraud as bigint) from a union all
select 'train', cast(train as bigint) from a union all
select 'test', cast(test as bigint) from a""")
def q_stage_counts(spark, d):
    t = transactions(spark, d)
    valid = FE.invalid_reason(t, VALID_COLS, LABEL).isNull()
    return M.stage_counts(t, valid, hash_unit(KEY, SPLIT_SALT) < 0.8)


@query("class_balance", with_transactions() + """
select cast(count(*) filter (where is_fraud = 0) as bigint) as legit,
       cast(count(*) filter (where is_fraud = 1) as bigint) as fraud,
       round(cast(count(*) filter (where is_fraud = 0) as double)
             / nullif(count(*) filter (where is_fraud = 1), 0), 6) as ratio
from transactions""")
def q_class_balance(spark, d):
    c = B.class_balance(transactions(spark, d))
    return c.select(F.col("legit").cast("long"), F.col("fraud").cast("long"), r6("ratio").alias("ratio"))


DIST_SQL = ("12742.0 * asin(sqrt(least(pow(sin((radians(merch_lat) - radians(lat)) / 2), 2)"
            " + cos(radians(lat)) * cos(radians(merch_lat))"
            " * pow(sin((radians(merch_long) - radians(long)) / 2), 2), 1.0)))")

IQR_SQL = f"""
feat as (select *, {DIST_SQL} as distance_km from transactions),
q as (select quantile_disc(case when isnan(amt) then null else amt end, 0.25) as a1,
             quantile_disc(case when isnan(amt) then null else amt end, 0.75) as a3,
             quantile_disc(case when isnan(distance_km) then null else distance_km end, 0.25) as d1,
             quantile_disc(case when isnan(distance_km) then null else distance_km end, 0.75) as d3
      from feat)"""


@query("iqr_stats", with_transactions(IQR_SQL) + """
select 'amt' as "column", round(a1, 6) as q1, round(a3, 6) as q3, round(a3 - a1, 6) as iqr from q
union all
select 'distance_km', round(d1, 6), round(d3, 6), round(d3 - d1, 6) from q""")
def q_iqr_stats(spark, d):
    t = FE.add_distance(transactions(spark, d))
    return S.iqr_table(t, ["amt", "distance_km"]).select(
        "column", r6("q1").alias("q1"), r6("q3").alias("q3"), r6("iqr").alias("iqr"))


@query("robust_scale", with_transactions(IQR_SQL) + """
select trans_num,
       round(amt * (case when a3 - a1 = 0 then 0.0 else 1.0 / (a3 - a1) end), 6) as amt_scaled,
       round(distance_km * (case when d3 - d1 = 0 then 0.0 else 1.0 / (d3 - d1) end), 6)
         as distance_km_scaled
from feat, q""")
def q_robust_scale(spark, d):
    t = FE.add_distance(transactions(spark, d)).select(KEY, "amt", "distance_km")
    s = S.robust_scale(t, ["amt", "distance_km"], relative_error=0.0)
    return s.select(KEY, r6("amt_scaled").alias("amt_scaled"),
                    r6("distance_km_scaled").alias("distance_km_scaled"))


# ------------------------------------------------------------------ sampling / split

@query("split_hash", with_transactions() + f"""
select trans_num, cast(is_fraud as bigint) as is_fraud,
       case when {HASH_SQL.format(k='trans_num', salt=':split')} < 0.8 then 'train' else 'test' end as side
from transactions""")
def q_split_hash(spark, d):
    t = transactions(spark, d).select(KEY, LABEL)
    return tx_long(split_side(t))


@query("oversample_exact", with_transactions(f"""
r as (select cast(count(*) filter (where is_fraud = 0) as double)
             / count(*) filter (where is_fraud = 1) as ratio from transactions),
c as (select t.trans_num, t.amt, t.is_fraud,
             cast(floor(r.ratio) as bigint)
             + case when {HASH_SQL.format(k='t.trans_num', salt=':os')} < r.ratio - floor(r.ratio)
                    then 1 else 0 end as copies
      from transactions t, r where t.is_fraud = 1)""") + """
select trans_num, amt, cast(is_fraud as bigint) as is_fraud, cast(1 as bigint) as copy
from transactions where is_fraud = 0
union all
select trans_num, amt, cast(is_fraud as bigint) as is_fraud, cast(k as bigint) as copy
from c, unnest(range(1, copies + 1)) as u(k) where copies > 0""")
def q_oversample_exact(spark, d):
    t = transactions(spark, d).select(KEY, "amt", LABEL)
    out = B.balance(t, mode="exact")
    return tx_long(out).withColumn("copy", F.col("copy").cast("long"))


# ------------------------------------------------------------------ scoring and metrics

def _fixed_scored(spark, d) -> DataFrame:
    return fixed_score(transactions(spark, d).select(KEY, "amt", "category", EVENT_TIME, LABEL))


SCORED_SQL = f"""
pp as (select trans_num, is_fraud as y, {FIXED_SCORE_SQL} as sc from transactions)"""


@query("score_linear", with_transactions(SCORED_SQL) + """
select trans_num, sc as fraud_probability,
       cast(case when sc > 0.5 then 1 else 0 end as bigint) as is_fraud_prediction
from pp""")
def q_score_linear(spark, d):
    s = _fixed_scored(spark, d)
    # The score is already rounded to 9 places; rounding it again to 6 would
    # round a decimal twice (engines disagree on ties of the binary value).
    return s.select(KEY, F.col("score").alias("fraud_probability"),
                    decision("score").cast("long").alias("is_fraud_prediction"))


@query("prediction_counts", with_transactions(SCORED_SQL) + f"""
select case when sc > 0.5 then 'fraud' else 'genuine' end as prediction_class,
       '{FIXED_MODEL}' as model_name, cast(count(*) as bigint) as n
from pp group by 1""")
def q_prediction_counts(spark, d):
    s = _fixed_scored(spark, d).select(F.struct(
        F.col("score").alias("fraud_probability"),
        decision("score").alias("is_fraud_prediction")).alias(FIXED_MODEL))
    return M.prediction_counts(s, [FIXED_MODEL]).withColumn("n", F.col("n").cast("long"))


@query("weighted_f1", with_transactions(SCORED_SQL, """
k as (select y, case when sc > 0.5 then 1 else 0 end as p, cast(count(*) as double) as n
      from pp group by 1, 2),
a as (select y as lab, sum(n) as act, sum(case when y = p then n else 0 end) as tp from k group by y),
b as (select p as lab, sum(n) as prd from k group by p)""") + """
select round(sum(act * 2 * tp / (act + coalesce(prd, 0))) / sum(act), 6) as f1,
       round(max(case when lab = 1 then 2 * tp / (act + coalesce(prd, 0)) end), 6) as f1_fraud
from a left join b using (lab)""")
def q_weighted_f1(spark, d):
    s = _fixed_scored(spark, d).withColumn("prediction", decision("score"))
    return M.f1_report(s).select(r6("f1").alias("f1"), r6("f1_fraud").alias("f1_fraud"))


PR_SQL = """
g as (select sc, cast(sum(y) as double) as tp, cast(count(*) as double) as n from pp
      where sc is not null group by sc),
u as (select sc, sum(tp) over (order by sc desc) as tp, sum(n) over (order by sc desc) as n,
             sum(tp) over () as p from g),
v as (select sc, tp / p as r, tp / n as pr from u)"""


@query("pr_curve", with_transactions(SCORED_SQL, PR_SQL) + """
select sc as threshold, round(r, 6) as recall, round(pr, 6) as precision
from v""")
def q_pr_curve(spark, d):
    c = M.pr_curve(_fixed_scored(spark, d))
    return c.select("threshold",
                    r6("recall").alias("recall"), r6("precision").alias("precision"))


@query("pr_auc", with_transactions(SCORED_SQL, PR_SQL, """
z as (select r, pr, lag(r) over (order by sc desc) as r0, lag(pr) over (order by sc desc) as p0 from v)""") + """
select round(sum((r - coalesce(r0, 0)) * (pr + coalesce(p0, pr)) / 2), 6) as pr_auc from z""")
def q_pr_auc(spark, d):
    return M.pr_auc(_fixed_scored(spark, d)).select(r6("pr_auc").alias("pr_auc"))


# ------------------------------------------------------------------ gates

REQUIRED = ["trans_num", "trans_date_trans_time", "category", "amt", "lat", "long",
            "merch_lat", "merch_long", "is_fraud"]


@query("gate_schema", with_transactions() + f"""
select 'schema_columns' as gate, cast({len(REQUIRED)} as bigint) as observed,
       cast({len(REQUIRED)} as bigint) as expected, true as passed
union all
select 'schema_rows', cast(count(*) as bigint), cast(1 as bigint), count(*) >= 1 from transactions""")
def q_gate_schema(spark, d):
    return G.gate_schema(transactions(spark, d), REQUIRED)


@query("gate_nonempty", with_transactions() + """
select 'nonempty' as gate, cast(count(*) as bigint) as observed, cast(1 as bigint) as expected,
       count(*) >= 1 as passed from transactions""")
def q_gate_nonempty(spark, d):
    return G.gate_nonempty(transactions(spark, d))


@query("gate_class_present", with_transactions() + """
select 'class_present' as gate, cast(count(*) filter (where is_fraud = 1) as bigint) as observed,
       cast(1 as bigint) as expected, count(*) filter (where is_fraud = 1) >= 1 as passed
from transactions""")
def q_gate_class_present(spark, d):
    return G.gate_class_present(transactions(spark, d))
