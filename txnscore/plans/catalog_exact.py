"""Compiled models, exact-size balancing and splitting, binned PR-AUC and located
reconciliation (O37-O39, O44, O45, O47), with SQL for both sides."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import flag, trans_hour
from ..operators import balance as B
from ..operators import gates as G
from ..operators import metrics as M
from ..operators import reconcile as R
from ..operators.split import split_stratified
from ..schemas import EVENT_TIME, KEY, LABEL
from ..views import transactions, with_transactions
from . import models as MD
from . import trees as T
from .catalog import HASH_SQL, SCORED_SQL, _fixed_scored, tx_long
from .catalog_models import even_transactions, trained
from .fixed import FIXED_TREE_FEATURES, fixed_trees
from .registry import query


# ------------------------------------------------------------------ compiled models

_FIXED_MARGIN = T.ensemble_sql(fixed_trees(), list(FIXED_TREE_FEATURES))


@query("score_trees", with_transactions(f"""
f as (select trans_num, amt, cast(city_pop as double) as city_pop, cast(hour(trans_date_trans_time) as double) as trans_hour,
             cast(case when category = 'purchase' then 1 else 0 end as double) as cat_purchase from transactions),
m as (select trans_num, {_FIXED_MARGIN} as margin from f)""") + """
select trans_num, round(1 / (1 + exp(-2 * margin)), 9) as fraud_probability,
       cast(case when margin > 0 then 1 else 0 end as bigint) as is_fraud_prediction from m""")
def q_score_trees(spark, d):
    """A fixed tree ensemble, compiled, on every transaction."""
    x = transactions(spark, d).withColumns({"cat_purchase": flag("category", "purchase"), "trans_hour": trans_hour(EVENT_TIME)})
    m = x.select(KEY, *[F.col(c).cast("double").alias(c) for c in FIXED_TREE_FEATURES]).select(
        KEY, F.expr(_FIXED_MARGIN).alias("margin"))
    return m.select(KEY, F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-2 * F.col("margin"))), 9).alias("fraud_probability"),
                    (F.col("margin") > 0).cast("long").alias("is_fraud_prediction"))


def _same(compiled: DataFrame, scored: DataFrame, names: list[str]) -> DataFrame:
    """Per key, whether compiled and model scores agree to 1e-9 with equal decisions."""
    both = compiled.withColumnsRenamed({n: f"{n}_sql" for n in names}).join(scored, KEY)

    def same(n):
        gap = F.abs(F.col(f"{n}.fraud_probability") - F.col(f"{n}_sql.fraud_probability"))
        return (gap < 1e-9) & (F.col(f"{n}.is_fraud_prediction") == F.col(f"{n}_sql.is_fraud_prediction"))
    return both.select(KEY, *[same(n).alias(f"{n}_same") for n in names])


@query("train_gbt_trees", with_transactions() + f"""
select trans_num, true as {MD.GBT_NAME}_same from transactions
where {HASH_SQL.format(k='trans_num', salt=':split')} >= 0.8""")
def q_gbt_trees(spark, d):
    """The boosted model is the sum of its trees written as SQL, on test rows."""
    t = trained(spark, d)
    model = PipelineModel(stages=[*t.features.stages, t.gbt])
    return _same(T.score_compiled(model, t.test), MD.score(model, t.test), [MD.GBT_NAME])


@query("score_batch_compiled", with_transactions() + f"""
select trans_num, true as {MD.LR_NAME}_same, true as {MD.GBT_NAME}_same from transactions""")
def q_score_batch_compiled(spark, d):
    """Every transaction scored by both models' SQL and by the saved scorer."""
    model, raw = trained(spark, d).scorer(), even_transactions(spark, d)
    return _same(T.score_compiled(model, raw), MD.score(model, raw), [MD.LR_NAME, MD.GBT_NAME])


# ------------------------------------------------------------------ exact sizes

@query("oversample_equal", with_transactions(f"""
r as (select count(*) filter (where is_fraud = 0) as legit, count(*) filter (where is_fraud = 1) as fraud from transactions),
o as (select trans_num, amt, row_number() over (order by {HASH_SQL.format(k='trans_num', salt=':os')}, trans_num) as nth
      from transactions where is_fraud = 1),
c as (select trans_num, amt, legit // fraud + case when nth <= legit % fraud then 1 else 0 end as copies from o, r)""") + """
select trans_num, amt, cast(is_fraud as bigint) as is_fraud, cast(1 as bigint) as copy from transactions where is_fraud = 0
union all
select trans_num, amt, cast(1 as bigint) as is_fraud, cast(k as bigint) as copy
from c, unnest(range(1, copies + 1)) as u(k) where copies > 0""")
def q_oversample_equal(spark, d):
    """Fraud rows copied to the very number of legit rows."""
    t = transactions(spark, d).select(KEY, "amt", LABEL)
    return tx_long(B.balance(t, mode="equal")).withColumn("copy", F.col("copy").cast("long"))


@query("oversample_equal_counts", with_transactions() + """
select cast(count(*) filter (where is_fraud = 0) as bigint) as legit,
       cast(count(*) filter (where is_fraud = 0) as bigint) as fraud, cast(1 as double) as ratio from transactions""")
def q_oversample_equal_counts(spark, d):
    t = transactions(spark, d).select(KEY, LABEL)
    n = B.class_balance(B.balance(t, mode="equal", copy_col=None))
    return n.select(F.col("legit").cast("long").alias("legit"), F.col("fraud").cast("long").alias("fraud"), "ratio")


@query("split_stratified", with_transactions(f"""
o as (select trans_num, is_fraud, count(*) over (partition by is_fraud) as n, row_number() over (
        partition by is_fraud order by {HASH_SQL.format(k='trans_num', salt=':split')}, trans_num) as nth from transactions)""") + """
select trans_num, cast(is_fraud as bigint) as is_fraud,
       case when nth <= floor(cast(0.8 as double) * n + 0.5) then 'train' else 'test' end as side from o""")
def q_split_stratified(spark, d):
    return tx_long(split_stratified(transactions(spark, d).select(KEY, LABEL), LABEL))


# ------------------------------------------------------------------ binned PR-AUC

PR_BINS = 1000


@query("pr_auc_binned", with_transactions(SCORED_SQL + f""",
h as (select least(greatest(cast(floor(sc * {M.SCORE_CELLS}) as bigint), 0), {M.SCORE_CELLS - 1}) as cell,
             sum(y) as tp, count(*) as n from pp group by 1),
b as (select tp, n, floor(coalesce(sum(n) over (order by cell desc rows between unbounded preceding and 1 preceding), 0)
             * {PR_BINS}::double / sum(n) over ()) as bin from h),
p as (select bin, cast(sum(tp) as double) as t, cast(sum(n) - sum(tp) as double) as f from b group by bin),
c as (select t, f, coalesce(sum(t) over w, 0) as tp, coalesce(sum(t + f) over w, 0) as a, sum(t) over () as total from p
      window w as (order by bin rows between unbounded preceding and 1 preceding))""") + """
select round(sum(t / total * (case when a > 0 then tp / a else (tp + t) / (a + t + f) end + (tp + t) / (a + t + f)) / 2), 6) as pr_auc,
       round(sum(t / total * (case when a + t > 0 then (tp + t) / (a + t) else 0 end
                              - case when a + f > 0 then tp / (a + f) else 1 end)), 6) as area_error from c""")
def q_pr_auc_binned(spark, d):
    out = M.pr_auc_binned(_fixed_scored(spark, d), PR_BINS)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("pr_auc_binned_bound", "select true as within")
def q_pr_auc_binned_bound(spark, d):
    """The exact area lies within the stated error of the binned one, for few and many bins."""
    scored = _fixed_scored(spark, d)
    exact, ok = M.pr_auc(scored), F.lit(True)
    for bins in (10, 100, 1000):
        r = M.pr_auc_binned(scored, bins).first()
        ok = ok & (F.abs(F.col("pr_auc") - r["pr_auc"]) <= r["area_error"] + 1e-12)
    return exact.select(ok.alias("within"))


# ------------------------------------------------------------------ located reconciliation

def _faulty(spark, d, every: int) -> tuple[DataFrame, DataFrame]:
    """Source and log of which some keys are lost, repeated, unknown or NULL."""
    g = F.col(KEY).cast("long") % every
    src = transactions(spark, d).select(F.when(g != 8, F.col(KEY)).alias(KEY), g.alias("g"))
    log = src.where("g not in (5, 8)").unionByName(src.where("g = 6")).unionByName(
        src.where("g = 7").withColumn(KEY, F.concat(F.lit("x"), F.col(KEY))))
    return src, log


def _faulty_sql(every: int) -> str:
    return with_transactions(f"""
src as (select case when g = 8 then null else trans_num end as k, g
        from (select trans_num, cast(trans_num as bigint) % {every} as g from transactions)),
log as (select k from src where g not in (5, 8) union all select k from src where g = 6
        union all select 'x' || k from src where g = 7),
s as (select k, count(*) as n from src group by k),
l as (select k, count(*) as n from log group by k)""") + """
select coalesce(s.k, l.k) as key, cast(coalesce(s.n, 0) as bigint) as in_source, cast(coalesce(l.n, 0) as bigint) as in_log
from s full outer join l on s.k is not distinct from l.k where coalesce(s.n, 0) <> coalesce(l.n, 0)"""


@query("reconcile_keys", _faulty_sql(499))
def q_reconcile_keys(spark, d):
    """The differing keys by the lookup table (few faults)."""
    return R.reconcile(*_faulty(spark, d, 499), KEY).keys


@query("reconcile_keys_many", _faulty_sql(11))
def q_reconcile_keys_many(spark, d):
    """More differing keys than the table can name: the exact join does."""
    return R.reconcile(*_faulty(spark, d, 11), KEY, cells=12).keys


@query("gate_reconcile_located", f"""
with k as ({_faulty_sql(499)})
select 'published_count' as gate, cast((select count(*) from events) + (select sum(in_log - in_source) from k) as bigint) as observed,
       cast((select count(*) from events) as bigint) as expected, (select sum(in_log - in_source) from k) = 0 as passed
union all select 'missing_in_log', cast(count(*) as bigint), cast(0 as bigint), count(*) = 0 from k where in_log = 0
union all select 'unknown_in_log', cast(count(*) as bigint), cast(0 as bigint), count(*) = 0 from k where in_source = 0""")
def q_gate_reconcile_located(spark, d):
    return G.gate_reconcile(*_faulty(spark, d, 499), KEY, mode="located")
