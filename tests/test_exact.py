"""Compiled models, exact sizes, binned areas and located reconciliation."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.sql import functions as F

from txnscore.operators import balance as B
from txnscore.operators import metrics as M
from txnscore.operators import reconcile as R
from txnscore.operators import stats as S
from txnscore.operators.split import split_stratified
from txnscore.plans import models as MD
from txnscore.plans import trees as T
from txnscore.plans.catalog_models import trained
from txnscore.plans.featurize import feature_table
from txnscore.schemas import KEY, LABEL
from txnscore.session import scratch_path
from txnscore.views import transactions

SF_SMALL = "/root/testdata/sf0.001"


# compiled models

def test_duckdb_evaluates_the_fitted_models_sql(spark):
    t = trained(spark, SF_SMALL)
    path = scratch_path(spark, "exported-features")
    raw = transactions(spark, SF_SMALL)
    feature_table(t.features, raw, keep=[KEY]).write.parquet(path)
    names = t.features.stages[-1].getInputCols()
    want = {r[KEY]: (r[1][0], r[2][0]) for r in MD.score(t.scorer(), raw).select(KEY, MD.LR_NAME, MD.GBT_NAME).collect()}
    sql = (f"select {KEY}, {T.probability_sql(t.lr, names, chr(34))}, {T.probability_sql(t.gbt, names, chr(34))} "
           f"from read_parquet('{path}/*.parquet')")
    got = {r[0]: r[1:] for r in duckdb.sql(sql).fetchall()}
    assert got.keys() == want.keys() and len(T.parse(t.gbt.toDebugString)) == MD.GBT_MAX_ITER
    assert all(abs(a - b) < 1e-9 for k in want for a, b in zip(got[k], want[k]))


def test_categorical_splits_and_missing_values(spark):
    rng = random.Random(2)
    rows = [(float(rng.randrange(6)), rng.random() * 10) for _ in range(300)]
    df = spark.createDataFrame([(c, x, float((c in (1, 4)) ^ (x > 6))) for c, x in rows], "c double, x double, y double")
    asm = VectorAssembler(inputCols=["c", "x"], outputCol="raw", handleInvalid="keep")
    idx = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=8).fit(asm.transform(df))
    model = GBTClassifier(labelCol="y", maxIter=4, maxDepth=3, seed=1).fit(idx.transform(asm.transform(df)))
    assert " in {" in model.toDebugString
    some = df.unionByName(spark.createDataFrame([(2.0, float("nan"), 0.0)], "c double, x double, y double"))
    scored = PipelineModel(stages=[asm, idx, model]).transform(some).withColumn("p", F.expr(T.probability_sql(model, ["c", "x"])))
    for r in scored.select("probability", "p").collect():
        assert abs(r[0][1] - r[1]) < 1e-9


def test_compiled_scores_of_rows_with_missing_inputs(spark):
    t = trained(spark, SF_SMALL)
    raw = transactions(spark, SF_SMALL).withColumn("amt", F.when(F.col("cc_num") % 3 != 0, F.col("amt")))
    a = {r[KEY]: r for r in T.score_compiled(t.scorer(), raw).collect()}
    for r in MD.score(t.scorer(), raw).collect():
        for m in (MD.LR_NAME, MD.GBT_NAME):
            assert (r[m] is None) == (a[r[KEY]][m] is None)
            assert r[m] is None or abs(r[m][0] - a[r[KEY]][m][0]) < 1e-9 and r[m][1] == a[r[KEY]][m][1]


def test_unreadable_tree_lines_are_an_error():
    with pytest.raises(ValueError):
        T.parse("GBT\n Tree 0 (weight 1.0):\n  If (what)\n")
    assert T.parse("no trees") == [] and T.tree_sql(T.Leaf(0.5), []) == "cast('0.5' as double)"


# exact sizes

def skewed(spark, n=300):
    """A third of the rows under one key, some of them equal rows, a NULL key."""
    rng = random.Random(4)
    rows = [(str(k), k % 7, 0) for k in range(n)] + [("hot", rng.randrange(3), 1) for _ in range(n // 2)]
    rows += [(f"f{k}", 0, 1) for k in range(n // 10)] + [(None, 1, 1), (None, 1, 1)]
    return spark.createDataFrame(rows, f"{KEY} string, amt int, {LABEL} int").repartition(7)


@pytest.mark.parametrize("k", [0, 1, 5, 29, 30, 77, 151, 181, 182])
def test_a_cut_takes_exactly_k_rows(spark, monkeypatch, k):
    monkeypatch.setattr(S, "CUT_ROWS", 3)
    minor = S.with_order(B.by_class(skewed(spark), 1), KEY, ":os")
    cut = S.cut_after(minor, k)
    assert minor.where(cut.before()).count() + cut.taken == k
    assert minor.where(cut.at()).count() == cut.of >= cut.taken


def test_equal_balance_on_hot_keys_equal_rows_and_small_majorities(spark):
    df = skewed(spark)
    for part in (df, df.where(f"{LABEL} = 1 or {KEY} < '2'"), df.where(f"{LABEL} = 1 or {KEY} = '7'")):
        legit = part.where(f"{LABEL} = 0").count()
        out = B.balance(part, mode="equal")
        assert Counter(r[0] for r in out.select(LABEL).collect()) == {0: legit, 1: legit}
        one, other = (Counter(r) for r in (out.collect(), B.balance(part.repartition(3), mode="equal").collect()))
        assert Counter(r[:3] for r in one.elements()) == Counter(r[:3] for r in other.elements())
    whole = Counter(B.balance(df, mode="equal", copy_col=None).where(f"{LABEL} = 1").collect())
    share = Counter(df.where(f"{LABEL} = 1").collect())
    low = df.where(f"{LABEL} = 0").count() // sum(share.values())
    assert all(low * n <= whole[r] <= (low + 1) * n for r, n in share.items())


def test_balance_without_minority_rows_is_an_error(spark):
    with pytest.raises(ValueError):
        B.balance(skewed(spark).where(f"{LABEL} = 0"), mode="equal")


@pytest.mark.parametrize("share", [0.0, 0.25, 0.8, 1.0])
def test_stratified_split_sizes(spark, share):
    df = skewed(spark)
    n = Counter(r[0] for r in df.select(LABEL).collect())
    out = split_stratified(df, LABEL, share)
    got = Counter((r[LABEL], r["side"]) for r in out.collect())
    for c, rows in n.items():
        train = math.floor(share * rows + 0.5)
        assert got[c, "train"] == train and got[c, "test"] == rows - train
    assert Counter(r[:3] for r in out.collect()) == Counter(r[:3] for r in df.collect())
    with pytest.raises(ValueError):
        split_stratified(df, KEY, 0.5, max_classes=10)


# binned area

@pytest.mark.parametrize("seed", range(4))
def test_the_exact_area_is_within_the_stated_error(spark, seed):
    rng = np.random.default_rng(seed)
    n = 4000
    y = rng.random(n) < (0.02, 0.5, 0.2, 1.0)[seed]
    s = np.clip(rng.normal(0.2 + 0.3 * y, 0.2), 0, 1) ** (seed + 1)
    s = np.round(s, 2) if seed == 2 else s
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)] + [(None, 1)], f"score double, {LABEL} int")
    exact = M.pr_auc(df).first()[0]
    last = 2.0
    for bins in (3, 30, 300, 3000):
        r = M.pr_auc_binned(df, bins).first()
        assert abs(r["pr_auc"] - exact) <= r["area_error"] + 1e-12
        assert r["area_error"] <= last + 1e-12
        last = r["area_error"]
    assert last < (0.2 if seed == 0 else 0.05)


def test_histogram_rows_are_bounded_and_parts_add_up(spark):
    df = spark.range(200_000).select(((F.col("id") * 7919) % 200_000 / 200_000).alias("score"),
                                     (F.col("id") % 3 == 0).cast("int").alias(LABEL))
    h = M.score_histogram(df)
    assert h.count() <= M.SCORE_CELLS
    parts = M.score_histogram(df.where("score < 0.3")).unionByName(M.score_histogram(df.where("score >= 0.3")))
    added = parts.groupBy("cell").agg(F.sum("tp").alias("tp"), F.sum("n").alias("n"))
    assert Counter(map(tuple, added.collect())) == Counter(map(tuple, h.collect()))


# reconciliation

def test_peeling_names_keys_with_any_multiplicity():
    rng = random.Random(1)
    for size, many in ((400, 300), (4, 2), (1, 1)):
        net = {rng.getrandbits(60): rng.choice([-3, -1, 1, 2]) for _ in range(many)}
        cells = {}
        for k, n in net.items():
            check, places = R.check_and_cells(k, size)
            for c in places:
                v = cells.setdefault(c, [0, 0, 0])
                v[0], v[1], v[2] = v[0] + n, v[1] + n * k, v[2] + n * check
        found = R.peel({c: tuple(v) for c, v in cells.items()}, size)
        assert found == net or (size == 4 and found is None)
    assert R.peel({}, 5) == {}
    assert R.peel({0: (2, 5, 9)}, 5) is None


def test_differing_keys_by_table_and_by_join(spark):
    rng = random.Random(9)
    src = [str(rng.randrange(400)) for _ in range(900)] + [None] * 3 + ["hot"] * 500
    log = [k for k in src if k != "7" and rng.random() > 0.02] + ["new", "new", "", "k"] + ["hot"] * 2
    a, b = Counter(src), Counter(log)
    want = {(k, a[k], b[k]) for k in a | b if a[k] != b[k]}
    x = spark.createDataFrame([(k,) for k in src], "k string").repartition(4)
    y = spark.createDataFrame([(k,) for k in log], "id string").repartition(3)
    for cells, decoded in ((R.CELLS, True), (9, False)):
        r = R.reconcile(x, y, "k", "id", cells)
        assert r.decoded == decoded and (r.source_rows, r.log_rows) == (len(src), len(log))
        assert {tuple(k) for k in r.keys.collect()} == want
    same = R.reconcile(x, x, "k")
    assert same.decoded and same.keys.count() == 0
    none = R.reconcile(x.limit(0), x.limit(0), "k")
    assert none.decoded and none.source_rows == 0 and none.keys.count() == 0


def test_neither_side_is_shuffled_by_key(spark):
    t = transactions(spark, SF_SMALL)
    plan = R.cell_sums(t, t, KEY, KEY, 100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(cell") == 1 and plan.count("Exchange") == 1
    named = R.reconcile(t, t.where("trans_num != '7'"), KEY).keys
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
