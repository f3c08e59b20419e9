"""Plan-shape rules that must hold for every registered query, and skew checks."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from txnscore.operators import balance as B
from txnscore.operators.stats import exact_quantiles
from txnscore.plans import registry

# Plans that write scratch data while being built (streams, round trips, fits)
# are checked too: explain() only plans the returned DataFrame.
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _nodes(node):
    yield node
    if node.nodeName() == "AdaptiveSparkPlan":
        yield from _nodes(node.initialPlan())
        return
    kids = node.children()
    for i in range(kids.size()):
        yield from _nodes(kids.apply(i))


def _bounded_single_partition(exchange) -> bool:
    """A single-partition exchange is fine above a global aggregate (one
    partial row per task) or above per-range-partition totals (one row per
    range partition)."""
    child = exchange.child()
    if "Aggregate" not in child.nodeName():
        return False
    keys = child.groupingExpressions()
    return keys.size() == 0 or "_range" in keys.toString()


def single_partition_violations(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan()
    bad = []
    for n in _nodes(plan):
        if n.nodeName() == "Exchange" and "SinglePartition" in n.outputPartitioning().toString():
            if not _bounded_single_partition(n):
                bad.append(n.toString())
    return bad


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_forbidden_operators(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = _plan(df)
    assert not [op for op in FORBIDDEN if op in plan], plan
    assert not single_partition_violations(df)


def test_scans_are_pruned(spark):
    plan = _plan(E.queries()["score_linear"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_oversampling_balanced_when_fraud_is_clustered(spark):
    rows = [(str(i), 0) for i in range(20000)] + [(f"f{i}", 1) for i in range(400)]
    df = spark.createDataFrame(rows, "trans_num string, is_fraud int").coalesce(1)
    out = B.oversample(df, mode="exact", spread_partitions=8)
    sizes = [n for n in out.rdd.glom().map(len).collect()]
    assert sum(sizes) == pytest.approx(20000, abs=1)
    assert max(sizes) < 1.2 * (sum(sizes) / len(sizes))


def test_hot_value_in_quantiles(spark):
    # a third of all rows hold one value
    vals = [7.0] * 3000 + [float(i % 997) for i in range(6000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(8)
    got = {r["p"]: r["value"] for r in exact_quantiles(df, ["x"], [0.25, 0.5, 0.75]).collect()}
    s = sorted(vals)
    import math
    for p, v in got.items():
        assert v == s[math.ceil(p * len(s)) - 1]


def test_label_filter_and_pruning_reach_the_parquet_reader(spark, tmp_path):
    from txnscore.sources.files import read_dataset, write_dataset
    from txnscore.views import transactions
    path = write_dataset(transactions(spark, SF_SMALL), str(tmp_path / "tx"))
    fraud = B.by_class(read_dataset(spark, path), 1).select("trans_num", "amt")
    plan = _plan(fraud)
    assert "PushedFilters: [IsNotNull(is_fraud), EqualTo(is_fraud,1)]" in plan
    assert "ReadSchema: struct<trans_num:string,amt:double,is_fraud:int>" in plan


def test_partitioned_dataset_prunes_folders(spark):
    df = E.queries()["scan_dataset"](spark, SF_SMALL).where("category = 'purchase'")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(category" in plan and "(category#" in plan
    assert df.count() == 202
