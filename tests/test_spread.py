"""Rows that lie in one large part are read, fitted and scored by even tasks."""

import pytest
from pyspark.sql import functions as F

from txnscore.plans import catalog_models as CM
from txnscore.plans import models as MD
from txnscore.schemas import LABEL
from txnscore.sources import files
from txnscore.views import transactions

SF_SMALL = "/root/testdata/sf0.001"


def part_rows(df):
    """Rows of each partition that holds any."""
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(files, "SPREAD_ROWS", 100)


def one_part(spark):
    """1,000 rows in one partition: a key that repeats, NULL keys and equal rows."""
    return spark.range(1000, numPartitions=1).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("trans_num"),
        (F.col("id") % 7).alias("x"))


def test_spread_keeps_rows_and_evens_parts(spark, small_parts):
    src = one_part(spark)
    out = files.spread(src)
    assert out.exceptAll(src).count() == 0 and out.count() == 1000
    assert max(part_rows(out)) <= 101
    stored = files.stored_evenly(src, "even")
    assert stored.schema == src.schema
    assert stored.exceptAll(src).count() == 0 and src.exceptAll(stored).count() == 0


def test_small_table_stays(spark):
    src = one_part(spark)
    assert files.spread(src) is src and files.stored_evenly(src, "even") is src


def test_fits_read_even_partitions(spark, small_parts, monkeypatch):
    """Legit rows of one source part made one partition that every pass waited for."""
    seen = {}
    monkeypatch.setattr(MD, "train_lr", lambda df: seen.setdefault("lr", part_rows(df)))
    monkeypatch.setattr(MD, "train_gbt", lambda df, seed: seen.setdefault("gbt", part_rows(df)))
    t = MD.train(transactions(spark, SF_SMALL).coalesce(1))
    for sizes in seen.values():
        assert sum(sizes) == t.train_rows and max(sizes) <= 110
    assert t.train_rows == t.train.count() and set(seen) == {"lr", "gbt"}
    assert {r[0] for r in t.train.select(LABEL).distinct().collect()} == {0, 1}


def test_scorers_read_even_files(spark, small_parts, monkeypatch):
    monkeypatch.setattr(CM, "_FITTED", {})
    raw = transactions(spark, SF_SMALL)
    even = CM.even_transactions(spark, SF_SMALL)
    assert even.exceptAll(raw).count() == 0 and even.count() == raw.count()
    assert len(even.inputFiles()) >= 10
