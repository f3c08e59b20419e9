"""The ``transactions`` fixture view over the driver's ``events`` table.

The same mapping exists twice: as DataFrame code for Spark and as SQL text
for the DuckDB oracle. Both read the whole ``events`` table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table of ``sf_dir`` by name."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Map event rows to transaction columns (FIXTURES.md section 2)."""
    uid, eid = F.col("user_id"), F.col("event_id")
    lat = (F.lit(25) + uid % 25).cast("double")
    lon = (F.lit(-120) + uid % 50).cast("double")
    return events.select(
        eid.cast("string").alias("trans_num"),
        F.col("ts").alias("trans_date_trans_time"),
        uid.alias("cc_num"),
        F.col("event_type").alias("category"),
        F.col("value").alias("amt"),
        F.when(uid % 2 == 0, "M").otherwise("F").alias("gender"),
        (F.lit(1000) + uid * 37).alias("city_pop"),
        lat.alias("lat"),
        lon.alias("long"),
        (lat + (eid % 200 - 100).cast("double") / 100).alias("merch_lat"),
        (lon + (eid % 190 - 95).cast("double") / 100).alias("merch_long"),
        F.when(F.col("event_type").isin("purchase", "error") & (F.col("value") > 150), 1)
         .otherwise(0).alias("is_fraud"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `transactions` view over the whole `events` table of ``sf_dir``."""
    return transactions_from_events(table(spark, sf_dir, "events"))


# DuckDB text of the same view; oracle statements start with ``WITH`` + this.
TRANSACTIONS_SQL = """
transactions as (
  select cast(event_id as varchar) as trans_num, ts as trans_date_trans_time, user_id as cc_num,
         event_type as category, value as amt,
         case when user_id % 2 = 0 then 'M' else 'F' end as gender,
         1000 + user_id * 37 as city_pop,
         cast(25 + user_id % 25 as double) as lat,
         cast(-120 + user_id % 50 as double) as long,
         cast(25 + user_id % 25 as double) + cast(event_id % 200 - 100 as double) / 100 as merch_lat,
         cast(-120 + user_id % 50 as double) + cast(event_id % 190 - 95 as double) / 100 as merch_long,
         case when event_type in ('purchase', 'error') and value > 150 then 1 else 0 end as is_fraud
  from events
)"""


def with_transactions(*ctes: str) -> str:
    """``WITH transactions as (...), <ctes>`` prefix for an oracle statement."""
    parts = [TRANSACTIONS_SQL.strip()] + [c.strip() for c in ctes]
    return "with " + ",\n".join(parts) + "\n"
