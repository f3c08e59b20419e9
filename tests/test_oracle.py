"""Every query with an oracle statement equals DuckDB on the same parquet:
same column names and types, same rows (order-insensitive hash)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle import TABLES, compare
from txnscore.plans import registry

SQL = registry.ORACLE
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def test_every_query_has_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())


def _duck_types(sql: str) -> dict:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return {r[0]: r[1] for r in con.execute("describe " + sql).fetchall()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    ok, n, detail = compare(spark, name, lambda s, d: df, SQL[name], SF_SMALL)
    assert ok, detail
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == _duck_types(SQL[name])
