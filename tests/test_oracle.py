"""Every registered query against its DuckDB oracle at sf0.01 (rows, column names, values)."""

import pytest

import __spark_entry__ as entry
from conftest import SF01
from oracle_check import compare, duck

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "climb_rate_ratio" in df.columns


def test_every_sql_query_has_a_registered_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, SF01, name, QUERIES[name], SQL.get(name))
    if name not in SQL:
        assert res["spark_rows"] > 0
        return
    assert res["ok"], res


@pytest.mark.parametrize("name", ["window_raw", "prepared_frame", "normalised_states", "recent_only"])
def test_time_zone_independent(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        res = compare(spark, con, SF01, name, QUERIES[name], SQL[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert res["ok"] and res["exact"], res
