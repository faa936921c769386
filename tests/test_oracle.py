"""Every batch query against its DuckDB oracle on the smallest supplied tables."""

import pytest

from salespark.plans.queries import QUERIES
from tools.oracle_check import compare, duck

BATCH = sorted(k for k, q in QUERIES.items() if q.sql)


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.fixture(scope="module")
def con01():
    return duck("/root/testdata/sf0.01")


@pytest.mark.parametrize("name", BATCH)
def test_query_matches_oracle(spark, con, sf_small, name):
    q = QUERIES[name]
    assert compare(spark, con, name, q.run, q.sql, sf_small, verbose=False)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert {r.value_band for r in rows} <= {"low", "medium", "high"} and rows
    assert set(E.oracle_sql()) <= set(E.queries())


ZONE_SENSITIVE = ["classify", "ts_pattern", "sql_valid", "agg_window_stats", "agg_revenue_minute",
                  "dim_date_build"]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_results_do_not_depend_on_session_zone(spark, con01, name):
    """The fixture spans DST changes; wall-clock results must not move."""
    q = QUERIES[name]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert compare(spark, con01, name, q.run, q.sql, "/root/testdata/sf0.01", verbose=False)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
