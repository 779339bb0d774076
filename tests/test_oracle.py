"""Every registered query against its SQL, exactly, on the driver tables."""

import pytest

import __spark_entry__ as registry
from authlytics.plans import pipeline
from authlytics.sources import driver_tables
from comparison import assert_same, open_tables

SF_DIR = "/root/testdata/sf0.01"
QUERIES = registry.own_queries()


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.oracle_sql()) >= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, tables, name):
    expected = tables.sql(registry.oracle_sql()[name]).to_arrow_table()
    assert expected.num_rows > 0
    assert_same(QUERIES[name](spark, SF_DIR), expected, ordered=name in pipeline.REPORTS)


def test_no_row_is_lost_at_the_source(spark):
    for raw, source in (("raw_users", "customer"), ("raw_auth_events", "events")):
        assert QUERIES[raw](spark, SF_DIR).count() == driver_tables._table(
            spark, SF_DIR, source
        ).count()


def test_unknown_customers_and_nations_stay(spark, tmp_path):
    for name in driver_tables.TABLES:
        rows = driver_tables._table(spark, SF_DIR, name)
        if name == "customer":
            rows = rows.filter("c_custkey <> 3")
        if name == "nation":
            rows = rows.filter("n_nationkey <> 5")
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    tables = open_tables(str(tmp_path))
    for name in ("raw_users", "raw_auth_events", "user_friction_scores"):
        expected = tables.sql(registry.oracle_sql()[name]).to_arrow_table()
        assert_same(QUERIES[name](spark, str(tmp_path)), expected)
    events = QUERIES["raw_auth_events"](spark, str(tmp_path))
    assert events.count() == driver_tables._table(spark, SF_DIR, "events").count()
    assert events.filter("mfa_enabled IS NULL").count() > 0


def test_planted_cases_occur(spark):
    scores = QUERIES["user_friction_scores"](spark, SF_DIR)
    assert scores.filter("failure_rate IS NULL").count() > 0
    users = QUERIES["raw_users"](spark, SF_DIR).select("user_id")
    events = QUERIES["stg_auth_events"](spark, SF_DIR)
    assert events.join(users, "user_id", "left_anti").count() > 0


@pytest.mark.parametrize(
    "name", ["stg_auth_events", "int_user_sessions", "dq_future_events", "dq_low_conversion"]
)
def test_result_does_not_depend_on_the_session_zone(spark, tables, name):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        expected = tables.sql(registry.oracle_sql()[name]).to_arrow_table()
        assert_same(QUERIES[name](spark, SF_DIR), expected)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_entry(spark):
    assert len(registry.entry(spark).collect()) == 5
