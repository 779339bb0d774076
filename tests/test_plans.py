"""Physical plans: what reaches the scan, how often it runs, and which operators are used."""

import pytest

import __spark_entry__ as registry
from authlytics.plans.models import Models
from authlytics.plans.rollup import auth_rollup
from authlytics.operators import reports
from authlytics.sources import raw
from fixtures import events, users

SF_DIR = "/root/testdata/sf0.001"


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    users(spark, {}).write.parquet(f"{folder}/users")
    events(spark, {}).write.parquet(f"{folder}/events")
    return Models(
        lambda: raw.read_raw_users(spark, f"{folder}/users"),
        lambda: raw.read_raw_auth_events(spark, f"{folder}/events"),
    )


@pytest.mark.parametrize("name", registry.own_queries())
def test_no_python_and_no_cross_join(spark, name):
    text = plan(registry.queries()[name](spark, SF_DIR))
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop", "Window"):
        assert operator not in text


def test_null_filters_reach_the_scan(stored):
    text = plan(stored.stg_auth_events)
    assert "PushedFilters: [IsNotNull(event_id), IsNotNull(user_id), IsNotNull(event_ts)]" in text


def test_sessions_sort_only_events_with_a_code(stored):
    text = plan(stored.int_user_sessions)
    assert "SortAggregate" not in plan(stored.fct_daily_auth_metrics)
    assert text.count("Exchange hashpartitioning") == 2
    lines = text.splitlines()
    last = max(i for i, line in enumerate(lines) if "SortAggregate" in line)
    scan = next(line for line in lines[last:] if "FileScan" in line)
    assert "IsNotNull(error_code)" in scan
    assert "HashAggregate" in text


def test_scores_join_plain_shuffles(spark, stored):
    """Both sides, so that adaptive execution can split a user id that the user table repeats."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        lines = plan(stored.user_friction_scores).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = next(line for line in lines if "SortMergeJoin" in line)
    depth = join.index("SortMergeJoin")
    sides = [i for i, line in enumerate(lines) if line[depth:].startswith((":- Sort", "+- Sort"))]
    below = [lines[i + 1] for i in sides]
    assert len(below) == 2 and all("Exchange hashpartitioning" in line for line in below)


def test_fact_join_adds_no_shuffle(stored):
    # Sessions: one for their keys and two for the distinct counts.  Funnel: the same.
    assert plan(stored.fct_daily_auth_metrics).count("Exchange hashpartitioning") == 6


def test_rollup_reads_the_events_once_and_shuffles_once(stored):
    text = plan(auth_rollup(stored.stg_auth_events))
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1
    assert "SortAggregate" not in text and "Expand" not in text


def test_failing_countries_do_not_read_the_funnel(stored):
    text = plan(reports.top_failure_countries(stored.fct_daily_auth_metrics))
    assert text.count("FileScan") == 1
    assert "TakeOrderedAndProject" in text


def test_trend_is_a_top_k(stored):
    assert "TakeOrderedAndProject" in plan(reports.daily_trend(stored.fct_daily_auth_metrics))


def test_reports_read_only_their_columns(stored):
    text = plan(reports.friction_segments(stored.user_friction_scores))
    assert "age_group" not in text and "device_type" not in text.split("FileScan")[0]
