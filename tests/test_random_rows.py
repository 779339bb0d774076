"""Models, reports and the rollup against their SQL on random dirty rows.

A third of the events belong to one user and another third to one session id; every column
holds nulls, blanks and mixed case.
"""

import random
from datetime import datetime, timedelta

import duckdb
import pytest

from authlytics import oracle
from authlytics.operators import marts
from authlytics.plans import pipeline
from authlytics.plans.checks import EVENT_TYPES
from authlytics.plans.models import Models
from authlytics.plans.rollup import auth_rollup, rollup_funnel, rollup_sessions
from authlytics.schemas import RAW_AUTH_EVENTS, RAW_USERS
from comparison import assert_same

MODELS = [
    "stg_auth_events",
    "stg_users",
    "int_user_sessions",
    "int_auth_funnel",
    "daily_sessions",
    "daily_funnel",
    "fct_daily_auth_metrics",
    "user_session_history",
    "user_friction_scores",
]
PLANS = ["free", "FREE", " free", "premium_duo", "Premium_family", "trial", None]
COUNTRIES = ["se", " SE", "us", "br ", "de", None]
DEVICES = ["mobile_ios", "Mobile_X", " mobile_ios", "desktop_mac", "WEB_browser", "smart_tv", None]
CODES = ["AUTH_001", "MFA_002", "PWD_001", "zz", None, None, None]


def dirty(rng, text):
    return rng.choice([text, text, text, text.upper(), f" {text}", None])


def random_rows(seed, n_events=3000, n_users=40):
    rng = random.Random(seed)

    def event(i):
        user = f"u{rng.randrange(n_users)}"
        session = f"s{rng.randrange(n_users * 12)}"
        if i % 3 == 0:
            user = "hot"
        elif i % 3 == 1:
            session = "hot"
        ts = datetime(2024, 6, 1) + timedelta(microseconds=rng.randrange(5 * 86400 * 10**6))
        # One user has no session id at all, and so null rates.
        sessions = [None] if user == "u0" else [session] * 9 + [None]
        return (
            rng.choice([f"e{i}", f"e{i}", f"e{i}", "same", None]),
            rng.choice(sessions),
            rng.choice([user] * 9 + [None]),
            dirty(rng, rng.choice(EVENT_TYPES + ("login_success", "login_attempt", "odd"))),
            rng.choice(DEVICES),
            rng.choice(COUNTRIES),
            rng.choice(PLANS),
            rng.choice([True, False, None]),
            rng.choice(CODES),
            rng.choice([ts] * 9 + [None]),
        )

    def user(i):
        return (
            rng.choice([f"u{i}"] * 9 + [None, "hot", "u1"]) if i > 1 else ["u0", "hot"][i],
            datetime(2023, rng.randrange(1, 13), rng.randrange(1, 28), 5),
            rng.choice(COUNTRIES),
            rng.choice(PLANS),
            "25-34",
            rng.choice([True, False, None]),
            rng.choice([True, False, None]),
        )

    return [user(i) for i in range(n_users)], [event(i) for i in range(n_events)]


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark, tmp_path_factory):
    """The models, and a DuckDB connection that holds the same raw rows."""
    folder = tmp_path_factory.mktemp("random")
    connection = duckdb.connect()
    loaded = {}
    for name, schema, rows in zip(
        ("raw_users", "raw_auth_events"), (RAW_USERS, RAW_AUTH_EVENTS), random_rows(request.param)
    ):
        path = f"{folder}/{name}"
        spark.createDataFrame(rows, schema).repartition(8).write.parquet(path)
        loaded[name] = spark.read.schema(schema).parquet(path)
        connection.execute(f"CREATE TABLE {name} AS FROM read_parquet('{path}/*.parquet')")
    yield Models(lambda: loaded["raw_users"], lambda: loaded["raw_auth_events"]), connection


def expected(connection, name):
    return connection.sql(oracle.statement(name, ("raw_users", "raw_auth_events"))).to_arrow_table()


@pytest.mark.parametrize("name", MODELS)
def test_model(case, name):
    models, connection = case
    rows = expected(connection, name)
    assert rows.num_rows > 0
    assert_same(getattr(models, name), rows)


def test_a_user_has_null_rates(case):
    scores = case[0].user_friction_scores
    assert scores.filter("failure_rate IS NULL AND friction_segment = 'low_friction'").count() > 0


@pytest.mark.parametrize("name", pipeline.REPORTS)
def test_report(case, name):
    models, connection = case
    mart, report = pipeline.REPORTS[name]
    assert_same(report(getattr(models, mart)), expected(connection, name), ordered=True)


def test_marts_from_the_rollup(case):
    models, connection = case
    rollup = auth_rollup(models.stg_auth_events)
    sessions, funnel = rollup_sessions(rollup), rollup_funnel(rollup)
    assert_same(
        marts.fct_daily_auth_metrics(marts.daily_sessions(sessions), marts.daily_funnel(funnel)),
        expected(connection, "fct_daily_auth_metrics"),
    )
    assert_same(
        marts.user_friction_scores(marts.user_session_history(sessions), models.stg_users),
        expected(connection, "user_friction_scores"),
    )
