"""The full build: staging views, marts from one event scan, checks and reports."""

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession

from authlytics.operators import marts, quality, reports, staging
from authlytics.plans.checks import DECLARED_CHECKS
from authlytics.plans.rollup import auth_rollup, rollup_funnel, rollup_sessions
from authlytics.plans.storage import Build, WorkingTables, load_raw, measured, publish_view
from authlytics.schemas import RAW_AUTH_EVENTS, RAW_USERS

REPORTS = {
    "rpt_overall_health": ("fct_daily_auth_metrics", reports.overall_health),
    "rpt_conversion_by_subscription": (
        "fct_daily_auth_metrics",
        reports.conversion_by_subscription,
    ),
    "rpt_friction_by_device": ("fct_daily_auth_metrics", reports.friction_by_device),
    "rpt_friction_segments": ("user_friction_scores", reports.friction_segments),
    "rpt_top_failure_countries": ("fct_daily_auth_metrics", reports.top_failure_countries),
    "rpt_daily_trend": ("fct_daily_auth_metrics", reports.daily_trend),
}


def _fct(working: WorkingTables, rollup: DataFrame, users: DataFrame) -> DataFrame:
    return marts.fct_daily_auth_metrics(
        marts.daily_sessions(rollup_sessions(rollup)), marts.daily_funnel(rollup_funnel(rollup))
    )


def _scores(working: WorkingTables, rollup: DataFrame, users: DataFrame) -> DataFrame:
    """Histories are written first, so that the join with the users knows their size."""
    history = marts.user_session_history(rollup_sessions(rollup))
    return marts.user_friction_scores(working.write(history, "user_session_history"), users)


RAW = ("raw_users", "raw_auth_events")
STAGING = ("stg_users", "stg_auth_events")
_SCHEMAS = dict(zip(RAW, (RAW_USERS, RAW_AUTH_EVENTS)))
# The staging view over each raw table.
_VIEWS = dict(zip(RAW, zip(STAGING, (staging.USERS, staging.EVENTS))))
MARTS = {"fct_daily_auth_metrics": _fct, "user_friction_scores": _scores}


def build_relations(
    spark: SparkSession,
    raw_users: DataFrame,
    raw_auth_events: DataFrame,
    write_mart: Callable[[DataFrame, str], DataFrame],
    wanted: Iterable[str] = tuple(MARTS),
) -> dict[str, DataFrame]:
    """Write the wanted marts from one scan of the events; sources and staging stay lazy."""
    events, users = staging.stg_auth_events(raw_auth_events), staging.stg_users(raw_users)
    relations = {
        "raw_users": raw_users,
        "raw_auth_events": raw_auth_events,
        "stg_users": users,
        "stg_auth_events": events,
    }
    working = WorkingTables(spark)
    try:
        rollup = working.write(auth_rollup(events), "auth_rollup")
        for name in wanted:
            relations[name] = write_mart(MARTS[name](working, rollup, users), name)
    finally:
        # The marts are written: nothing reads the working tables any more.
        working.drop()
    return relations


def _measured_as(check: quality.Check) -> tuple[str, str, str]:
    """(table, value, usable): what a check is measured on while that table is written."""
    for raw, (view, model) in _VIEWS.items():
        if check.relation == view:
            return raw, model.rules.get(check.column, check.column), model.usable
    return check.relation, check.column, "true"


def measures(table: str) -> dict[str, Column]:
    """The declared checks of a table, and of the staging view over it, that its write can take."""
    found: dict[str, Column] = {}
    for check in DECLARED_CHECKS:
        written, value, usable = _measured_as(check)
        if written == table:
            found |= quality.measure(check, value, usable)
    return found


def load(rows: DataFrame, database: str, table: str) -> None:
    """Replace a raw table by the rows, measuring its checks as they are written."""
    load_raw(rows, _SCHEMAS[table], database, table, measures(table))


def known_failures(
    spark: SparkSession, database: str, as_of: datetime | None = None
) -> dict[str, int]:
    """Failures of declared checks that were measured while the database's tables were written."""
    if as_of is None:
        (now,) = spark.sql("SELECT CAST(localtimestamp() AS STRING)").first()
    else:
        now = str(as_of)
    found = measured(spark, database, (*RAW, "marts"))
    failures: dict[str, int] = {}
    for check in DECLARED_CHECKS:
        name = check.measure_name(_measured_as(check)[1])
        if name in found:
            settled = quality.settled(check, found[name], now)
            if settled is not None:
                failures[check.name] = settled
    return failures


def run_checks(
    relations: dict[str, DataFrame],
    as_of: datetime | None = None,
    failures: dict[str, int] | None = None,
    two_passes: bool = False,
) -> DataFrame:
    """The declared checks over relations by name, one row per check.

    `failures` as known from `known_failures` need no scan; `two_passes` spares the network for
    unique keys at the price of a second scan.
    """
    return quality.check_all(relations, DECLARED_CHECKS, as_of, failures, two_passes)


def run_report(name: str, relations: dict[str, DataFrame]) -> DataFrame:
    mart, report = REPORTS[name]
    return report(relations[mart])


def build_all(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """Build a database from its raw tables: staging views, then both marts together.

    Returns every relation as it is read from the database.
    """
    raw_users, raw_auth_events = (spark.table(f"{database}.{name}") for name in RAW)
    for raw, (name, model) in _VIEWS.items():
        publish_view(spark, database, name, model.view_text(f"{database}.{raw}"))
    build = Build(spark, database, "marts")
    build_relations(
        spark,
        raw_users,
        raw_auth_events,
        lambda rows, name: build.write(rows, name, measures(name)),
    )
    build.show()
    return open_relations(spark, database)


def open_relations(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """What a database holds after a build, in any session: for `run_checks` and `run_report`."""
    return {name: spark.table(f"{database}.{name}") for name in (*RAW, *STAGING, *MARTS)}
