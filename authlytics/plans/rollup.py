"""Sessions and user days from one pass over the events.

Both marts read sessions, and the fact table also reads the funnel.  Composed lazily that is three
scans of the event table.  Sessions and user days are both unions of session days: events that agree
in the session's keys and the day.  The rollup groups the events by that common refinement, in one
scan and one shuffle in which every event counts once, and is written once; sessions and user
days follow from its far fewer rows by a second small aggregate each.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlytics.operators.funnel import FUNNEL_KEYS, funnel_measures
from authlytics.operators.sessions import SESSION_KEYS, session_measures, with_outcome

# Not read by the marts.
_UNUSED = ("total_events", "step5_token_issued", "timed_out_mfa")
_KEYS = tuple(dict.fromkeys(SESSION_KEYS + FUNNEL_KEYS))

# How the session measures of days combine; every other measure is a maximum of flags.
_OF_SESSIONS = {
    "session_start_ts": F.min,
    "session_end_ts": F.max,
    "session_date": F.min,
    "had_successful_login": F.max,
    "had_auth_failure": F.max,
    "mfa_was_triggered": F.max,
    "mfa_succeeded": F.max,
    "had_password_reset": F.max,
    "error_event_count": F.sum,
}
_OF_USER_DAYS = (
    "step1_login_attempted",
    "step2_mfa_triggered",
    "step3_mfa_passed",
    "step4_login_success",
    "failed_bad_password",
    "failed_account_locked",
    "failed_mfa",
)


def auth_rollup(events: DataFrame) -> DataFrame:
    """A row per session and day, with the measures of both."""
    return events.groupBy(*_KEYS).agg(*session_measures(), *funnel_measures()).drop(*_UNUSED)


def _combined(rollup: DataFrame, keys: Iterable[str], measures: list[Column]) -> DataFrame:
    return rollup.groupBy(*keys).agg(*measures)


def rollup_sessions(rollup: DataFrame) -> DataFrame:
    measures = [combine(name).alias(name) for name, combine in _OF_SESSIONS.items()]
    return with_outcome(_combined(rollup, SESSION_KEYS, measures))


def rollup_funnel(rollup: DataFrame) -> DataFrame:
    """User days with a login attempt."""
    measures = [F.max(name).alias(name) for name in _OF_USER_DAYS]
    return _combined(rollup, FUNNEL_KEYS, measures).filter(F.col("step1_login_attempted") == 1)
