"""Staging: drop unusable raw rows, normalise text, derive flags and truncated times.

A model is its declared columns: those without a rule here are the raw column of the same name.
Rules are SQL text made from the tables of `functions.columns`; a lazy DataFrame and the view in a
database (`plans.pipeline`) come from the same rules.  Rules mean the raw columns: flags and
classes see the raw text, not the normalised column of the same name.  Times are cast without a
zone, so nothing goes through the session time zone.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from authlytics.functions import columns as c
from authlytics.schemas import STG_AUTH_EVENTS, STG_USERS


@dataclass(frozen=True)
class Staging:
    """A staging model: its columns, the rules of those that are derived, and what rows need."""

    columns: StructType
    rules: dict[str, str]
    required: tuple[str, ...]

    def _selected(self) -> list[str]:
        return [f"{self.rules[n]} AS {n}" if n in self.rules else n for n in self.columns.names]

    @property
    def usable(self) -> str:
        return " AND ".join(f"{name} IS NOT NULL" for name in self.required)

    def over(self, raw: DataFrame) -> DataFrame:
        return raw.filter(self.usable).selectExpr(*self._selected())

    def view_text(self, raw: str) -> str:
        return f"SELECT {', '.join(self._selected())} FROM {raw} WHERE {self.usable}"


def _tidy(change: str, *names: str) -> dict[str, str]:
    return {name: f"{change}(trim({name}))" for name in names}


EVENTS = Staging(
    STG_AUTH_EVENTS,
    rules={
        **_tidy("lower", "event_type", "device_type", "subscription_type"),
        "country_code": "upper(trim(country))",
        "device_category": c.class_of("device_type", c.DEVICE_CLASSES),
        "is_error_event": "error_code IS NOT NULL",
        **{flag: c.member_of("event_type", kinds) for flag, kinds in c.EVENT_FLAGS.items()},
        "event_ts": "CAST(event_ts AS TIMESTAMP_NTZ)",
        "event_date": c.start_of("day", "event_ts"),
        "event_hour": c.start_of("hour", "event_ts"),
    },
    required=("event_id", "user_id", "event_ts"),
)

USERS = Staging(
    STG_USERS,
    rules={
        **_tidy("lower", "subscription_type"),
        "country_code": "upper(trim(country))",
        "subscription_tier": c.class_of("subscription_type", c.SUBSCRIPTION_CLASSES),
        "created_at": "CAST(created_at AS TIMESTAMP_NTZ)",
        "cohort_month": c.start_of("month", "created_at"),
    },
    required=("user_id",),
)


def stg_auth_events(raw_auth_events: DataFrame) -> DataFrame:
    """One row per raw event that has an event id, a user id and a timestamp."""
    return EVENTS.over(raw_auth_events)


def stg_users(raw_users: DataFrame) -> DataFrame:
    """One row per raw user that has an id."""
    return USERS.over(raw_users)
