"""Hand-written raw rows: only the columns that matter are given, the rest have defaults."""

from datetime import datetime

from authlytics.plans.models import Models
from authlytics.schemas import RAW_AUTH_EVENTS, RAW_USERS

EVENT = {
    "session_id": "s1",
    "user_id": "u1",
    "event_type": "login_attempt",
    "device_type": "web_browser",
    "country": "se",
    "subscription_type": "free",
    "mfa_enabled": False,
    "error_code": None,
    "event_ts": "2024-06-01 10:00:00",
}

USER = {
    "user_id": "u1",
    "created_at": "2024-02-10 08:30:00",
    "country": "se",
    "subscription_type": "free",
    "age_group": "25-34",
    "email_verified": True,
    "mfa_enabled": False,
}


def _rows(schema, defaults, rows):
    for row in rows:
        full = defaults | row
        yield tuple(
            datetime.fromisoformat(full[f.name])
            if f.name in ("event_ts", "created_at") and full[f.name]
            else full[f.name]
            for f in schema
        )


def events(spark, *rows):
    numbered = [{"event_id": f"e{i}"} | row for i, row in enumerate(rows)]
    return spark.createDataFrame(list(_rows(RAW_AUTH_EVENTS, EVENT, numbered)), RAW_AUTH_EVENTS)


def users(spark, *rows):
    return spark.createDataFrame(list(_rows(RAW_USERS, USER, rows)), RAW_USERS)


def models(spark, event_rows, user_rows=({},)):
    return Models(lambda: users(spark, *user_rows), lambda: events(spark, *event_rows))


def dicts(rows):
    return [row.asDict() for row in rows.collect()]


def only(rows):
    (row,) = dicts(rows)
    return row
