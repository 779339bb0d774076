"""Sessions: events grouped by session id and the attributes they carry."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlytics.functions import columns as c
from authlytics.schemas import INT_USER_SESSIONS

SESSION_KEYS = (
    "session_id",
    "user_id",
    "country_code",
    "device_type",
    "device_category",
    "subscription_type",
    "mfa_enabled",
)


def session_measures() -> list[Column]:
    """Aggregates of fixed width: Spark keeps them in a hash aggregate."""
    event_type = F.col("event_type")
    return [
        F.min("event_ts").alias("session_start_ts"),
        F.max("event_ts").alias("session_end_ts"),
        F.min("event_date").alias("session_date"),
        F.max(c.flag(F.col("is_successful_login"))).alias("had_successful_login"),
        F.max(c.flag(F.col("is_auth_failure"))).alias("had_auth_failure"),
        F.max(c.flag(event_type == "mfa_triggered")).alias("mfa_was_triggered"),
        F.max(c.flag(event_type == "mfa_success")).alias("mfa_succeeded"),
        F.max(c.flag(event_type == "password_reset_requested")).alias("had_password_reset"),
        F.count("*").alias("total_events"),
        c.count_where(F.col("is_error_event")).alias("error_event_count"),
    ]


def with_outcome(sessions: DataFrame) -> DataFrame:
    """Add the duration and the outcome to grouped sessions."""
    duration = c.seconds_between(F.col("session_start_ts"), F.col("session_end_ts"))
    return sessions.withColumns(
        {"session_duration_seconds": duration, "session_outcome": c.session_outcome()}
    )


def _grouped(events: DataFrame, *measures: Column) -> DataFrame:
    """The events grouped by the session keys as one struct, in which nulls are equal."""
    return events.withColumn("session", F.struct(*SESSION_KEYS)).groupBy("session").agg(*measures)


def sessions_without_codes(events: DataFrame) -> DataFrame:
    """One row per session id and attribute combination, without `last_error_code`."""
    grouped = _grouped(events, *session_measures())
    return with_outcome(grouped.select("session.*", "*").drop("session"))


def int_user_sessions(events: DataFrame) -> DataFrame:
    """One row per session id and attribute combination.

    `last_error_code` is the largest code as text.  A text maximum needs a sort aggregate, so it
    is taken over the few events that carry a code only, while all events go through a hash
    aggregate; both leave their rows partitioned by the keys, so the join adds no shuffle.
    """
    measures = _grouped(events, *session_measures())
    coded = events.filter(F.col("error_code").isNotNull())
    codes = _grouped(coded, F.max("error_code").alias("last_error_code"))
    joined = measures.join(codes, "session", "left").select("session.*", "*")
    return with_outcome(joined).select(*INT_USER_SESSIONS.names)
