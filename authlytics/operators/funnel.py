"""Login funnel: how far each user got on each day."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlytics.functions import columns as c
from authlytics.schemas import INT_AUTH_FUNNEL

FUNNEL_KEYS = (
    "user_id",
    "event_date",
    "country_code",
    "subscription_type",
    "device_category",
    "mfa_enabled",
)


def _seen(event_type: str) -> Column:
    return F.max(c.flag(F.col("event_type") == event_type))


def funnel_measures() -> list[Column]:
    return [
        _seen("login_attempt").alias("step1_login_attempted"),
        _seen("mfa_triggered").alias("step2_mfa_triggered"),
        _seen("mfa_success").alias("step3_mfa_passed"),
        F.max(c.flag(F.col("is_successful_login"))).alias("step4_login_success"),
        _seen("token_issued").alias("step5_token_issued"),
        _seen("login_failure_bad_password").alias("failed_bad_password"),
        _seen("login_failure_account_locked").alias("failed_account_locked"),
        _seen("mfa_failure").alias("failed_mfa"),
        _seen("mfa_timeout").alias("timed_out_mfa"),
    ]


def int_auth_funnel(events: DataFrame) -> DataFrame:
    """One row per user, day and attribute combination with at least one login attempt.

    The attempt filter is on the grouped rows: the other steps of an attempter's day count,
    whichever event carried them.
    """
    per_day = events.groupBy(*FUNNEL_KEYS).agg(
        *funnel_measures(), F.count_distinct("session_id").alias("session_count")
    )
    attempters = per_day.filter(F.col("step1_login_attempted") == 1)
    return attempters.withColumns(
        {
            "converted": c.flag(F.col("step4_login_success") == 1),
            "funnel_drop_stage": c.funnel_drop_stage(),
        }
    ).select(*INT_AUTH_FUNNEL.names)
