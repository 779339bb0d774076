"""Marts: the daily fact table and the per-user friction scores."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlytics.functions import columns as c
from authlytics.operators.skew import spread_join
from authlytics.schemas import FCT_DAILY_AUTH_METRICS, USER_FRICTION_SCORES

SLICE_KEYS = ["metric_date", "country_code", "device_category", "subscription_type"]


def _outcomes(outcome: str) -> Column:
    return c.count_where(F.col("session_outcome") == outcome)


def daily_sessions(sessions: DataFrame) -> DataFrame:
    """Session counts and averages per day, country, device and subscription.

    The two exact distinct counts make Spark spread each slice over its session and user
    ids first, so one slice with most of the rows is still counted by many tasks.
    """
    return (
        sessions.withColumnRenamed("session_date", "metric_date")
        .groupBy(*SLICE_KEYS)
        .agg(
            F.count_distinct("session_id").alias("total_sessions"),
            F.count_distinct("user_id").alias("unique_users"),
            F.sum("had_successful_login").alias("successful_logins"),
            F.sum("had_auth_failure").alias("sessions_with_failure"),
            _outcomes("clean_success").alias("clean_successes"),
            _outcomes("success_after_retry").alias("successes_after_retry"),
            _outcomes("failed").alias("failed_sessions"),
            _outcomes("mfa_blocked").alias("mfa_blocked_sessions"),
            _outcomes("password_reset").alias("password_reset_sessions"),
            F.avg("session_duration_seconds").alias("avg_session_duration_secs"),
            F.avg("error_event_count").alias("avg_errors_per_session"),
        )
    )


def daily_funnel(funnel: DataFrame) -> DataFrame:
    """Funnel counts and rates on the grain of `daily_sessions`; no denominator gives 0."""
    attempters = F.count_distinct("user_id")
    triggered, passed = F.sum("step2_mfa_triggered"), F.sum("step3_mfa_passed")
    logged_in = F.sum("step4_login_success")
    zero = F.lit(0).cast("float")
    return (
        funnel.withColumnRenamed("event_date", "metric_date")
        .groupBy(*SLICE_KEYS)
        .agg(
            attempters.alias("users_attempted_login"),
            triggered.alias("mfa_triggered_count"),
            passed.alias("mfa_passed_count"),
            logged_in.alias("login_success_count"),
            F.sum("failed_bad_password").alias("failed_bad_password_count"),
            F.sum("failed_account_locked").alias("failed_account_locked_count"),
            F.sum("failed_mfa").alias("failed_mfa_count"),
            F.coalesce(c.rate(logged_in, attempters), zero).alias("login_conversion_rate"),
            F.coalesce(c.rate(passed, triggered), zero).alias("mfa_pass_rate"),
        )
    )


def fct_daily_auth_metrics(per_slice: DataFrame, funnel_per_slice: DataFrame) -> DataFrame:
    """Every slice with sessions, with its funnel figures where anyone tried to log in.

    Slices without attempters, and slices with a null key, keep null funnel figures.  Both
    sides leave their aggregates partitioned by the slice keys, so the join adds no shuffle.
    """
    facts = per_slice.join(funnel_per_slice, SLICE_KEYS, "left")
    return facts.withColumns(
        {
            "avg_session_duration_secs": c.rounded(F.col("avg_session_duration_secs"), 2),
            "avg_errors_per_session": c.rounded(F.col("avg_errors_per_session"), 4),
        }
    ).select(*FCT_DAILY_AUTH_METRICS.names)


def user_session_history(sessions: DataFrame) -> DataFrame:
    """Session history per user.

    The device and the country are the alphabetically largest ones.  Rates divide rows by
    distinct session ids and can exceed 1 when one id spans several rows.

    Sessions are grouped per (user, session id), per (user, day) and per (user, country,
    device) in one hash aggregate; each kind of row then feeds its own columns.  Text maxima
    need a sort aggregate, which this way sees only the distinct values.
    """
    of_session = F.grouping("session_id") == 0
    per_value = sessions.groupingSets(
        [
            ["user_id", "session_id"],
            ["user_id", "session_date"],
            ["user_id", "country_code", "device_category"],
        ],
        "user_id",
        "session_id",
        "session_date",
        "country_code",
        "device_category",
    ).agg(
        of_session.alias("of_session"),
        F.sum("had_auth_failure").alias("failures"),
        F.sum("had_successful_login").alias("logins"),
        _outcomes("mfa_blocked").alias("mfa_blocked"),
        _outcomes("password_reset").alias("password_reset"),
    )

    def total(column: str) -> Column:
        return F.sum(F.when(F.col("of_session"), F.col(column)))

    distinct_sessions = F.count("session_id")
    failures, logins = total("failures"), total("logins")
    return per_value.groupBy("user_id").agg(
        distinct_sessions.alias("total_sessions"),
        F.count("session_date").alias("active_days"),
        F.min("session_date").alias("first_session_date"),
        F.max("session_date").alias("last_session_date"),
        failures.alias("total_failed_sessions"),
        total("mfa_blocked").alias("mfa_blocked_count"),
        total("password_reset").alias("password_reset_count"),
        logins.alias("successful_sessions"),
        c.rate(failures, distinct_sessions).alias("failure_rate"),
        c.rate(logins, distinct_sessions).alias("success_rate"),
        F.max("device_category").alias("most_recent_device"),
        F.max("country_code").alias("most_recent_country"),
    )


def user_friction_scores(history: DataFrame, users: DataFrame) -> DataFrame:
    """Friction score and segment of every known user with a session.

    Users are the streamed side: should one user id be repeated in the user table, a merge
    join buffers only the single history row of that id, and the id's rows are spread over tasks.
    """
    profile = users.select(
        "user_id", "subscription_tier", "mfa_enabled", "email_verified", "cohort_month"
    )
    scored = spread_join(profile, history, "user_id")
    return scored.withColumns(
        {"friction_score": c.friction_score(), "friction_segment": c.friction_segment()}
    ).select(*USER_FRICTION_SCORES.names)
