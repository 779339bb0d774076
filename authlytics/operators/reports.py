"""Report queries over the marts.  Averages of slice rates are unweighted."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlytics.functions import columns as c


def _avg_percent(rate: str) -> Column:
    return c.percent(F.avg(rate))


def overall_health(fct: DataFrame) -> DataFrame:
    return fct.agg(
        F.count_distinct("metric_date").alias("days_covered"),
        F.sum("users_attempted_login").alias("total_login_attempts"),
        F.sum("successful_logins").alias("total_successes"),
        _avg_percent("login_conversion_rate").alias("avg_conversion_pct"),
        _avg_percent("mfa_pass_rate").alias("avg_mfa_pass_pct"),
        F.sum("password_reset_sessions").alias("total_password_resets"),
        F.sum("mfa_blocked_sessions").alias("total_mfa_blocks"),
    )


def conversion_by_subscription(fct: DataFrame) -> DataFrame:
    return (
        fct.filter(F.col("subscription_type").isNotNull())
        .groupBy("subscription_type")
        .agg(
            _avg_percent("login_conversion_rate").alias("conversion_pct"),
            F.sum("users_attempted_login").alias("attempts"),
        )
        .orderBy(F.desc_nulls_last("conversion_pct"), "subscription_type")
    )


def friction_by_device(fct: DataFrame) -> DataFrame:
    return (
        fct.filter(F.col("device_category").isNotNull())
        .groupBy("device_category")
        .agg(
            _avg_percent("login_conversion_rate").alias("conversion_pct"),
            c.rounded(F.avg("avg_errors_per_session"), 3).alias("avg_errors_per_session"),
            F.sum("mfa_blocked_sessions").alias("mfa_blocks"),
        )
        .orderBy(F.asc_nulls_last("conversion_pct"), "device_category")
    )


def friction_segments(scores: DataFrame) -> DataFrame:
    return (
        scores.groupBy("friction_segment")
        .agg(
            F.count("*").alias("user_count"),
            c.rounded(F.avg("friction_score"), 1).alias("avg_score"),
            _avg_percent("failure_rate").alias("avg_failure_rate_pct"),
            c.rounded(F.avg("password_reset_count"), 2).alias("avg_resets"),
        )
        .orderBy(F.desc_nulls_last("avg_score"), "friction_segment")
    )


def top_failure_countries(fct: DataFrame) -> DataFrame:
    """The five countries with the highest failure share: a ratio of sums."""
    share = c.ratio(F.sum("sessions_with_failure"), F.sum("total_sessions"))
    share_percent = c.rounded((share * 100).cast("float"), 2).cast("float")
    return (
        fct.filter(F.col("country_code").isNotNull())
        .groupBy("country_code")
        .agg(
            share_percent.alias("failure_rate_pct"),
            F.sum("total_sessions").alias("total_sessions"),
        )
        .orderBy(F.desc_nulls_last("failure_rate_pct"), "country_code")
        .limit(5)
    )


def daily_trend(fct: DataFrame) -> DataFrame:
    """Conversion on the first seven days."""
    return (
        fct.groupBy("metric_date")
        .agg(
            _avg_percent("login_conversion_rate").alias("conversion_pct"),
            F.sum("users_attempted_login").alias("attempts"),
        )
        .orderBy(F.asc_nulls_last("metric_date"))
        .limit(7)
    )
