"""Small Column helpers: text, time, ratios and the business rules.

Timestamps are zone-free (`timestamp_ntz`).  The time helpers use only functions that
read such values directly, so results do not depend on the session time zone.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event types that count as a failed authentication.
AUTH_FAILURE_TYPES = (
    "login_failure_bad_password",
    "login_failure_account_locked",
    "mfa_failure",
    "mfa_timeout",
)

# Flags by the raw event types that set them.
EVENT_FLAGS = {
    "is_auth_failure": AUTH_FAILURE_TYPES,
    "is_successful_login": ("login_success",),
    "is_login_attempt": ("login_attempt",),
}

# Classes by the whole raw text, or by its beginning (after a `^`); else OTHER.
DEVICE_CLASSES = {
    "^mobile": "mobile",
    "^desktop": "desktop",
    "web_browser": "web",
    "smart_tv": "smart_tv",
}
SUBSCRIPTION_CLASSES = {"free": "free", "^premium": "premium"}
OTHER = "unknown"


# -- SQL text of rules, for views as well as for DataFrames ---------------------------


def _quoted(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def member_of(column: str, values: tuple[str, ...]) -> str:
    """Whether the text is one of the values; null stays null."""
    return f"{column} IN ({_quoted(values)})"


def class_of(column: str, classes: dict[str, str]) -> str:
    """The class whose rule the lower-cased text meets."""
    text, branches = f"lower({column})", []
    for rule, name in classes.items():
        start = rule.removeprefix("^")
        meets = f"startswith({text}, '{start}')" if rule != start else f"{text} = '{rule}'"
        branches.append(f"WHEN {meets} THEN '{name}'")
    return f"CASE {' '.join(branches)} ELSE '{OTHER}' END"


def start_of(unit: str, column: str) -> str:
    """The start of the hour, day or month that a zone-free time lies in."""
    day = f"CAST({column} AS DATE)"
    if unit == "month":
        day = f"trunc({day}, 'month')"
    start = f"CAST({day} AS TIMESTAMP_NTZ)"
    return f"{start} + make_dt_interval(0, hour({column}))" if unit == "hour" else start


# -- time ---------------------------------------------------------------------------


def day_of(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def _second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole-second boundaries crossed: 0.9 s to 1.1 s is one, although 0.2 s long."""
    days = F.date_diff(end.cast("date"), start.cast("date")).cast("long")
    return days * 86400 + _second_of_day(end) - _second_of_day(start)


# -- numbers ------------------------------------------------------------------------


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(condition, 1).otherwise(0)


def count_where(condition: Column) -> Column:
    return F.sum(flag(condition))


def ratio(part: Column, whole: Column) -> Column:
    """32-bit quotient, null when the whole is 0."""
    quotient = part.cast("float") / F.nullif(whole, F.lit(0)).cast("float")
    return quotient.cast("float")


def rounded(value: Column, places: int) -> Column:
    """Scale, round half away from zero, scale back, all on doubles.

    `F.round` works on the shortest decimal text of the number instead, which gives
    another last digit on values such as 1.005.
    """
    scale = float(10**places)
    return F.round(value.cast("double") * scale) / scale


def rate(part: Column, whole: Column) -> Column:
    """32-bit ratio at 4 places, null when the whole is 0."""
    return rounded(ratio(part, whole), 4).cast("float")


def percent(share: Column) -> Column:
    return rounded(share * 100, 2)


# -- business rules -------------------------------------------------------------------


def session_outcome() -> Column:
    """First rule that holds decides; only sessions without a login reach the last ones."""
    logged_in = F.col("had_successful_login") == 1
    return (
        F.when(logged_in & (F.col("had_auth_failure") == 0), "clean_success")
        .when(logged_in & (F.col("had_auth_failure") == 1), "success_after_retry")
        .when(F.col("had_password_reset") == 1, "password_reset")
        .when((F.col("mfa_was_triggered") == 1) & (F.col("mfa_succeeded") == 0), "mfa_blocked")
        .when(~logged_in, "failed")
        .otherwise("other")
    )


def funnel_drop_stage() -> Column:
    stalled_at_mfa = (F.col("step2_mfa_triggered") == 1) & (F.col("step3_mfa_passed") == 0)
    return (
        F.when(F.col("step4_login_success") == 1, "converted")
        .when(stalled_at_mfa, "dropped_at_mfa")
        .when(F.col("failed_bad_password") == 1, "dropped_bad_password")
        .when(F.col("failed_account_locked") == 1, "dropped_account_locked")
        .when(F.col("step1_login_attempted") == 1, "dropped_unknown")
        .otherwise("no_attempt")
    )


def friction_score() -> Column:
    """Weighted friction signals on a 0-100 scale; rounded first, then capped."""
    blocked_mfa_user = F.col("mfa_enabled") & (F.col("mfa_blocked_count") > 0)
    points = (
        F.col("failure_rate") * 40
        + F.col("mfa_blocked_count") * 5
        + F.col("password_reset_count") * 10
        + flag(blocked_mfa_user) * 5
        + flag(~F.col("email_verified")) * 5
    )
    return F.least(F.lit(100.0), rounded(points, 2)).cast("float")


def friction_segment() -> Column:
    """Cut on the failure rate, not on the score."""
    return (
        F.when(F.col("failure_rate") >= 0.5, "high_friction")
        .when(F.col("failure_rate") >= 0.2, "medium_friction")
        .otherwise("low_friction")
    )
