"""Column contracts: the two raw tables and every relation derived from them."""

from pyspark.sql.types import (
    BooleanType,
    FloatType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "s": StringType(),
    "ts": TimestampNTZType(),
    "b": BooleanType(),
    "i": IntegerType(),
    "l": LongType(),
    "f": FloatType(),
    "d": DoubleType(),
}


def _struct(columns: str) -> StructType:
    fields = (column.split(":") for column in columns.split())
    return StructType([StructField(name, _TYPES[kind]) for name, kind in fields])


RAW_USERS = _struct(
    "user_id:s created_at:ts country:s subscription_type:s age_group:s "
    "email_verified:b mfa_enabled:b"
)

RAW_AUTH_EVENTS = _struct(
    "event_id:s session_id:s user_id:s event_type:s device_type:s country:s "
    "subscription_type:s mfa_enabled:b error_code:s event_ts:ts"
)

STG_AUTH_EVENTS = _struct(
    "event_id:s session_id:s user_id:s event_type:s device_type:s device_category:s "
    "country_code:s subscription_type:s mfa_enabled:b error_code:s event_ts:ts "
    "event_date:ts event_hour:ts is_error_event:b is_auth_failure:b "
    "is_successful_login:b is_login_attempt:b"
)

STG_USERS = _struct(
    "user_id:s created_at:ts country_code:s subscription_type:s age_group:s "
    "email_verified:b mfa_enabled:b subscription_tier:s cohort_month:ts"
)

INT_USER_SESSIONS = _struct(
    "session_id:s user_id:s country_code:s device_type:s device_category:s "
    "subscription_type:s mfa_enabled:b session_start_ts:ts session_end_ts:ts "
    "session_date:ts had_successful_login:i had_auth_failure:i mfa_was_triggered:i "
    "mfa_succeeded:i had_password_reset:i last_error_code:s total_events:l "
    "error_event_count:l session_duration_seconds:l session_outcome:s"
)

INT_AUTH_FUNNEL = _struct(
    "user_id:s event_date:ts country_code:s subscription_type:s device_category:s "
    "mfa_enabled:b step1_login_attempted:i step2_mfa_triggered:i step3_mfa_passed:i "
    "step4_login_success:i step5_token_issued:i failed_bad_password:i "
    "failed_account_locked:i failed_mfa:i timed_out_mfa:i session_count:l converted:i "
    "funnel_drop_stage:s"
)

DAILY_SESSIONS = _struct(
    "metric_date:ts country_code:s device_category:s subscription_type:s "
    "total_sessions:l unique_users:l successful_logins:l sessions_with_failure:l "
    "clean_successes:l successes_after_retry:l failed_sessions:l "
    "mfa_blocked_sessions:l password_reset_sessions:l avg_session_duration_secs:d "
    "avg_errors_per_session:d"
)

DAILY_FUNNEL = _struct(
    "metric_date:ts country_code:s device_category:s subscription_type:s "
    "users_attempted_login:l mfa_triggered_count:l mfa_passed_count:l "
    "login_success_count:l failed_bad_password_count:l failed_account_locked_count:l "
    "failed_mfa_count:l login_conversion_rate:f mfa_pass_rate:f"
)

FCT_DAILY_AUTH_METRICS = _struct(
    "metric_date:ts country_code:s device_category:s subscription_type:s "
    "total_sessions:l unique_users:l users_attempted_login:l successful_logins:l "
    "clean_successes:l successes_after_retry:l login_conversion_rate:f "
    "sessions_with_failure:l failed_sessions:l failed_bad_password_count:l "
    "failed_account_locked_count:l mfa_triggered_count:l mfa_passed_count:l "
    "failed_mfa_count:l mfa_pass_rate:f password_reset_sessions:l "
    "mfa_blocked_sessions:l avg_session_duration_secs:d avg_errors_per_session:d"
)

USER_SESSION_HISTORY = _struct(
    "user_id:s total_sessions:l active_days:l first_session_date:ts "
    "last_session_date:ts total_failed_sessions:l mfa_blocked_count:l "
    "password_reset_count:l successful_sessions:l failure_rate:f success_rate:f "
    "most_recent_device:s most_recent_country:s"
)

USER_FRICTION_SCORES = _struct(
    "user_id:s total_sessions:l active_days:l first_session_date:ts "
    "last_session_date:ts total_failed_sessions:l mfa_blocked_count:l "
    "password_reset_count:l successful_sessions:l failure_rate:f success_rate:f "
    "most_recent_device:s most_recent_country:s subscription_tier:s mfa_enabled:b "
    "email_verified:b cohort_month:ts friction_score:f friction_segment:s"
)

DQ_SUMMARY = _struct("check_name:s failures:l should_warn:b should_error:b")
