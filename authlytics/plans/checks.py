"""The declared data checks: 24 over sources, staging and marts."""

from authlytics.operators.quality import Check

# The event taxonomy.
EVENT_TYPES = (
    "login_attempt",
    "login_success",
    "login_failure_bad_password",
    "login_failure_account_locked",
    "mfa_triggered",
    "mfa_success",
    "mfa_failure",
    "mfa_timeout",
    "token_issued",
    "token_refresh",
    "session_active",
    "session_expired",
    "logout",
    "password_reset_requested",
    "password_reset_email_sent",
    "password_reset_completed",
    "password_reset_failed",
    "password_reset_expired",
)

# The classes the models may produce.
DEVICE_CATEGORIES = ("mobile", "desktop", "web", "smart_tv", "unknown")
SUBSCRIPTION_TIERS = ("free", "premium", "unknown")
FRICTION_SEGMENTS = ("high_friction", "medium_friction", "low_friction")

DECLARED_CHECKS = [
    Check("raw_auth_events", "event_id", "not_null"),
    Check("raw_auth_events", "event_id", "unique"),
    Check("raw_auth_events", "user_id", "not_null"),
    Check("raw_auth_events", "event_type", "not_null"),
    Check("raw_auth_events", "event_ts", "not_null"),
    Check("raw_users", "user_id", "not_null"),
    Check("raw_users", "user_id", "unique"),
    Check("stg_auth_events", "event_id", "not_null"),
    Check("stg_auth_events", "event_id", "unique"),
    Check("stg_auth_events", "user_id", "not_null"),
    Check("stg_auth_events", "event_type", "not_null"),
    Check("stg_auth_events", "event_type", "accepted_values", EVENT_TYPES),
    Check("stg_auth_events", "device_category", "accepted_values", DEVICE_CATEGORIES),
    Check("stg_auth_events", "event_ts", "not_null"),
    Check("stg_users", "user_id", "not_null"),
    Check("stg_users", "user_id", "unique"),
    Check("stg_users", "subscription_tier", "accepted_values", SUBSCRIPTION_TIERS),
    Check("fct_daily_auth_metrics", "metric_date", "not_null"),
    Check("user_friction_scores", "user_id", "not_null"),
    Check("user_friction_scores", "user_id", "unique"),
    Check("user_friction_scores", "friction_score", "not_null"),
    Check("user_friction_scores", "friction_segment", "accepted_values", FRICTION_SEGMENTS),
    Check("fct_daily_auth_metrics", "login_conversion_rate", "low_conversion"),
    Check("stg_auth_events", "event_ts", "future_events"),
]
