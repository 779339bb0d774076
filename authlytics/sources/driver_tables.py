"""Raw users and events derived from the `events`, `customer` and `nation` tables.

The rules are deterministic and row-wise, and plant nulls, untrimmed text and mixed case.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from authlytics.operators.skew import spread_join
from authlytics.schemas import RAW_AUTH_EVENTS, RAW_USERS
from authlytics.sources.raw import conform

# Columns read from the driver tables.
TABLES = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING",
}

# Per source event type, the auth event type for k below each bound.
EVENT_TYPES = {
    "click": [(90, "login_attempt"), (100, "token_refresh")],
    "view": [(60, "login_success"), (80, "token_issued"), (100, "session_active")],
    "signup": [
        (50, "mfa_triggered"),
        (75, "mfa_success"),
        (90, "mfa_failure"),
        (100, "mfa_timeout"),
    ],
    "error": [
        (60, "login_failure_bad_password"),
        (80, "login_failure_account_locked"),
        (100, "session_expired"),
    ],
    "purchase": [
        (30, "password_reset_requested"),
        (50, "password_reset_email_sent"),
        (65, "password_reset_completed"),
        (75, "password_reset_failed"),
        (85, "password_reset_expired"),
        (95, "token_refresh"),
        (100, "logout"),
    ],
}

# Error code raised by an event type.
ERROR_CODES = {
    "login_failure_bad_password": "AUTH_001",
    "login_failure_account_locked": "AUTH_002",
    "mfa_failure": "MFA_001",
    "mfa_timeout": "MFA_002",
    "session_expired": "SESSION_001",
    "password_reset_failed": "PWD_001",
    "password_reset_expired": "PWD_002",
}

# Raw subscription text per market segment.
SUBSCRIPTIONS = {
    "AUTOMOBILE": "free",
    "BUILDING": "Premium_Individual",
    "FURNITURE": "premium_duo",
    "HOUSEHOLD": "FREE",
    "MACHINERY": "trial",
}

# Raw device text, by remainder.
DEVICES = [
    "Mobile_iOS",
    "mobile_android",
    "desktop_windows",
    "desktop_mac",
    "web_browser",
    "smart_tv",
    " mobile_ios",
]

# Age bands, by remainder.
AGE_GROUPS = ["18-24", "25-34", "35-44", "45-54", "55+"]


def _first_match(pairs: list[tuple[Column, Column | str]]) -> Column:
    start = F.when(*pairs[0])
    return reduce(lambda chain, pair: chain.when(*pair), pairs[1:], start)


def _lookup(key: Column, mapping: dict[str, str]) -> Column:
    return _first_match([(key == name, value) for name, value in mapping.items()])


def _by_remainder(remainder: Column, values: list[str]) -> Column:
    return _first_match([(remainder == i, value) for i, value in enumerate(values)])


def _null_every(divisor: int, value: Column) -> Column:
    return F.when(F.col("event_id") % divisor != 0, value)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _with_profile(customer_rows: DataFrame, nation: DataFrame) -> DataFrame:
    """Add country, subscription and MFA setting to rows that carry customer columns.

    Rows of an unknown customer or nation stay, without what is unknown.
    """
    known = customer_rows.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return known.withColumns(
        {
            "country": F.concat(F.lit(" "), F.lower("n_name")),
            "subscription_type": _lookup(F.col("c_mktsegment"), SUBSCRIPTIONS),
            "mfa_enabled": F.col("c_custkey") % 20 < 7,
        }
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    customers = _table(spark, sf_dir, "customer")
    created_day = F.date_add(F.lit("2023-01-01").cast("date"), (key * 37 % 366).cast("int"))
    users = _with_profile(customers, _table(spark, sf_dir, "nation")).select(
        F.concat(F.lit("usr_"), key).alias("user_id"),
        created_day.alias("created_at"),
        "country",
        "subscription_type",
        _by_remainder(key % 5, AGE_GROUPS).alias("age_group"),
        (key % 25 >= 2).alias("email_verified"),
        "mfa_enabled",
    )
    return conform(users, RAW_USERS)


def raw_auth_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, k = F.col("user_id"), F.col("k")
    events = _table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "ts",
        F.regexp_extract("props", r'"k": (\d+)', 1).cast("int").alias("k"),
        F.col("event_type").alias("source_type"),
        # Noon-to-noon days, so that sessions cross midnight.
        F.unix_date((F.col("ts") + F.expr("INTERVAL 12 HOURS")).cast("date")).alias("bucket"),
    )
    rules = [
        (F.col("source_type") == source, _first_match([(k < bound, t) for bound, t in targets]))
        for source, targets in EVENT_TYPES.items()
    ]
    typed = events.withColumn("auth_type", _first_match(rules))
    auth_type = F.col("auth_type")
    dirty_type = (
        F.when(k % 10 == 7, F.upper(auth_type))
        .when(k % 10 == 3, F.concat(F.lit(" "), auth_type))
        .otherwise(auth_type)
    )
    # Customers are joined before nations, so that their own size decides whether they are sent to
    # all; otherwise a hot user is spread over tasks.
    customers = _table(spark, sf_dir, "customer").withColumn("user_id", F.col("c_custkey"))
    of_customer = spread_join(typed, customers, "user_id", "left")
    session = F.concat(F.lit("sess_"), user, F.lit("_"), F.col("bucket"))
    # Ids that no customer has, and users all of whose session ids are missing.
    unknown = F.when(F.col("event_id") % 83 == 0, "usr_x").otherwise("usr_")
    raw = _with_profile(of_customer, _table(spark, sf_dir, "nation")).select(
        _null_every(97, F.concat(F.lit("evt_"), F.col("event_id"))).alias("event_id"),
        F.when(user % 149 != 148, session).alias("session_id"),
        _null_every(89, F.concat(unknown, user)).alias("user_id"),
        dirty_type.alias("event_type"),
        _by_remainder((user * 7 + F.col("bucket")) % 7, DEVICES).alias("device_type"),
        _null_every(101, F.col("country")).alias("country"),
        "subscription_type",
        "mfa_enabled",
        _lookup(auth_type, ERROR_CODES).alias("error_code"),
        F.col("ts").alias("event_ts"),
    )
    return conform(raw, RAW_AUTH_EVENTS)
