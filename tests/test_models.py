"""One test per rule that is easy to get wrong, on hand-written rows."""

from datetime import datetime

import pytest

from authlytics import schemas
from authlytics.operators import reports
from fixtures import dicts, models, only


def at(text):
    return {"event_ts": f"2024-06-01 {text}"}


def reset(session="s1"):
    return {"event_type": "password_reset_requested", "session_id": session}


# -- staging ------------------------------------------------------------------------


def test_flags_read_the_raw_type(spark):
    m = models(spark, [{"event_type": " LOGIN_SUCCESS "}, {"event_type": "MFA_failure"}])
    success, failure = sorted(dicts(m.stg_auth_events), key=lambda r: r["event_id"])
    assert success["event_type"] == "login_success"
    assert success["is_successful_login"] is False
    assert failure["event_type"] == "mfa_failure"
    assert failure["is_auth_failure"] is False


def test_null_type_gives_null_flags(spark):
    row = only(models(spark, [{"event_type": None}]).stg_auth_events)
    assert row["is_auth_failure"] is None and row["is_login_attempt"] is None
    assert row["is_error_event"] is False


@pytest.mark.parametrize(
    "device, category, normalised",
    [
        (" mobile_ios", "unknown", "mobile_ios"),
        ("MOBILE_x", "mobile", "mobile_x"),
        ("Desktop_Mac", "desktop", "desktop_mac"),
        ("WEB_BROWSER", "web", "web_browser"),
        ("smart_tv", "smart_tv", "smart_tv"),
        ("tv", "unknown", "tv"),
        (None, "unknown", None),
    ],
)
def test_device_category_is_not_trimmed(spark, device, category, normalised):
    row = only(models(spark, [{"device_type": device}]).stg_auth_events)
    assert (row["device_category"], row["device_type"]) == (category, normalised)


def test_rows_without_keys_are_dropped(spark):
    m = models(spark, [{"event_id": None}, {"user_id": None}, {"event_ts": None}, {}])
    assert [r["event_id"] for r in dicts(m.stg_auth_events)] == ["e3"]
    assert dicts(models(spark, [{}], [{"user_id": None}]).stg_users) == []


def test_only_spaces_are_trimmed(spark):
    row = only(models(spark, [{"country": "\tse "}]).stg_auth_events)
    assert row["country_code"] == "\tSE"


@pytest.mark.parametrize(
    "plan, tier",
    [("FREE", "free"), ("Premium_Duo", "premium"), (" free", "unknown"), (None, "unknown")],
)
def test_subscription_tier(spark, plan, tier):
    row = only(models(spark, [{}], [{"subscription_type": plan}]).stg_users)
    assert row["subscription_tier"] == tier


def test_truncated_times_do_not_depend_on_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist in that zone on this day.
        ts = {"event_ts": "2024-03-10 02:30:00.9"}
        end = {"event_ts": "2024-03-10 03:00:00"}
        m = models(spark, [ts, end], [{"created_at": "2024-03-10 02:30:00"}])
        event = min(dicts(m.stg_auth_events), key=lambda r: r["event_ts"])
        session, user = only(m.int_user_sessions), only(m.stg_users)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert event["event_ts"] == datetime(2024, 3, 10, 2, 30, 0, 900000)
    assert event["event_hour"] == datetime(2024, 3, 10, 2)
    assert event["event_date"] == datetime(2024, 3, 10)
    assert user["cohort_month"] == datetime(2024, 3, 1)
    assert session["session_duration_seconds"] == 1800


# -- sessions -----------------------------------------------------------------------


def test_duration_counts_second_boundaries(spark):
    m = models(spark, [at("00:00:00.9"), at("00:00:01.1")])
    assert only(m.int_user_sessions)["session_duration_seconds"] == 1


def test_duration_over_midnight_and_before_the_epoch(spark):
    rows = [{"event_ts": "1969-12-31 23:59:59.5"}, {"event_ts": "1970-01-02 00:00:00.5"}]
    assert only(models(spark, rows).int_user_sessions)["session_duration_seconds"] == 86401


def test_midnight_splits_the_funnel_but_not_the_session(spark):
    rows = [
        at("23:59:50"),
        {"event_type": "login_success", "event_ts": "2024-06-02 00:00:05"},
    ]
    m = models(spark, rows)
    session, step = only(m.int_user_sessions), only(m.int_auth_funnel)
    assert session["session_date"] == datetime(2024, 6, 1)
    assert session["session_outcome"] == "clean_success"
    assert step["event_date"] == datetime(2024, 6, 1)
    assert (step["converted"], step["funnel_drop_stage"]) == (0, "dropped_unknown")


@pytest.mark.parametrize(
    "types, outcome",
    [
        (["login_success"], "clean_success"),
        (["login_failure_bad_password", "login_success"], "success_after_retry"),
        (["login_success", "password_reset_requested"], "clean_success"),
        (["password_reset_requested", "mfa_triggered"], "password_reset"),
        (["mfa_triggered", "mfa_failure"], "mfa_blocked"),
        (["mfa_triggered", "mfa_success"], "failed"),
        (["token_refresh"], "failed"),
        (["Login_Success"], "failed"),
    ],
)
def test_session_outcome(spark, types, outcome):
    m = models(spark, [{"event_type": t} for t in types])
    assert only(m.int_user_sessions)["session_outcome"] == outcome


def test_last_error_is_the_largest_code(spark):
    rows = [
        at("10:00:00") | {"error_code": "PWD_001"},
        at("10:00:05") | {"error_code": "AUTH_001"},
        at("10:00:09"),
    ]
    row = only(models(spark, rows).int_user_sessions)
    assert (row["last_error_code"], row["error_event_count"], row["total_events"]) == (
        "PWD_001",
        2,
        3,
    )


def test_null_keys_form_their_own_session(spark):
    rows = [{"session_id": None}, {"session_id": None}, {"session_id": None, "country": None}]
    m = models(spark, rows)
    counts = sorted(r["total_events"] for r in dicts(m.int_user_sessions))
    assert counts == [1, 2]
    assert only(m.user_session_history)["total_sessions"] == 0
    assert only(m.user_session_history)["failure_rate"] is None


# -- funnel -------------------------------------------------------------------------


@pytest.mark.parametrize(
    "types, stage",
    [
        (["login_success", "mfa_triggered"], "converted"),
        (["mfa_triggered", "login_failure_bad_password"], "dropped_at_mfa"),
        (["mfa_triggered", "mfa_success", "login_failure_bad_password"], "dropped_bad_password"),
        (["login_failure_account_locked"], "dropped_account_locked"),
        (["token_issued"], "dropped_unknown"),
    ],
)
def test_drop_stage(spark, types, stage):
    m = models(spark, [{"event_type": t} for t in ["login_attempt", *types]])
    assert only(m.int_auth_funnel)["funnel_drop_stage"] == stage


def test_days_without_an_attempt_are_not_in_the_funnel(spark):
    assert dicts(models(spark, [{"event_type": "login_success"}]).int_auth_funnel) == []


def test_funnel_counts_distinct_sessions(spark):
    rows = [{"session_id": s} for s in ("a", "a", "b", None)]
    assert only(models(spark, rows).int_auth_funnel)["session_count"] == 2


# -- marts --------------------------------------------------------------------------


def test_split_session_counts_rows_over_ids(spark):
    failing = {"event_type": "login_failure_bad_password"}
    m = models(spark, [failing, failing | {"device_type": "smart_tv"}])
    assert len(dicts(m.int_user_sessions)) == 2
    history = only(m.user_session_history)
    assert (history["total_sessions"], history["failure_rate"]) == (1, 2.0)
    assert history["active_days"] == 1


def test_conversion_can_exceed_one(spark):
    rows = [
        {"event_type": t, "mfa_enabled": mfa}
        for t in ("login_attempt", "login_success")
        for mfa in (True, False)
    ]
    fact = only(models(spark, rows).fct_daily_auth_metrics)
    assert (fact["users_attempted_login"], fact["login_conversion_rate"]) == (1, 2.0)


def test_null_keys_never_match_the_funnel(spark):
    rows = [{"country": None}, {"event_type": "mfa_triggered", "country": None}]
    fact = only(models(spark, rows).fct_daily_auth_metrics)
    assert fact["total_sessions"] == 1
    assert fact["users_attempted_login"] is None and fact["mfa_pass_rate"] is None


def test_no_attempt_leaves_null_rates_and_no_challenge_gives_zero(spark):
    quiet = only(models(spark, [{"event_type": "token_refresh"}]).fct_daily_auth_metrics)
    assert quiet["login_conversion_rate"] is None
    tried = only(models(spark, [{}]).fct_daily_auth_metrics)
    assert (tried["login_conversion_rate"], tried["mfa_pass_rate"]) == (0.0, 0.0)


def test_most_recent_is_the_alphabetical_maximum(spark):
    rows = [
        at("10:00:00") | {"device_type": "web_browser", "country": "us"},
        at("11:00:00") | {"device_type": "mobile_ios", "country": "br"},
    ]
    history = only(models(spark, rows).user_session_history)
    assert (history["most_recent_device"], history["most_recent_country"]) == ("web", "US")


def test_score_is_capped_and_segment_follows_failures(spark):
    score = only(models(spark, [reset(f"s{i}") for i in range(12)]).user_friction_scores)
    assert (score["friction_score"], score["friction_segment"]) == (100.0, "low_friction")


@pytest.mark.parametrize(
    "verified, mfa, score",
    [(True, False, 5.0), (False, False, 10.0), (True, True, 10.0), (None, None, 5.0)],
)
def test_penalties_ignore_null_flags(spark, verified, mfa, score):
    user = {"email_verified": verified, "mfa_enabled": mfa}
    m = models(spark, [{"event_type": "mfa_triggered"}], [user])
    assert only(m.user_friction_scores)["friction_score"] == score


@pytest.mark.parametrize(
    "failures, sessions, segment",
    [(1, 2, "high_friction"), (1, 5, "medium_friction"), (1, 6, "low_friction")],
)
def test_segment_bounds(spark, failures, sessions, segment):
    types = ["mfa_failure"] * failures + ["logout"] * (sessions - failures)
    rows = [{"event_type": t, "session_id": f"s{i}"} for i, t in enumerate(types)]
    assert only(models(spark, rows).user_friction_scores)["friction_segment"] == segment


def test_rates_are_32_bit(spark):
    """3/800 lies above 0.00375 as a decimal fraction but below it as a 32-bit float."""
    types = ["mfa_failure"] * 3 + ["logout"] * 797
    rows = [{"event_type": t, "session_id": f"s{i}"} for i, t in enumerate(types)]
    assert only(models(spark, rows).user_session_history)["failure_rate"] == pytest.approx(0.0037)


def test_unknown_users_stay_in_the_facts_only(spark):
    m = models(spark, [{"user_id": "stranger"}])
    assert len(dicts(m.fct_daily_auth_metrics)) == 1
    assert dicts(m.user_friction_scores) == []


def test_score_takes_the_profile_from_the_user(spark):
    user = {"subscription_type": "premium_duo", "mfa_enabled": True}
    score = only(models(spark, [{"mfa_enabled": False}], [user]).user_friction_scores)
    assert (score["subscription_tier"], score["mfa_enabled"]) == ("premium", True)


def test_repeated_user_rows_repeat_the_score(spark):
    m = models(spark, [{}], [{}, {"email_verified": False}])
    assert len(dicts(m.user_friction_scores)) == 2


# -- reports ------------------------------------------------------------------------


def test_empty_input(spark):
    m = models(spark, [], [])
    health = only(reports.overall_health(m.fct_daily_auth_metrics))
    assert health["days_covered"] == 0 and health["avg_conversion_pct"] is None
    assert dicts(reports.friction_segments(m.user_friction_scores)) == []


def test_reports_skip_null_groups_and_limit(spark):
    rows = [{"country": f"c{i}", "event_type": "mfa_failure"} for i in range(6)]
    rows += [{"country": None}]
    rows += [{"event_ts": f"2024-06-{d:02d} 10:00:00", "session_id": f"d{d}"} for d in range(2, 11)]
    fct = models(spark, rows).fct_daily_auth_metrics
    top = dicts(reports.top_failure_countries(fct))
    assert [r["country_code"] for r in top] == ["C0", "C1", "C2", "C3", "C4"]
    trend = [r["metric_date"].day for r in dicts(reports.daily_trend(fct))]
    assert trend == [1, 2, 3, 4, 5, 6, 7]


# -- contracts ----------------------------------------------------------------------


@pytest.mark.parametrize(
    "name",
    [
        "raw_users",
        "raw_auth_events",
        "stg_auth_events",
        "stg_users",
        "int_user_sessions",
        "int_auth_funnel",
        "daily_sessions",
        "daily_funnel",
        "fct_daily_auth_metrics",
        "user_session_history",
        "user_friction_scores",
    ],
)
def test_contract(spark, name):
    contract = getattr(schemas, name.upper())
    found = getattr(models(spark, [{}]), name).schema
    assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in contract]
