"""Sinks, the build through the rollup, and its agreement with the lazy models."""

import json
import os
import threading
import uuid
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from authlytics import schemas
from authlytics.plans import pipeline, storage
from authlytics.plans.models import Models
from authlytics.sources import driver_tables, raw
from fixtures import EVENT, dicts, events, models, users

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def database(spark):
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def same_rows(left, right):
    return left.columns == right.columns and sorted(map(repr, left.collect())) == sorted(
        map(repr, right.collect())
    )


def load(database, users, events):
    storage.load_raw(users, schemas.RAW_USERS, database, "raw_users")
    storage.load_raw(events, schemas.RAW_AUTH_EVENTS, database, "raw_auth_events")


@pytest.fixture
def lazy(spark):
    return Models(
        lambda: driver_tables.raw_users(spark, SF_DIR),
        lambda: driver_tables.raw_auth_events(spark, SF_DIR),
    )


def test_build_all_equals_the_lazy_models(spark, database, lazy):
    load(database, lazy.raw_users, lazy.raw_auth_events)
    built = pipeline.build_all(spark, database)
    for name in (*pipeline.RAW, *pipeline.STAGING, *pipeline.MARTS):
        assert same_rows(built[name], getattr(lazy, name))


def test_another_session_reports_and_checks_what_was_built(spark, database, lazy):
    load(database, lazy.raw_users, lazy.raw_auth_events)
    pipeline.build_all(spark, database)
    other = spark.newSession()
    relations = pipeline.open_relations(other, database)
    assert same_rows(relations["stg_users"], lazy.stg_users)
    for name in pipeline.REPORTS:
        mart, report = pipeline.REPORTS[name]
        found = pipeline.run_report(name, relations).collect()
        assert found == report(getattr(lazy, mart)).collect()
    assert len(pipeline.run_checks(relations).collect()) == 24


def test_build_on_dirty_rows_equals_the_lazy_models(spark, database):
    lazy = models(
        spark,
        [
            {"session_id": None},
            {"session_id": None, "event_ts": "2024-06-02 10:00:00"},
            {"country": None},
            {"device_type": None, "event_type": "mfa_triggered"},
            {"mfa_enabled": None, "event_type": None},
            {"subscription_type": None, "event_type": "login_success"},
            {"user_id": "u2", "event_type": "password_reset_requested"},
            {"user_id": None},
        ],
        [{}, {"user_id": "u2", "email_verified": None}],
    )
    load(database, lazy.raw_users, lazy.raw_auth_events)
    built = pipeline.build_all(spark, database)
    for name in pipeline.MARTS:
        assert same_rows(built[name], getattr(lazy, name))


def build(spark, database, user):
    m = models(spark, [{"user_id": user}], [{"user_id": user}])
    load(database, m.raw_users, m.raw_auth_events)
    return pipeline.build_all(spark, database)


def users_of(spark, database):
    return [r["user_id"] for r in dicts(spark.table(f"{database}.user_friction_scores"))]


def builds(spark, database, table):
    return len(spark.sql(f"SHOW PARTITIONS {database}.{table}__builds").collect())


def test_rebuild_replaces_the_tables_and_keeps_the_build_before(spark, database):
    for user, kept in (("u1", 1), ("u2", 2), ("u3", 2)):
        build(spark, database, user)
        assert users_of(spark, database) == [user]
        for table in (*pipeline.MARTS, *pipeline.RAW):
            assert builds(spark, database, table) == kept


def test_a_mart_is_written_once(spark, database, monkeypatch):
    written = []
    m = models(spark, [{}])
    load(database, m.raw_users, m.raw_auth_events)
    writer = type(m.raw_users.write)
    plain = writer.parquet
    monkeypatch.setattr(
        writer, "parquet", lambda self, path, *a: (written.append(path), plain(self, path, *a))[1]
    )
    pipeline.build_all(spark, database)
    for mart in pipeline.MARTS:
        assert sum(mart in path for path in written) == 1


def test_a_reader_that_started_before_the_switch_ends_on_the_old_build(spark, database):
    storage.publish(spark, database, "marts", marts(spark, "u1"))
    before = spark.table(f"{database}.user_friction_scores").select("user_id")
    before._jdf.queryExecution().executedPlan()
    storage.publish(spark, database, "marts", marts(spark, "u2"))
    assert [r["user_id"] for r in before.collect()] == ["u1"]
    assert users_of(spark, database) == ["u2"]


def started(spark, database, user):
    begun = storage.Build(spark, database, "marts")
    for name, rows in marts(spark, user).items():
        begun.write(rows, name)
    return begun


def whole_pair(spark, database):
    """The one user of the scores, if both marts show the same build."""
    shown = {
        name: {r[0] for r in spark.table(f"{database}.{name}").select(F.input_file_name()).collect()}
        for name in pipeline.MARTS
    }
    names = {path.split("build=")[1].split("/")[0] for paths in shown.values() for path in paths}
    assert len(names) == 1
    return users_of(spark, database)


def test_two_writers_one_after_the_other(spark, database):
    first, second = started(spark, database, "u1"), started(spark, database, "u2")
    second.show()
    assert whole_pair(spark, database) == ["u2"]
    first.show()
    assert whole_pair(spark, database) == ["u1"]


def test_two_writers_that_aim_at_the_same_version(spark, database, monkeypatch):
    first, second = started(spark, database, "u1"), started(spark, database, "u2")
    versions = storage.BuildLog._versions
    stale = []

    def old(self):
        # The second writer's first look is from before the first writer's entry.
        if self is second.log and not stale:
            stale.append(True)
            return []
        return versions(self)

    first.show()
    monkeypatch.setattr(storage.BuildLog, "_versions", old)
    second.show()
    assert whole_pair(spark, database) == ["u2"]
    assert [r.version for r in second.log.records()] == [1, 2]


def test_a_slow_writer_does_not_set_the_name_back(spark, database, monkeypatch):
    first, second = started(spark, database, "u1"), started(spark, database, "u2")
    plain, waiting = type(spark).sql, [True]

    def sql(self, text, *args, **kwargs):
        # The second writer runs between the first one's entry and its view.
        if waiting and "__current AS" in text:
            waiting.clear()
            second.show()
        return plain(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", sql)
    first.show()
    assert whole_pair(spark, database) == ["u2"]


def test_two_writers_at_once(spark, database):
    begun = [started(spark, database, user) for user in ("u1", "u2")]
    threads = [threading.Thread(target=one.show) for one in begun]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    newest = begun[0].log.records()[-1].build
    expected = next(user for one, user in zip(begun, ("u1", "u2")) if one.name == newest)
    assert whole_pair(spark, database) == [expected]


def test_half_written_builds_go_by_age(spark, database, monkeypatch):
    left = started(spark, database, "u1")
    storage.publish(spark, database, "marts", marts(spark, "u2"))
    assert builds(spark, database, "user_friction_scores") == 2
    monkeypatch.setattr(storage, "ABANDONED_HOURS", -1)
    storage.publish(spark, database, "marts", marts(spark, "u3"))
    assert builds(spark, database, "user_friction_scores") == 2
    folder = left._folder("user_friction_scores").removeprefix("file:")
    assert f"build={left.name}" not in os.listdir(folder)


def test_two_databases_do_not_disturb_each_other(spark, database):
    other = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {other}")
    try:
        build(spark, database, "u1")
        build(spark, other, "u2")
        assert users_of(spark, database) == ["u1"] and users_of(spark, other) == ["u2"]
        assert [r["user_id"] for r in dicts(spark.table(f"{database}.stg_users"))] == ["u1"]
    finally:
        spark.sql(f"DROP DATABASE {other} CASCADE")


class Stopped(Exception):
    pass


def marts(spark, user):
    m = models(spark, [{"user_id": user}], [{"user_id": user}])
    return {name: getattr(m, name) for name in pipeline.MARTS}


@pytest.mark.parametrize("step", range(11))
def test_a_build_stopped_anywhere_leaves_a_whole_pair(spark, database, monkeypatch, step):
    """Stop the second build before its step-th statement, write or entry, then build again."""
    storage.publish(spark, database, "marts", marts(spark, "u1"))
    second, left = marts(spark, "u2"), [step]

    def stops(method):
        def call(self, *args, **kwargs):
            if left[0] == 0:
                raise Stopped
            left[0] -= 1
            return method(self, *args, **kwargs)

        return call

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", stops(type(spark).sql))
        writer = type(second["user_friction_scores"].write)
        patch.setattr(writer, "parquet", stops(writer.parquet))
        patch.setattr(storage.BuildLog, "append", stops(storage.BuildLog.append))
        try:
            storage.publish(spark, database, "marts", second)
        except Stopped:
            pass
    # Two tables, each in three steps, then the entry in the log, then the name.
    assert whole_pair(spark, database) == (["u1"] if step < 8 else ["u2"])
    storage.publish(spark, database, "marts", marts(spark, "u3"))
    assert whole_pair(spark, database) == ["u3"]


def test_a_record_that_was_cut_short_counts_as_none(spark, database):
    storage.publish(spark, database, "marts", marts(spark, "u1"))
    log = storage.BuildLog(spark, database, "marts")
    log._files.create(log._file(2), False).close()
    assert [r.version for r in log.records()] == [1]
    storage.publish(spark, database, "marts", marts(spark, "u2"))
    assert [r.version for r in log.records()] == [1, 3]
    assert whole_pair(spark, database) == ["u2"]


# -- checks that are measured while tables are written ------------------------------


DIRTY = [
    {},
    {"event_id": None},
    {"event_id": "same"},
    {"event_id": "same", "event_type": "odd"},
    {"event_type": None},
    {"event_type": "odd", "user_id": None},
    {"event_ts": "2024-06-09 00:00:00", "device_type": None},
]


def loaded(spark, database, event_rows, user_rows=({},)):
    m = models(spark, event_rows, user_rows)
    for name in pipeline.RAW:
        pipeline.load(getattr(m, name), database, name)
    return pipeline.build_all(spark, database)


@pytest.mark.parametrize("day", [5, 20])
@pytest.mark.parametrize("rows", [DIRTY, [{}], []])
def test_measured_checks_are_the_checks(spark, database, rows, day):
    relations = loaded(spark, database, rows, [{}, {"user_id": None}] if rows else [])
    as_of = datetime(2024, 6, day)
    failures = pipeline.known_failures(spark, database, as_of)
    known = dicts(pipeline.run_checks(relations, as_of, failures))
    plain = dicts(pipeline.run_checks(relations, as_of))
    assert sorted(known, key=str) == sorted(plain, key=str)
    # Only rows that fail leave something to count, besides unique keys and averages.
    kinds = {c.name: c.kind for c in pipeline.DECLARED_CHECKS if c.name not in failures}
    asked = {"unique", "low_conversion"}
    asked |= {"accepted_values"} if rows is DIRTY else set()
    asked |= {"future_events"} if rows is DIRTY and day == 5 else set()
    assert set(kinds.values()) == asked


def test_clean_tables_are_checked_without_a_scan_of_their_rows(spark, database):
    relations = loaded(spark, database, [{}, {}])
    failures = pipeline.known_failures(spark, database)
    found = pipeline.run_checks(relations, None, failures)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "events__builds" in line]
    # One for each of the two unique keys, which read the ids and what makes a row usable.
    assert len(scans) == 2 and all("device_type" not in line for line in scans)


def test_a_measure_of_another_rule_is_not_taken(spark, database, monkeypatch):
    loaded(spark, database, [{}])
    check = next(c for c in pipeline.DECLARED_CHECKS if c.kind == "accepted_values")
    stricter = replace(check, values=("nothing",))
    assert check.name in pipeline.known_failures(spark, database)
    monkeypatch.setattr(pipeline, "DECLARED_CHECKS", [stricter])
    assert pipeline.known_failures(spark, database) == {}


def test_measures_belong_to_the_build_that_is_shown(spark, database, monkeypatch):
    loaded(spark, database, [{"user_id": None}])
    name = "raw_auth_events.user_id.not_null"
    assert pipeline.known_failures(spark, database)[name] == 1
    with monkeypatch.context() as patch:
        # A load that stops after its entry in the log.
        patch.setattr(type(spark), "sql", lambda self, text: (_ for _ in ()).throw(Stopped()))
        begun = storage.Build(spark, database, "raw_auth_events")
        begun.measured = {"raw_auth_events": {f"{name} user_id": 7}}
        with pytest.raises(Stopped):
            begun.show()
    assert pipeline.known_failures(spark, database)[name] == 1


def test_failed_load_keeps_the_raw_table(spark, database):
    storage.load_raw(users(spark, {}), schemas.RAW_USERS, database, "raw_users")
    broken = users(spark, {}).drop("created_at").selectExpr("*", "'yesterday' AS created_at")
    with pytest.raises(Exception):
        storage.load_raw(broken, schemas.RAW_USERS, database, "raw_users")
    assert len(dicts(spark.table(f"{database}.raw_users"))) == 1


def test_load_raw_coerces_text_and_replaces(spark, database, tmp_path):
    path = str(tmp_path / "landed.json")
    with open(path, "w") as out:
        out.write(json.dumps(EVENT | {"event_id": "e1", "event_ts": "2024-06-01T10:00:00"}))
    load_events = lambda rows: storage.load_raw(
        rows, schemas.RAW_AUTH_EVENTS, database, "raw_auth_events"
    )
    load_events(events(spark, {}, {}))
    landed = ", ".join(
        f"{f.name} {'boolean' if f.name == 'mfa_enabled' else 'string'}"
        for f in schemas.RAW_AUTH_EVENTS
    )
    load_events(spark.read.schema(landed).json(path))
    (row,) = dicts(spark.table(f"{database}.raw_auth_events"))
    assert str(row["event_ts"]) == "2024-06-01 10:00:00" and row["error_code"] is None


def test_text_that_is_no_timestamp_raises(spark):
    rows = events(spark, {}).drop("event_ts").selectExpr("*", "'yesterday' AS event_ts")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        raw.conform(rows, schemas.RAW_AUTH_EVENTS).collect()


def test_readers_use_the_declared_schema(spark, tmp_path):
    users(spark, {}).write.parquet(str(tmp_path / "users"))
    events(spark, {}).write.parquet(str(tmp_path / "events"))
    assert raw.read_raw_users(spark, str(tmp_path / "users")).schema == schemas.RAW_USERS
    read = raw.read_raw_auth_events(spark, str(tmp_path / "events"))
    assert read.schema == schemas.RAW_AUTH_EVENTS and read.count() == 1


def test_working_tables_are_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "working_folder", lambda _: str(tmp_path))
    kept = storage.WorkingTables(spark)
    m = models(spark, [{}])
    relations = pipeline.build_relations(spark, m.raw_users, m.raw_auth_events, kept.write)
    assert len(dicts(relations["user_friction_scores"])) == 1
    # Only the marts' folder is left: the rollup's went with the build.
    assert [f"{tmp_path}/{name}" for name in os.listdir(tmp_path)] == [kept.folder]
    kept.drop()
    assert os.listdir(tmp_path) == []
