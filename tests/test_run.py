from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from firstpour import run, storage
from firstpour.operators import ledger, load_log, state
from firstpour.operators.land import land_incremental
from firstpour.plans.run import compact, plan
from firstpour.sources import active_sources, read_bronze
from tests.conftest import DAY_1, DAY_2, DAY_3, rows

SCHEMA = (
    "SRC_TYPE string, SRC_NAME string, SRC_ORIGIN_NAME string, SRC_OBJECT_NAME string, "
    "SRC_OBJECT_CONSTRAINT string, SRC_FLAG_ACTIV int, SRC_FLAG_INCR int, SRC_DATE_CRITERIA string, "
    "SRC_DATE_LASTUPDATE string, FORCE_ENCODE string"
)


@pytest.fixture
def manifest(spark):
    return spark.createDataFrame(
        [
            ("DB", "LAKE", "MAIN", "one", None, 1, 0, None, None, None),
            ("DB", "LAKE", "MAIN", "two", None, 1, 1, "n", None, None),
            ("DB", "LAKE", "MAIN", "off", None, 0, 1, "n", None, None),
            ("DB", "LAKE", "MAIN", "gone", None, 1, 1, "n", None, None),
            ("DB", "LAKE", "MAIN", "three", "WHERE n > 1", None, 1, "n", None, None),
        ],
        SCHEMA,
    )


@pytest.fixture
def filled(put):
    for name in ("one", "two", "off", "three"):
        put(name, [(1, 1), (2, 2)], "id int, n int")


def test_only_flagged_sources_are_active(manifest):
    assert [r["SRC_OBJECT_NAME"] for r in active_sources(manifest).collect()] == ["one", "two", "gone"]


def test_run_loads_active_sources_and_survives_a_failure(spark, config, manifest, filled):
    results = run(spark, config, manifest, DAY_1)
    assert [(r.source.object, r.rows, r.error is None) for r in results] == [
        ("one", 2, True),
        ("two", 2, True),
        ("gone", 0, False),
    ]
    logged = load_log.read_log(spark, config.log_path).select("SRC_OBJECT_NAME", "ACTION", "COUNT_ROW")
    assert rows(logged) == [("gone", "ERROR", 0), ("one", "SUCCESS", 2), ("two", "SUCCESS", 2)]


def test_second_run_starts_from_the_stored_watermarks(spark, config, manifest, filled, put):
    run(spark, config, manifest, DAY_1)
    compact(spark, config)
    put("two", [(1, 1), (2, 2), (3, 3)], "id int, n int")
    starts = {source.object: start.value for source, start, _ in plan(spark, config, manifest)}
    assert starts == {"one": None, "two": "2", "gone": None}
    results = run(spark, config, manifest, DAY_2)
    assert {r.source.object: r.rows for r in results} == {"one": 2, "two": 1, "gone": 0}
    assert read_bronze(spark, results[1].table).count() == 3


def test_no_active_source_is_no_work(spark, config, manifest):
    assert run(spark, config, manifest.where("false"), DAY_1) == []


@pytest.mark.parametrize("reconcile", [False, True])
def test_sources_sharing_a_table_take_turns(spark, config, put, reconcile):
    """Neither may undo what the other has loaded."""
    config = replace(config, reconcile=reconcile)
    # A space and an underscore give the same bronze table; so does the same row twice.
    put("a b", [(1, 1)], "id int, n int")
    put("a_b", [(2, 2)], "id int, n int")
    row = ("DB", "LAKE", "MAIN", "a b", None, 1, 1, "n", None, None)
    manifest = spark.createDataFrame([row, (*row[:3], "a_b", *row[4:])], SCHEMA)
    results = run(spark, config, manifest, DAY_1)
    assert [r.error for r in results] == [None, None]
    assert rows(read_bronze(spark, results[0].table).select("id")) == [(1,), (2,)]
    put("a b", [(1, 1), (3, 3)], "id int, n int")
    put("a_b", [(2, 2), (4, 4)], "id int, n int")
    results = run(spark, config, manifest, DAY_2)
    assert [r.error for r in results] == [None, None]
    assert rows(read_bronze(spark, results[0].table).select("id")) == [(1,), (2,), (3,), (4,)]


def test_timestamp_watermark_cells(spark, config, root):
    spark.sql(
        "SELECT 1 AS id, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS n UNION ALL SELECT 2, TIMESTAMP_NTZ '2024-01-01 00:00:01'"
    ).write.parquet(f"{root}/source/one")
    cell = datetime(2024, 1, 1, tzinfo=timezone.utc)
    schema = SCHEMA.replace("SRC_DATE_LASTUPDATE string", "SRC_DATE_LASTUPDATE timestamp")
    manifest = spark.createDataFrame([("DB", "LAKE", "MAIN", "one", None, 1, 1, "n", cell, None)], schema)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        results = run(spark, config, manifest, DAY_1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (results[0].error, results[0].rows) == (None, 1)


def test_odd_control_row_is_logged_and_others_load(spark, config, put):
    put("one", [(1, 1)], "id int, n int")
    schema = SCHEMA.replace("SRC_FLAG_INCR int", "SRC_FLAG_INCR string")
    row = ("DB", "LAKE", "MAIN", "one", None, 1, "1", "n", None, None)
    manifest = spark.createDataFrame([(*row[:3], "odd", *row[4:6], "Y", *row[7:]), row], schema)
    results = {r.source.object: r.error for r in run(spark, config, manifest, DAY_1)}
    assert results["one"] is None and "control row" in results["odd"]
    logged = load_log.read_log(spark, config.log_path)
    assert rows(logged.select("SRC_OBJECT_NAME", "ACTION")) == [("odd", "ERROR"), ("one", "SUCCESS")]


def test_row_listed_twice_loads_once(spark, config, put):
    put("one", [(1, 1)], "id int, n int")
    row = ("DB", "LAKE", "MAIN", "one", None, 1, 1, "n", None, None)
    results = run(spark, config, spark.createDataFrame([row, row], SCHEMA), DAY_1)
    assert read_bronze(spark, results[0].table).count() == 1
    assert [r.error is None for r in results] == [True, False]


def test_records_are_folded_at_the_end_of_a_run(spark, config, put):
    put("one", [(1, 1)], "id int, n int")
    for n in range(20):
        state.advance(spark, config.state_path, ("a", "b", str(n % 3)), str(n), "int", DAY_1.replace(minute=n))
    storage.make_dirs(spark, f"{config.state_path}/batch-unfinished")
    row = ("DB", "LAKE", "MAIN", "one", None, 1, 1, "n", None, None)
    run(spark, replace(config, compact_after=5), spark.createDataFrame([row], SCHEMA), DAY_2)
    assert len(storage.children(spark, config.state_path)) == 2
    latest = state.latest_state(state.read_state(spark, config.state_path))
    assert rows(latest.where("src_name = 'a'").select("value")) == [("17",), ("18",), ("19",)]


@pytest.mark.parametrize("reconcile", [False, True])
def test_folding_does_not_undo_finished_loads(spark, config, put, reconcile):
    """Of two sources sharing a table the second one's first load fails; its time is that of the other's."""
    config = replace(config, reconcile=reconcile)
    row = ("DB", "LAKE", "MAIN", "a b", None, 1, 1, "n", None, None)
    manifest = spark.createDataFrame([row, (*row[:3], "a_b", *row[4:])], SCHEMA)
    put("a b", [(1, 1)], "id int, n int")
    put("a_b", [(5, 5)], "id int, n int")
    broken = manifest.withColumn("SRC_DATE_CRITERIA", F.expr("if(SRC_OBJECT_NAME = 'a_b', 'raise_error(id)', 'n')"))
    assert [r.error is None for r in run(spark, config, broken, DAY_1)] == [True, False]
    put("a b", [(1, 1), (2, 2)], "id int, n int")
    results = run(spark, config, manifest, DAY_2)
    assert [r.error for r in results] == [None, None]
    before = ledger.open_ids(spark, config.notes_path)
    compact(spark, config)
    assert before == [] == ledger.open_ids(spark, config.notes_path)  # what failed has landed nothing
    put("a b", [(1, 1), (2, 2), (3, 3)], "id int, n int")
    results = run(spark, replace(config, reconcile=True), manifest, DAY_3)
    assert [r.error for r in results] == [None, None]
    assert rows(read_bronze(spark, results[0].table).select("id")) == [(1,), (2,), (3,), (5,)]


def test_folding_keeps_the_commits_of_runs_that_still_have_a_note(spark, config):
    """A driver may die after it has committed a run and before it takes the note away."""
    key, folder = ("LAKE", "MAIN", "one"), f"{config.root}/one"
    for n, (noted, done) in enumerate([(True, False), (True, True), (False, True), (False, True)]):
        at = DAY_1.replace(minute=n)
        opened = ledger.begin(spark, config.notes_path, folder, key, at)
        if done:
            state.advance(spark, config.state_path, key, str(n), "int", at, opened.id)
        if not noted:
            ledger.close(spark, config.notes_path, opened)
    ids = ledger.open_ids(spark, config.notes_path)
    for _ in range(2):
        assert len(state.committed(spark, config.state_path, ids)) == 1
        compact(spark, config, 3)
    assert len(storage.children(spark, config.state_path)) == 1
    assert state.read_state(spark, config.state_path).count() == 2
    assert rows(state.latest_state(state.read_state(spark, config.state_path)).select("value")) == [("3",)]


def test_odd_flags_of_every_kind_are_logged(spark, config, put):
    put("one", [(1, 1)], "id int, n int")
    schema = SCHEMA.replace("SRC_FLAG_INCR int", "SRC_FLAG_INCR double")
    row = ("DB", "LAKE", "MAIN", "one", None, 1, 1.0, "n", None, None)
    manifest = spark.createDataFrame([(*row[:3], "odd", *row[4:6], float("inf"), *row[7:]), row], schema)
    results = {r.source.object: r.error for r in run(spark, config, manifest, DAY_1)}
    assert results["one"] is None and "control row" in results["odd"]


def test_short_loads_are_logged_while_a_long_one_runs(spark, config, put, monkeypatch):
    """A driver lost during a long load keeps the log of those that had finished."""
    from threading import Event

    from firstpour.plans import run as runs

    put("one", [(1, 1)], "id int, n int")
    seen = Event()

    def slow(spark, config, source, last):
        assert seen.wait(60)
        return spark.range(1)

    written = load_log.log_loads
    monkeypatch.setattr(runs, "LOG_SECONDS", 0.2)
    monkeypatch.setattr(load_log, "log_loads", lambda spark, path, records: (written(spark, path, records), records and seen.set()))
    row = ("DB", "LAKE", "MAIN", "one", None, 1, 0, None, None, None)
    manifest = spark.createDataFrame([("SLOW", "X", "MAIN", "two", *row[4:]), row], SCHEMA)
    results = run(spark, replace(config, readers={"SLOW": slow}), manifest, DAY_1)
    assert [r.error for r in results] == [None, None]


class Killed(BaseException):
    """What ends a driver: no load catches it."""


def dying(objects):
    from firstpour.plans.load import read_database

    def read(spark, config, source, last):
        if source.object in objects:
            raise Killed
        return read_database(spark, config, source, last)

    return {"DB": read}


def test_a_run_cut_short_is_taken_up_again(spark, config, put, monkeypatch):
    row = ("DB", "LAKE", "MAIN", "one", None, 1, 1, "n", None, None)
    names = ["one", "two", "three", "four"]
    for name in names:
        put(name, [(1, 1), (2, 2)], "id int, n int")
    manifest = spark.createDataFrame([(*row[:3], n, *row[4:6], int(n != "two"), *row[7:]) for n in names], SCHEMA)
    lone = replace(config, parallel=1, readers=dying(["three"]))
    with pytest.raises(Killed):
        run(spark, lone, manifest, DAY_1, name="night 15")
    # the load of three died with its rows landed, too
    opened = ledger.begin(spark, config.notes_path, f"{config.root}/lake_main_three", ("LAKE", "MAIN", "three"), DAY_1)
    land_incremental(spark.createDataFrame([(1, 1)], "id int, n int"), f"{config.root}/lake_main_three", DAY_1, run=opened)
    results = run(spark, replace(config, parallel=1), manifest, DAY_2, name="night 15")
    assert [(r.source.object, r.rows, r.error) for r in results] == [(n, 2, None) for n in names]
    before = {r.source.object for r in results if r.decision == "loaded before"}
    assert before and "three" not in before
    for r in results:
        held = read_bronze(spark, r.table)
        assert rows(held.select("id")) == [(1,), (2,)] and held.select("fetch_date").distinct().count() == 1
        assert {x["d"] for x in held.select(F.date_format("fetch_date", "yyyyMMdd").alias("d")).collect()} == {"20240115"}
    again = run(spark, config, manifest, DAY_3, name="night 15")
    assert {r.decision for r in again} == {"loaded before"}
    # a note may be lost: the watermark record has the run's time
    storage.delete(spark, f"{config.root}/_control/runs")
    assert [r.rows for r in run(spark, config, manifest.where("SRC_OBJECT_NAME <> 'two'"), DAY_1, name="night 15")] == [0, 0, 0]
    assert rows(read_bronze(spark, results[0].table).select("id")) == [(1,), (2,)]


def test_longest_loads_come_first(spark, config, put):
    began = []

    def slow(spark, config, source, last):
        began.append(source.object)
        return spark.range(1)

    def record(name, seconds, day):
        return load_log.LogRecord(day, day + timedelta(seconds=seconds), ("X", "M", name), "", "SLOW", "SUCCESS")

    load_log.log_loads(spark, config.log_path, [record("a", 5, DAY_1), record("b", 60, DAY_1), record("c", 99, DAY_1), record("c", 1, DAY_2)])
    manifest = spark.createDataFrame([("SLOW", "X", "M", n, None, 1, 0, None, None, None) for n in "abcd"], SCHEMA)
    run(spark, replace(config, parallel=1, readers={"SLOW": slow}), manifest, DAY_3)
    assert began == ["d", "b", "a", "c"]
