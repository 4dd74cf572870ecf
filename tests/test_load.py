from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from firstpour import LoadError, Source, load, storage
from firstpour.operators import load_log, state
from firstpour.operators.land import land_incremental
from firstpour.operators.metrics import high_watermark
from firstpour.plans import load as plans
from firstpour.plans.load import current_watermark, reset_watermark
from firstpour.sources import read_bronze
from firstpour.testing import workbook
from tests.conftest import DAY_1, DAY_1_LATER, DAY_2, DAY_3, rows

THINGS = Source("DB", "LAKE", "MAIN", "things", None, True, "n")
SCHEMA = "id int, n int"


def ids(spark, table):
    return sorted(r["id"] for r in read_bronze(spark, table).select("id").collect())


def log(spark, config):
    read = load_log.read_log(spark, config.log_path).orderBy("START_TIME", F.col("ACTION").desc())
    return [(r["ACTION"], r["COUNT_ROW"]) for r in read.collect()]


def test_increments_start_past_the_watermark(spark, config, put):
    put("things", [(1, 1), (2, 2), (3, None)], SCHEMA)
    first = load(spark, config, THINGS, DAY_1)
    assert (first.rows, first.decision, first.watermark) == (3, "create_partitioned", "2")
    # Equal to the watermark, and null after the first load: neither is picked up.
    put("things", [(1, 1), (2, 2), (3, None), (4, 2), (5, None), (6, 3)], SCHEMA)
    second = load(spark, config, THINGS, DAY_2)
    assert (second.rows, second.decision, second.watermark) == (1, "sync", "3")
    assert ids(spark, second.table) == [1, 2, 3, 6]
    assert log(spark, config) == [("SUCCESS", 3), ("SUCCESS", 1)]


def test_empty_increment_is_a_success_with_a_warning(spark, config, put):
    put("things", [(1, 1)], SCHEMA)
    load(spark, config, THINGS, DAY_1)
    result = load(spark, config, THINGS, DAY_2)
    assert (result.rows, result.decision, result.watermark) == (0, "nothing", "1")
    assert ids(spark, result.table) == [1]
    assert log(spark, config) == [("SUCCESS", 1), ("WARNING", 0), ("SUCCESS", 0)]


def test_empty_first_load_stores_a_null_watermark(spark, config, put):
    put("things", [(1, 1)], SCHEMA)
    source = replace(THINGS, last_update="5")
    result = load(spark, config, source, DAY_1)
    assert (result.rows, result.watermark) == (0, None)
    assert not spark.catalog.tableExists(result.table)
    # The null is the newest record, so the next load is unfiltered.
    assert load(spark, config, source, DAY_2).rows == 1


def test_watermark_in_the_control_row_starts_the_first_load(spark, config, put):
    put("things", [(1, 1), (2, 2), (3, 3)], SCHEMA)
    result = load(spark, config, replace(THINGS, last_update="2"), DAY_1)
    assert ids(spark, result.table) == [3]


def test_full_load_is_filtered_but_does_not_advance(spark, config, put):
    put("things", [(1, 1), (2, 2)], SCHEMA)
    source = replace(THINGS, incremental=False, last_update="1")
    result = load(spark, config, source, DAY_1)
    assert ids(spark, result.table) == [2]
    assert state.read_state(spark, config.state_path).count() == 0


def test_all_null_criteria(spark, config, put):
    put("things", [(1, None)], SCHEMA)
    assert load(spark, config, THINGS, DAY_1).watermark is None
    assert load(spark, config, THINGS, DAY_2).rows == 1


def test_incremental_without_criteria_takes_everything_each_time(spark, config, put):
    put("things", [(1, 1)], SCHEMA)
    source = replace(THINGS, criteria=None)
    load(spark, config, source, DAY_1)
    result = load(spark, config, source, DAY_2)
    assert (ids(spark, result.table), result.watermark) == ([1, 1], None)


@pytest.mark.parametrize(
    "source, message",
    [
        (Source("FILE", "CSV", "/nowhere", "S"), "unknown workbook source"),
        (Source("API", "X", "Y", "Z"), "unknown source type"),
        (Source("DB", "NOWHERE", "Y", "Z"), "no database configured"),
        (Source("DB", "LAKE", "MAIN", "absent"), "PATH_NOT_FOUND"),
        (replace(THINGS, criteria="absent"), "UNRESOLVED_COLUMN"),
    ],
)
def test_failures_are_logged_and_raised(spark, config, put, source, message):
    put("things", [(1, 1)], SCHEMA)
    with pytest.raises(LoadError, match=message):
        load(spark, config, source, DAY_1)
    row = load_log.read_log(spark, config.log_path).first()
    assert row["ACTION"] == "ERROR" and message in row["ERROR_MESSAGE"] and row["ERROR_TYPE"]
    assert not spark.catalog.tableExists(config.table(source))


@pytest.mark.parametrize("stage", ["land_incremental", "publish"])
def test_failed_stage_leaves_the_watermark(spark, config, put, monkeypatch, stage):
    put("things", [(1, 1)], SCHEMA)
    load(spark, config, THINGS, DAY_1)
    put("things", [(1, 1), (2, 2)], SCHEMA)

    def fail(*args, **kwargs):
        raise OSError("disk gone")

    with monkeypatch.context() as patched:
        patched.setattr(plans, stage, fail)
        with pytest.raises(LoadError, match="disk gone"):
            load(spark, config, THINGS, DAY_2)
    assert current_watermark(spark, config, THINGS).value == "1"
    assert load(spark, config, THINGS, DAY_3).rows == 1


def test_failed_load_keeps_the_published_snapshot(spark, config, put):
    put("things", [(1, 1)], SCHEMA)
    source = replace(THINGS, incremental=False)
    table = load(spark, config, source, DAY_1).table
    with pytest.raises(LoadError):
        load(spark, config, replace(source, constraint="WHERE raise_error('boom') IS NULL"), DAY_2)
    assert ids(spark, table) == [1]


def interrupted(spark, config, put):
    """A load that landed its rows and died before recording its watermark."""
    put("things", [(1, 1)], SCHEMA)
    load(spark, config, THINGS, DAY_1)
    put("things", [(1, 1), (2, 2), (3, 3)], SCHEMA)
    late = spark.createDataFrame([(3, 3)], SCHEMA)
    land_incremental(late, config.folder(THINGS), DAY_1_LATER, "n")


def test_interrupted_load_repeats_rows_by_default(spark, config, put):
    interrupted(spark, config, put)
    assert ids(spark, load(spark, config, THINGS, DAY_2).table) == [1, 2, 3, 3]


def test_reconcile_undoes_an_interrupted_load(spark, config, put):
    interrupted(spark, config, put)
    result = load(spark, replace(config, reconcile=True), THINGS, DAY_2)
    assert ids(spark, result.table) == [1, 2, 3]
    assert result.watermark == "3"


def test_reconcile_copes_with_spaces_in_the_path(spark, config, put):
    spaced = replace(config, root=f"{config.root}/a b", reconcile=True)
    put("things", [(1, 1)], SCHEMA)
    load(spark, spaced, THINGS, DAY_1)
    put("things", [(1, 1), (2, 2)], SCHEMA)
    land_incremental(spark.createDataFrame([(2, 2)], SCHEMA), spaced.folder(THINGS), DAY_2, "n")
    assert ids(spark, load(spark, spaced, THINGS, DAY_3).table) == [1, 2]


def test_run_time_must_move_forward(spark, config, put):
    put("things", [(1, 1)], SCHEMA)
    load(spark, config, THINGS, DAY_2)
    with pytest.raises(LoadError, match="not after"):
        load(spark, config, THINGS, DAY_2)
    with pytest.raises(LoadError, match="not after"):
        load(spark, config, THINGS, DAY_1)


def test_full_table_cannot_turn_incremental_unnoticed(spark, config, put):
    put("things", [(1, 1)], SCHEMA)
    load(spark, config, replace(THINGS, incremental=False), DAY_1)
    with pytest.raises(LoadError, match="full snapshot"):
        load(spark, config, THINGS, DAY_2)


def test_reset_by_hand_reloads_history(spark, config, put):
    put("things", [(1, 1), (2, 2)], SCHEMA)
    load(spark, config, THINGS, DAY_1)
    reset_watermark(spark, config, THINGS, 1, DAY_1 + timedelta(hours=1))
    # The source lost its newest row meanwhile: the watermark is still that of the table.
    put("things", [(1, 1)], SCHEMA)
    result = load(spark, config, THINGS, DAY_2)
    assert (result.rows, result.watermark) == (0, "2")


@pytest.mark.parametrize("criteria", ["n", "N", "coalesce(n, id)"])
@pytest.mark.parametrize("exact", [False, True])
def test_observed_watermark_equals_the_table_maximum(spark, config, put, exact, criteria):
    config = replace(config, exact_watermark=exact)
    for last, day in ((3, DAY_1), (3, DAY_2), (7, DAY_3)):
        put("things", [(i, i) for i in range(1, last + 1)], SCHEMA)
        result = load(spark, config, replace(THINGS, criteria=criteria), day)
        high = high_watermark(read_bronze(spark, result.table), "n").first()["high"]
        assert result.watermark == str(high) == str(last)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "decimal(20,3)", "double", "string"])
def test_watermark_types_survive_storage_and_other_session_zones(spark, config, root, kind):
    values = {"date": ("'2024-01-01'", "'2024-01-02'"), "decimal(20,3)": ("1.500", "12.001"), "double": ("0.1", "0.30000000000000004")}
    low, high = values.get(kind, ("'2024-01-01 00:00:00.000001'", "'2024-01-01 12:00:00.5'"))
    df = spark.sql(f"SELECT 1 AS id, CAST({low} AS {kind}) AS n UNION ALL SELECT 2, CAST({high} AS {kind})")
    df.where("id = 1").write.parquet(f"{root}/source/things")
    load(spark, config, THINGS, DAY_1)
    df.where("id = 2").write.mode("append").parquet(f"{root}/source/things")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        result = load(spark, config, THINGS, DAY_2)
        assert (result.rows, load(spark, config, THINGS, DAY_3).rows) == (1, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert ids(spark, result.table) == [1, 2]


def test_charset_repair_in_a_load(spark, config, put):
    put("things", [(1, "café".encode().decode("latin-1"))], "id int, name string")
    source = Source("DB", "LAKE", "MAIN", "things", force_encode="ISO-8859-1")
    assert [r["name"] for r in read_bronze(spark, load(spark, config, source, DAY_1).table).collect()] == ["café"]


@pytest.fixture
def book(tmp_path):
    path = tmp_path / "in.xlsx"
    path.write_bytes(workbook({"My Sheet": {1: ["Title"], 2: ["id", "day"], 3: [1, "2024-01-01"], 4: [2, "2024-01-02"]}}))
    return str(path)


def test_workbook_load(spark, config, book):
    result = load(spark, config, Source("FILE", "TURKEY", book, "My Sheet"), DAY_1)
    assert result.table.endswith("`turkey_my_sheet`")
    assert rows(read_bronze(spark, result.table).drop("fetch_date")) == [("1", "2024-01-01"), ("2", "2024-01-02")]
    plain = load(spark, config, Source("FILE", "EXCEL", book, "My Sheet"), DAY_1)
    assert read_bronze(spark, plain.table).columns == ["Title", "Unnamed: 1", "fetch_date"]


def test_workbook_loads_ignore_filters_unless_asked(spark, config, book):
    source = Source("FILE", "TURKEY", book, "My Sheet", "WHERE id = '2'", True, "day", "2024-01-01")
    result = load(spark, config, source, DAY_1)
    assert (result.rows, result.watermark) == (2, "2024-01-02")
    again = load(spark, replace(config, filter_files=True), source, DAY_2)
    assert again.rows == 0


def test_similar_names_do_not_mix(spark, config, put):
    put("orders", [(1, 1)], SCHEMA)
    put("orders_old", [(2, 2)], SCHEMA)
    one = load(spark, config, replace(THINGS, object="orders"), DAY_1)
    two = load(spark, config, replace(THINGS, object="orders_old"), DAY_1)
    assert (ids(spark, one.table), ids(spark, two.table)) == ([1], [2])


def test_state_compaction_keeps_the_latest(spark, config):
    path = config.state_path
    for i in range(4):
        state.advance(spark, path, ("A", "B", f"C{i % 2}"), str(i), "int", DAY_1 + timedelta(hours=i))
    state.advance(spark, path, ("A", "B", "C0"), None, "int", DAY_1 + timedelta(hours=9))
    before = rows(state.latest_state(state.read_state(spark, path)))
    state.compact_state(spark, path)
    assert len(storage.children(spark, path)) == 1
    assert rows(state.latest_state(state.read_state(spark, path))) == before
    assert before[0][3] is None and before[1][3] == "3"


def test_naive_run_time_is_utc(spark, config, put):
    put("things", [(1, 1)], SCHEMA)
    result = load(spark, config, THINGS, datetime(2024, 1, 15, 23, 59))
    assert read_bronze(spark, result.table).first()["fetch_day"] == "20240115"


def test_incremental_table_survives_a_new_catalog(spark, config, put):
    put("things", [(1, 1), (2, 2)], SCHEMA)
    table = load(spark, config, THINGS, DAY_1).table
    spark.sql(f"DROP TABLE {table}")
    # An empty batch must not pass for a first one, or the next load would repeat everything.
    result = load(spark, config, THINGS, DAY_2)
    assert (result.rows, result.watermark, ids(spark, table)) == (0, "2", [1, 2])
    spark.sql(f"DROP TABLE {table}")
    put("things", [(1, 1), (2, 2), (3, 3)], f"{SCHEMA}")
    result = load(spark, config, THINGS, DAY_3)
    assert (result.rows, result.decision, ids(spark, table)) == (1, "sync", [1, 2, 3])


def test_new_catalog_keeps_the_first_columns(spark, config, put):
    put("things", [(1, 1)], SCHEMA)
    table = load(spark, config, THINGS, DAY_1).table
    spark.sql(f"DROP TABLE {table}")
    put("things", [(1, 1, "a"), (2, 2, "b")], f"{SCHEMA}, name string")
    load(spark, config, THINGS, DAY_2)
    assert ids(spark, table) == [1, 2]
    assert "name" not in read_bronze(spark, table).columns


def test_full_table_survives_a_new_catalog(spark, config, put):
    put("things", [(1, 1)], SCHEMA)
    source = replace(THINGS, incremental=False)
    table = load(spark, config, source, DAY_1).table
    spark.sql(f"DROP TABLE {table}")
    load(spark, config, replace(source, constraint="WHERE id > 99"), DAY_2)
    assert ids(spark, table) == [1]


def test_nan_is_no_watermark(spark, config, put):
    schema = "id int, n double"
    put("things", [(1, 1.0), (2, float("nan"))], schema)
    assert load(spark, config, THINGS, DAY_1).watermark == "1.0"
    put("things", [(1, 1.0), (2, float("nan")), (3, 2.0)], schema)
    result = load(spark, config, THINGS, DAY_2)
    assert (result.watermark, 3 in ids(spark, result.table)) == ("2.0", True)
    state.advance(spark, config.state_path, THINGS.key, "NaN", "double", DAY_2 + timedelta(hours=1))
    assert current_watermark(spark, config, THINGS).value is None


def test_shared_table_keeps_each_sources_watermark(spark, config, put):
    other = replace(THINGS, object="thi ngs")
    mine = replace(THINGS, object="thi_ngs")
    put("thi_ngs", [(1, 10)], SCHEMA)
    put("thi ngs", [(2, 2)], SCHEMA)
    load(spark, config, mine, DAY_1)
    assert load(spark, config, other, DAY_1_LATER).watermark == "2"
    put("thi ngs", [(2, 2), (3, 3)], SCHEMA)
    assert load(spark, replace(config, exact_watermark=True), other, DAY_2).rows == 1


def test_reconcile_undoes_an_interrupted_first_load(spark, config, put, monkeypatch):
    put("things", [(1, 1), (2, 2)], SCHEMA)

    def fail(*args, **kwargs):
        raise OSError("driver gone")

    with monkeypatch.context() as patched:
        patched.setattr(plans, "publish", fail)
        with pytest.raises(LoadError):
            load(spark, config, THINGS, DAY_1)
    result = load(spark, replace(config, reconcile=True), THINGS, DAY_2)
    assert ids(spark, result.table) == [1, 2]


def test_own_reader(spark, config):
    made = replace(config, readers={"RANGE": lambda spark, config, source, last: spark.range(int(source.object))})
    result = load(spark, made, Source("RANGE", "X", "Y", "3"), DAY_1)
    assert ids(spark, result.table) == [0, 1, 2]


def test_narrow_increments_are_rebalanced(spark, config, put, monkeypatch):
    seen = []
    monkeypatch.setattr(plans, "land_incremental", lambda df, *args: seen.append(args[3].rebalance) or land_incremental(df, *args))
    put("things", [(1, 1)], SCHEMA)
    load(spark, config, THINGS, DAY_1)
    put("things", [(1, 1), (2, 2)], SCHEMA)
    load(spark, config, THINGS, DAY_2)
    assert seen == [False, True]
