"""What a load counts while it writes, and watermarks from file footers."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from firstpour import Source, load
from firstpour.operators import load_log
from firstpour.operators.footers import footer_high, footer_watermark
from firstpour.operators.metrics import high_watermark
from firstpour.sources import read_bronze
from tests.conftest import DAY_1, DAY_2, SF, rows

SCHEMA = "id int, n int"
THINGS = Source("DB", "LAKE", "MAIN", "things", None, True, "n")


def messages(spark, config):
    found = load_log.read_log(spark, config.log_path).where("ACTION = 'WARNING'")
    return sorted(r["ERROR_MESSAGE"] for r in found.collect())


def test_missed_rows_are_counted_and_not_loaded(spark, config, put):
    config = replace(config, count_missed=True)
    put("things", [(1, 1), (2, 2), (3, None)], SCHEMA)
    first = load(spark, config, THINGS, DAY_1)
    assert (first.rows, messages(spark, config)) == (3, [])
    put("things", [(4, 2), (5, 2), (6, 3), (7, None), (8, 1), (9, None), (10, None)], SCHEMA)
    second = load(spark, config, THINGS, DAY_2)
    assert (second.rows, second.watermark) == (1, "3")
    assert rows(read_bronze(spark, second.table).select("id")) == [(1,), (2,), (3,), (6,)]
    assert messages(spark, config) == ["2 rows equal to the watermark 2 were not loaded", "3 rows without a value of n were not loaded"]


def test_only_missed_rows_leave_the_watermark(spark, config, put):
    config = replace(config, count_missed=True)
    put("things", [(1, 1)], SCHEMA)
    load(spark, config, THINGS, DAY_1)
    result = load(spark, config, THINGS, DAY_2)
    assert (result.rows, result.decision, result.watermark) == (0, "nothing", "1")
    assert messages(spark, config) == ["1 rows equal to the watermark 1 were not loaded", "no rows to land"]


@pytest.mark.parametrize("incremental", [False, True])
def test_unrepaired_values_are_counted_by_column(spark, config, put, incremental):
    misread = "café".encode().decode("cp1252")
    put("things", [(1, 1, misread, "Ω"), (2, 2, "é", "日"), (3, 3, None, "ok"), (4, 4, "ok", misread)], f"{SCHEMA}, a string, b string")
    source = replace(THINGS, force_encode="windows-1252", incremental=incremental)
    result = load(spark, config, source, DAY_1)
    kept = read_bronze(spark, result.table)
    assert rows(kept.select("id", "a", "b")) == [(1, "café", "Ω"), (2, "é", "日"), (3, None, "ok"), (4, "ok", "café")]
    assert not [c for c in kept.columns if "unrepaired" in c]
    assert messages(spark, config) == [
        "1 values of column a are no text read under windows-1252 and stay as they were",
        "2 values of column b are no text read under windows-1252 and stay as they were",
    ]


def test_counts_equal_a_separate_scan(spark, config):
    """Over a given table, with a watermark in its midst."""
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    mark = orders.groupBy("o_orderdate").count().orderBy(F.desc("count"), "o_orderdate").first()
    source = Source("DB", "TPCH", "MAIN", "orders", None, True, "o_orderdate", str(mark["o_orderdate"]))
    result = load(spark, replace(config, count_missed=True), source, DAY_1)
    assert result.rows == orders.where(F.col("o_orderdate") > mark["o_orderdate"]).count()
    assert messages(spark, config) == [f"{mark['count']} rows equal to the watermark {mark['o_orderdate']} were not loaded"]


# ---------------------------------------------------------------- footers


@pytest.mark.parametrize("kind", ["int", "bigint", "date", "timestamp_ntz", "timestamp", "decimal(20,3)", "double", "float", "string"])
def test_footers_tell_what_a_scan_does(spark, root, kind):
    high = {"date": "'2024-03-01'", "string": "'zz'"}.get(kind, "'2024-03-01 10:00:00.123457'" if kind.startswith("time") else "7.125")
    low = {"date": "'2024-01-01'", "string": "'aa'"}.get(kind, "'1969-12-31 23:59:59.5'" if kind.startswith("time") else "-3")
    for n, values in enumerate(((low, "NULL"), (high, low), ("NULL",))):
        spark.sql(" UNION ALL ".join(f"SELECT CAST({v} AS {kind}) AS `a b`" for v in values)).coalesce(1).write.mode("append").parquet(f"{root}/t t")
    table = spark.read.parquet(f"{root}/t t")
    assert rows(footer_watermark(table, "a b")) == rows(high_watermark(table, "`a b`"))


def test_not_a_number_is_scanned_for(spark, root):
    for values in ((1.0, float("nan"), 9.0), (3.0,), (float("nan"),)):
        spark.createDataFrame([(v,) for v in values], "n double").coalesce(1).write.mode("append").parquet(f"{root}/t")
    table = spark.read.parquet(f"{root}/t")
    assert footer_watermark(table, "n").first()["high"] == high_watermark(table, "n").first()["high"] == 9.0
    assert {footer_high(f, "n")[0] for f in table.inputFiles()} == {True, False}


def test_only_footers_are_read(spark, root):
    """With every data page overwritten, the footers still tell."""
    spark.range(100_000).selectExpr("id", "CAST(id AS STRING) AS t").coalesce(1).write.parquet(f"{root}/t")
    table = spark.read.parquet(f"{root}/t")
    path = table.inputFiles()[0].removeprefix("file://")
    with open(path, "r+b") as file:
        file.seek(-8, 2)
        footer, end = int.from_bytes(file.read(4), "little"), file.seek(0, 2)
        file.seek(4)
        file.write(b"\0" * (end - footer - 12))
    assert footer < 5_000 and footer_watermark(table, "id").first()["high"] == 99_999


def test_absent_columns_empty_tables_and_exact_watermarks(spark, config, put, root):
    spark.range(5).write.parquet(f"{root}/t")
    spark.range(3).selectExpr("id", "id AS n").write.mode("append").parquet(f"{root}/t")
    table = spark.read.schema("id long, n long").parquet(f"{root}/t")
    assert footer_watermark(table, "n").first()["high"] == 2
    assert footer_watermark(spark.createDataFrame([], "n int"), "n").first()["high"] is None
    put("things", [(1, 1), (2, 5)], SCHEMA)
    exact = replace(config, exact_watermark=True)
    assert load(spark, exact, THINGS, DAY_1).watermark == "5"
    put("things", [(1, 1)], SCHEMA)
    assert load(spark, exact, THINGS, DAY_2).watermark == "5"
