"""JDBC scans against an embedded database: in-process, no server, no port."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, TimestampNTZType, TimestampType

import __spark_entry__ as registry
from firstpour import BronzeConfig, JdbcDatabase, Source, Split, load, storage
from firstpour.sources import read_bronze, scan_jdbc
from firstpour.sources.jdbc import _bucket_predicates, _loosened, full_table_name, request_text, source_literal
from tests.conftest import DAY_1, DAY_2, SF, rows

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


@pytest.fixture(scope="module")
def url(spark):
    path = storage.scratch(spark, "derby").removeprefix("file:")
    made = f"jdbc:derby:{path};create=true"
    types = "o_orderstatus VARCHAR(1), o_orderpriority VARCHAR(20)"
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    orders.write.option("createTableColumnTypes", types).jdbc(made, "orders", properties={"driver": DRIVER})
    # One value holds most rows, some have none, and some are negative.
    skewed = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 10 < 7, 5).when(F.col("o_orderkey") % 10 < 9, -3).alias("k"),
    )
    skewed.write.jdbc(made, "skewed", properties={"driver": DRIVER})
    return made


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


def database(url, **splits):
    return JdbcDatabase(url, DRIVER, splits=splits)


def test_default_scan_is_one_task_and_whole(spark, url, orders):
    df = scan_jdbc(spark, database(url), "", "orders")
    assert df.rdd.getNumPartitions() == 1
    assert df.dtypes == orders.dtypes
    assert rows(df) == rows(orders)


@pytest.mark.parametrize(
    "split",
    [
        Split(4, column="o_orderkey"), Split(4, column="o_orderdate"), Split(4, column="o_totalprice", even=False),
        Split(4, column="o_orderdate", even=False), Split(4, expression='MOD("o_custkey", 4)'),
    ],
)
def test_split_scan_is_whole(spark, url, orders, split):
    df = scan_jdbc(spark, database(url, orders=split), "", "orders")
    assert df.rdd.getNumPartitions() == 4
    assert rows(df) == rows(orders)


@pytest.mark.parametrize("expression", ['"k"', 'MOD("k", 3)'])
def test_bucket_split_loses_no_null_negative_or_large_number(spark, url, expression):
    df = scan_jdbc(spark, database(url, skewed=Split(3, expression=expression)), "", "skewed")
    assert rows(df) == rows(scan_jdbc(spark, database(url), "", "skewed"))


@pytest.mark.parametrize("expression", ['"o_orderkey" / 3.0', 'CAST("k" AS DECIMAL(10,2)) / 2', '"o_orderkey" * 1.0E0 / 700'])
def test_bucket_split_loses_no_fraction(spark, url, expression):
    df = scan_jdbc(spark, database(url, skewed=Split(3, expression=expression)), "", "skewed")
    assert rows(df) == rows(scan_jdbc(spark, database(url), "", "skewed"))


@pytest.mark.parametrize("split", [Split(4, column="k"), Split(4, column="k", then="o_orderkey")])
def test_heavy_values_and_nulls_are_spread(spark, url, split):
    """One value holds 70 % of the rows, another 20 %, and 10 % have none."""
    df = scan_jdbc(spark, database(url, skewed=split), "", "skewed")
    assert rows(df) == rows(scan_jdbc(spark, database(url), "", "skewed"))
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert 4 <= len(sizes) <= 6 and max(sizes) <= 1.2 * sum(sizes) / 4


def test_one_value_in_all_rows_is_spread(spark, url):
    spark.range(100).selectExpr("id", "7 AS k").write.jdbc(url, "same", properties={"driver": DRIVER})
    df = scan_jdbc(spark, database(url, same=Split(4, column="k")), "", "same")
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 100 and max(sizes) <= 30
    with pytest.raises(ValueError, match="to split on"):
        scan_jdbc(spark, database(url, same=Split(4, column="k", then="absent")), "", "same")


def test_decimals_beyond_64_bits(spark, url):
    made = spark.range(400).selectExpr("CAST(id AS INT) AS id", "CAST(10000000000000000000000 AS DECIMAL(30,0)) + id * id AS k")
    made.selectExpr("id", "CAST(k AS DECIMAL(30,0)) AS k").write.jdbc(url, "wide", properties={"driver": DRIVER})
    df = scan_jdbc(spark, database(url, wide=Split(4, column="k")), "", "wide")
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and sum(sizes) == 400 and max(sizes) <= 110


def test_hash_split_spreads_a_hot_value(spark, url):
    hot = scan_jdbc(spark, database(url, skewed=Split(4, expression='MOD("o_orderkey", 4)')), "", "skewed")
    sizes = [r["count"] for r in hot.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1.5 * sum(sizes) / 4


def test_constraint_and_watermark_run_at_the_source(spark, url, orders):
    db = database(url, orders=Split(4, column="o_orderkey"))
    where = "WHERE \"o_orderstatus\" = 'F' OR \"o_orderstatus\" = 'O'"
    df = scan_jdbc(spark, db, "", "orders", where, "o_orderdate", "1998-01-01 00:00:00")
    expected = orders.where("o_orderstatus IN ('F', 'O') AND o_orderdate > '1998-01-01'")
    assert rows(df) == rows(expected)
    assert "GreaterThan(o_orderdate" in plan(df)


def test_bounds_follow_the_watermark(spark, url):
    """Only the rows past the watermark decide how the range is cut."""
    db = database(url, orders=Split(4, column="o_orderdate"))
    df = scan_jdbc(spark, db, "", "orders", None, "o_orderdate", "2001-01-01 00:00:00")
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 0.5 * sum(sizes)


def test_columns_are_pruned_at_the_source(spark, url):
    df = scan_jdbc(spark, database(url), "", "orders", columns=["o_orderkey"])
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan(df)


def test_empty_range_needs_no_bounds(spark, url):
    db = database(url, orders=Split(4, column="o_orderkey"))
    df = scan_jdbc(spark, db, "", "orders", 'WHERE "o_orderkey" < 0')
    assert df.count() == 0


def test_incremental_load_over_jdbc(spark, url, root, orders):
    config = BronzeConfig("TEST", root, {"ERP": database(url, orders=Split(4, column="o_orderkey"))}, "jdbc_" + root[-8:])
    source = Source("DB", "ERP", "", "orders", "WHERE \"o_orderdate\" <= TIMESTAMP('1998-01-01 00:00:00')", True, "o_orderdate")
    first = load(spark, config, source, DAY_1)
    second = load(spark, config, Source("DB", "ERP", "", "orders", None, True, "o_orderdate"), DAY_2)
    assert first.rows + second.rows == orders.count()
    kept = read_bronze(spark, second.table).drop("fetch_date", "fetch_year", "fetch_month", "fetch_day")
    assert rows(kept) == rows(orders)


def test_criteria_expression_runs_at_the_source(spark, url):
    data = [(1, None, 5), (2, 1, 9), (3, 7, None), (4, None, None)]
    frame = spark.createDataFrame(data, "ID int, A int, B int")
    frame.write.jdbc(url, "versions", properties={"driver": DRIVER})
    df = scan_jdbc(spark, database(url), "", "versions", "WHERE ID < 9", "COALESCE(A, B)", "4")
    assert "COALESCE(A, B) > 4" in plan(df)
    assert rows(df) == [(1, None, 5), (3, 7, None)]


def test_names_and_literals():
    assert full_table_name("SALES", "ORDER_LINES") == "SALES.ORDER_LINES"
    assert full_table_name("", "V$SESSION") == "V$SESSION"
    assert full_table_name("SALES", "ORDER LINES") == 'SALES."ORDER LINES"'
    assert source_literal("5", LongType()) == "5"
    assert source_literal("2024-01-01 00:00:00.5", TimestampNTZType()) == "{ts '2024-01-01 00:00:00.5'}"
    assert source_literal("2024-01-01", DateType()) == "{d '2024-01-01'}"
    assert source_literal("it's", StringType()) == "'it''s'"
    assert request_text("t") == "SELECT * FROM t"
    assert request_text("t", "WHERE a OR b", "c", "1") == "SELECT * FROM t WHERE (a OR b) AND c > 1"
    assert _bucket_predicates(Split(1, expression="x")) == ["1 = 1"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("type", ["DECIMAL(12,2)", "DOUBLE"])
def test_split_on_fractional_columns(spark, url, type):
    made = spark.range(50).selectExpr("id", f"CAST(id * 1.5 AS {type}) AS k")
    made.write.jdbc(url, f"fraction_{type[:3]}", properties={"driver": DRIVER})
    database = JdbcDatabase(url, DRIVER, splits={f"APP.FRACTION_{type[:3]}".lower(): Split(4, column="k")})
    df = scan_jdbc(spark, database, "APP", f"FRACTION_{type[:3]}")
    assert df.rdd.getNumPartitions() == 4 and df.count() == 50


def test_watermark_column_splits_by_default(spark, url, orders):
    df = scan_jdbc(spark, JdbcDatabase(url, DRIVER, partitions=3), "", "orders", criteria="o_orderdate")
    assert df.rdd.getNumPartitions() == 3 and df.count() == orders.count()


def test_text_is_converted_at_the_source(spark, url, orders):
    database = JdbcDatabase(url, DRIVER, convert="LOWER({column})")
    df = scan_jdbc(spark, database, "", "orders", charset="ANY")
    assert df.columns == orders.columns
    assert {r[0] for r in df.select("o_orderstatus").distinct().collect()} == {"f", "o", "p"}


def test_zoned_watermarks_are_loosened_at_the_source():
    assert _loosened("2024-01-03 02:00:00+00:00", TimestampType()) == "2024-01-02 00:00:00"
    assert _loosened("2024-01-03 02:00:00", TimestampNTZType()) == "2024-01-03 02:00:00"


def test_query_where_scratch_is_a_file_uri(spark, orders, monkeypatch, tmp_path):
    monkeypatch.setattr(storage, "scratch", lambda spark, label: f"file://{tmp_path}/{label}")
    assert rows(registry.queries()["scan_jdbc"](spark, SF)) == rows(orders)


def test_filtered_query_where_scratch_is_a_file_uri(spark, orders, monkeypatch, tmp_path):
    monkeypatch.setattr(storage, "scratch", lambda spark, label: f"file://{tmp_path}/{label}")
    expected = orders.where("o_orderstatus IN ('F', 'O') AND o_orderdate > '1998-01-01'")
    assert rows(registry.queries()["scan_jdbc_filtered"](spark, SF)) == rows(expected)


@pytest.mark.parametrize("query", ["scan_jdbc", "scan_jdbc_filtered"])
def test_queries_take_orders_with_nulls(spark, orders, root, query):
    columns = orders.columns
    odd = orders.select(*[F.when(F.crc32(F.concat_ws("-", F.lit(c), "o_orderkey")) % 4 > 0, F.col(c)).alias(c) for c in columns])
    odd.write.parquet(f"{root}/orders.parquet")
    expected = odd if query == "scan_jdbc" else odd.where("o_orderstatus IN ('F', 'O') AND o_orderdate > '1998-01-01'")
    assert odd.where("o_orderstatus IS NULL AND o_orderpriority IS NULL").count()
    assert rows(registry.queries()[query](spark, root)) == rows(expected)
