import pytest
from pyspark.sql import functions as F

from firstpour import storage
from firstpour.functions import partition_values
from firstpour.operators import metrics
from firstpour.operators.land import WriteOptions, conform, land_full, land_incremental
from firstpour.operators.merge import merge_chunks
from firstpour.operators.publish import attach, create_partitioned, is_partitioned, publish, sync_partitions, table_schema
from firstpour.sources import file_count, landed_files, last_sequence, read_bronze
from tests.conftest import DAY_1, DAY_1_LATER, DAY_2, rows


@pytest.fixture
def table(config):
    return f"`{config.schema}`.things"


@pytest.fixture
def folder(config):
    return f"{config.root}/things"


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_full_without_rows_leaves_no_folder(spark, folder):
    landed = land_full(spark.range(0), folder, DAY_1, "id")
    assert (landed.rows, landed.high) == (0, None)
    assert not storage.exists(spark, landed.path)


def test_incremental_without_rows_writes_no_file(spark, folder):
    landed = land_incremental(spark.range(0), folder, DAY_1, "id")
    assert landed.rows == 0
    assert storage.children(spark, landed.path) == []


def test_empty_batch_publishes_nothing(spark, folder, table):
    publish(spark, table, land_full(spark.range(3), folder, DAY_1), False)
    assert publish(spark, table, land_full(spark.range(0), folder, DAY_2), False) == "nothing"
    assert ids(read_bronze(spark, table)) == [0, 1, 2]


def test_failed_full_write_leaves_nothing(spark, folder):
    bad = spark.range(5, numPartitions=2).withColumn("x", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        land_full(bad, folder, DAY_1)
    assert storage.children(spark, f"{folder}/snapshots/20240115") == []


def test_failed_incremental_write_leaves_nothing(spark, folder):
    land_incremental(spark.range(3), folder, DAY_1)
    bad = spark.range(100, numPartitions=4).withColumn(
        "id", F.when(F.col("id") == 99, F.raise_error(F.lit("boom")).cast("bigint")).otherwise(F.col("id"))
    )
    with pytest.raises(Exception, match="boom"):
        land_incremental(bad, folder, DAY_1_LATER)
    assert ids(spark.read.parquet(f"{folder}/increments")) == [0, 1, 2]


def test_rerun_on_one_day_replaces_and_other_days_stay(spark, folder, table):
    publish(spark, table, land_full(spark.range(1), folder, DAY_1), False)
    publish(spark, table, land_full(spark.range(2), folder, DAY_1_LATER), False)
    publish(spark, table, land_full(spark.range(3), folder, DAY_2), False)
    assert ids(read_bronze(spark, table)) == [0, 1, 2]
    assert len(storage.children(spark, f"{folder}/snapshots/20240115")) == 1
    assert ids(spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/snapshots/20240115")) == [0, 1]


def test_full_publish_follows_changed_columns(spark, folder, table):
    publish(spark, table, land_full(spark.range(2), folder, DAY_1), False)
    wider = spark.range(2).withColumn("name", F.lit("a"))
    publish(spark, table, land_full(wider, folder, DAY_2), False)
    assert read_bronze(spark, table).columns == ["id", "name", "fetch_date"]
    assert read_bronze(spark, table).count() == 2


def test_incremental_adds_to_the_day_and_to_the_table(spark, folder, table):
    for batch, day in ((spark.range(2), DAY_1), (spark.range(2, 4), DAY_1_LATER), (spark.range(4, 6), DAY_2)):
        done = publish(spark, table, land_incremental(batch, folder, day), True, partition_values(day))
        assert done == ("create_partitioned" if day == DAY_1 else "sync")
    bronze = read_bronze(spark, table)
    assert ids(bronze) == [0, 1, 2, 3, 4, 5]
    assert ids(bronze.where("fetch_day = '20240115'")) == [0, 1, 2, 3]
    assert dict(bronze.dtypes)["fetch_day"] == "string"


def test_sync_finds_days_the_catalog_does_not_know(spark, folder, table):
    publish(spark, table, land_incremental(spark.range(2), folder, DAY_1), True, partition_values(DAY_1))
    land_incremental(spark.range(2, 4), folder, DAY_2)
    assert ids(read_bronze(spark, table)) == [0, 1]
    sync_partitions(spark, table)
    assert ids(read_bronze(spark, table)) == [0, 1, 2, 3]


def test_new_catalog_recovers_the_history(spark, folder, table):
    for batch, day in ((spark.range(2), DAY_1), (spark.range(2, 4), DAY_2)):
        publish(spark, table, land_incremental(batch, folder, day), True, partition_values(day))
    spark.sql(f"DROP TABLE {table}")
    landed = land_incremental(spark.range(4, 5), folder, DAY_2)
    assert publish(spark, table, landed, True, partition_values(DAY_2)) == "create_partitioned"
    assert ids(read_bronze(spark, table)) == [0, 1, 2, 3, 4]
    assert is_partitioned(spark, table)


def test_later_columns_show_only_when_merged(spark, folder, table):
    publish(spark, table, land_incremental(spark.range(1), folder, DAY_1), True, partition_values(DAY_1))
    wider = spark.range(1, 2).withColumn("name", F.lit("a"))
    publish(spark, table, land_incremental(wider, folder, DAY_2), True, partition_values(DAY_2))
    assert "name" not in read_bronze(spark, table).columns
    merged = read_bronze(spark, table, merge_schema=True)
    assert rows(merged.select("id", "name")) == [(0, None), (1, "a")]
    assert merged.schema["fetch_day"].dataType == read_bronze(spark, table).schema["fetch_day"].dataType


def test_drifting_type_is_cast_or_fails_before_landing(spark, folder, table):
    publish(spark, table, land_incremental(spark.range(1), folder, DAY_1), True, partition_values(DAY_1))
    known = table_schema(spark, table)
    text = spark.createDataFrame([("7",)], "id string")
    land_incremental(text, folder, DAY_1_LATER, schema=known)
    spark.catalog.refreshTable(table)
    assert ids(read_bronze(spark, table)) == [0, 7]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        land_incremental(spark.createDataFrame([("x",)], "id string"), folder, DAY_1_LATER, schema=known)
    assert conform(text, None) is text


@pytest.mark.parametrize(
    "held, later",
    [
        ("CAST(1 AS bigint)", "2.7D"),
        ("CAST(1 AS int)", "4000000000L"),
        ("DATE '2024-01-01'", "TIMESTAMP_NTZ '2024-01-02 13:14:15'"),
        ("CAST(1.5 AS decimal(10,2))", "CAST(2.98765 AS decimal(10,5))"),
        ("1.5F", "0.1D"),
        ("CAST(7 AS int)", "'007'"),
    ],
)
def test_values_that_would_change_fail_before_landing(spark, folder, table, held, later):
    publish(spark, table, land_incremental(spark.sql(f"SELECT {held} AS v"), folder, DAY_1), True, partition_values(DAY_1))
    known = table_schema(spark, table)
    with pytest.raises(Exception, match="does not fit|CAST_OVERFLOW|overflow"):
        land_incremental(spark.sql(f"SELECT {later} AS v"), folder, DAY_2, schema=known)
    assert read_bronze(spark, table).count() == 1
    same = spark.sql(f"SELECT CAST({held} AS string) AS v")
    assert land_incremental(same, folder, DAY_2, schema=known).rows == 1


def test_newest_of_a_days_snapshots_is_recovered(spark, folder, table):
    for n in range(3):
        land_full(spark.range(n, n + 1), folder, DAY_1.replace(hour=10 + n))
    attach(spark, table, folder, False)
    assert ids(spark.table(table)) == [2]


def test_merged_read_shows_published_days_and_first_types(spark, folder, table):
    publish(spark, table, land_incremental(spark.range(1), folder, DAY_1), True, partition_values(DAY_1))
    wider = spark.range(1, 2).withColumn("extra", F.lit(5))
    publish(spark, table, land_incremental(wider, folder, DAY_1_LATER), True, partition_values(DAY_1))
    known = table_schema(spark, table)
    text = spark.range(2, 3).withColumn("extra", F.lit("6"))
    land_incremental(text, folder, DAY_2, schema=known)
    assert rows(read_bronze(spark, table, merge_schema=True).select("id", "extra")) == [(0, None), (1, 5)]
    sync_partitions(spark, table, partition_values(DAY_2))
    assert (2, 6) in rows(read_bronze(spark, table, merge_schema=True).select("id", "extra"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        land_incremental(spark.range(3, 4).withColumn("extra", F.lit("x")), folder, DAY_2, schema=known)


def test_source_columns_named_like_ours_get_another_name(spark, folder, table):
    source = spark.range(1).withColumns({"fetch_day": F.lit("19990101"), "fetch_date": F.lit("x")})
    publish(spark, table, land_incremental(source, folder, DAY_1), True, partition_values(DAY_1))
    row = read_bronze(spark, table).first()
    assert (row["fetch_day"], row["src_fetch_day"], row["src_fetch_date"]) == ("20240115", "19990101", "x")


def test_write_options(spark, folder):
    options = WriteOptions("none", 10)
    landed = land_full(spark.range(0, 35, 1, 1), folder, DAY_1, options=options)
    files = landed_files(spark, landed.path)
    assert file_count(files).first()["n_files"] == 4
    assert all(name.endswith("000.parquet") or "-c00" in name for name in (r["file_name"] for r in files.collect()))
    assert not any(".snappy." in r["file_name"] for r in files.collect())


def test_rebalanced_batch_is_whole_and_counted(spark, folder):
    landed = land_full(spark.range(0, 1000, 1, 16), folder, DAY_1, "id", WriteOptions(rebalance=True))
    assert (landed.rows, landed.high) == (1000, "999")
    assert spark.read.parquet(landed.path).count() == 1000
    assert file_count(landed_files(spark, landed.path)).first()["n_files"] < 16


def test_inventory_of_numbered_files(spark, root):
    files = spark.createDataFrame(
        [("ERP_AR0007.parquet",), ("ERP_AR0012.parquet",), ("ERP_AR12345.parquet",), ("ERP_AR_LINES0099.parquet",)],
        "file_name string",
    )
    assert last_sequence(files, "ERP_AR").first()[0] == 12345
    assert last_sequence(files, "ERP_XX").first()[0] == 0
    assert last_sequence(files.where("false"), "ERP_AR").first()[0] == 0


def test_inventory_reads_bare_day_folders(spark, root):
    spark.range(1).coalesce(1).write.parquet(f"{root}/bare/2024/202401/20240115")
    spark.range(1).coalesce(1).write.parquet(f"{root}/bare/2024/202401/20240116")
    assert file_count(landed_files(spark, f"{root}/bare")).first()["n_files"] == 2


def test_merge_keeps_duplicates_and_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(merge_chunks([a, b, a])) == [(1, "x"), (1, "x"), (1, None), (2, None)]


@pytest.mark.parametrize("land", [land_full, land_incremental])
@pytest.mark.parametrize("size", [0, 5])
def test_lost_metrics_are_read_off_the_landed_rows(spark, folder, monkeypatch, land, size):
    land(spark.range(100, 103), folder, DAY_1, "id")
    monkeypatch.setattr(metrics, "OBSERVATION_WAIT", 0.0)
    landed = land(spark.range(size), folder, DAY_1_LATER, "id")
    assert (landed.rows, landed.high) == (size, str(size - 1) if size else None)


def test_number_of_files(spark, folder):
    landed = land_full(spark.range(0, 1000, 1, 3), folder, DAY_1, "id", WriteOptions(files=5))
    assert (landed.rows, file_count(landed_files(spark, landed.path)).first()["n_files"]) == (1000, 5)


def test_leftovers_of_a_killed_write_are_not_committed(spark, folder):
    """Finished tasks of a job whose driver died lie where the next job's commit would find them."""
    day = "/".join(f"{k}={v}" for k, v in partition_values(DAY_1).items())
    stale = f"{folder}/increments/_temporary/0/task_202401150900000000000000000000_0001_m_000000"
    spark.range(90, 95).coalesce(1).write.parquet(f"{stale}/{day}")
    landed = land_incremental(spark.range(3), folder, DAY_1)
    assert (landed.rows, ids(spark.read.parquet(landed.path))) == (3, [0, 1, 2])


def test_merged_read_of_a_table_with_a_column_named_like_its_details(spark, folder, table):
    source = spark.range(1).withColumn("Location", F.lit("here"))
    publish(spark, table, land_incremental(source, folder, DAY_1), True, partition_values(DAY_1))
    assert read_bronze(spark, table, merge_schema=True).first()["Location"] == "here"


def test_folders_are_compared_like_a_repair_over_many_days(spark, config):
    """A thousand days, a few of which the catalog does not know."""
    folder = f"{config.root}/many/increments"
    days = spark.range(1000).selectExpr("id", "date_add(DATE '2021-01-01', CAST(id AS INT)) AS d").selectExpr(
        "id", "date_format(d, 'yyyy') AS fetch_year", "date_format(d, 'yyyyMM') AS fetch_month", "date_format(d, 'yyyyMMdd') AS fetch_day"
    )
    days.coalesce(1).write.partitionBy("fetch_year", "fetch_month", "fetch_day").parquet(folder)
    own, repaired = f"`{config.schema}`.own", f"`{config.schema}`.repaired"
    for table in (own, repaired):
        create_partitioned(spark, table, folder, spark.range(1).schema)
    spark.sql(f"MSCK REPAIR TABLE {repaired}")
    assert sync_partitions(spark, own) == 1000
    for day in ("2021-02-03", "2022-07-09", "2023-09-27"):
        y, m, d = day[:4], day[:4] + day[5:7], day.replace("-", "")
        spark.sql(f"ALTER TABLE {own} DROP PARTITION (fetch_year = '{y}', fetch_month = '{m}', fetch_day = '{d}')")
    assert spark.table(own).count() == 997
    assert sync_partitions(spark, own, newer=True) == 1
    assert sync_partitions(spark, own) == 2 and sync_partitions(spark, own) == 0
    listed = [sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {t}").collect()) for t in (own, repaired)]
    assert listed[0] == listed[1] and len(listed[0]) == 1000
    assert rows(spark.table(own)) == rows(spark.table(repaired))
