"""The plans Spark makes of the operators: what reaches the scan, what is shuffled, what is sorted."""

import pytest
from pyspark.sql import functions as F

from firstpour.functions import partition_values
from firstpour.functions.charset import force_encode
from firstpour.operators.land import WriteOptions, land_full, land_incremental
from firstpour.operators.metrics import high_watermark
from firstpour.operators.predicates import select_rows, since
from firstpour.operators.publish import publish
from firstpour.operators.state import SCHEMA, latest_state
from firstpour.sources import landed_files, read_bronze, scan_parquet
from tests.conftest import DAY_1, DAY_2, SF

EVENTS = f"{SF}/events.parquet"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def last_write(spark) -> str:
    """Plan of the write that ran last."""
    executions = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [executions.apply(i).physicalPlanDescription() for i in range(executions.size())]
    return [p for p in plans if p and "InsertIntoHadoopFsRelationCommand" in p][-1]  # an execution may be without its plan yet


def test_watermark_and_constraint_reach_the_parquet_scan(spark):
    df = select_rows(scan_parquet(spark, EVENTS), "WHERE event_type = 'click'", "ts", "2024-01-15 00:00:00")
    assert "GreaterThan(ts," in plan(df) and "EqualTo(event_type,click)" in plan(df)


def test_columns_are_pruned(spark):
    df = since(scan_parquet(spark, EVENTS, ["event_id", "ts"]), "ts", "2024-01-15 00:00:00")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan(df)


@pytest.fixture
def bronze(spark, config):
    table = f"`{config.schema}`.events"
    events = scan_parquet(spark, EVENTS)
    for batch, day in ((events.where("event_id % 2 = 0"), DAY_1), (events.where("event_id % 2 = 1"), DAY_2)):
        publish(spark, table, land_incremental(batch, f"{config.root}/events", day, "ts"), True, partition_values(day))
    return read_bronze(spark, table)


def test_day_filter_prunes_partitions(spark, bronze):
    found = plan(bronze.where("fetch_day = '20240116'"))
    assert "PartitionFilters: [isnotnull(fetch_day" in found and "(fetch_day" in found.split("PartitionFilters")[1]
    assert len(bronze.where("fetch_day = '20240116'").inputFiles()) < len(bronze.inputFiles())


def test_high_watermark_reads_one_column(spark, bronze):
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan(high_watermark(bronze, "ts"))


def test_incremental_write_neither_shuffles_nor_sorts(spark, config):
    land_incremental(since(scan_parquet(spark, EVENTS), "ts", "2024-01-15 00:00:00"), f"{config.root}/e", DAY_1, "ts")
    written = last_write(spark)
    assert "Exchange" not in written and "Sort" not in written
    assert "GreaterThan(ts," in written


def test_full_write_neither_shuffles_nor_sorts(spark, config):
    land_full(scan_parquet(spark, EVENTS), f"{config.root}/f", DAY_1)
    assert "Exchange" not in last_write(spark) and "Sort" not in last_write(spark)


def test_rebalanced_write_counts_after_its_shuffle(spark, config):
    """Metrics below the shuffle would be counted again when a lost executor's tasks are rerun."""
    land_full(scan_parquet(spark, EVENTS), f"{config.root}/g", DAY_1, None, WriteOptions(rebalance=True))
    written = last_write(spark)
    assert "rebalance" in written.lower()
    assert written.index("CollectMetrics") < written.index("Exchange")


def test_column_functions_stay_in_the_jvm(spark):
    df = force_encode(scan_parquet(spark, EVENTS), "ISO-8859-1")
    assert "Python" not in plan(df) and "Exchange" not in plan(df)


def test_state_is_combined_before_its_shuffle(spark):
    found = plan(latest_state(spark.createDataFrame([], SCHEMA)))
    assert "partial_max" in found and found.count("Exchange hashpartitioning") == 1


def test_inventory_reads_no_file_content(spark):
    assert "content" not in plan(landed_files(spark, SF))
    assert landed_files(spark, SF).where(F.col("bytes") > 0).count() == 14
