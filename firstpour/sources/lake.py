"""Parquet tables as sources, and the published bronze tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from firstpour.functions.stamp import PARTITION_COLUMNS
from firstpour.operators.publish import later_columns


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All columns by default; a shorter list reaches the scan as its read schema."""
    return spark.read.parquet(path).select(*(columns or ["*"]))


def read_bronze(spark: SparkSession, table: str, merge_schema: bool = False) -> DataFrame:
    """A published table with the columns it was created with.

    Files landed later may hold more columns; those show only with ``merge_schema``. Only days the
    catalog knows are read, so rows landed but not published yet do not show.
    """
    fixed, later = spark.table(table), later_columns(spark, table)
    if not merge_schema or not later.fields:
        return fixed
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    # The table's details follow its columns, one of which may have the same name.
    location = described[-1]["data_type"]
    wide = spark.read.schema(StructType([*fixed.schema.fields, *later.fields])).parquet(location)
    last = PARTITION_COLUMNS[-1]
    days = [r[0].rpartition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return wide.where(F.col(last).isin(days)) if days else wide.limit(0)
