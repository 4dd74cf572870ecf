"""Publishing landed files as catalog tables."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from firstpour import storage
from firstpour.functions.naming import bronze_name_column
from firstpour.functions.stamp import PARTITION_COLUMNS
from firstpour.functions.text import text_literal
from firstpour.operators.land import Landed, drop_other_runs, increments


def _ddl(schema: StructType) -> str:
    """Column list for CREATE TABLE; columns are nullable, as a later batch may lack them."""
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields]).toDDL()


def is_partitioned(spark: SparkSession, table: str) -> bool:
    described = spark.sql(f"DESCRIBE TABLE {table}").collect()
    return any(row["col_name"] == "# Partition Information" for row in described)


# Table property with the columns that came after the table's creation, as a schema in JSON.
LATER = "later_columns"


def later_columns(spark: SparkSession, table: str) -> StructType:
    """Columns of batches that came after the first, with the type they first had."""
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == LATER).first()
    return StructType.fromJson(json.loads(found["value"])) if found else StructType([])


def _note_later(spark: SparkSession, table: str, batch: StructType) -> None:
    known = later_columns(spark, table)
    names = {f.name.lower() for f in [*spark.table(table).schema.fields, *known.fields]}
    new = [StructField(f.name, f.dataType, True) for f in batch.fields if f.name.lower() not in names]
    if new:
        text = text_literal(StructType([*known.fields, *new]).json())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{LATER}' = {text})")


def table_schema(spark: SparkSession, table: str) -> StructType | None:
    """Data columns of an existing table, later ones included, without the partition columns."""
    if not spark.catalog.tableExists(table):
        return None
    own = [f for f in spark.table(table).schema.fields if f.name not in PARTITION_COLUMNS]
    return StructType([*own, *later_columns(spark, table).fields])


def _same_columns(a: StructType, b: StructType) -> bool:
    return [(f.name, f.dataType) for f in a.fields] == [(f.name, f.dataType) for f in b.fields]


def publish_full(spark: SparkSession, table: str, landed: Landed) -> None:
    """Point the table at the newest snapshot. With unchanged columns that is one metadata update,
    so readers never miss the table; otherwise it is dropped, files kept, and created anew."""
    unchanged = (
        spark.catalog.tableExists(table)
        and not is_partitioned(spark, table)
        and _same_columns(spark.table(table).schema, landed.schema)
    )
    if unchanged:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {text_literal(landed.path)}")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(
            f"CREATE TABLE {table} ({_ddl(landed.schema)}) USING parquet LOCATION {text_literal(landed.path)}"
        )
    drop_other_runs(spark, landed.path)


def create_partitioned(spark: SparkSession, table: str, path: str, schema: StructType) -> None:
    """Create the table with the first batch's columns and text partitions. It shows no rows until
    its partitions are synchronised."""
    days = ", ".join(f"{c} STRING" for c in PARTITION_COLUMNS)
    spark.sql(
        f"CREATE TABLE {table} ({_ddl(schema)}, {days}) USING parquet "
        f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION {text_literal(path)}"
    )


def sync_partitions(
    spark: SparkSession, table: str, partition: Mapping[str, str] | None = None, newer: bool = False
) -> int:
    """Register partitions that exist as folders; returns how many were looked at as unknown.

    A load knows the one partition it wrote, and adding that is a single catalog call whatever the
    length of the history. Without a partition the day folders are compared with the catalog: one
    listing a month, of folders only, and only what the catalog lacks is added. With ``newer`` only
    days from the catalog's last one on are listed, a month or two.
    """
    if partition:
        unknown = [dict(partition)]
    else:
        known = {row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        last = max((name.rpartition("=")[2] for name in known), default="") if newer else ""
        folders = _days(spark, _location(spark, table), last)
        unknown = [dict(part.split("=", 1) for part in day.split("/")) for day in folders if day not in known]
    for first in range(0, len(unknown), 100):
        specs = " ".join(
            "PARTITION (" + ", ".join(f"{name} = {text_literal(value)}" for name, value in day.items()) + ")"
            for day in unknown[first : first + 100]
        )
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    spark.catalog.refreshTable(table)
    return len(unknown)


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    # The table's details follow its columns, one of which may have the same name.
    return described[-1]["data_type"]


def _days(spark: SparkSession, path: str, first: str = "") -> Iterator[str]:
    """Day folders, as year/month/day below a table's folder, oldest first, from a day on; folders of
    earlier years and months are not opened."""

    def below(folder: str, name: str, size: int) -> list[str]:
        names = [n for n in storage.children(spark, folder) if n.startswith(f"{name}=")]
        return [n for n in names if n.partition("=")[2] >= first[:size]]

    names = PARTITION_COLUMNS
    for year in below(path, names[0], 4):
        for month in below(f"{path}/{year}", names[1], 6):
            for day in below(f"{path}/{year}/{month}", names[2], 8):
                yield f"{year}/{month}/{day}"


def _day_folders(spark: SparkSession, path: str) -> Iterator[str]:
    """Day partitions holding files, oldest first."""
    for year in storage.children(spark, path):
        for month in storage.children(spark, f"{path}/{year}"):
            for day in storage.children(spark, f"{path}/{year}/{month}"):
                folder = f"{path}/{year}/{month}/{day}"
                if any(name.endswith(".parquet") for name in storage.children(spark, folder)):
                    yield folder


def _snapshots(spark: SparkSession, path: str) -> Iterator[str]:
    """Completely written snapshots, newest first: run folders are named by their time."""
    for day in reversed(storage.children(spark, path)):
        for run in reversed(storage.children(spark, f"{path}/{day}")):
            if storage.exists(spark, f"{path}/{day}/{run}/_SUCCESS"):
                yield f"{path}/{day}/{run}"


def attach(spark: SparkSession, table: str, folder: str, incremental: bool) -> None:
    """Register a table this catalog does not know although earlier loads landed its files, as
    after a restart with a catalog that does not outlive its session. Without it an empty batch
    would look like the first one, and its watermark would be lost."""
    if spark.catalog.tableExists(table):
        return
    path = increments(folder) if incremental else f"{folder}/snapshots"
    found = next(_day_folders(spark, path) if incremental else _snapshots(spark, path), None)
    if found is None:
        return
    schema = spark.read.parquet(found).schema
    if incremental:
        create_partitioned(spark, table, path, schema)
        sync_partitions(spark, table)
    else:
        spark.sql(f"CREATE TABLE {table} ({_ddl(schema)}) USING parquet LOCATION {text_literal(found)}")


def publish(
    spark: SparkSession,
    table: str,
    landed: Landed,
    incremental: bool,
    partition: Mapping[str, str] | None = None,
) -> str:
    """Make landed files visible; returns what was done."""
    if landed.rows == 0:
        return "nothing"
    if not incremental:
        publish_full(spark, table, landed)
        return "recreate"
    if spark.catalog.tableExists(table):
        sync_partitions(spark, table, partition)
        _note_later(spark, table, landed.schema)
        return "sync"
    create_partitioned(spark, table, landed.path, landed.schema)
    sync_partitions(spark, table)
    return "create_partitioned"


def publish_decision(landings: DataFrame, catalog: DataFrame) -> DataFrame:
    """The same decision over a whole control table.

    ``landings`` is a control table with ``n_files``, the number of files landed for each source;
    ``catalog`` lists existing tables in ``table_name``.
    """
    named = landings.withColumn(
        "table_name",
        bronze_name_column(
            F.col("SRC_TYPE"), F.col("SRC_NAME"), F.col("SRC_ORIGIN_NAME"), F.col("SRC_OBJECT_NAME")
        ),
    )
    known = catalog.select("table_name").distinct().withColumn("known", F.lit(True))
    incremental = F.coalesce(F.col("SRC_FLAG_INCR"), F.lit(0)) != 0
    return named.join(known, "table_name", "left").withColumn(
        "decision",
        F.when(F.coalesce(F.col("n_files"), F.lit(0)) == 0, "nothing")
        .when(incremental & F.col("known"), "sync")
        .when(incremental, "create_partitioned")
        .otherwise("recreate"),
    ).drop("known")
