"""Registered queries, one or more per operator, each with SQL that gives the same rows.

Every query reads the tables below ``sf_dir`` whole, or data Spark derives from them. What a query
lands goes to a fresh folder under ``spark.checkpoint.dir``; run times are fixed, so results are
too.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterator
from dataclasses import replace
from datetime import datetime, timezone
from itertools import chain, combinations

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firstpour import BronzeConfig, JdbcDatabase, LakeDatabase, LoadResult, Source, Split, load, run, storage
from firstpour import testing
from firstpour.functions.charset import code_page
from firstpour.functions import (
    all_string as cast_all,
    bronze_name_column,
    force_encode as repair,
    partition_values,
    stamp,
    with_fetch_partitions,
)
from firstpour.operators import ledger, load_log as logs, records, state
from firstpour.operators.footers import footer_watermark
from firstpour.operators.land import WriteOptions, land_full as land_snapshot, land_incremental as land_batch
from firstpour.operators.merge import merge_chunks as merge
from firstpour.operators.metrics import high_watermark as highest
from firstpour.operators.predicates import constrain, select_rows, since
from firstpour.operators.publish import (
    create_partitioned,
    publish,
    publish_decision as decide,
    sync_partitions as synchronise,
    table_schema,
)
from firstpour.plans.load import prepare, read_database
from firstpour.sources import (
    active_sources,
    decode_sheets,
    inventory,
    landed_files,
    read_bronze,
    scan_jdbc as read_jdbc,
    scan_parquet,
)

cloudpickle.register_pickle_by_value(testing)

DAY_1 = datetime(2024, 1, 15, 10, tzinfo=timezone.utc)
DAY_2 = datetime(2024, 1, 16, 10, tzinfo=timezone.utc)
DAY_3 = datetime(2024, 1, 17, 10, tzinfo=timezone.utc)
LATER_ON_DAY_1 = datetime(2024, 1, 15, 18, tzinfo=timezone.utc)


# ---------------------------------------------------------------- helpers


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir}/{name}.parquet")


def _config(spark: SparkSession, sf_dir: str, **options) -> BronzeConfig:
    """A bronze layer of its own, with the tables below ``sf_dir`` as source database ``SRC``."""
    root = storage.scratch(spark, "bronze")
    config = BronzeConfig(
        environment="TEST",
        root=root,
        databases={"SRC": LakeDatabase(f"{sf_dir}/{{object}}.parquet")},
        database=root.rpartition("/")[2].replace("-", "_"),
        **options,
    )
    prepare(spark, config)
    return config


def _utc(df: DataFrame, column: str) -> Column:
    """A timestamp as UTC wall clock, whatever the session zone."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    return F.to_utc_timestamp(column, zone).cast("timestamp_ntz")


def _plain(df: DataFrame) -> DataFrame:
    return df.withColumn("fetch_date", _utc(df, "fetch_date"))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control table with one source per customer."""
    return _table(spark, sf_dir, "customer").select(
        F.when(F.col("c_nationkey") < 5, "FILE").otherwise("DB").alias("SRC_TYPE"),
        F.col("c_mktsegment").alias("SRC_NAME"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("SRC_ORIGIN_NAME"),
        F.replace("c_name", F.lit("#"), F.lit(" ")).alias("SRC_OBJECT_NAME"),
        F.when(F.col("c_acctbal") >= 0, 1).otherwise(0).alias("SRC_FLAG_ACTIV"),
        F.when(F.col("c_nationkey") >= 20, None)
        .when(F.col("c_mktsegment") == "BUILDING", 1)
        .otherwise(0)
        .alias("SRC_FLAG_INCR"),
        F.col("c_custkey"),
    )


MANIFEST_SQL = """
    SELECT CASE WHEN c_nationkey < 5 THEN 'FILE' ELSE 'DB' END AS "SRC_TYPE",
           c_mktsegment AS "SRC_NAME",
           'N' || CAST(c_nationkey AS VARCHAR) AS "SRC_ORIGIN_NAME",
           replace(c_name, '#', ' ') AS "SRC_OBJECT_NAME",
           CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS "SRC_FLAG_ACTIV",
           CASE WHEN c_nationkey >= 20 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS "SRC_FLAG_INCR",
           c_custkey
    FROM customer
"""

NAME_SQL = """
    CASE WHEN "SRC_TYPE" = 'FILE'
         THEN concat_ws('_', "SRC_NAME", replace("SRC_OBJECT_NAME", ' ', '_'))
         ELSE concat_ws('_', "SRC_NAME", "SRC_ORIGIN_NAME", replace("SRC_OBJECT_NAME", ' ', '_')) END
"""


def _derby(spark: SparkSession, sf_dir: str, split: Split | None) -> JdbcDatabase:
    """``orders`` in an embedded database, which only the process that opened it can see: JDBC
    queries run on a local session."""
    # the path alone: after "jdbc:derby:" two slashes, as in "file:///", would name a server
    path = spark._jvm.org.apache.hadoop.fs.Path(storage.scratch(spark, "derby")).toUri().getPath()
    database = JdbcDatabase(
        url=f"jdbc:derby:{path};create=true",
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
        splits={"orders": split} if split else {},
    )
    orders, texts = _table(spark, sf_dir, "orders"), ("o_orderstatus", "o_orderpriority")
    # Spark writes null text as a CLOB, which Derby takes for no other type: such rows go in without the column
    for absent in chain.from_iterable(combinations(texts, n) for n in range(len(texts) + 1)):
        (
            orders.where(" AND ".join(f"{c} IS {'' if c in absent else 'NOT '}NULL" for c in texts))
            .drop(*absent)
            .write.mode("append")
            .option("createTableColumnTypes", "o_orderstatus VARCHAR(1), o_orderpriority VARCHAR(20)")
            .option("batchsize", 10_000)
            .jdbc(database.url, "orders", properties={"driver": database.driver})
        )
    return database


# ---------------------------------------------------------------- scans


def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders")


def scan_jdbc(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _derby(spark, sf_dir, Split(4, column="o_orderkey"))
    return read_jdbc(spark, database, "", "orders")


def scan_jdbc_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _derby(spark, sf_dir, Split(4, expression='MOD("o_custkey", 4)'))
    return read_jdbc(
        spark,
        database,
        "",
        "orders",
        where="WHERE \"o_orderstatus\" = 'F' OR \"o_orderstatus\" = 'O'",
        criteria="o_orderdate",
        last="1998-01-01 00:00:00",
    )


def scan_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers through workbooks of up to 2,000 rows each, with one title row above the header."""

    def books(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                part = batch.slice(start, 2_000)
                rows = {1: ["Customers"], 2: list(batch.schema.names)}
                cells = zip(*[column.to_pylist() for column in part.columns])
                rows.update({3 + i: [testing.Shared(v) if isinstance(v, str) else v for v in c] for i, c in enumerate(cells)})
                content = testing.workbook({"My Sheet": rows})
                yield pa.RecordBatch.from_pydict(
                    {"path": pa.array(["derived"]), "content": pa.array([content], pa.binary())}
                )

    made = _table(spark, sf_dir, "customer").mapInArrow(books, "path string, content binary")
    folder = storage.scratch(spark, "books")
    made.write.parquet(folder)  # the workbooks are made once and spread over tasks
    return decode_sheets(spark.read.parquet(folder).hint("rebalance"), "My Sheet", skip_rows=1)


def manifest_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_sources(_manifest(spark, sf_dir))


def bronze_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    config, table = _two_event_days(spark, sf_dir)
    return _plain(read_bronze(spark, table).where("fetch_day = '20240116'"))


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _config(spark, sf_dir)
    lineitem = _table(spark, sf_dir, "lineitem")
    landed = land_snapshot(lineitem, f"{config.root}/lineitem", DAY_1, options=WriteOptions(files=8))
    files = landed_files(spark, f"{config.root}/lineitem")
    return inventory(files, "part-").withColumn("n_rows", F.lit(landed.rows).cast("bigint"))


# ---------------------------------------------------------------- functions


def force_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose UTF-8 bytes were read as Latin-1, repaired."""
    documents = _table(spark, sf_dir, "documents")
    misread = documents.withColumn("text", F.decode(F.encode("text", "UTF-8"), "ISO-8859-1"))
    return repair(misread, "ISO-8859-1")


def all_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_all(_table(spark, sf_dir, "lineitem"))


def fetch_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(stamp(_table(spark, sf_dir, "events"), DAY_1))


def fetch_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day partitions of events taken as fetched at their own time."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    fetched = F.from_utc_timestamp(F.col("ts").cast("timestamp"), zone)
    return _plain(with_fetch_partitions(_table(spark, sf_dir, "events").withColumn("fetch_date", fetched)))


def target_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = bronze_name_column(
        F.col("SRC_TYPE"), F.col("SRC_NAME"), F.col("SRC_ORIGIN_NAME"), F.col("SRC_OBJECT_NAME")
    )
    return _manifest(spark, sf_dir).select("c_custkey", name.alias("table_name"))


# ---------------------------------------------------------------- predicates


def constraint_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constrain(_table(spark, sf_dir, "orders"), "WHERE o_orderstatus = 'F'")


def watermark_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return since(_table(spark, sf_dir, "events"), "ts", "2024-01-15 00:00:00")


def constraint_and_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_rows(
        _table(spark, sf_dir, "orders"),
        "WHERE o_orderstatus = 'F' OR o_orderstatus = 'O'",
        "o_orderdate",
        "1998-01-01 00:00:00",
    )


def state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events taken as watermark records, one source per event type and user."""
    events = _table(spark, sf_dir, "events")
    found = events.select(
        F.col("event_type").alias("src_name"),
        F.lit("USERS").alias("src_origin_name"),
        F.col("user_id").cast("string").alias("src_object_name"),
        F.when(F.col("value") < 50, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("value"),
        F.lit("timestamp_ntz").alias("type"),
        F.from_utc_timestamp(
            F.col("ts").cast("timestamp"), spark.conf.get("spark.sql.session.timeZone")
        ).alias("updated_at"),
    )
    latest = state.latest_state(found)
    return latest.withColumn("updated_at", _utc(latest, "updated_at"))


# ---------------------------------------------------------------- metrics and merge


def high_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    config, table = _two_event_days(spark, sf_dir)
    return highest(read_bronze(spark, table), "ts")


def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _config(spark, sf_dir)
    landed = land_snapshot(_table(spark, sf_dir, "events"), f"{config.root}/events", DAY_1, "ts")
    metrics = spark.createDataFrame([(landed.rows, landed.high)], "n bigint, high string")
    return metrics.withColumn("high", F.col("high").cast("timestamp_ntz"))


def merge_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three chunks, the last of which lacks a column."""
    events = _table(spark, sf_dir, "events")
    return merge(
        [
            events.where("value < 10"),
            events.where("value >= 10 AND value < 50"),
            events.where("value >= 50 OR value IS NULL").drop("props"),
        ]
    )


# ---------------------------------------------------------------- landing and publishing


def land_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _config(spark, sf_dir)
    options = WriteOptions("none", 50_000)
    landed = land_snapshot(_table(spark, sf_dir, "lineitem"), f"{config.root}/lineitem", DAY_1, None, options)
    return _plain(spark.read.parquet(landed.path))


def land_full_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots on one day: all that the folder still holds is the second."""
    config = _config(spark, sf_dir)
    orders = _table(spark, sf_dir, "orders")
    folder, table = f"{config.root}/orders", f"`{config.schema}`.orders"
    publish(spark, table, land_snapshot(orders.where("o_orderstatus = 'F'"), folder, DAY_1), False)
    publish(spark, table, land_snapshot(orders, folder, LATER_ON_DAY_1), False)
    return _plain(spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/snapshots"))


def publish_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshots: the second has the columns of the first, the third has one less."""
    config = _config(spark, sf_dir)
    customers = _table(spark, sf_dir, "customer")
    folder, table = f"{config.root}/customer", f"`{config.schema}`.customer"
    publish(spark, table, land_snapshot(customers.where("c_acctbal < 0"), folder, DAY_1), False)
    publish(spark, table, land_snapshot(customers, folder, LATER_ON_DAY_1), False)
    publish(spark, table, land_snapshot(customers.drop("c_mktsegment"), folder, DAY_2), False)
    return _plain(read_bronze(spark, table))


def _two_event_days(spark: SparkSession, sf_dir: str) -> tuple[BronzeConfig, str]:
    """Events up to 15 January landed on day 1, the later ones on day 2, published after each."""
    config = _config(spark, sf_dir)
    events = _table(spark, sf_dir, "events")
    folder, table = f"{config.root}/events", f"`{config.schema}`.events"
    for batch, day in (
        (events.where("ts <= TIMESTAMP_NTZ '2024-01-15 00:00:00'"), DAY_1),
        (since(events, "ts", "2024-01-15 00:00:00"), DAY_2),
    ):
        publish(spark, table, land_batch(batch, folder, day, "ts"), True, partition_values(day))
    return config, table


def land_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches into the same day: the second adds to the first."""
    config = _config(spark, sf_dir)
    orders = _table(spark, sf_dir, "orders")
    first = land_batch(orders.where("o_orderdate <= '1998-01-01'"), f"{config.root}/orders", DAY_1)
    land_batch(orders.where("o_orderdate > '1998-01-01'"), f"{config.root}/orders", LATER_ON_DAY_1)
    landed = spark.read.parquet(first.path)
    return _plain(landed.withColumns({c: F.col(c).cast("string") for c in partition_values(DAY_1)}))


def publish_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    config, table = _two_event_days(spark, sf_dir)
    return _plain(read_bronze(spark, table))


def sync_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table created over two landed days that no catalog knows of yet."""
    config = _config(spark, sf_dir)
    lineitem = _table(spark, sf_dir, "lineitem")
    folder, table = f"{config.root}/lineitem", f"`{config.schema}`.lineitem"
    landed = land_batch(lineitem.where("l_shipdate < '1998-01-01'"), folder, DAY_1)
    land_batch(lineitem.where("l_shipdate >= '1998-01-01'"), folder, DAY_2)
    create_partitioned(spark, table, landed.path, landed.schema)
    synchronise(spark, table)
    return _plain(read_bronze(spark, table))


def publish_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source per customer, one landed file per order; tables exist for customers with a
    finished order."""
    manifest, orders = _manifest(spark, sf_dir), _table(spark, sf_dir, "orders")
    files = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_files"))
    finished = orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    name = bronze_name_column(
        F.col("SRC_TYPE"), F.col("SRC_NAME"), F.col("SRC_ORIGIN_NAME"), F.col("SRC_OBJECT_NAME")
    )
    catalog = manifest.join(finished, "c_custkey", "left_semi").select(name.alias("table_name"))
    decided = decide(manifest.join(files, "c_custkey", "left"), catalog)
    return decided.select("c_custkey", "table_name", "n_files", "decision")


def empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that selects no row leaves the table as it was."""
    config = _config(spark, sf_dir)
    source = Source("DB", "SRC", "MAIN", "supplier")
    result = load(spark, config, source, DAY_1)
    load(spark, config, replace(source, constraint="WHERE s_acctbal > 1e12"), DAY_2)
    return _plain(read_bronze(spark, result.table))


def schema_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first batch lacks a column the second has: the table keeps the first batch's columns."""
    config = _config(spark, sf_dir)
    events = _table(spark, sf_dir, "events")
    folder, table = f"{config.root}/events", f"`{config.schema}`.events"
    for batch, day in (
        (events.where("ts <= TIMESTAMP_NTZ '2024-01-15 00:00:00'").drop("props"), DAY_1),
        (since(events, "ts", "2024-01-15 00:00:00"), DAY_2),
    ):
        publish(spark, table, land_batch(batch, folder, day), True, partition_values(day))
    return _plain(read_bronze(spark, table))


def schema_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table read with the columns of all files."""
    config = _config(spark, sf_dir)
    events = _table(spark, sf_dir, "events")
    folder, table = f"{config.root}/events", f"`{config.schema}`.events"
    for batch, day in (
        (events.where("ts <= TIMESTAMP_NTZ '2024-01-15 00:00:00'").drop("props"), DAY_1),
        (since(events, "ts", "2024-01-15 00:00:00"), DAY_2),
    ):
        publish(spark, table, land_batch(batch, folder, day), True, partition_values(day))
    land_batch(events, folder, DAY_3)  # landed but not published: must not show
    return _plain(read_bronze(spark, table, merge_schema=True))


def type_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem in two batches, the second in wider types whose values fit the table's."""
    config = _config(spark, sf_dir)
    lines = _table(spark, sf_dir, "lineitem")
    folder, table = f"{config.root}/lineitem", f"`{config.schema}`.lineitem"
    early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    publish(spark, table, land_batch(lines.where(early), folder, DAY_1), True, partition_values(DAY_1))
    wider = lines.where(~early).withColumns(
        {
            "l_orderkey": F.col("l_orderkey").cast("decimal(20,0)"),
            "l_linenumber": F.col("l_linenumber").cast("string"),
            "l_quantity": F.col("l_quantity").cast("decimal(20,6)"),
            "l_shipdate": F.col("l_shipdate").cast("string"),
        }
    )
    landed = land_batch(wider, folder, DAY_2, schema=table_schema(spark, table))
    publish(spark, table, landed, True, partition_values(DAY_2))
    return read_bronze(spark, table).select(*lines.columns)


# ---------------------------------------------------------------- pipelines


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[BronzeConfig, LoadResult]:
    """Orders up to 1998 on day 1, then on day 2 whatever lies past the stored watermark."""
    config = _config(spark, sf_dir)
    source = Source("DB", "SRC", "MAIN", "orders", "WHERE o_orderdate <= '1998-01-01'", True, "o_orderdate")
    load(spark, config, source, DAY_1)
    return config, load(spark, config, replace(source, constraint=None), DAY_2)


def incremental_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    config, result = _two_loads(spark, sf_dir)
    return read_bronze(spark, result.table).drop("fetch_date", "fetch_year", "fetch_month")


def _writable(spark: SparkSession, **options) -> tuple[BronzeConfig, str]:
    """A bronze layer whose source tables are folders the query fills."""
    config = _config(spark, storage.scratch(spark, "source"), **options)
    folder = storage.scratch(spark, "tables")
    return replace(config, databases={"SRC": LakeDatabase(f"{folder}/{{object}}")}), folder


def watermark_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events loaded twice by a floating value, some of them not a number."""
    config, folder = _writable(spark)
    events = _table(spark, sf_dir, "events")
    odd = F.col("event_id") % 10 == 3
    events = events.withColumn("value", F.when(odd, F.lit(float("nan"))).otherwise(F.col("value")))
    source = Source("DB", "SRC", "MAIN", "events", None, True, "value")
    events.where("isnan(value) or value <= 50").write.parquet(f"{folder}/events")
    load(spark, config, source, DAY_1)
    events.where("not isnan(value)").write.mode("overwrite").parquet(f"{folder}/events")
    result = load(spark, config, source, DAY_2)
    return read_bronze(spark, result.table).select("event_id", F.when(~F.isnan("value"), F.col("value")).alias("value"))


def shared_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources into one table, their keys interleaved, each loaded twice."""
    config, folder = _writable(spark)
    orders = _table(spark, sf_dir, "orders")
    low, high = F.col("o_orderkey") % 2 == 0, F.col("o_totalprice") > 100_000
    for name, part, days in (("a b", low, (DAY_1, DAY_2)), ("a_b", ~low, (LATER_ON_DAY_1, DAY_3))):
        source = Source("DB", "SRC", "MAIN", name, None, True, "o_totalprice")
        orders.where(part & ~high).write.parquet(f"{folder}/{name}")
        load(spark, config, source, days[0])
    for name, part, days in (("a b", low, (DAY_1, DAY_2)), ("a_b", ~low, (LATER_ON_DAY_1, DAY_3))):
        source = Source("DB", "SRC", "MAIN", name, None, True, "o_totalprice")
        orders.where(part).write.mode("overwrite").parquet(f"{folder}/{name}")
        result = load(spark, config, source, days[1])
    return read_bronze(spark, result.table).select(*orders.columns)


def interrupted_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load that landed its rows and got no further, then one that makes up for it."""
    config = _config(spark, sf_dir, reconcile=True)
    source = Source("DB", "SRC", "MAIN", "orders", None, True, "o_orderdate")
    orders = _table(spark, sf_dir, "orders")
    opened = ledger.begin(spark, config.notes_path, config.folder(source), source.key, DAY_1)
    land_batch(orders, config.folder(source), DAY_1, "o_orderdate", run=opened)
    result = load(spark, config, source, DAY_2)
    return read_bronze(spark, result.table).select(*orders.columns)


def interrupted_shared_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources into one table at one time: one is lost between landing and its state record, and
    the next loads of both make up for it."""
    config, folder = _writable(spark, reconcile=True)
    orders = _table(spark, sf_dir, "orders")
    sources = [Source("DB", "SRC", "MAIN", name, None, True, "o_orderkey") for name in ("a b", "a_b")]
    for rest, source in enumerate(sources):
        orders.where(F.col("o_orderkey") % 2 == rest).write.parquet(f"{folder}/{source.object}")
    load(spark, config, sources[0], DAY_1)
    lost = sources[1]
    opened = ledger.begin(spark, config.notes_path, config.folder(lost), lost.key, DAY_1)
    landed = land_batch(scan_parquet(spark, f"{folder}/a_b"), config.folder(lost), DAY_1, "o_orderkey", run=opened)
    ledger.enter(spark, config.ledger_path, opened, landed.files)
    publish(spark, config.table(lost), landed, True, partition_values(DAY_1))
    for source in sources:
        result = load(spark, config, source, DAY_2)
    return read_bronze(spark, result.table).select(*orders.columns)


def load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and days of arrival of the files that the ledger has for two loads of orders."""
    config, result = _two_loads(spark, sf_dir)
    entered = ledger.read_ledger(spark, config.ledger_path)
    held = spark.table(result.table).groupBy(F.col("_metadata.file_name").alias("file"), "fetch_day").agg(F.count(F.lit(1)).alias("n"))
    joined = entered.join(held, "file", "full")
    return joined.groupBy("src_object_name", F.date_format(_utc(joined, "run_ts"), "yyyyMMdd").alias("run_day"), "fetch_day").agg(
        F.sum("n").alias("n_rows")
    )


def state_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as watermark records, appended in four batches with folds in between."""
    config = _config(spark, sf_dir)
    events = _table(spark, sf_dir, "events")
    stamped = F.from_utc_timestamp(F.col("ts").cast("timestamp"), spark.conf.get("spark.sql.session.timeZone"))
    made = events.select(
        F.col("event_type").alias("src_name"), F.lit("USERS").alias("src_origin_name"), F.col("user_id").cast("string").alias("src_object_name"),
        F.col("event_id").cast("string").alias("value"), F.lit("bigint").alias("type"), stamped.alias("updated_at"),
        F.lit(None).cast("string").alias("run"), "event_id",
    )
    for part in range(4):
        records.append_records(made.where(F.col("event_id") % 4 == part).drop("event_id"), config.state_path)
        state.compact_state(spark, config.state_path, config.notes_path, grace=3600.0 if part % 2 else 0.0)
    latest = state.latest_state(state.read_state(spark, config.state_path))
    return latest.select("src_name", "src_object_name", "value", _utc(latest, "updated_at").alias("updated_at"))


def watermark_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the two loads above left as the current watermark."""
    config, _ = _two_loads(spark, sf_dir)
    latest = state.latest_state(state.read_state(spark, config.state_path))
    return latest.select(
        "src_name",
        "src_origin_name",
        "src_object_name",
        F.col("value").cast("timestamp_ntz").alias("value"),
        _utc(latest, "updated_at").alias("updated_at"),
    )


def full_load_with_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load whose control row holds a watermark is filtered by it too."""
    config = _config(spark, sf_dir)
    source = Source("DB", "SRC", "MAIN", "events", None, False, "ts", "2024-01-20 00:00:00")
    return _plain(read_bronze(spark, load(spark, config, source, DAY_1).table))


MANIFEST_ROWS = [
    # type, name, origin, object, constraint, active, incremental, criteria, last update
    ("DB", "SRC", "MAIN", "nation", None, 1, "0", None, None),
    ("DB", "SRC", "MAIN", "supplier", "WHERE s_acctbal >= 0", 1, None, None, None),
    ("DB", "SRC", "MAIN", "customer", None, 1, "0", None, None),
    ("DB", "SRC", "MAIN", "orders", "WHERE o_orderstatus = 'F' OR o_orderstatus = 'O'", 1, "1", "o_orderdate", "1998-01-01 00:00:00"),
    ("DB", "SRC", "MAIN", "lineitem", None, 1, "1", "l_shipdate", None),
    ("DB", "SRC", "MAIN", "events", None, 1, "1", "ts", "2024-01-15 00:00:00"),
    ("DB", "SRC", "MAIN", "part", None, 0, "0", None, None),
    ("DB", "SRC", "MAIN", "documents", "WHERE n_chars < 0", 1, "0", None, None),
    ("DB", "SRC", "MAIN", "region", None, 1, "Y", None, None),
    ("FILE", "CSV", "MAIN", "pages", None, 1, "0", None, None),
]
MANIFEST_SCHEMA = (
    "SRC_TYPE string, SRC_NAME string, SRC_ORIGIN_NAME string, SRC_OBJECT_NAME string, "
    "SRC_OBJECT_CONSTRAINT string, SRC_FLAG_ACTIV int, SRC_FLAG_INCR string, SRC_DATE_CRITERIA string, "
    "SRC_DATE_LASTUPDATE string"
)


def _run(spark: SparkSession, sf_dir: str) -> tuple[BronzeConfig, list[LoadResult]]:
    config = _config(spark, sf_dir)
    manifest = spark.createDataFrame(MANIFEST_ROWS, MANIFEST_SCHEMA)
    return config, run(spark, config, manifest, DAY_1)


def run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in each bronze table after one run over a control table of the given tables."""
    _, results = _run(spark, sf_dir)
    counts = [
        read_bronze(spark, r.table).agg(F.lit(r.source.object).alias("object"), F.count(F.lit(1)).alias("n_rows"))
        for r in results
        if spark.catalog.tableExists(r.table)
    ]
    return merge(counts)


class _Lost(BaseException):
    """Ends a run as the loss of its driver does: no load catches it."""


def resumed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run, cut short at one source and taken up again: rows and times in each bronze table."""

    def lost(spark: SparkSession, config: BronzeConfig, source: Source, last: str | None) -> DataFrame:
        if source.object == "lineitem":
            raise _Lost
        return read_database(spark, config, source, last)

    config = _config(spark, sf_dir, parallel=2)
    manifest = spark.createDataFrame(MANIFEST_ROWS, MANIFEST_SCHEMA)
    try:
        run(spark, replace(config, readers={"DB": lost}), manifest, DAY_1, name="night")
    except _Lost:
        results = run(spark, config, manifest, DAY_2, name="night")
    times = F.countDistinct("fetch_date").alias("n_times")
    counts = [
        read_bronze(spark, r.table).agg(F.lit(r.source.object).alias("object"), F.count(F.lit(1)).alias("n_rows"), times)
        for r in results
        if spark.catalog.tableExists(r.table)
    ]
    return merge(counts)


def code_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose UTF-8 bytes were read as three code pages, each repaired."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    parts = []
    for name in ("windows-1252", "ISO-8859-15", "cp850"):
        latin, page = "".join(map(chr, range(256))), code_page(name)
        moved = [i for i in range(256) if latin[i] != page[i]]
        misread = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
        misread = F.translate(misread, "".join(latin[i] for i in moved), "".join(page[i] for i in moved))
        parts.append(repair(documents.withColumn("text", misread), name).withColumn("page", F.lit(name)))
    return merge(parts)


def watermark_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest values of three columns of a bronze table, from the footers of its files."""
    config, table = _two_event_days(spark, sf_dir)
    bronze = read_bronze(spark, table)
    high = [footer_watermark(bronze, c).withColumnRenamed("high", c) for c in ("ts", "event_id", "value")]
    one, two, three = (h.withColumn("n", F.lit(1)) for h in high)
    return one.join(two, "n").join(three, "n").drop("n")


def counted_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log says of rows that a watermark keeps out and of text that could not be repaired."""
    config, folder = _writable(spark, count_missed=True)
    orders = _table(spark, sf_dir, "orders")
    orders.withColumn("o_orderdate", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))).write.parquet(f"{folder}/orders")
    load(spark, config, Source("DB", "SRC", "MAIN", "orders", None, True, "o_orderdate", "1998-01-01 00:00:00"), DAY_1)
    documents = _table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    odd = F.when(F.col("lang") == "en", F.concat(F.lit("\u0416"), "text")).otherwise(F.decode(F.encode("text", "UTF-8"), "ISO-8859-1"))
    documents.withColumn("text", odd).write.parquet(f"{folder}/documents")
    load(spark, config, Source("DB", "SRC", "MAIN", "documents", force_encode="ISO-8859-1"), DAY_1)
    return logs.read_log(spark, config.log_path).where("ACTION = 'WARNING'").select("SRC_OBJECT_NAME", "ERROR_MESSAGE")


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    config, _ = _run(spark, sf_dir)
    return logs.read_log(spark, config.log_path).select(
        "SRC_NAME", "SRC_ORIGIN_NAME", "SRC_OBJECT_NAME", "SRC_TYPE", "ACTION", "COUNT_ROW", "SQL_REQUEST", "ERROR_TYPE"
    )


# ---------------------------------------------------------------- registration


def entry(spark: SparkSession) -> DataFrame:
    """Two incremental loads of orders: rows and order dates per day of arrival."""
    _, result = _two_loads(spark, "/root/testdata/sf0.001")
    return (
        read_bronze(spark, result.table)
        .groupBy("fetch_day")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("o_orderdate").alias("first_order"),
            F.max("o_orderdate").alias("last_order"),
        )
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = [
        scan_table, scan_jdbc, scan_jdbc_filtered, scan_sheets, manifest_active, bronze_pruned_read,
        file_inventory, force_encode, all_string, fetch_stamp, fetch_partitions, target_names,
        constraint_filter, watermark_filter, constraint_and_watermark, state_latest, high_watermark,
        batch_metrics, merge_chunks, land_full, land_full_rerun, publish_full, land_incremental,
        publish_incremental, sync_partitions, publish_decision, empty_batch, schema_first, schema_merged,
        incremental_two_batches, watermark_state, full_load_with_watermark, run_manifest, load_log,
        type_drift, watermark_float, shared_table, interrupted_first_load, interrupted_shared_table, load_ledger,
        state_folded, resumed_run, code_pages, watermark_footers, counted_warnings,
    ]
    return {query.__name__: query for query in registered} | _llm()[0]


def _llm() -> tuple[dict, dict]:
    """Queries of the training-data operators and their SQL; none where that package is left out."""
    try:
        from firstpour.llm import registry
    except ModuleNotFoundError as missing:
        if (missing.name or "").partition(".llm")[0] != "firstpour":
            raise
        return {}, {}
    found, sql = dict(registry.QUERIES), dict(registry.SQL)
    try:
        import corpus_pipeline
    except ModuleNotFoundError as missing:
        if missing.name != "corpus_pipeline":
            raise
    else:
        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def oracle_sql() -> dict[str, str]:
    day_1 = "TIMESTAMP '2024-01-15 10:00:00' AS fetch_date"
    later = "TIMESTAMP '2024-01-15 18:00:00' AS fetch_date"
    day_2 = "TIMESTAMP '2024-01-16 10:00:00' AS fetch_date"
    by_date = """
        CASE WHEN {0} THEN TIMESTAMP '2024-01-15 10:00:00' ELSE TIMESTAMP '2024-01-16 10:00:00' END AS fetch_date,
        '2024' AS fetch_year, '202401' AS fetch_month,
        CASE WHEN {0} THEN '20240115' ELSE '20240116' END AS fetch_day
    """
    event_days = by_date.format("ts <= TIMESTAMP '2024-01-15 00:00:00'")
    line_days = by_date.format("l_shipdate < TIMESTAMP '1998-01-01 00:00:00'")
    selected = "(o_orderstatus = 'F' OR o_orderstatus = 'O') AND o_orderdate > TIMESTAMP '1998-01-01 00:00:00'"
    log_row = """
        SELECT '{0}' AS "SRC_NAME", 'MAIN' AS "SRC_ORIGIN_NAME", '{1}' AS "SRC_OBJECT_NAME", '{2}' AS "SRC_TYPE",
               '{3}' AS "ACTION", {4} AS "COUNT_ROW", '{5}' AS "SQL_REQUEST", {6} AS "ERROR_TYPE"
    """

    def logged(name: str, where: str, request: str) -> str:
        text = f"SELECT * FROM MAIN.{name}{request}".replace("'", "''")
        return log_row.format("SRC", name, "DB", "SUCCESS", f"(SELECT count(*) FROM {name} WHERE {where})", text, "CAST(NULL AS VARCHAR)")

    none = "CAST(NULL AS VARCHAR)"
    return {
        "scan_table": "SELECT * FROM orders",
        "scan_jdbc": "SELECT * FROM orders",
        "scan_jdbc_filtered": f"SELECT * FROM orders WHERE {selected}",
        "scan_sheets": """
            SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
                   regexp_replace(CAST(c_acctbal AS VARCHAR), '[.]0$', '') AS c_acctbal, c_mktsegment
            FROM customer
        """,
        "type_drift": "SELECT * FROM lineitem",
        "watermark_float": """
            SELECT event_id, CASE WHEN event_id % 10 <> 3 THEN value END AS value FROM events
        """,
        "shared_table": "SELECT * FROM orders",
        "interrupted_first_load": "SELECT * FROM orders",
        "interrupted_shared_table": "SELECT * FROM orders",
        "load_ledger": """
            SELECT 'orders' AS src_object_name, day AS run_day, day AS fetch_day, CAST(count(*) AS BIGINT) AS n_rows
            FROM (SELECT CASE WHEN o_orderdate <= TIMESTAMP '1998-01-01 00:00:00' THEN '20240115' ELSE '20240116' END AS day FROM orders)
            GROUP BY day
        """,
        "resumed_run": f"""
            SELECT 'nation' AS object, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_times FROM nation
            UNION ALL SELECT 'supplier', count(*), 1 FROM supplier WHERE s_acctbal >= 0
            UNION ALL SELECT 'customer', count(*), 1 FROM customer
            UNION ALL SELECT 'orders', count(*), 1 FROM orders WHERE {selected}
            UNION ALL SELECT 'lineitem', count(*), 1 FROM lineitem
            UNION ALL SELECT 'events', count(*), 1 FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'
        """,
        "code_pages": """
            SELECT doc_id, text, page FROM documents, (VALUES ('windows-1252'), ('ISO-8859-15'), ('cp850')) p(page)
        """,
        "watermark_footers": "SELECT max(ts) AS ts, max(event_id) AS event_id, max(value) AS value FROM events",
        "counted_warnings": """
            SELECT 'orders' AS "SRC_OBJECT_NAME", n || ' rows ' || said AS "ERROR_MESSAGE" FROM (
                SELECT count(*) AS n, 'equal to the watermark 1998-01-01 00:00:00 were not loaded' AS said
                FROM orders WHERE o_orderstatus <> 'P' AND o_orderdate = TIMESTAMP '1998-01-01 00:00:00'
                UNION ALL SELECT count(*), 'without a value of o_orderdate were not loaded' FROM orders WHERE o_orderstatus = 'P')
            WHERE n > 0
            UNION ALL SELECT 'documents', n || ' values of column text are no text read under ISO-8859-1 and stay as they were' FROM (
                SELECT count(*) AS n FROM documents WHERE lang = 'en' AND text IS NOT NULL)
            WHERE n > 0
        """,
        "state_folded": """
            SELECT src_name, src_object_name, value, updated_at FROM (
                SELECT event_type AS src_name, CAST(user_id AS VARCHAR) AS src_object_name, CAST(event_id AS VARCHAR) AS value,
                       ts AS updated_at,
                       row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) AS age
                FROM events)
            WHERE age = 1
        """,
        "manifest_active": f'SELECT * FROM ({MANIFEST_SQL}) WHERE "SRC_FLAG_ACTIV" = 1',
        "bronze_pruned_read": f"""
            SELECT *, {day_2}, '2024' AS fetch_year, '202401' AS fetch_month, '20240116' AS fetch_day
            FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'
        """,
        "file_inventory": """
            SELECT CAST(8 AS BIGINT) AS n_files, CAST(7 AS BIGINT) AS last_sequence, count(*) AS n_rows FROM lineitem
        """,
        "force_encode": "SELECT * FROM documents",
        "all_string": """
            SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
                   CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
                   CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_extendedprice AS VARCHAR) AS l_extendedprice,
                   CAST(l_discount AS VARCHAR) AS l_discount, CAST(l_tax AS VARCHAR) AS l_tax,
                   l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate
            FROM lineitem
        """,
        "fetch_stamp": f"SELECT *, {day_1} FROM events",
        "fetch_partitions": """
            SELECT *, ts AS fetch_date, strftime(ts, '%Y') AS fetch_year, strftime(ts, '%Y%m') AS fetch_month,
                   strftime(ts, '%Y%m%d') AS fetch_day
            FROM events
        """,
        "target_names": f"SELECT c_custkey, {NAME_SQL} AS table_name FROM ({MANIFEST_SQL})",
        "constraint_filter": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
        "watermark_filter": "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'",
        "constraint_and_watermark": f"SELECT * FROM orders WHERE {selected}",
        "state_latest": """
            SELECT src_name, src_origin_name, src_object_name, value, type, updated_at FROM (
                SELECT *, row_number() OVER (
                    PARTITION BY src_name, src_origin_name, src_object_name
                    ORDER BY updated_at DESC, value DESC NULLS LAST) AS age
                FROM (
                    SELECT event_type AS src_name, 'USERS' AS src_origin_name,
                           CAST(user_id AS VARCHAR) AS src_object_name,
                           CASE WHEN value < 50 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS value,
                           'timestamp_ntz' AS type, ts AS updated_at
                    FROM events))
            WHERE age = 1
        """,
        "high_watermark": "SELECT max(ts) AS high FROM events",
        "batch_metrics": "SELECT count(*) AS n, max(ts) AS high FROM events",
        "merge_chunks": "SELECT * REPLACE (CASE WHEN value < 50 THEN props END AS props) FROM events",
        "land_full": f"SELECT *, {day_1} FROM lineitem",
        "land_full_rerun": f"SELECT *, {later} FROM orders",
        "publish_full": f"SELECT * EXCLUDE (c_mktsegment), {day_2} FROM customer",
        "land_incremental": """
            SELECT *, CASE WHEN o_orderdate <= TIMESTAMP '1998-01-01 00:00:00'
                           THEN TIMESTAMP '2024-01-15 10:00:00' ELSE TIMESTAMP '2024-01-15 18:00:00' END AS fetch_date,
                   '2024' AS fetch_year, '202401' AS fetch_month, '20240115' AS fetch_day
            FROM orders
        """,
        "publish_incremental": f"SELECT *, {event_days} FROM events",
        "sync_partitions": f"SELECT *, {line_days} FROM lineitem",
        "publish_decision": f"""
            SELECT c_custkey, table_name, n_files,
                   CASE WHEN n_files IS NULL THEN 'nothing'
                        WHEN coalesce("SRC_FLAG_INCR", 0) = 0 THEN 'recreate'
                        WHEN finished > 0 THEN 'sync'
                        ELSE 'create_partitioned' END AS decision
            FROM (SELECT *, {NAME_SQL} AS table_name FROM ({MANIFEST_SQL}))
            LEFT JOIN (SELECT o_custkey, count(*) AS n_files, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished
                       FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
        """,
        "empty_batch": f"SELECT *, {day_1} FROM supplier",
        "schema_first": f"SELECT * EXCLUDE (props), {event_days} FROM events",
        "schema_merged": f"""
            SELECT * REPLACE (CASE WHEN ts > TIMESTAMP '2024-01-15 00:00:00' THEN props END AS props), {event_days}
            FROM events
        """,
        "incremental_two_batches": """
            SELECT *, CASE WHEN o_orderdate <= TIMESTAMP '1998-01-01 00:00:00' THEN '20240115' ELSE '20240116' END
                      AS fetch_day
            FROM orders
        """,
        "watermark_state": """
            SELECT 'SRC' AS src_name, 'MAIN' AS src_origin_name, 'orders' AS src_object_name,
                   max(o_orderdate) AS value, TIMESTAMP '2024-01-16 10:00:00' AS updated_at
            FROM orders
        """,
        "full_load_with_watermark": f"SELECT *, {day_1} FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'",
        "run_manifest": f"""
            SELECT 'nation' AS object, count(*) AS n_rows FROM nation
            UNION ALL SELECT 'supplier', count(*) FROM supplier WHERE s_acctbal >= 0
            UNION ALL SELECT 'customer', count(*) FROM customer
            UNION ALL SELECT 'orders', count(*) FROM orders WHERE {selected}
            UNION ALL SELECT 'lineitem', count(*) FROM lineitem
            UNION ALL SELECT 'events', count(*) FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'
        """,
        "load_log": " UNION ALL ".join(
            [
                logged("nation", "true", ""),
                logged("supplier", "s_acctbal >= 0", " WHERE (s_acctbal >= 0)"),
                logged("customer", "true", ""),
                logged("orders", selected, " WHERE (o_orderstatus = 'F' OR o_orderstatus = 'O') AND o_orderdate > '1998-01-01 00:00:00'"),
                logged("lineitem", "true", ""),
                logged("events", "ts > TIMESTAMP '2024-01-15 00:00:00'", " WHERE ts > '2024-01-15 00:00:00'"),
                log_row.format("SRC", "documents", "DB", "WARNING", "CAST(0 AS BIGINT)", "SELECT * FROM MAIN.documents WHERE (n_chars < 0)", none),
                log_row.format("SRC", "documents", "DB", "SUCCESS", "CAST(0 AS BIGINT)", "SELECT * FROM MAIN.documents WHERE (n_chars < 0)", none),
                log_row.format("SRC", "region", "DB", "ERROR", "CAST(0 AS BIGINT)", "SELECT * FROM MAIN.region", "'ValueError'"),
                log_row.format("CSV", "pages", "FILE", "ERROR", "CAST(0 AS BIGINT)", "SELECT * FROM MAIN [pages]", "'ValueError'"),
            ]
        ),
    } | _llm()[1]
