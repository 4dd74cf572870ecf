"""Loading one source: extract, land, publish, advance the watermark, log."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from firstpour.config import BronzeConfig, JdbcDatabase, Source, watermark_to_text
from firstpour.functions.charset import force_encode, unrepaired
from firstpour.functions.naming import bronze_name_column
from firstpour.functions.stamp import PARTITION_COLUMNS, in_utc, partition_values
from firstpour.functions.text import quoted, text_literal
from firstpour.operators import ledger, load_log, state
from firstpour.operators.land import (
    Landed,
    WriteOptions,
    land_full,
    land_incremental,
    undo_after,
)
from firstpour.operators.footers import footer_watermark
from firstpour.operators.metrics import Watch, high_watermark, watermark_text
from firstpour.operators.predicates import column_name, field_type, select_rows
from firstpour.operators.publish import attach, is_partitioned, publish, table_schema
from firstpour.sources.jdbc import full_table_name, request_text, scan_jdbc
from firstpour.sources.lake import scan_parquet
from firstpour.sources.sheets import LEADING_ROWS, scan_sheets


#: Column of a batch with the names of the columns whose text could not be repaired; it is not landed.
UNREPAIRED = "_unrepaired_"


class LoadError(Exception):
    """A load that stopped; the stage and the cause are in the message and in the load log."""


@dataclass(frozen=True)
class Watermark:
    """Where a load starts from. ``recorded`` tells a value read off the bronze table by an earlier
    load from one set by hand or standing in the control table."""

    value: str | None = None
    recorded: bool = False
    updated_at: datetime | None = None


@dataclass(frozen=True)
class LoadResult:
    source: Source
    table: str
    rows: int
    decision: str
    watermark: str | None
    error: str | None = None
    records: list[load_log.LogRecord] = field(default_factory=list, compare=False)


def read_database(spark: SparkSession, config: BronzeConfig, source: Source, last: str | None) -> DataFrame:
    database = config.databases.get(source.name)
    if database is None:
        raise ValueError(f"no database configured for source {source.name!r}")
    if isinstance(database, JdbcDatabase):
        df = scan_jdbc(
            spark, database, source.origin, source.object, source.constraint, source.criteria, last,
            charset=source.force_encode, missed=_counts_missed(config, source),
        )
        if source.force_encode and database.convert:
            return df
    else:
        scan = scan_parquet(spark, database.path(source.origin, source.object))
        df = select_rows(scan, source.constraint, source.criteria, last, _counts_missed(config, source))
    if not source.force_encode:
        return df
    return force_encode(df.withColumn(UNREPAIRED, unrepaired(df, source.force_encode)), source.force_encode)


def _counts_missed(config: BronzeConfig, source: Source) -> bool:
    return config.count_missed and source.incremental


def read_file(spark: SparkSession, config: BronzeConfig, source: Source, last: str | None) -> DataFrame:
    """Workbook sources ignore constraint and watermark unless the configuration asks for them."""
    if source.name not in LEADING_ROWS:
        raise ValueError(f"unknown workbook source {source.name!r}")
    df = scan_sheets(spark, source.origin, source.object, LEADING_ROWS[source.name])
    if not config.filter_files:
        return df
    return select_rows(df, source.constraint, source.criteria, last, _counts_missed(config, source))


READERS: dict[str, Callable[[SparkSession, BronzeConfig, Source, str | None], DataFrame]] = {
    "DB": read_database,
    "FILE": read_file,
}


def stored_watermarks(spark: SparkSession, config: BronzeConfig) -> DataFrame:
    """Latest record per source, with the record time in microseconds since the epoch."""
    latest = state.latest_state(state.read_state(spark, config.state_path))
    return latest.withColumn("updated_micros", F.unix_micros("updated_at"))


def stored_watermark(value: str | None, type: str | None, updated_micros: int) -> Watermark:
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    if type in ("double", "float") and value == "NaN":
        value = None  # above all numbers: as a watermark it would let nothing through any more
    return Watermark(value, type is not None, epoch + timedelta(microseconds=updated_micros))


def current_watermark(spark: SparkSession, config: BronzeConfig, source: Source) -> Watermark:
    row = (
        stored_watermarks(spark, config)
        .where(
            (F.col("src_name") == source.name)
            & (F.col("src_origin_name") == source.origin)
            & (F.col("src_object_name") == source.object)
        )
        .first()
    )
    if row is None:
        return Watermark(source.last_update)
    return stored_watermark(row["value"], row["type"], row["updated_micros"])


def readers(config: BronzeConfig) -> dict[str, Callable[[SparkSession, BronzeConfig, Source, str | None], DataFrame]]:
    return READERS | dict(config.readers)


def sharing(config: BronzeConfig, source: Source) -> Column:
    """Whether a state record belongs to a source whose name comes to the same table, the source's own
    included."""
    key = [F.col(name) for name in state.KEY]
    spellings = [F.lower(bronze_name_column(F.lit(type), *key)) for type in readers(config)]
    return F.lit(source.bronze_name.lower()).isin(*spellings)


def last_commit(spark: SparkSession, config: BronzeConfig, source: Source) -> datetime | None:
    """Time of the last recorded load into the source's table, by this source or by another that
    shares it."""
    row = (
        state.read_state(spark, config.state_path)
        .where(sharing(config, source))
        .agg(F.max(F.unix_micros("updated_at")).alias("micros"))
        .first()
    )
    return None if row["micros"] is None else stored_watermark(None, None, row["micros"]).updated_at


def prepare(spark: SparkSession, config: BronzeConfig) -> None:
    """Make sure the bronze database exists; its own folder stays empty, as every table has a
    location."""
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {quoted(config.schema)} "
        f"LOCATION {text_literal(config.catalog_path)}"
    )


def next_watermark(
    spark: SparkSession,
    config: BronzeConfig,
    source: Source,
    start: Watermark,
    landed: Landed,
) -> tuple[str | None, str | None]:
    """Largest criteria value of a source's rows after a load, and its type.

    That is the larger of the value the load started from and the one observed during the write; the
    table is not read, as other sources may share it. After a watermark set by hand, or where
    ``exact_watermark`` asks for it, the table's maximum is taken instead, unless another source has
    loaded into the table. No table, or no criteria
    column, means no watermark.
    """
    table = config.table(source)
    if not source.criteria or not spark.catalog.tableExists(table):
        return None, None
    bronze = spark.table(table)
    criteria = source.criteria
    if f"src_{criteria.strip().lower()}" in bronze.columns and criteria.strip().lower() in ("fetch_date", *PARTITION_COLUMNS):
        criteria = f"src_{criteria.strip().lower()}"  # the source's own column, under its landed name
    type = field_type(bronze, criteria)
    by_hand = start.updated_at is not None and not start.recorded
    if (config.exact_watermark or by_hand) and not _shared(spark, config, source):
        named = column_name(bronze, criteria)
        frame = footer_watermark(bronze, named) if named else high_watermark(bronze, criteria)
    else:
        values = [F.lit(value).cast(type) for value in (landed.high, start.value)]
        frame = spark.sql("VALUES (1)").select(F.greatest(*values, F.lit(None).cast(type)).alias("high"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    high = frame.select(watermark_text(F.col("high"), type, zone)).first()[0]
    return high, type.simpleString()


def _shared(spark: SparkSession, config: BronzeConfig, source: Source) -> bool:
    if any(run.key != source.key for run in ledger.open_runs(spark, config.notes_path, config.folder(source))):
        return True
    own = F.struct(*state.KEY) == F.struct(*[F.lit(k) for k in source.key])
    return not state.read_state(spark, config.state_path).where(sharing(config, source) & ~own).isEmpty()


def recover(spark: SparkSession, config: BronzeConfig, source: Source) -> int:
    """Delete the files that interrupted loads have left in a source's table, by it or by another that
    shares it, and close their runs. A run that a state record has committed is only closed."""
    folder = config.folder(source)
    runs = ledger.open_runs(spark, config.notes_path, folder)
    done = state.committed(spark, config.state_path, [run.id for run in runs])
    count = 0
    for run in runs:
        if run.id not in done:
            count += ledger.undo(spark, config.ledger_path, run)
        ledger.close(spark, config.notes_path, run)
    return count + undo_after(spark, folder, last_commit(spark, config, source))


def _request(config: BronzeConfig, source: Source, last: str | None) -> str:
    if source.type == "FILE" and not config.filter_files:
        return request_text(f"{source.origin} [{source.object}]")
    literal = None if last is None else f"'{last}'"
    if source.type == "FILE":
        return request_text(f"{source.origin} [{source.object}]", source.constraint, source.criteria, literal)
    return request_text(
        full_table_name(source.origin, source.object), source.constraint, source.criteria, literal
    )


def _watch(config: BronzeConfig, source: Source, df: DataFrame, last: str | None) -> tuple[Watch, dict[str, str]]:
    """What to count while a batch is written, and what the log says of each count."""
    said = {
        "equal": f"rows equal to the watermark {last} were not loaded",
        "empty": f"rows without a value of {source.criteria} were not loaded",
    }
    past = last if _counts_missed(config, source) and source.criteria and (source.type != "FILE" or config.filter_files) else None
    if not source.force_encode or UNREPAIRED not in df.columns:
        return Watch(past), said
    counts = {}
    for i, f in enumerate(df.schema.fields):
        if isinstance(f.dataType, StringType):
            counts[f"u{i}"] = F.count_if(F.array_contains(F.col(UNREPAIRED), f.name))
            said[f"u{i}"] = f"values of column {f.name} are no text read under {source.force_encode} and stay as they were"
    return Watch(past, counts, (UNREPAIRED,)), said


def attempt(
    spark: SparkSession,
    config: BronzeConfig,
    source: Source,
    run_ts: datetime,
    start: Watermark | None = None,
) -> LoadResult:
    """Run one load and describe how it went; a failure is in the result, not raised.

    The watermark moves only after the rows are published. A load that dies in between is loaded
    again from the old watermark, so rows may arrive twice; with ``reconcile`` the files it left
    behind are deleted first, as the ledger of runs tells them.
    """
    run_ts = in_utc(run_ts)
    began = datetime.now(timezone.utc)
    table = config.table(source)
    folder = config.folder(source)
    stage, rows, send, decision, last = "start", 0, None, "nothing", None
    records: list[load_log.LogRecord] = []
    opened: ledger.Run | None = None

    def record(action: str, error_type: str | None = None, message: str | None = None) -> None:
        records.append(
            load_log.LogRecord(
                start_time=began,
                end_time=datetime.now(timezone.utc),
                key=source.key,
                request=_request(config, source, last),
                source_type=source.type,
                action=action,
                rows=rows,
                error_type=error_type,
                error_message=message,
                send_duration=send,
            )
        )

    try:
        if start is None:
            start = current_watermark(spark, config, source)
        last = start.value
        if start.updated_at is not None and run_ts <= start.updated_at:
            raise ValueError(f"run time {run_ts} is not after the last load at {start.updated_at}")
        if source.type not in readers(config):
            raise ValueError(f"unknown source type {source.type!r}")
        if config.reconcile and source.incremental:
            if recover(spark, config, source) and spark.catalog.tableExists(table):
                spark.catalog.refreshTable(table)
        if source.incremental:
            attach(spark, table, folder, True)
        known = table_schema(spark, table)
        if source.incremental and known is not None and not is_partitioned(spark, table):
            raise ValueError(f"{table} holds a full snapshot; drop it to load incrementally")

        stage = "extract"
        df = readers(config)[source.type](spark, config, source, last)

        stage = "land"
        narrow = source.incremental and bool(last is not None and source.criteria or source.constraint)
        rebalance = narrow if config.rebalance is None else config.rebalance
        options = WriteOptions(config.compression, config.max_records_per_file, rebalance, config.files)
        criteria = source.criteria if source.incremental else None
        watch, said = _watch(config, source, df, last)
        sending = datetime.now(timezone.utc)
        if source.incremental:
            opened = ledger.begin(spark, config.notes_path, folder, source.key, run_ts)
            landed = land_incremental(df, folder, run_ts, criteria, options, known, opened, watch)
            ledger.enter(spark, config.ledger_path, opened, landed.files)
        else:
            landed = land_full(df, folder, run_ts, criteria, options, watch)
        rows = landed.rows
        send = (datetime.now(timezone.utc) - sending).total_seconds()
        for name, count in landed.counts.items():
            if count:
                record("WARNING", None, f"{count} {said[name]}")
        if rows == 0:
            record("WARNING", None, "no rows to land")
            attach(spark, table, folder, source.incremental)

        stage = "publish"
        partition = partition_values(run_ts) if source.incremental else None
        decision = publish(spark, table, landed, source.incremental, partition)

        watermark = last
        if source.incremental:
            stage = "watermark"
            watermark, kind = next_watermark(spark, config, source, start, landed)
            state.advance(spark, config.state_path, source.key, watermark, kind, run_ts, opened.id)
            ledger.close(spark, config.notes_path, opened)
        record("SUCCESS")
        return LoadResult(source, table, rows, decision, watermark, None, records)
    except Exception as error:
        message = f"{stage}: {error}"
        record("ERROR", type(error).__name__, message)
        if opened is not None and stage == "land":
            with suppress(Exception):  # a note too many does no harm
                ledger.close_empty(spark, config.notes_path, opened)
        return LoadResult(source, table, rows, decision, last, message, records)


def refused(config: BronzeConfig, source: Source, error: Exception) -> LoadResult:
    """The result of a control row no load can be made of."""
    now = datetime.now(timezone.utc)
    message = f"control row: {error}"
    record = load_log.LogRecord(
        now, now, source.key, _request(config, source, None), source.type, "ERROR", 0, type(error).__name__, message
    )
    return LoadResult(source, config.table(source), 0, "nothing", None, message, [record])


def load(spark: SparkSession, config: BronzeConfig, source: Source, run_ts: datetime) -> LoadResult:
    """Load one source and write its log records; raises ``LoadError`` when a stage failed."""
    prepare(spark, config)
    result = attempt(spark, config, source, run_ts)
    load_log.log_loads(spark, config.log_path, result.records)
    compact(spark, config, config.compact_after)
    if result.error:
        raise LoadError(result.error)
    return result


def compact(spark: SparkSession, config: BronzeConfig, least: int = 2) -> None:
    """Fold the state, ledger and log records of past loads into one file each, where there are at
    least ``least`` folders. Other loads, on this driver or another, may run meanwhile."""
    state.compact_state(spark, config.state_path, config.notes_path, config.fold_grace, least)
    ledger.compact_ledger(spark, config.ledger_path, config.fold_grace, least)
    load_log.compact_log(spark, config.log_path, config.fold_grace, least)


def reset_watermark(
    spark: SparkSession, config: BronzeConfig, source: Source, value: object, at: datetime
) -> None:
    """Set a source's watermark by hand; ``None`` makes the next load take everything."""
    state.advance(spark, config.state_path, source.key, watermark_to_text(value), None, at)
