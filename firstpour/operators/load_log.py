"""The load log: one record per outcome of a load."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstpour.operators.records import append_records, compact_records, make_records, read_records

# The columns of the load log.
SCHEMA = (
    "START_TIME timestamp, END_TIME timestamp, SRC_NAME string, SRC_ORIGIN_NAME string, "
    "SRC_OBJECT_NAME string, SQL_REQUEST string, ERROR_TYPE string, ERROR_MESSAGE string, "
    "SRC_TYPE string, COUNT_ROW bigint, ACTION string, TOTAL_DURATION double, "
    "FETCH_DURATION double, SEND_PARQUET_DURATION double"
)


@dataclass(frozen=True)
class LogRecord:
    start_time: datetime
    end_time: datetime
    key: tuple[str, str, str]
    request: str
    source_type: str
    action: str
    rows: int = 0
    error_type: str | None = None
    error_message: str | None = None
    send_duration: float | None = None

    def row(self) -> tuple:
        # Extraction and landing are one Spark job: its time is the send duration.
        total = (self.end_time - self.start_time).total_seconds()
        return (
            self.start_time, self.end_time, *self.key, self.request, self.error_type,
            self.error_message, self.source_type, self.rows, self.action, total, None,
            self.send_duration,
        )


def log_loads(spark: SparkSession, path: str, records: Sequence[LogRecord]) -> None:
    if records:
        append_records(make_records(spark, SCHEMA, [r.row() for r in records]), path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return read_records(spark, path, SCHEMA)


def last_durations(spark: SparkSession, path: str) -> dict[tuple[str, str, str], float]:
    """Seconds each source took the last time it was loaded: as many values as there are sources."""
    key = ("SRC_NAME", "SRC_ORIGIN_NAME", "SRC_OBJECT_NAME")
    done = read_log(spark, path).where("ACTION = 'SUCCESS'").groupBy(*key)
    return {tuple(r[k] for k in key): r["took"] for r in done.agg(F.max_by("TOTAL_DURATION", "START_TIME").alias("took")).collect()}


def compact_log(spark: SparkSession, path: str, grace: float = 0.0, least: int = 2) -> None:
    """Fold the records written so far into one file."""
    compact_records(spark, path, SCHEMA, lambda records: records, grace, least)
