"""Watermark state: append-only, the latest record of a source counts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstpour.functions.stamp import in_utc
from firstpour.operators import ledger
from firstpour.operators.records import append_records, compact_records, make_records, read_records

KEY = ("src_name", "src_origin_name", "src_object_name")
SCHEMA = (
    "src_name string, src_origin_name string, src_object_name string, "
    "value string, type string, updated_at timestamp, run string"
)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return read_records(spark, path, SCHEMA)


def latest_state(state: DataFrame) -> DataFrame:
    """Newest record per source. A null value is a valid newest one: it means no watermark."""
    newest = F.max(F.struct("updated_at", "value", "type")).alias("newest")
    return state.groupBy(*KEY).agg(newest).select(*KEY, "newest.value", "newest.type", "newest.updated_at")


def advance(
    spark: SparkSession,
    path: str,
    key: tuple[str, str, str],
    value: str | None,
    type: str | None,
    updated_at: datetime,
    run: str | None = None,
) -> None:
    """Append a record; with the id of the run it commits."""
    append_records(make_records(spark, SCHEMA, [(*key, value, type, in_utc(updated_at), run)]), path)


def committed(spark: SparkSession, path: str, runs: Sequence[str]) -> set[str]:
    """Those of a few runs that a state record has committed."""
    if not runs:
        return set()
    return {row["run"] for row in read_state(spark, path).where(F.col("run").isin(list(runs))).select("run").collect()}


def compact_state(spark: SparkSession, path: str, notes: str | None = None, grace: float = 0.0, least: int = 2) -> None:
    """Fold the records written so far into one file. Records of runs that still have a note below
    ``notes`` stay too: without them they would seem interrupted. The notes are read after the records
    were listed, and a run leaves its note before it writes its record, so none is overlooked."""

    def fold(records: DataFrame) -> DataFrame:
        latest = latest_state(records).withColumn("run", F.lit(None).cast("string"))
        runs = ledger.open_ids(spark, notes) if notes else []
        return latest.union(records.where(F.col("run").isin(runs)).select(*latest.columns)) if runs else latest

    compact_records(spark, path, SCHEMA, fold, grace, least)
