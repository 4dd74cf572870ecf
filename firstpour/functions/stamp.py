"""Ingestion stamp and the day partition derived from it."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTITION_COLUMNS = ("fetch_year", "fetch_month", "fetch_day")


def in_utc(run_ts: datetime) -> datetime:
    """A run time as UTC; one without a zone is taken to be UTC already."""
    if run_ts.tzinfo is None:
        return run_ts.replace(tzinfo=timezone.utc)
    return run_ts.astimezone(timezone.utc)


def partition_values(run_ts: datetime) -> dict[str, str]:
    day = in_utc(run_ts)
    return {
        "fetch_year": day.strftime("%Y"),
        "fetch_month": day.strftime("%Y%m"),
        "fetch_day": day.strftime("%Y%m%d"),
    }


def stamp(df: DataFrame, run_ts: datetime) -> DataFrame:
    """Add ``fetch_date``, one constant per load."""
    return df.withColumn("fetch_date", F.lit(in_utc(run_ts)))


def with_fetch_partitions(df: DataFrame) -> DataFrame:
    """Add year, month and day of ``fetch_date`` in UTC, as text."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    utc = F.col("fetch_date") if zone == "UTC" else F.to_utc_timestamp("fetch_date", zone)
    return df.withColumns(
        {
            "fetch_year": F.date_format(utc, "yyyy"),
            "fetch_month": F.date_format(utc, "yyyyMM"),
            "fetch_day": F.date_format(utc, "yyyyMMdd"),
        }
    )
