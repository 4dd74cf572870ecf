"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Days and stored watermarks are UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Timestamps other engines read as such, and with statistics filters can use.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Job-level commit: a failed or retried task leaves nothing in the target folder.
    "spark.hadoop.mapreduce.fileoutputcommitter.algorithm.version": "1",
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
