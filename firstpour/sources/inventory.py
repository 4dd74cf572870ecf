"""Inventory of landed parquet files, from listings alone: no file is opened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per parquet file under ``path``, at any depth and with any folder layout."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            "path",
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("length").alias("bytes"),
        )
    )


def _sequence(stem: str) -> Column:
    digits = F.regexp_extract("file_name", rf"\A\Q{stem}\E(\d+)", 1)
    number = F.when(digits != "", digits.cast("bigint"))
    return F.coalesce(F.max(number), F.lit(0).cast("bigint")).alias("last_sequence")


def last_sequence(files: DataFrame, stem: str) -> DataFrame:
    """Highest number that follows ``stem`` in a file name; 0 when there is none."""
    return files.agg(_sequence(stem))


def file_count(files: DataFrame) -> DataFrame:
    return files.agg(F.count(F.lit(1)).alias("n_files"))


def inventory(files: DataFrame, stem: str) -> DataFrame:
    """File count and highest number in one pass."""
    return files.agg(F.count(F.lit(1)).alias("n_files"), _sequence(stem))
