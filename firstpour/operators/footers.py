"""The high watermark of a table from the footers of its files.

Parquet keeps the largest value of a column for each row group in the footer. Tasks read footers only,
each a few kilobytes whatever the file's size; a file whose footer does not tell (text, whose bounds may
be cut short; old timestamps; statistics left out, as for numbers that are none; a store only Spark's
readers open) is scanned, for that one column.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime, timezone
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    NumericType,
    TimestampNTZType,
    TimestampType,
)

from firstpour.functions.text import quoted
from firstpour.operators.metrics import largest

#: Files whose footers a task reads.
FILES_A_TASK = 64


def footer_high(uri: str, column: str) -> tuple[bool, str | None]:
    """Whether a file's footer tells the column's largest value, and that as text; no value where the
    file has no such column or no row with a value."""
    from pyarrow import fs, parquet

    system, path = fs.FileSystem.from_uri(uri)
    found = parquet.read_metadata(path, filesystem=system)
    names = [found.schema.column(i).path.lower() for i in range(found.num_columns)]
    if column.lower() not in names:
        return not any(n.startswith(f"{column.lower()}.") for n in names), None
    at, high = names.index(column.lower()), None
    for group in range(found.num_row_groups):
        chunk = found.row_group(group).column(at)
        held = chunk.statistics
        if held is None or not held.has_min_max:
            if chunk.num_values and not (held is not None and held.has_null_count and held.null_count == chunk.num_values):
                return False, None
            continue
        value = held.max
        if isinstance(value, (bytes, str)) or value != value:
            return False, None
        high = value if high is None else max(high, value)
    return True, None if high is None else _text(high)


def _text(value: object) -> str:
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            return value.astimezone(timezone.utc).isoformat(" ")
        return value.isoformat(" ")
    if isinstance(value, date):
        return value.isoformat()
    return format(value, "f") if isinstance(value, Decimal) else repr(value)


def _told(type: DataType) -> bool:
    return isinstance(type, (NumericType, DecimalType, DateType, TimestampType, TimestampNTZType))


def footer_watermark(bronze: DataFrame, column: str) -> DataFrame:
    """Largest value of a table's column, as ``high_watermark`` gives it."""
    spark, type = bronze.sparkSession, bronze.schema[column].dataType
    files = bronze.inputFiles() if _told(type) else []  # as many names as the driver's listing holds
    if not files:
        return bronze.agg(largest(F.col(quoted(column)), type).alias("high"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], []]
            for uri in batch.column(0).to_pylist():
                try:
                    known, high = footer_high(uri, column)
                except Exception:  # a store pyarrow does not open, an encrypted file: the scan tells
                    known, high = False, None
                for values, value in zip(rows, (uri, known, high), strict=True):
                    values.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, (pa.string(), pa.bool_(), pa.string()))], names=["file", "known", "high"])

    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(-(-len(files) // FILES_A_TASK))
    told = listed.mapInArrow(read, "file string, known boolean, high string").agg(
        F.max(F.col("high").cast(type)).alias("high"), F.collect_list(F.when(~F.col("known"), F.col("file"))).alias("untold")
    )
    found = told.select(F.col("high").cast("string").alias("high"), "untold").first()
    if len(found["untold"]) == len(files):
        return bronze.agg(largest(F.col(quoted(column)), type).alias("high"))
    known = F.lit(found["high"]).cast(type)
    if not found["untold"]:
        return spark.sql("VALUES (1)").select(known.alias("high"))
    own = spark.read.schema(f"{quoted(column)} {type.simpleString()}").parquet(*found["untold"])
    scanned = largest(F.col(quoted(column)), type)
    return own.agg(scanned.alias("scanned")).select(F.greatest("scanned", known).alias("high"))
