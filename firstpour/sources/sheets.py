"""Workbook sheets: whole workbooks are spread over tasks, each decoded within one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from firstpour.sources import workbook

# Ship the decoder with the tasks: executors need no copy of this package.
cloudpickle.register_pickle_by_value(workbook)

# Rows above the header, by source name.
LEADING_ROWS = {"EXCEL": 0, "TURKEY": 1}

# Cell texts that stand for a missing value.
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

ROWS_PER_BATCH = 10_000


def sheet_columns(books: DataFrame, sheet: str, skip_rows: int) -> list[str]:
    """Columns of the sheet over all workbooks, in order of first appearance."""

    def headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                names = workbook.sheet_header(content.as_py(), sheet, skip_rows)
                yield pa.RecordBatch.from_pydict(
                    {
                        "path": pa.array([path.as_py()] * len(names), pa.string()),
                        "position": pa.array(range(len(names)), pa.int32()),
                        "name": pa.array(names, pa.string()),
                    }
                )

    found = books.select("path", "content").mapInArrow(headers, "path string, position int, name string")
    first = found.groupBy(F.lower("name").alias("folded")).agg(
        F.min(F.struct("path", "position", "name")).alias("first")
    )
    return [row["name"] for row in first.orderBy("first").select("first.name").collect()]


def decode_sheets(
    books: DataFrame, sheet: str, skip_rows: int = 0, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows of one sheet of every workbook in ``books(path, content)``, all columns as text.

    The row after the skipped ones names the columns; workbooks are matched by name, and a column
    a workbook lacks is null. Without ``columns`` a first pass over the workbooks collects the
    names.
    """
    names = list(columns) if columns else sheet_columns(books, sheet, skip_rows)
    if not names:
        raise ValueError(f"sheet {sheet!r} has no columns")
    places = {name.lower(): i for i, name in enumerate(names)}
    types = pa.schema([pa.field(f"c{i}", pa.string()) for i in range(len(names))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[list[str | None]] = [[] for _ in names]

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in pending], schema=types)
            for column in pending:
                column.clear()
            return out

        for batch in batches:
            for content in batch["content"]:
                places_here: list[int | None] = []
                for number, cells in workbook.table_rows(content.as_py(), sheet, skip_rows):
                    if number == skip_rows + 1:
                        header = workbook.header_names(cells, 0)
                        places_here = [places.get(n.lower()) for n in header]
                        continue
                    if len(cells) > len(places_here):
                        # Cells right of the header: unnamed columns, numbered by position.
                        header = workbook.header_names(header, len(cells))
                        places_here = [places.get(n.lower()) for n in header]
                    elif not cells and len(places_here) < 2:
                        continue
                    values: list[str | None] = [None] * len(names)
                    for place, value in zip(places_here, cells):
                        if place is not None:
                            values[place] = value
                    for column, value in zip(pending, values):
                        column.append(value)
                    if len(pending[0]) >= ROWS_PER_BATCH:
                        yield flush()
        if pending[0]:
            yield flush()

    schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
    decoded = books.select("content").mapInArrow(rows, schema)
    return decoded.select(
        [
            F.when(~F.col(f"c{i}").isin(*MISSING_TEXT), F.col(f"c{i}")).alias(name)
            for i, name in enumerate(names)
        ]
    )


def scan_sheets(
    spark: SparkSession,
    path: str,
    sheet: str,
    skip_rows: int = 0,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A sheet of one workbook, or of every workbook in a folder.

    Spark packs workbooks into tasks by size, so what a task holds at once is bounded by
    ``spark.sql.files.maxPartitionBytes`` plus one workbook.
    """
    books = spark.read.format("binaryFile").load(path)
    return decode_sheets(books, sheet, skip_rows, columns)
