"""Helpers the operators share: rows in and out of tasks, hashing of ids, bounds on broadcasts."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from firstpour.functions.text import quoted


class _ByValue:
    """Pickles as what it holds, code included."""

    def __init__(self, held: object):
        self.held = held

    def __reduce__(self):
        return pickle.loads, (cloudpickle.dumps(self.held),)


def ship(df: DataFrame, model: object) -> Broadcast:
    """A model of bounded size for all tasks; a worker unpacks it once and keeps it across its tasks."""
    return df.sparkSession.sparkContext.broadcast(_ByValue(model))


#: Characters of text that a task works on at a time, whatever the size of Arrow's batches.
SLICE_CHARS = 2_000_000


def remainder(id_column: str | Column, modulus: int) -> Column:
    """crc32 of an id as text, modulo ``modulus``; of the empty text for a null id."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def slices[Rows: (pa.RecordBatch, pa.Table)](batch: Rows, text: str, limit: int = SLICE_CHARS) -> Iterator[Rows]:
    """Runs of rows with at most ``limit`` bytes of text, or one row that has more."""
    column = batch.column(batch.schema.get_field_index(text))
    start = held = 0
    for i, size in enumerate(pa.compute.binary_length(column).to_pylist()):
        if i > start and held + (size or 0) > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size or 0
    if batch.num_rows > start:
        yield batch.slice(start)


def map_text(
    df: DataFrame, text: str, schema: str, work: Callable[[pa.RecordBatch, list[str]], dict[str, object]], keep: list[str] | None = None,
    after: Callable[[], None] | None = None,
) -> DataFrame:
    """Rows with what ``work`` makes of their texts (null: empty), run slice by slice inside tasks.

    ``work`` gets the rows and their texts and returns a value per row for each field of ``schema``.
    The columns ``keep``, by default all of ``df``, stay; one of the same name is replaced. ``after``
    runs at a task's end, to give up what the next task on the worker should not find in memory.
    """
    made: StructType = _parse_datatype_string(schema)
    names = {f.name.lower() for f in made}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    target = StructType([df.schema[c] for c in kept] + made.fields)
    arrow = to_arrow_schema(target)
    fields, names_in = [f.name for f in made], df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch.rename_columns(names_in), text):
                texts = [t or "" for t in rows.column(rows.schema.get_field_index(text)).to_pylist()]
                values = work(rows, texts)
                columns = [rows.column(rows.schema.get_field_index(c)) for c in kept]
                columns += [
                    values[n] if isinstance(values[n], pa.Array) else pa.array(values[n], arrow.field(n).type) for n in fields
                ]
                yield pa.RecordBatch.from_arrays(
                    [c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
                )
        if after:
            after()
        pa.default_memory_pool().release_unused()

    # numbered, since mapInArrow takes no names with dots
    plain = df.select([F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(names_in)])
    return plain.mapInArrow(run, target)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores after it, so that no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
