"""Append-only tables of small records, safe for loads and drivers that run side by side.

Every append writes a folder of its own. Folding puts many folders into one and then creates the next
generation: a small file that names the folded folder as base and those that have gone into it. It is
created under its final name in one step and never changed, so of two drivers that fold at once one
succeeds and the other throws its work away. A reader takes the newest generation's base and whatever
folder has not gone into it; appends that finish during a fold are such folders, so nothing is lost or
seen twice. What has gone into a base stays for ``grace`` seconds, for readers that began before.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from firstpour import storage

GENERATION = "_generation-"


@dataclass(frozen=True)
class Generation:
    """What readers see besides new folders: ``base``, and not what is ``gone``. ``at``: seconds since the epoch."""

    number: int = 0
    base: str | None = None
    gone: tuple[str, ...] = ()
    at: float = 0.0


def generation(spark: SparkSession, path: str) -> Generation:
    """The newest generation of a table of records; number 0 before the first fold."""
    names = storage.hidden(spark, path, GENERATION)
    if not names:
        return Generation()
    text = storage.read_text(spark, f"{path}/{names[-1]}")
    if text is None:  # a newer one has been made, and this one cleared away, meanwhile
        return generation(spark, path)
    found = json.loads(text)
    return Generation(found["number"], found["base"], tuple(found["gone"]), found["at"])


def live(spark: SparkSession, path: str, now: Generation | None = None) -> list[str]:
    """Folders that make up the table: the base and the batches that have not gone into it."""
    now = now or generation(spark, path)
    batches = [n for n in storage.children(spark, path) if n.startswith("batch-") and n not in now.gone]
    return ([now.base] if now.base else []) + batches


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of all folders that count, as listed now."""
    now = generation(spark, path)
    names = live(spark, path, now)
    if not names:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if not now.number and len(names) == len(storage.children(spark, path)):
        return reader.option("recursiveFileLookup", "true").parquet(path)
    return reader.parquet(*[f"{path}/{name}" for name in names])


def make_records(spark: SparkSession, schema: str, rows: Sequence[Sequence]) -> DataFrame:
    """Rows as literals, which Spark plans as a local relation."""
    fields = StructType.fromDDL(schema).fields
    parts = []
    for first in range(0, max(1, len(rows)), 100):
        items = [
            F.struct([F.lit(value).cast(f.dataType).alias(f.name) for f, value in zip(fields, row)])
            for row in rows[first : first + 100]
        ]
        if items:
            parts.append(spark.sql("VALUES (1)").select(F.inline(F.array(items))))
    return reduce(DataFrame.union, parts).coalesce(1) if parts else spark.createDataFrame([], schema)


def append_records(records: DataFrame, path: str, kind: str = "batch") -> str:
    """Write into a folder of its own: appends to one shared folder would share its temporary
    directory, which the first job to finish removes. Returns the folder's name."""
    name = f"{kind}-{uuid.uuid4().hex}"
    records.write.mode("errorifexists").parquet(f"{path}/{name}")
    return name


def sweep(spark: SparkSession, path: str, grace: float = 0.0) -> None:
    """Delete what has gone into the newest base, once that is ``grace`` seconds old, and older generations."""
    now = generation(spark, path)
    if not now.number or time.time() - now.at < grace:
        return
    for name in now.gone:
        storage.delete(spark, f"{path}/{name}")
    for name in storage.hidden(spark, path, GENERATION):
        if name < f"{GENERATION}{now.number:08d}":
            storage.delete(spark, f"{path}/{name}")


def compact_records(
    spark: SparkSession, path: str, schema: str, fold: Callable[[DataFrame], DataFrame], grace: float = 0.0, least: int = 2
) -> bool:
    """Fold the completely written folders into a new base, where there are at least ``least``;
    folders still being written are left alone. False where another driver was faster.

    Readers and appenders may run meanwhile, here or on other drivers. Readers that take longer than
    ``grace`` seconds to look at what they have listed may find it gone.
    """
    sweep(spark, path, grace)
    now = generation(spark, path)
    names = live(spark, path, now)
    if len(names) < max(2, least):
        return True
    old = [name for name in names if storage.exists(spark, f"{path}/{name}/_SUCCESS")]
    if len(old) < 2:
        return True
    records = spark.read.schema(schema).parquet(*[f"{path}/{name}" for name in old])
    base = append_records(fold(records).coalesce(1), path, "fold")
    there = set(storage.children(spark, path))
    gone = [name for name in now.gone if name in there] + old
    made = {"number": now.number + 1, "base": base, "gone": gone, "at": time.time()}
    if not storage.write_text(spark, f"{path}/{GENERATION}{now.number + 1:08d}", json.dumps(made)):
        storage.delete(spark, f"{path}/{base}")
        return False
    if not grace:
        sweep(spark, path)
    return True
