"""The ledger of incremental loads: which run of which source wrote which file of a table.

A run has an id, and every file it lands carries it in its name. Before a run lands anything it leaves
a note below the table's own folder of notes; after the landing its files are entered in the ledger, by
name and size; then the watermark's state record, which carries the run's id, commits it; then the note
goes. So a note whose run has no state record tells exactly which files an interrupted load left behind,
whatever else was loaded into the table at the same time, by this source or another.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from firstpour import storage
from firstpour.functions.stamp import in_utc, partition_values
from firstpour.operators.records import append_records, compact_records, make_records, read_records

#: What names of landed files begin with, before the run's id.
PREFIX = "load-"
SCHEMA = (
    "run string, folder string, src_name string, src_origin_name string, src_object_name string, "
    "run_ts timestamp, action string, file string, bytes bigint"
)


@dataclass(frozen=True)
class Run:
    """One load of a source into the table whose files lie in ``folder``."""

    id: str
    folder: str
    key: tuple[str, str, str]
    at: datetime

    @property
    def prefix(self) -> str:
        return f"{PREFIX}{self.id}-"

    @property
    def day(self) -> str:
        """Where the run lands its files."""
        return "/".join([f"{self.folder}/increments", *(f"{n}={v}" for n, v in partition_values(self.at).items())])


def _note(notes: str, run: Run) -> str:
    return f"{notes}/{run.folder.rpartition('/')[2]}/{run.id}.json"


def begin(spark: SparkSession, notes: str, folder: str, key: tuple[str, str, str], run_ts: datetime) -> Run:
    run = Run(uuid.uuid4().hex, folder, key, in_utc(run_ts))
    storage.write_text(spark, _note(notes, run), json.dumps({"id": run.id, "key": key, "at": run.at.isoformat()}))
    return run


def close(spark: SparkSession, notes: str, run: Run) -> None:
    storage.delete(spark, _note(notes, run))


def close_empty(spark: SparkSession, notes: str, run: Run) -> None:
    """Take away the note of a run that failed before any file of it was landed."""
    if not storage.files(spark, run.day, run.prefix):
        close(spark, notes, run)


def open_runs(spark: SparkSession, notes: str, folder: str) -> list[Run]:
    """Runs into a table that have a note: under way, interrupted, or committed a moment ago."""
    own = f"{notes}/{folder.rpartition('/')[2]}"
    found = []
    for name in storage.children(spark, own):
        text = storage.read_text(spark, f"{own}/{name}")
        if text is not None:
            held = json.loads(text)
            found.append(Run(held["id"], folder, tuple(held["key"]), datetime.fromisoformat(held["at"]).astimezone(timezone.utc)))
    return found


def open_ids(spark: SparkSession, notes: str) -> list[str]:
    """Ids of all runs that have a note."""
    return [n.removesuffix(".json") for table in storage.children(spark, notes) for n in storage.children(spark, f"{notes}/{table}")]


def _append(spark: SparkSession, path: str, run: Run, action: str, files: Sequence[tuple[str | None, int | None]]) -> None:
    rows = [(run.id, run.folder, *run.key, run.at, action, name, size) for name, size in files]
    records = make_records(spark, SCHEMA, rows) if len(rows) <= 1000 else spark.createDataFrame(rows, SCHEMA).coalesce(1)
    append_records(records, path)


def enter(spark: SparkSession, path: str, run: Run, files: Sequence[tuple[str, int]]) -> None:
    """Enter the files a run has landed, by name and bytes."""
    if files:
        _append(spark, path, run, "landed", files)


def replaced(spark: SparkSession, path: str, run: Run, old: Sequence[str], new: Sequence[tuple[str, int]]) -> None:
    """Enter that a run's files ``new`` hold the rows of ``old``, which are gone."""
    _append(spark, path, run, "landed", new)
    _append(spark, path, run, "dropped", [(name, None) for name in old])


def undo(spark: SparkSession, path: str, run: Run) -> int:
    """Delete what an interrupted run has landed, told by the names of its files."""
    files = storage.files(spark, run.day, run.prefix)
    if files:
        _append(spark, path, run, "dropped", [(name, None) for name, _ in files])
    for name, _ in files:
        storage.delete(spark, f"{run.day}/{name}")
    return len(files)


def entries(records: DataFrame) -> DataFrame:
    """Landed files that no later entry has dropped."""
    dropped = records.where("action = 'dropped'").select("folder", "file").distinct()
    return records.where("action = 'landed'").join(dropped, ["folder", "file"], "left_anti").select(*records.columns)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A row per landed file: run, table folder, source, run time, file, bytes."""
    return entries(read_records(spark, path, SCHEMA)).drop("action")


def compact_ledger(spark: SparkSession, path: str, grace: float = 0.0, least: int = 2) -> None:
    compact_records(spark, path, SCHEMA, lambda records: entries(records), grace, least)
