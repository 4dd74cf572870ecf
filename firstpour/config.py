"""Descriptions of a source, of the databases sources live in, and of the bronze layer."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from typing import Any

from firstpour.functions.naming import bronze_name, catalog_name


@dataclass(frozen=True)
class Split:
    """How one JDBC table is read in parallel.

    ``column`` is a column of numbers, dates or times. The source counts its rows by ranges of it, and
    the ranges are chosen to hold equal numbers of rows. A value that holds more rows than a task should
    get, or nulls that do, are split by ``then``, by default whichever of the first eight other such columns has the most
    values there. ``expression`` is for what counting cannot serve: source SQL that yields a bucket
    number from 0 to ``partitions - 1``, such as a hash of the primary key taken modulo ``partitions``.
    """

    partitions: int
    column: str | None = None
    expression: str | None = None
    then: str | None = None
    # Count the rows at the source. Without, ranges of the column are equal in width, cut between its
    # smallest and largest value: two grouped queries less, and even only where the values are.
    even: bool = True

    def __post_init__(self) -> None:
        if (self.column is None) == (self.expression is None):
            raise ValueError("a split needs either a column or an expression")
        if self.partitions < 1:
            raise ValueError("a split needs at least one partition")


@dataclass(frozen=True)
class JdbcDatabase:
    """A database reached over JDBC.

    ``splits`` is keyed by object name or ``schema.object``, in any case. Without one, a table is
    split into ``partitions`` ranges of its watermark column, where it is a number or a time; a
    table without such a column is read by a single task, since bounds cannot be guessed.

    ``convert`` is source SQL that converts a text column at the database where a source asks for a
    charset, such as ``CONVERT({column}, 'UTF8', '{charset}')``. It helps where reading itself fails
    and takes any charset the database knows; without it the rows are repaired after the read.
    """

    url: str
    driver: str | None = None
    fetchsize: int = 50_000
    options: Mapping[str, str] = field(default_factory=dict)
    splits: Mapping[str, Split] = field(default_factory=dict)
    partitions: int = 8
    convert: str | None = None

    def split(self, schema: str, name: str) -> Split | None:
        found = {key.lower(): split for key, split in self.splits.items()}
        return found.get(f"{schema}.{name}".lower(), found.get(name.lower()))


@dataclass(frozen=True)
class LakeDatabase:
    """Parquet tables; ``location`` is a path with ``{schema}`` and ``{object}`` placeholders."""

    location: str

    def path(self, schema: str, name: str) -> str:
        return self.location.format(schema=schema, object=name)


@dataclass(frozen=True)
class Source:
    """One control-table row. ``origin`` is a schema for databases and a path for workbooks;
    ``object`` is a table or a sheet."""

    type: str
    name: str
    origin: str
    object: str
    constraint: str | None = None
    incremental: bool = False
    criteria: str | None = None
    last_update: str | None = None
    force_encode: str | None = None

    @property
    def key(self) -> tuple[str, str, str]:
        return (self.name, self.origin, self.object)

    @property
    def bronze_name(self) -> str:
        return bronze_name(self.type, self.name, self.origin, self.object)


@dataclass(frozen=True)
class BronzeConfig:
    """Where the bronze layer of one environment lives and how it is written."""

    environment: str
    root: str
    databases: Mapping[str, JdbcDatabase | LakeDatabase] = field(default_factory=dict)
    database: str | None = None
    compression: str = "snappy"
    max_records_per_file: int | None = None
    # Rebalance a batch before the write. Costs one shuffle of the batch, and keeps a narrow filter
    # over a very wide scan from leaving thousands of tiny files. By default (None) incremental
    # loads with a watermark or constraint do.
    rebalance: bool | None = None
    # Land this many files per load, at the cost of a shuffle; one file means one writing task.
    files: int | None = None
    # Scan the whole bronze table for the watermark after every incremental load.
    exact_watermark: bool = False
    # Count, while an increment is written, the rows that the watermark keeps out for good: those equal
    # to it and those without a value. They are read for it.
    count_missed: bool = False
    # Undo what an interrupted load left behind before loading again.
    reconcile: bool = False
    # Apply constraint and watermark to workbook sources too.
    filter_files: bool = False
    # Loads that may run side by side in one run.
    parallel: int = 4
    # Folders of state, ledger or log records from which a load or run folds them into one at its end,
    # and the seconds that what was folded stays for readers that began before.
    compact_after: int = 200
    fold_grace: float = 3600.0
    # Readers by source type, over and instead of the built-in ones: (spark, config, source, last)
    # to the rows past the watermark ``last``.
    readers: Mapping[str, Any] = field(default_factory=dict)

    @property
    def schema(self) -> str:
        return self.database or f"bronze_{self.environment}".lower()

    def table(self, source: Source) -> str:
        return f"`{self.schema}`.`{catalog_name(source.bronze_name)}`"

    def folder(self, source: Source) -> str:
        """One directory per table, so no table can pick up the files of a similarly named one."""
        return f"{self.root}/{catalog_name(source.bronze_name)}"

    @property
    def state_path(self) -> str:
        return f"{self.root}/_control/state"

    @property
    def notes_path(self) -> str:
        return f"{self.root}/_control/notes"

    @property
    def ledger_path(self) -> str:
        return f"{self.root}/_control/ledger"

    @property
    def catalog_path(self) -> str:
        return f"{self.root}/_control/catalog"

    @property
    def log_path(self) -> str:
        return f"{self.root}/_control/load_log"


def watermark_to_text(value: Any) -> str | None:
    """Text of a watermark held as a Python value; ``None`` and not-a-time both mean no watermark."""
    if value is None or value != value:
        return None
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            return value.astimezone(timezone.utc).isoformat(" ")
        return value.isoformat(" ")
    if isinstance(value, date):
        return value.isoformat()
    return str(value)


def source_from_row(row: Mapping[str, Any] | Any) -> Source:
    """Build a source from a control-table row; blank text counts as absent, a null flag as off."""
    values = row.asDict() if hasattr(row, "asDict") else dict(row)

    def text(name: str) -> str | None:
        value = values.get(name)
        if value is None or value != value or str(value).strip() == "":
            return None
        return str(value)

    flag = values.get("SRC_FLAG_INCR")
    return Source(
        type=text("SRC_TYPE") or "",
        name=text("SRC_NAME") or "",
        origin=text("SRC_ORIGIN_NAME") or "",
        object=text("SRC_OBJECT_NAME") or "",
        constraint=text("SRC_OBJECT_CONSTRAINT"),
        incremental=bool(flag is not None and flag == flag and int(flag) != 0),
        criteria=text("SRC_DATE_CRITERIA"),
        last_update=watermark_to_text(values.get("SRC_DATE_LASTUPDATE")) or None,
        force_encode=text("FORCE_ENCODE"),
    )
