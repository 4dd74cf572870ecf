"""Landing: one write job per load, with its row count and watermark observed on the way."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from firstpour import storage
from firstpour.functions.stamp import PARTITION_COLUMNS, in_utc, partition_values, stamp
from firstpour.functions.text import quoted
from firstpour.operators.ledger import PREFIX, Run
from firstpour.operators.metrics import Watch, batch_metrics, observed


@dataclass(frozen=True)
class Landed:
    """What a landing wrote. ``high`` is the batch's largest criteria value, as text; ``files`` are the
    names and bytes of what a run landed, ``counts`` what else was counted on the way."""

    path: str
    rows: int
    high: str | None
    schema: StructType
    files: tuple[tuple[str, int], ...] = ()
    counts: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class WriteOptions:
    compression: str = "snappy"
    max_records_per_file: int | None = None
    rebalance: bool = False
    files: int | None = None

    def prepare(self, df: DataFrame) -> DataFrame:
        """Even the batch out, by size or to a number of files; with no key, so nothing can skew."""
        if self.files:
            return df.repartition(self.files)
        return df.hint("rebalance") if self.rebalance else df

    def writer(self, df: DataFrame) -> DataFrameWriter:
        writer = df.write.option("compression", self.compression)
        if self.max_records_per_file:
            writer = writer.option("maxRecordsPerFile", self.max_records_per_file)
        return writer


def snapshots(folder: str, run_ts: datetime) -> str:
    return f"{folder}/snapshots/{partition_values(run_ts)['fetch_day']}"


def increments(folder: str) -> str:
    return f"{folder}/increments"


def conform(df: DataFrame, schema: StructType | None) -> DataFrame:
    """Cast columns whose type differs from the one the table was created with.

    A value that does not come back from the table's type as it was fails the load, in the same
    pass as the write: a drifting source neither loses digits or times unnoticed nor leaves files
    the table cannot read.
    """
    if schema is None:
        return df
    fixed = {f.name.lower(): f for f in schema.fields}
    drifted = [
        f.name
        for f in df.schema.fields
        if f.name.lower() in fixed and fixed[f.name.lower()].dataType != f.dataType
    ]

    def lossless(name: str) -> Column:
        column, type = F.col(quoted(name)), fixed[name.lower()].dataType
        cast = column.cast(type)
        kept = cast.cast(df.schema[name].dataType).eqNullSafe(column)
        told = f"column {name}: a value of type {df.schema[name].dataType.simpleString()} does not fit {type.simpleString()}"
        return F.when(kept, cast).otherwise(F.raise_error(F.lit(told)).cast(type))

    return df.withColumns({c: lossless(c) for c in drifted})


def make_room(df: DataFrame, reserved: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """Give source columns named like ours another name, ``src_`` before it; lower-case old name to
    new name."""
    taken = {c.lower() for c in df.columns}
    renamed: dict[str, str] = {}
    for column in df.columns:
        if column.lower() in reserved:
            name = f"src_{column}"
            while name.lower() in taken:
                name = f"src_{name}"
            taken.add(name.lower())
            renamed[column.lower()] = name
    return df.withColumnsRenamed({c: renamed[c.lower()] for c in df.columns if c.lower() in renamed}), renamed


def landed_criteria(criteria: str | None, renamed: dict[str, str]) -> str | None:
    """The criterion as the landed columns are named."""
    return renamed.get(criteria.strip().lower(), criteria) if criteria else criteria


def land_full(
    df: DataFrame,
    folder: str,
    run_ts: datetime,
    criteria: str | None = None,
    options: WriteOptions = WriteOptions(),
    watch: Watch = Watch(),
) -> Landed:
    """Write a snapshot into a run folder of its own, under the run's day.

    Nothing points at the folder until it is published, so a failed write is never visible. A
    batch without rows leaves no folder behind.
    """
    spark = df.sparkSession
    # Named by time, so that the newest run of a day sorts last.
    path = f"{snapshots(folder, run_ts)}/run-t{in_utc(run_ts):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex}"
    observation = Observation()
    df, renamed = make_room(df, ("fetch_date",))
    criteria = landed_criteria(criteria, renamed)
    batch = watch.written(observed(options.prepare(stamp(df, run_ts)), observation, criteria, watch), criteria)
    try:
        options.writer(batch).mode("errorifexists").parquet(path)
        rows, high, counts = batch_metrics(
            observation, lambda: spark.read.schema(batch.schema).parquet(path), criteria
        )
    except Exception:
        storage.delete(spark, path)
        raise
    if rows == 0:
        storage.delete(spark, path)
    return Landed(path, rows, high, batch.schema, counts=counts)


def land_incremental(
    df: DataFrame,
    folder: str,
    run_ts: datetime,
    criteria: str | None = None,
    options: WriteOptions = WriteOptions(),
    schema: StructType | None = None,
    run: Run | None = None,
    watch: Watch = Watch(),
) -> Landed:
    """Append a batch to the run's day partition, keeping every file already there.

    The partition values are constants of the run, so the write needs neither a shuffle nor a
    sort. A batch without rows writes no file. One writer per table at a time. With a ``run`` of the
    ledger, its files carry the run's id in their names.
    """
    observation = Observation()
    df, renamed = make_room(df, ("fetch_date", *PARTITION_COLUMNS))
    criteria = landed_criteria(criteria, renamed)
    plain = conform(stamp(df, run_ts), schema)
    batch = watch.written(observed(options.prepare(plain), observation, criteria, watch), criteria)
    days = {name: F.lit(value) for name, value in partition_values(run_ts).items()}
    path = increments(folder)
    day = "/".join([path, *(f"{name}={value}" for name, value in partition_values(run_ts).items())])
    before = storage.children(df.sparkSession, day)
    # What a killed driver's job left here would be committed along with this one.
    storage.delete(df.sparkSession, f"{path}/_temporary")
    writer = options.writer(batch.withColumns(days)).mode("append").partitionBy(*PARTITION_COLUMNS)
    if run:
        writer = writer.option("mapreduce.output.basename", run.prefix.rstrip("-"))
    writer.parquet(path)

    def landed() -> DataFrame:
        spark = df.sparkSession
        if not storage.exists(spark, day):
            return spark.createDataFrame([], batch.schema)
        mine = F.col("fetch_date") == F.lit(in_utc(run_ts))
        written = spark.read.schema(batch.schema).parquet(day).where(mine)
        # Another source of the same table may have landed at the same run time: not its files.
        return written.where(~F.col("_metadata.file_name").isin(before)) if before else written

    rows, high, counts = batch_metrics(observation, landed, criteria)
    files = storage.files(df.sparkSession, day, run.prefix) if run else []
    return Landed(path, rows, high, batch.schema, tuple(files), counts)


def drop_other_runs(spark, landed_path: str) -> None:
    """Remove the same day's earlier snapshots; other days' stay."""
    day, _, run = landed_path.rpartition("/")
    for name in storage.children(spark, day):
        if name != run:
            storage.delete(spark, f"{day}/{name}")


def _unnamed(spark, path: str, first_day: str) -> bool:
    """Whether days from a first one on hold files that carry no run's id."""
    for year in storage.children(spark, path):
        for month in storage.children(spark, f"{path}/{year}"):
            for day in storage.children(spark, f"{path}/{year}/{month}"):
                if day.rpartition("=")[2] >= first_day and any(
                    not name.startswith(PREFIX) for name in storage.children(spark, f"{path}/{year}/{month}/{day}")
                ):
                    return True
    return False


def undo_after(spark, folder: str, committed: datetime | None) -> int:
    """Delete landed files that carry no run's id in their names and are stamped later than the last
    committed load: what an interrupted load left behind before there was a ledger, or what was landed
    by hand. All rows of a file share one stamp."""
    path = increments(folder)
    if committed is None or not _unnamed(spark, path, partition_values(committed)["fetch_day"]):
        return 0
    columns = "fetch_date timestamp, fetch_year string, fetch_month string, fetch_day string"
    leftovers = (
        spark.read.schema(columns)
        .parquet(path)
        .where(F.col("fetch_day") >= partition_values(committed)["fetch_day"])
        .where((F.col("fetch_date") > F.lit(committed)) & ~F.col("_metadata.file_name").startswith(PREFIX))
        .select("_metadata.file_path")
        .distinct()
    )
    count = 0
    for row in leftovers.toLocalIterator():
        storage.delete_file(spark, row["file_path"])
        count += 1
    return count
