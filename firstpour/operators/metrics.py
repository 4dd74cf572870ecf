"""Row count and high watermark of a batch, taken while it is written."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from threading import Thread

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, TimestampType

from firstpour.operators.predicates import criteria_column, field_type, since

# Seconds to wait for observed metrics after their write has finished. They arrive through Spark's
# listener bus, which drops events when it is overrun.
OBSERVATION_WAIT = 60.0


def watermark_text(column: Column, type: DataType, zone: str) -> Column:
    """A watermark as text that casts back to the same value in any session zone."""
    if isinstance(type, TimestampType):
        utc = F.date_format(F.to_utc_timestamp(column, zone), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return F.concat(utc, F.lit("+00:00"))
    return column.cast("string")


def largest(column: Column, type: DataType) -> Column:
    """The largest value; not-a-number, which Spark puts above all numbers, does not count."""
    if isinstance(type, (DoubleType, FloatType)):
        return F.max(F.when(~F.isnan(column), column))
    return F.max(column)


@dataclass(frozen=True)
class Watch:
    """What else to count while a batch is written.

    With ``past``, the watermark the load started from, the batch may hold rows that are equal to it or
    have no value: they are counted, and not written. ``counts`` are aggregates by name, over columns
    that may be ``hidden``, which are not written either.
    """

    past: str | None = None
    counts: Mapping[str, Column] = field(default_factory=dict)
    hidden: tuple[str, ...] = ()

    def written(self, df: DataFrame, criteria: str | None) -> DataFrame:
        """What of an observed batch is to be written."""
        return since(df, criteria, self.past).drop(*self.hidden)


def metric_columns(df: DataFrame, criteria: str | None, watch: Watch = Watch()) -> list[Column]:
    """``n`` (rows) and ``high`` (largest criteria value, as text), and what ``watch`` asks for."""
    n, more = F.count(F.lit(1)), []
    if criteria:
        zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
        type, own = field_type(df, criteria), criteria_column(df, criteria)
        if watch.past is not None:
            mark = F.lit(watch.past).cast(type)
            n = F.count_if(own > mark)
            more = [F.count_if(own == mark).alias("equal"), F.count_if(own.isNull()).alias("empty")]
            own = F.when(own > mark, own)
        high = watermark_text(largest(own, type), type, zone)
    else:
        high = F.max(F.lit(None).cast("string"))
    return [n.alias("n"), high.alias("high"), *more, *[c.alias(name) for name, c in watch.counts.items()]]


def observed(df: DataFrame, observation: Observation, criteria: str | None = None, watch: Watch = Watch()) -> DataFrame:
    """Attach the metrics to whatever consumes the frame.

    Must sit in the stage of the write, after any shuffle: Spark counts each task of the last stage
    exactly once, while tasks of an earlier stage that is rerun for a lost executor would be
    counted again.
    """
    return df.observe(observation, *metric_columns(df, criteria, watch))


def batch_metrics(
    observation: Observation, landed: Callable[[], DataFrame], criteria: str | None = None
) -> tuple[int, str | None, dict[str, int]]:
    """Metrics of a finished write; rows and high watermark are read off the landed rows, which only
    then are listed, if the observed ones got lost. The other counts then are lost."""
    found: dict = {}
    waiting = Thread(target=lambda: found.update(observation.get), daemon=True)
    waiting.start()
    waiting.join(OBSERVATION_WAIT)
    if not found:
        rows = landed()
        found = rows.agg(*metric_columns(rows, criteria)).first().asDict()
    return found["n"], found["high"], {k: v for k, v in found.items() if k not in ("n", "high")}


def high_watermark(bronze: DataFrame, column: str) -> DataFrame:
    """Largest criteria value of a whole bronze table: a one-column scan."""
    return bronze.agg(largest(criteria_column(bronze, column), field_type(bronze, column)).alias("high"))
