"""Loading every active source of a control table."""

from __future__ import annotations

import math
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import replace
from datetime import datetime
from time import monotonic

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstpour.config import BronzeConfig, Source, source_from_row
from firstpour.operators import load_log
from firstpour.plans.load import (
    LoadResult,
    Watermark,
    attempt,
    compact,
    prepare,
    refused,
    stored_watermark,
    stored_watermarks,
)
from firstpour.plans.progress import Progress
from firstpour.sources.manifest import active_sources

KEY = {"src_name": "SRC_NAME", "src_origin_name": "SRC_ORIGIN_NAME", "src_object_name": "SRC_OBJECT_NAME"}

# Log records written together, and the seconds they may wait, whatever else still runs: few enough to
# lose little with the driver, many enough not to leave a file per load. Errors do not wait.
LOG_BATCH, LOG_SECONDS = 50, 5.0


def plan(
    spark: SparkSession, config: BronzeConfig, manifest: DataFrame
) -> list[tuple[Source, Watermark, Exception | None]]:
    """Active sources in table order with the watermark each starts from, or what is wrong with their
    row. One query for the whole control table; its rows name tables, so there are as many as there
    are tables to load."""
    active = active_sources(manifest).withColumn("position", F.monotonically_increasing_id())
    # Text with its zone, whatever zone Python runs in.
    zone = spark.conf.get("spark.sql.session.timeZone")
    if dict(active.dtypes).get("SRC_DATE_LASTUPDATE") == "timestamp":
        utc = F.to_utc_timestamp("SRC_DATE_LASTUPDATE", zone).cast("string")
        active = active.withColumn("SRC_DATE_LASTUPDATE", F.concat(utc, F.lit("+00:00")))
    stored = stored_watermarks(spark, config).select(
        *[F.col(mine).alias(theirs) for mine, theirs in KEY.items()],
        F.col("value").alias("stored_value"),
        F.col("type").alias("stored_type"),
        "updated_micros",
    )
    rows = active.join(stored, list(KEY.values()), "left").orderBy("position").toLocalIterator()
    planned = []
    for row in rows:
        wrong = None
        try:
            source = source_from_row(row)
        except Exception as error:  # whatever a cell holds, the other rows are loaded
            source, wrong = source_from_row({**row.asDict(), "SRC_FLAG_INCR": None}), error
        if row["updated_micros"] is None:
            start = Watermark(source.last_update)
        else:
            start = stored_watermark(row["stored_value"], row["stored_type"], row["updated_micros"])
        planned.append((source, start, wrong))
    return planned


def run(
    spark: SparkSession, config: BronzeConfig, manifest: DataFrame, run_ts: datetime, name: str | None = None
) -> list[LoadResult]:
    """One load per active source, ``config.parallel`` at a time; sources that share a bronze table
    take turns in table order. A failed load or an odd control row is logged and does not stop the
    others. Where sources have to wait, those that took longest the last time come first. Grown state
    and log folders are folded at the end.

    With a ``name``, a run that was cut short goes on when it is started again under that name: with
    the time it began with, and with what it has not loaded yet. What the lost driver left half done
    is undone first, as with ``reconcile``.
    """
    prepare(spark, config)
    progress = Progress(spark, config, name, run_ts) if name else None
    if progress:
        run_ts = progress.at
        config = replace(config, reconcile=config.reconcile or progress.resumed)
    planned = plan(spark, config, manifest)
    turns: dict[str, list[int]] = {}
    for i, (source, _, _) in enumerate(planned):
        turns.setdefault(config.table(source), []).append(i)
    order = list(turns.values())
    if len(order) > config.parallel:
        took = load_log.last_durations(spark, config.log_path)
        # sources never loaded before may be the longest of all
        order.sort(key=lambda indexes: -sum(took.get(planned[i][0].key, math.inf) for i in indexes))
    results: dict[int, LoadResult] = {}
    unlogged: list[load_log.LogRecord] = []
    written = monotonic()

    def take_turns(indexes: list[int]) -> list[load_log.LogRecord]:
        seen = set()
        for i in indexes:
            source, start, wrong = planned[i]
            if wrong is not None:
                results[i] = refused(config, source, wrong)
                continue
            before = progress.loaded(source, start) if progress and source.key not in seen else None
            # A source listed twice starts its second turn from what the first one stored.
            results[i] = before or attempt(spark, config, source, run_ts, None if source.key in seen else start)
            seen.add(source.key)
            if progress and before is None:
                progress.note(results[i])
        return [record for i in indexes for record in results[i].records]

    try:
        with ThreadPoolExecutor(max_workers=max(1, config.parallel)) as pool:
            work = inheritable_thread_target(spark)(take_turns)
            pending = {pool.submit(work, indexes) for indexes in order}
            while pending:
                finished, pending = wait(pending, LOG_SECONDS, FIRST_COMPLETED)
                unlogged += [record for done in finished for record in done.result()]
                urgent = any(r.action == "ERROR" for r in unlogged) or monotonic() - written > LOG_SECONDS
                if unlogged and (urgent or len(unlogged) >= LOG_BATCH):
                    load_log.log_loads(spark, config.log_path, unlogged)
                    unlogged, written = [], monotonic()
    finally:
        load_log.log_loads(spark, config.log_path, unlogged)
    compact(spark, config, config.compact_after)
    return [results[i] for i in sorted(results)]
