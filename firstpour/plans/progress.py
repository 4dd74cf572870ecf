"""Progress of a run over a control table, so that a run cut short can be taken up again.

A run with a name keeps a small file for each source it has loaded, next to one with its time. Started
again under that name it has the same time, passes over those sources and loads the rest, after undoing
what the lost driver left half done. A load that was committed but not noted any more is told by its
watermark record, which has the run's time.
"""

from __future__ import annotations

import hashlib
import json
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from firstpour import storage
from firstpour.config import BronzeConfig, Source
from firstpour.functions.stamp import in_utc
from firstpour.plans.load import LoadResult, Watermark


class Progress:
    def __init__(self, spark: SparkSession, config: BronzeConfig, name: str, run_ts: datetime):
        self.spark, self.config = spark, config
        self.folder = f"{config.root}/_control/runs/{hashlib.sha256(name.encode()).hexdigest()[:32]}"
        header = f"{self.folder}/run.json"
        # of two drivers that start one run both get the time of the first
        storage.write_text(spark, header, json.dumps({"name": name, "at": in_utc(run_ts).isoformat()}))
        held = json.loads(storage.read_text(spark, header))
        self.at = datetime.fromisoformat(held["at"]).astimezone(timezone.utc)
        names = storage.children(spark, f"{self.folder}/done")
        self.done = {n: json.loads(storage.read_text(spark, f"{self.folder}/done/{n}")) for n in names}
        self.resumed = bool(names) or self.at != in_utc(run_ts)

    def _note(self, source: Source) -> str:
        key = json.dumps([source.type, *source.key])
        return hashlib.sha256(key.encode()).hexdigest()[:32] + ".json"

    def loaded(self, source: Source, start: Watermark) -> LoadResult | None:
        """The result of a source this run has loaded already."""
        table, held = self.config.table(source), self.done.get(self._note(source))
        if held is not None:
            return LoadResult(source, table, held["rows"], "loaded before", held["watermark"])
        if source.incremental and start.updated_at == self.at:
            return LoadResult(source, table, 0, "loaded before", start.value)
        return None

    def note(self, result: LoadResult) -> None:
        if result.error is None:
            text = json.dumps({"source": result.source.key, "rows": result.rows, "watermark": result.watermark})
            storage.write_text(self.spark, f"{self.folder}/done/{self._note(result.source)}", text)
