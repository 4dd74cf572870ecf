"""The control table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def active_sources(manifest: DataFrame) -> DataFrame:
    return manifest.where("SRC_FLAG_ACTIV = 1")
