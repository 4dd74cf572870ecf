"""Bronze-layer ingestion on Spark: scan, filter, stamp, land, publish, advance, log."""

from firstpour.config import (
    BronzeConfig,
    JdbcDatabase,
    LakeDatabase,
    Source,
    Split,
    source_from_row,
)
from firstpour.plans.load import LoadError, LoadResult, load
from firstpour.plans.run import run

__all__ = [
    "BronzeConfig",
    "JdbcDatabase",
    "LakeDatabase",
    "LoadError",
    "LoadResult",
    "Source",
    "Split",
    "load",
    "run",
    "source_from_row",
]
