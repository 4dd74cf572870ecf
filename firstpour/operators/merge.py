"""Merging chunks into one snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def merge_chunks(chunks: Sequence[DataFrame]) -> DataFrame:
    """All rows of all chunks, duplicates included, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), chunks)
