"""String casting and identifier quoting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def all_string(df: DataFrame) -> DataFrame:
    """Every column as text; nulls stay null."""
    return df.select([F.col(quoted(c)).cast("string").alias(c) for c in df.columns])
