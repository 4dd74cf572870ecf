"""Row selection: free-text constraint and high-watermark predicate."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from firstpour.functions.text import quoted


def condition(text: str | None) -> str:
    """A constraint without the WHERE it may start with."""
    return re.sub(r"\A\s*where\b", "", text or "", flags=re.IGNORECASE).strip()


def column_name(df: DataFrame, text: str) -> str | None:
    """The column a text names, in the column's own spelling."""
    return next((c for c in df.columns if c.lower() == text.strip().lower()), None)


def criteria_column(df: DataFrame, text: str) -> Column:
    """A watermark criterion: a column, or an expression over columns."""
    name = column_name(df, text)
    return F.col(quoted(name)) if name else F.expr(text)


def field_type(df: DataFrame, text: str) -> DataType:
    return df.select(criteria_column(df, text)).schema[0].dataType


def constrain(df: DataFrame, text: str | None) -> DataFrame:
    """Keep the rows a SQL condition holds for; no text keeps all."""
    return df.where(F.expr(condition(text))) if condition(text) else df


def since(df: DataFrame, column: str | None, value: str | None, missed: bool = False) -> DataFrame:
    """Rows strictly past the watermark. Without a column or a value there is no filter: comparing
    with null would keep nothing. Rows whose own value is null or equal are not picked up, but for
    ``missed``, to be counted."""
    if not column or value is None:
        return df
    own, mark = criteria_column(df, column), F.lit(value).cast(field_type(df, column))
    return df.where((own >= mark) | own.isNull() if missed else own > mark)


def select_rows(
    df: DataFrame, where: str | None = None, column: str | None = None, value: str | None = None, missed: bool = False
) -> DataFrame:
    """Constraint AND watermark. Each is its own condition, so ``a OR b`` as a constraint means
    ``(a OR b) AND column > value``."""
    return since(constrain(df, where), column, value, missed)
