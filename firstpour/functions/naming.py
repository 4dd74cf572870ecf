"""Names of bronze tables."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def bronze_name(type: str, name: str, origin: str, object: str) -> str:
    """``<source>_<schema>_<table>`` for databases, ``<source>_<sheet>`` for workbooks."""
    parts = [name, object] if type == "FILE" else [name, origin, object]
    parts[-1] = parts[-1].replace(" ", "_")
    return "_".join(parts)


def bronze_name_column(type: Column, name: Column, origin: Column, object: Column) -> Column:
    """The same name computed over a control table."""
    spaceless = F.replace(object, F.lit(" "), F.lit("_"))
    return F.when(type == "FILE", F.concat_ws("_", name, spaceless)).otherwise(
        F.concat_ws("_", name, origin, spaceless)
    )


def catalog_name(name: str) -> str:
    """Spark's catalog takes letters, digits and underscores only, and ignores case. Other
    characters are spelled out as their code, so two tables cannot end up under one name."""
    return re.sub(r"[^0-9A-Za-z_]", lambda m: f"_x{ord(m.group()):02x}_", name).lower()
