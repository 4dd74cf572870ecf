"""Column-level functions: charset repair, stamping, naming, casting."""

from firstpour.functions.charset import CHARSETS, force_encode
from firstpour.functions.naming import bronze_name, bronze_name_column, catalog_name
from firstpour.functions.stamp import PARTITION_COLUMNS, partition_values, stamp, with_fetch_partitions
from firstpour.functions.text import all_string, quoted

__all__ = [
    "CHARSETS",
    "PARTITION_COLUMNS",
    "all_string",
    "bronze_name",
    "bronze_name_column",
    "catalog_name",
    "force_encode",
    "partition_values",
    "quoted",
    "stamp",
    "with_fetch_partitions",
]
