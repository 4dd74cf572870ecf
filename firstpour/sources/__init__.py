"""Scans: database tables, lake tables, workbook sheets, the control table, landed files."""

from firstpour.sources.inventory import file_count, inventory, landed_files, last_sequence
from firstpour.sources.jdbc import scan_jdbc
from firstpour.sources.lake import read_bronze, scan_parquet
from firstpour.sources.manifest import active_sources
from firstpour.sources.sheets import LEADING_ROWS, decode_sheets, scan_sheets

__all__ = [
    "LEADING_ROWS",
    "active_sources",
    "decode_sheets",
    "file_count",
    "inventory",
    "landed_files",
    "last_sequence",
    "read_bronze",
    "scan_jdbc",
    "scan_parquet",
    "scan_sheets",
]
