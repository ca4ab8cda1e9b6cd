"""Sources: raw and bronze CSV, lakehouse tables, read-by-extension, table sets."""

from lakeloom.sources.files import (
    BRONZE_CSV_OPTIONS,
    RAW_CSV_OPTIONS,
    format_of,
    read_any,
    read_bronze_csv,
    read_csv,
    read_table,
)
from lakeloom.sources.tablesets import (
    catalog_table_set,
    jdbc_table_set,
    read_named_tables,
    read_table_set,
)

__all__ = [
    "BRONZE_CSV_OPTIONS",
    "RAW_CSV_OPTIONS",
    "format_of",
    "read_any",
    "read_bronze_csv",
    "read_csv",
    "read_table",
    "catalog_table_set",
    "jdbc_table_set",
    "read_named_tables",
    "read_table_set",
]
