"""Sinks: bronze/raw CSV, lakehouse tables, managed catalog tables."""

from lakeloom.sinks.catalog import create_schema, qualified_name, table_exists, write_to_managed_table
from lakeloom.sinks.files import write_bronze_csv, write_counted, write_csv, write_table

__all__ = [
    "create_schema",
    "qualified_name",
    "table_exists",
    "write_to_managed_table",
    "write_bronze_csv",
    "write_counted",
    "write_csv",
    "write_table",
]
