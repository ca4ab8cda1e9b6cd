"""Catalog sinks: schemas and managed tables (K4-K6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

MANAGED_SUFFIX = "_gold_layer_managed_table"


def qualified_name(table: str, schema: str, catalog: str | None = None, suffix: str = MANAGED_SUFFIX) -> str:
    """The one place that builds a managed table's name."""
    parts = [p for p in (catalog, schema, f"{table}{suffix}") if p]
    return ".".join(f"`{p}`" for p in parts)


def create_schema(spark: SparkSession, schema: str, catalog: str | None = None, location: str | None = None) -> None:
    """CREATE SCHEMA IF NOT EXISTS; with ``location`` its managed tables live under that path."""
    name = ".".join(f"`{p}`" for p in (catalog, schema) if p)
    stmt = f"CREATE SCHEMA IF NOT EXISTS {name}"
    if location:
        stmt += f" LOCATION '{location}'"
    spark.sql(stmt)


def table_exists(spark: SparkSession, table: str, schema: str, catalog: str | None = None,
                 suffix: str = MANAGED_SUFFIX) -> bool:
    name = ".".join(p for p in (catalog, schema, f"{table}{suffix}") if p)
    return spark.catalog.tableExists(name)


def write_to_managed_table(
    df: DataFrame,
    table: str,
    schema: str,
    catalog: str | None = None,
    partition_cols: Sequence[str] = (),
    mode: str = "overwrite",
    fmt: str = "parquet",
    location: str | None = None,
    suffix: str = MANAGED_SUFFIX,
) -> str:
    """Create the schema if needed, then overwrite or append the managed table (K4).

    The same ``mode`` is used whether or not the table exists yet (B11). Returns the
    table's qualified name.
    """
    spark = df.sparkSession
    create_schema(spark, schema, catalog, location)
    name = qualified_name(table, schema, catalog, suffix)
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, got {mode!r}")
    w = df.write.format(fmt).mode(mode)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.saveAsTable(name)
    return name
