"""File readers: raw CSV, lossless bronze CSV, lakehouse tables, read-by-extension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Options of the raw-source CSV read (comma, double-quote quoting and escaping, header).
RAW_CSV_OPTIONS = {
    "mode": "PERMISSIVE",
    "quote": '"',
    "escape": '"',
    "header": "true",
    "delimiter": ",",
}

# Lossless pipe-separated bronze text. Written with these options plus BRONZE_WRITE_EXTRA,
# read back with these plus BRONZE_READ_EXTRA: '' and null, padding, '|', quotes,
# embedded newlines and backslashes all survive the round trip.
BRONZE_CSV_OPTIONS = {
    "sep": "|",
    "quote": '"',
    "escape": '"',
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Unquoted empty cells are read as null; the mark only keeps the reader from taking a text
# such as \\N or an empty string for null, so it is one that no text holds.
NULL_MARK = "\x01\x02null\x02\x01"
BRONZE_WRITE_EXTRA = {"emptyValue": '""', "nullValue": ""}
BRONZE_READ_EXTRA = {"multiLine": "true", "emptyValue": "", "nullValue": NULL_MARK, "mode": "PERMISSIVE"}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    infer_schema: bool = False,
    **options: str,
) -> DataFrame:
    """Raw CSV source (S1). Pass ``schema`` in production; inference costs a full extra scan."""
    reader = spark.read.options(**RAW_CSV_OPTIONS).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true" if infer_schema else "false")
    return reader.csv(path)


def read_bronze_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Bronze pipe-separated CSV (S2). Without a schema every column is a string (no inference)."""
    reader = spark.read.options(**BRONZE_CSV_OPTIONS).options(**BRONZE_READ_EXTRA)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A lakehouse table by path (S3); ``fmt`` may be delta/iceberg when their jars are present."""
    return spark.read.format(fmt).options(**options).load(path)


_EXTENSIONS = {"csv": "csv", "parquet": "parquet", "pqt": "parquet", "json": "json", "orc": "orc"}


def format_of(path: str) -> str:
    """The file format from the last extension of the name."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    parts = name.split(".")
    if len(parts) < 2 or parts[-1].lower() not in _EXTENSIONS:
        raise ValueError(f"unsupported file format: {path!r}")
    return _EXTENSIONS[parts[-1].lower()]


def read_any(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Read CSV or Parquet by extension (S4/S5). Cloud storage is a path scheme plus Hadoop conf."""
    fmt = format_of(path)
    if fmt == "csv":
        return read_csv(spark, path, schema=schema, infer_schema=schema is None)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
