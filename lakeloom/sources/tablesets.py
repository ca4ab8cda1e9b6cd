"""Table sets: every table of a folder, of a Spark database, or of a JDBC database.

Listing is driver-side metadata only; each table stays a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeloom.sources.files import format_of, read_any


def _list_names(spark: SparkSession, directory: str) -> list[str]:
    jvm = spark.sparkContext._jvm  # Hadoop FileSystem works for every storage scheme
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(directory)
    return sorted(str(s.getPath().getName()) for s in p.getFileSystem(conf).listStatus(p))


def read_table_set(
    spark: SparkSession, directory: str, formats: tuple[str, ...] = ("parquet", "csv")
) -> dict[str, DataFrame]:
    """One DataFrame per data file (or file-set directory) of ``directory``."""
    tables: dict[str, DataFrame] = {}
    for name in _list_names(spark, directory):
        if name.startswith((".", "_")):
            continue
        try:
            fmt = format_of(name)
        except ValueError:
            continue
        if fmt not in formats:
            continue
        tables[name.rsplit(".", 1)[0]] = read_any(spark, f"{directory.rstrip('/')}/{name}")
    return tables


def catalog_table_set(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """Every table of a Spark database (S8/S9 for catalog-registered sources)."""
    db = database or spark.catalog.currentDatabase()
    return {t.name: spark.table(f"`{db}`.`{t.name}`") for t in spark.catalog.listTables(db) if not t.isTemporary}


def jdbc_table_names(spark: SparkSession, url: str, properties: dict[str, str] | None = None,
                     schema: str | None = None) -> list[str]:
    """The base tables an external database names in ``INFORMATION_SCHEMA``."""
    where = "table_type = 'BASE TABLE'"
    if schema:
        where += " AND table_schema = '" + schema.replace("'", "''") + "'"
    query = f"(SELECT table_name AS name FROM information_schema.tables WHERE {where}) t"
    return sorted(r["name"] for r in spark.read.jdbc(url, query, properties=dict(properties or {})).collect())


def jdbc_key_bounds(spark: SparkSession, url: str, table: str, column: str,
                    properties: dict[str, str] | None = None) -> tuple | None:
    """Smallest and largest value of a key, asked of the database; None for an empty table."""
    query = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) t"
    row = spark.read.jdbc(url, query, properties=dict(properties or {})).first()
    return None if row is None or row["lo"] is None else (row["lo"], row["hi"])


def jdbc_table_set(
    spark: SparkSession,
    url: str,
    tables: list[str] | None = None,
    properties: dict[str, str] | None = None,
    partitioning: dict[str, tuple] | None = None,
    schema: str | None = None,
) -> dict[str, DataFrame]:
    """Tables of an external database through JDBC (S8/S9); all its base tables when none are named.

    ``partitioning[table] = (column, num_partitions)`` splits the read into parallel range queries
    between the key's bounds, which the database is asked for; ``(column, lower, upper,
    num_partitions)`` states them. Without it a table is read by a single task. Credentials belong
    in ``properties`` from the cluster's secret store, never in code.
    """
    props = dict(properties or {})
    out: dict[str, DataFrame] = {}
    for t in jdbc_table_names(spark, url, props, schema) if tables is None else tables:
        spec = (partitioning or {}).get(t)
        if spec and len(spec) == 2:
            bounds = jdbc_key_bounds(spark, url, t, spec[0], props)
            spec = (spec[0], *bounds, spec[1]) if bounds else None
        if spec:
            column, lower, upper, n = spec
            out[t] = spark.read.jdbc(
                url, t, column=column, lowerBound=lower, upperBound=upper, numPartitions=n, properties=props
            )
        else:
            out[t] = spark.read.jdbc(url, t, properties=props)
    return out


def read_named_tables(spark: SparkSession, directory: str, names: list[str]) -> dict[str, DataFrame]:
    """The ``<name>.parquet`` files of ``directory`` for the given names."""
    return {n: spark.read.parquet(f"{directory.rstrip('/')}/{n}.parquet") for n in names}
