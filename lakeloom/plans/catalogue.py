"""Registered queries over the driver tables, each with its DuckDB oracle SQL.

Every query reads whole tables from ``sf_dir`` (or data Spark derives from them) and
returns a DataFrame; queries that exercise sinks write to the session's shared
checkpoint folder and read their output back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.casts import lenient_text, percent_text
from lakeloom.functions.patterns import anchored, patterns, sql_semantic_type
from lakeloom.functions.values import sql_tagged_value
from lakeloom.operators import marts, profilers, tablesets, transforms
from lakeloom.plans import medallion, profiling
from lakeloom.plans.tables import ORDER_KEYS, SCHEMAS, TABLE_NAMES, dtype, load, load_all
from lakeloom.session import scratch_path
from lakeloom.sinks.catalog import table_exists, write_to_managed_table
from lakeloom.sinks.files import write_bronze_csv, write_csv, write_table
from lakeloom.sources.files import read_any, read_bronze_csv, read_csv, read_table
from lakeloom.sources.tablesets import catalog_table_set, read_table_set

Query = Callable[[SparkSession, str], DataFrame]

PAYLOAD_SCHEMA = "k STRING"
VIEW_EVENT = "view"
DAY = "2024-01-15"
FIND_VALUE = "A"
TEXT_DAY = "1996-01-02"
NAMED_FILES = ["nation", "supplier", "benchmark"]


# ----------------------------------------------------------------------------- marts

def _views(spark: SparkSession, sf: str) -> DataFrame:
    """Viewing events with the JSON payload expanded (the fact of the events marts)."""
    ev = load(spark, sf, "events").where(F.col("event_type") == VIEW_EVENT)
    return transforms.flatten_payload(ev, "props", PAYLOAD_SCHEMA, keep=["ts", "event_type"])


def item_views_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return marts.views_by_period(_views(spark, sf), load(spark, sf, "part"), "k", "p_partkey", F.year("ts"))


def item_orders_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return marts.views_by_period(load(spark, sf, "orders"), load(spark, sf, "lineitem"), "o_orderkey", "l_orderkey",
                                 F.year("o_orderdate"))


def item_view_rank_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return marts.item_rank_by_period(load(spark, sf, "orders"), load(spark, sf, "lineitem"), "o_orderkey",
                                     "l_orderkey", F.year("o_orderdate"), item_from_dim="l_partkey")


def most_used_platform_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return marts.top_group_by_period(load(spark, sf, "orders"), load(spark, sf, "lineitem"), "o_orderkey",
                                     "l_orderkey", F.year("o_orderdate"), "o_orderpriority")


def most_used_brand_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return marts.top_group_by_period(
        _views(spark, sf), load(spark, sf, "part"), "k", "p_partkey",
        transforms.TIME_FUNCTIONS["dayofmonth"](F.col("ts")), "p_brand",
        period_name="day", group_name="most_used_brand", usage_name="total_brand_usage", group_from_dim=True,
    )


_JOIN_EV = ("FROM events e JOIN part p ON TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT) = p.p_partkey "
            f"WHERE e.event_type = '{VIEW_EVENT}'")
_JOIN_OL = "FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey"
SQL_ITEM_VIEWS_BY_YEAR = (
    f"SELECT CAST(year(e.ts) AS INTEGER) AS year, COUNT(*) AS total_item_view {_JOIN_EV} GROUP BY 1"
)

# ------------------------------------------------------------------------ transforms

def flatten_payload(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.flatten_payload(load(spark, sf, "events"), "props", PAYLOAD_SCHEMA)


def flatten_json_found(spark: SparkSession, sf: str) -> DataFrame:
    """The JSON columns are chosen by the first row, as the reference does."""
    return transforms.flatten_json_auto(load(spark, sf, "events"), mode="first", order_by="event_id")


def flatten_json_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Text columns of which one holds objects with nested objects and lists among scalars; none is named."""
    text = F.when(F.col("l_linenumber") == 1, F.col("l_orderkey").cast("string")).otherwise(F.to_json(F.struct(
        F.col("l_orderkey").alias("order"), F.struct("l_partkey", "l_suppkey").alias("of"),
        F.array("l_linenumber", F.col("l_linenumber") + 1).alias("lines"))))
    rows = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", text.alias("doc"))
    out = transforms.flatten_json_auto(rows, expand_lists=2)
    names = {c: c.replace(".", "_") for c in out.columns if c not in ("doc", "lines")}
    return out.select(*[transforms.q(c).alias(n) for c, n in names.items()]).fillna(-1)  # scalar cells have no fields


def flatten_json_auto(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.flatten_json_auto(load(spark, sf, "events"), ["props"])


RENAMES = {"c_name": "customer_name", "c_mktsegment": "market_segment", "c_absent": "ignored"}


def rename_columns(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.rename_columns(load(spark, sf, "customer"), RENAMES)


EVENT_CASTS = {"event_id": "bigint", "ts": "date", "user_id": "int", "value": "float"}


def cast_columns(spark: SparkSession, sf: str) -> DataFrame:
    bronze = transforms.cast_all_to_string(load(spark, sf, "events"))
    return transforms.cast_columns(bronze, EVENT_CASTS)


def cast_all_to_string(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.cast_all_to_string(load(spark, sf, "customer"))


def year_column(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.derive_time_columns(load(spark, sf, "orders"), {"o_orderdate": {"o_orderdate_year": "year"}})


def month_column(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.derive_time_columns(load(spark, sf, "orders"), {"o_orderdate": {"o_orderdate_month": "month"}})


def daily_slice(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.daily_slice(load(spark, sf, "events"), DAY)


# ------------------------------------------------------------------ sources and sinks

def csv_roundtrip_comma(spark: SparkSession, sf: str) -> DataFrame:
    src = load(spark, sf, "part")
    path = scratch_path(spark, "part_csv")
    write_csv(src, path)
    return read_csv(spark, path, schema=src.schema)


def csv_roundtrip_pipe(spark: SparkSession, sf: str) -> DataFrame:
    src = load(spark, sf, "documents")
    path = scratch_path(spark, "documents_bronze")
    write_bronze_csv(src, path)
    return read_bronze_csv(spark, path, schema=src.schema)


def read_any_format(spark: SparkSession, sf: str) -> DataFrame:
    src = load(spark, sf, "customer")
    root = scratch_path(spark, "any")
    write_csv(src, f"{root}/customer.csv")
    write_table(src, f"{root}/customer.parquet")
    return read_any(spark, f"{root}/customer.csv", schema=src.schema).unionByName(
        read_any(spark, f"{root}/customer.parquet"))


def partitioned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    src = transforms.derive_time_columns(load(spark, sf, "orders"), {"o_orderdate": {"o_orderdate_year": "year"}})
    path = scratch_path(spark, "orders_by_year")
    write_table(src, path, partition_by=["o_orderdate_year"])
    return read_table(spark, path).where(F.col("o_orderdate_year") == 1998)


def _managed(spark: SparkSession, sf: str, second_mode: str) -> DataFrame:
    src = load(spark, sf, "customer")
    schema = f"lakeloom_{uuid.uuid4().hex[:10]}"
    location = scratch_path(spark, f"{schema}.db")
    write_to_managed_table(src, "customer", schema, location=location, mode="overwrite")
    name = write_to_managed_table(src, "customer", schema, location=location, mode=second_mode)
    return spark.table(name)


def managed_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    return _managed(spark, sf, "overwrite")


def managed_append(spark: SparkSession, sf: str) -> DataFrame:
    return _managed(spark, sf, "append")


def medallion_views_by_year(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "medallion")
    raw = {"events": load(spark, sf, "events"), "part": load(spark, sf, "part")}
    result = medallion.run_medallion(
        spark, raw, root,
        {"events": medallion.EVENTS_SILVER, "part": medallion.PART_SILVER},
        medallion.EVENTS_GOLD,
    )
    return read_table(spark, result.gold["eventviewitembyyear"])


def medallion_top_brand_by_year(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "medallion")
    raw = {"events": load(spark, sf, "events"), "part": load(spark, sf, "part")}
    result = medallion.run_medallion(
        spark, raw, root,
        {"events": medallion.EVENTS_SILVER, "part": medallion.PART_SILVER},
        medallion.EVENTS_GOLD, bronze_format="parquet",
    )
    return read_table(spark, result.gold["mostusedplatformbyyearrank"])


def incremental_views_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """The yearly totals mart kept by two streaming jobs over files landing in batches."""
    from lakeloom.streaming import stream_silver, stream_view_totals

    root = scratch_path(spark, "incremental")
    events = load(spark, sf, "events")
    # Spark lands the events as several files; the streams pick them up a few at a time
    events.repartition(4, "event_id").write.parquet(f"{root}/landing")
    stream_silver(spark, f"{root}/landing", events.schema, f"{root}/silver", f"{root}/_ckpt/silver",
                  medallion.EVENTS_SILVER, max_files_per_trigger=2)
    part = medallion.to_silver(load(spark, sf, "part"), medallion.PART_SILVER)
    stream_view_totals(spark, f"{root}/silver", part, f"{root}/gold", f"{root}/_ckpt/gold",
                       medallion.EVENTS_GOLD)
    return read_table(spark, f"{root}/gold")


# ------------------------------------------------------------------------- profilers

def profile_head(spark: SparkSession, sf: str) -> DataFrame:
    return profilers.head(load(spark, sf, "customer"), 5, order_by="c_custkey")


def column_types(spark: SparkSession, sf: str) -> DataFrame:
    return profilers.column_types(load(spark, sf, "lineitem"))


def profile_shape(spark: SparkSession, sf: str) -> DataFrame:
    return profilers.shape(load(spark, sf, "customer"))


def table_set_shapes(spark: SparkSession, sf: str) -> DataFrame:
    return tablesets.table_set_shapes(read_table_set(spark, sf, formats=("parquet",)))


def describe_non_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return profilers.describe_non_numeric(load(spark, sf, "orders"))


def describe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return profilers.describe_numeric(load(spark, sf, "lineitem"), digits=4)


def describe_all(spark: SparkSession, sf: str) -> DataFrame:
    return profilers.describe_all(load(spark, sf, "orders"), digits=4)


def duplicate_count(spark: SparkSession, sf: str) -> DataFrame:
    return profilers.duplicate_count(load(spark, sf, "documents"), subset=["text"])


def duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    return profilers.duplicate_count(load(spark, sf, "conversations").select("role", "text"))


def duplicate_rows_table_set(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicates among the whole rows of every table."""
    return _per_table({t: profilers.duplicate_count(df) for t, df in load_all(spark, sf).items()})


def describe_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Every non-numeric column of all tables: text, times, lists."""
    return _per_table({t: profilers.describe_non_numeric(df) for t, df in load_all(spark, sf).items()})


def _exact_values(spark: SparkSession, sf: str) -> DataFrame:
    """The line items with exact money, dates, binary and nested columns, and NaN where nothing is discounted."""
    li = load(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice").cast("decimal(20,2)") * F.lit(1000000).cast("decimal(10,0)")
         + F.col("l_orderkey").cast("decimal(20,2)")).cast("decimal(38,2)").alias("price_key"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("decimal(20,0)").alias("line_key"),
        F.when(F.col("l_discount") == 0, float("nan")).otherwise(F.col("l_discount")).alias("discount"),
        F.to_date("l_shipdate").alias("ship_date"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).cast("binary").alias("raw"),
        F.array("l_orderkey", F.col("l_linenumber").cast("long")).alias("pair"),
        F.struct("l_returnflag", "l_linestatus").alias("flags"),
    )


def unique_exact_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Unique columns among exact decimals, NaN, dates, binary and nested values."""
    return profilers.unique_columns(_exact_values(spark, sf))


def describe_exact_values(spark: SparkSession, sf: str) -> DataFrame:
    """Describe of date, binary and nested columns."""
    return profilers.describe_non_numeric(_exact_values(spark, sf))


def unique_columns(spark: SparkSession, sf: str) -> DataFrame:
    return profilers.unique_columns(load(spark, sf, "customer"))


def unique_columns_table_set(spark: SparkSession, sf: str) -> DataFrame:
    return tablesets.unique_columns_table_set(load_all(spark, sf))


def _documents_labels(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id", "left")


def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profilers.null_counts(_documents_labels(spark, sf))


DETECT_TABLES = ["events", "documents", "pages", "conversations"]


def _per_table(frames: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in frames.items():
        df = df.select(F.lit(name).alias("table_name"), "*")
        out = df if out is None else out.unionByName(df)
    return out


def detect_json_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _per_table({t: profilers.detect_json_columns(load(spark, sf, t), mode="first", order_by=ORDER_KEYS[t])
                       for t in DETECT_TABLES})


def detect_xml_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _per_table({t: profilers.detect_xml_columns(load(spark, sf, t), mode="first", order_by=ORDER_KEYS[t])
                       for t in DETECT_TABLES})


def detect_json_share(spark: SparkSession, sf: str) -> DataFrame:
    return _per_table({t: profilers.detect_json_columns(load(spark, sf, t), mode="share") for t in DETECT_TABLES})


DATE_TABLES = ["orders", "lineitem", "events"]


def date_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _per_table({t: profilers.date_columns(load(spark, sf, t)) for t in DATE_TABLES})


VALUE_COUNT_TABLES = ["orders", "customer"]


def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _per_table({t: profilers.value_counts(load(spark, sf, t), 0.05) for t in VALUE_COUNT_TABLES})


def value_counts_wide(spark: SparkSession, sf: str) -> DataFrame:
    return profilers.value_counts_wide(load(spark, sf, "orders"), 0.05)


def describe_numeric_refined(spark: SparkSession, sf: str) -> DataFrame:
    """Quartiles whose brackets are narrowed by sketches until few values are left to rank."""
    return profilers.describe_numeric(load(spark, sf, "lineitem"), digits=4, limit=2000, accuracy=200)


def describe_numeric_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """Quartiles by the distributed ranks of whole columns."""
    return profilers.describe_numeric(load(spark, sf, "lineitem"), digits=4, limit=1000, refine=False)


def null_percent(spark: SparkSession, sf: str) -> DataFrame:
    """Null shares as percent text for display."""
    counts = profilers.null_counts(_documents_labels(spark, sf))
    return counts.select("column_name", percent_text(F.col("null_ratio_rows")).alias("null_share"))


def list_value_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Dominant elements of a list column."""
    words = load(spark, sf, "benchmark").select(F.split("text", " ").alias("words"))
    return profilers.value_counts(words, 0.01)


def lenient_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents from raw bytes, each followed by a byte that is not UTF-8, decoded without failing."""
    raw = load(spark, sf, "documents").select("doc_id", F.concat(F.col("text").cast("binary"), F.unhex(F.lit("FF"))).alias("raw"))
    return raw.select("doc_id", lenient_text(F.col("raw")).alias("text"))


def _text_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a raw layer holds them: all text, the date day-first, with the time in half of the rows."""
    odd = F.col("o_orderkey") % 2 == 1
    day = F.when(odd, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss"))
    return load(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), day.alias("o_orderdate"), "o_orderpriority")


def date_columns_text(spark: SparkSession, sf: str) -> DataFrame:
    return profilers.date_columns(_text_dates(spark, sf))


def daily_slice_text(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.daily_slice(_text_dates(spark, sf), TEXT_DAY)


def date_columns_voted(spark: SparkSession, sf: str) -> DataFrame:
    """Text dates of which one column has the day first and another the month; the cells elect the order."""
    li = load(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "dd.MM.yyyy").alias("european"), F.date_format("l_shipdate", "MM/dd/yyyy").alias("american"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("iso"), "l_shipdate", "l_returnflag")
    return profilers.date_columns(li, day_first=None)


def daily_slice_set(spark: SparkSession, sf: str) -> DataFrame:
    """One day of every table of a set whose dates are text in several formats; one job finds them all."""
    li = load(spark, sf, "lineitem")
    tables = {
        "orders": _text_dates(spark, sf),
        "lineitem": li.select("l_orderkey", "l_linenumber", F.date_format("l_shipdate", "MM-dd-yyyy").alias("shipped")),
        "events": load(spark, sf, "events"),
        "customer": load(spark, sf, "customer"),
    }
    return tablesets.table_set_shapes(tablesets.sliced(tables, TEXT_DAY))


# ------------------------------------------------------------------------ table sets

def contained_columns(spark: SparkSession, sf: str) -> DataFrame:
    return tablesets.contained_columns(load_all(spark, sf))


def contained_columns_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """The same pairs, with all columns ruled out first that ranges and bitmaps refute."""
    return tablesets.contained_columns(load_all(spark, sf), prune=True)


def unique_columns_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """The same columns, with whole-number columns refuted first by their ranges."""
    return tablesets.unique_columns_table_set(load_all(spark, sf), prune=True)


def find_value(spark: SparkSession, sf: str) -> DataFrame:
    return tablesets.find_value(load_all(spark, sf), FIND_VALUE)


def data_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return tablesets.data_dictionary(load_all(spark, sf), order_by=ORDER_KEYS, mode="first")


def profile_report(spark: SparkSession, sf: str) -> DataFrame:
    """All eleven reports of all tables."""
    return profiling.profile_report(load_all(spark, sf), order_by=ORDER_KEYS)


def report_with_own_profiler(spark: SparkSession, sf: str) -> DataFrame:
    """A report of the registry next to a caller's own one of another shape."""
    def longest(df: DataFrame, table: str) -> DataFrame:
        text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
        return df.agg(F.max(F.greatest(F.lit(0), F.lit(0), *[F.length(c) for c in text])).cast("double").alias("longest_text")).select(
            F.lit(table).alias("table_name"), F.lit("longest").alias("profile"), "longest_text")

    return profiling.profile_report(load_all(spark, sf), {"longest": longest}, reports=["shape"])


def report_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The null reports of all tables, written by run date and profile and read back."""
    path = scratch_path(spark, "report")
    profiling.write_report(profiling.profile_report(load_all(spark, sf), reports=["null_counts"]), path, run_date=DAY)
    return read_table(spark, path).withColumn("run_date", F.col("run_date").cast("string"))


def table_set_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of a table-set tool through the same sink."""
    path = scratch_path(spark, "shapes")
    profiling.write_report(tablesets.table_set_shapes(load_all(spark, sf)), path)
    return read_table(spark, path)


def profile_named_files(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.profile_files(spark, [f"{sf.rstrip('/')}/{t}.parquet" for t in NAMED_FILES])


def catalog_database(spark: SparkSession, sf: str) -> DataFrame:
    """Every table of a catalog database: shapes of the database that the given tables were saved to."""
    schema = f"lakeloom_{uuid.uuid4().hex[:10]}"
    location = scratch_path(spark, f"{schema}.db")
    for t, df in load_all(spark, sf).items():
        write_to_managed_table(df, t, schema, location=location, mode="overwrite", suffix="")
    found = tablesets.table_set_shapes(catalog_table_set(spark, schema))
    known = spark.createDataFrame([(t, table_exists(spark, t, schema, suffix="")) for t in TABLE_NAMES],
                                  "table_name string, in_catalog boolean")
    return found.join(known, "table_name")


def presented_views(spark: SparkSession, sf: str) -> DataFrame:
    """The yearly mart under its presentation names, newest year first."""
    return marts.presentation(item_orders_by_year(spark, sf))


def order_date_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return marts.date_dimension(load(spark, sf, "orders"), "o_orderdate")


def orders_year_over_year(spark: SparkSession, sf: str) -> DataFrame:
    return marts.year_over_year(item_orders_by_year(spark, sf), "year", "total_item_view")


def priority_share_by_year(spark: SparkSession, sf: str) -> DataFrame:
    counts = load(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), "o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"))
    return marts.share_of_total(counts, "orders", within="year")


# ------------------------------------------------------------------------ registry

def queries() -> dict[str, Query]:
    return {
        "item_views_by_year": item_views_by_year,
        "item_orders_by_year": item_orders_by_year,
        "item_view_rank_by_year": item_view_rank_by_year,
        "most_used_platform_by_year": most_used_platform_by_year,
        "most_used_brand_by_day": most_used_brand_by_day,
        "flatten_payload": flatten_payload,
        "flatten_json_auto": flatten_json_auto,
        "rename_columns": rename_columns,
        "cast_columns": cast_columns,
        "cast_all_to_string": cast_all_to_string,
        "year_column": year_column,
        "month_column": month_column,
        "daily_slice": daily_slice,
        "csv_roundtrip_comma": csv_roundtrip_comma,
        "csv_roundtrip_pipe": csv_roundtrip_pipe,
        "read_any_format": read_any_format,
        "partitioned_roundtrip": partitioned_roundtrip,
        "managed_overwrite": managed_overwrite,
        "managed_append": managed_append,
        "medallion_views_by_year": medallion_views_by_year,
        "medallion_top_brand_by_year": medallion_top_brand_by_year,
        "incremental_views_by_year": incremental_views_by_year,
        "profile_head": profile_head,
        "column_types": column_types,
        "profile_shape": profile_shape,
        "table_set_shapes": table_set_shapes,
        "describe_non_numeric": describe_non_numeric,
        "describe_numeric": describe_numeric,
        "describe_all": describe_all,
        "duplicate_count": duplicate_count,
        "duplicate_rows": duplicate_rows,
        "duplicate_rows_table_set": duplicate_rows_table_set,
        "describe_mixed": describe_mixed,
        "unique_exact_keys": unique_exact_keys,
        "describe_exact_values": describe_exact_values,
        "unique_columns": unique_columns,
        "unique_columns_table_set": unique_columns_table_set,
        "null_counts": null_counts,
        "detect_json_columns": detect_json_columns,
        "detect_json_share": detect_json_share,
        "detect_xml_columns": detect_xml_columns,
        "date_columns": date_columns,
        "value_counts": value_counts,
        "value_counts_wide": value_counts_wide,
        "contained_columns": contained_columns,
        "contained_columns_pruned": contained_columns_pruned,
        "unique_columns_pruned": unique_columns_pruned,
        "find_value": find_value,
        "data_dictionary": data_dictionary,
        "profile_report": profile_report,
        "flatten_json_found": flatten_json_found,
        "flatten_json_mixed": flatten_json_mixed,
        "describe_numeric_refined": describe_numeric_refined,
        "describe_numeric_ranked": describe_numeric_ranked,
        "null_percent": null_percent,
        "list_value_counts": list_value_counts,
        "lenient_documents": lenient_documents,
        "date_columns_text": date_columns_text,
        "daily_slice_text": daily_slice_text,
        "report_with_own_profiler": report_with_own_profiler,
        "report_sink": report_sink,
        "table_set_sink": table_set_sink,
        "profile_named_files": profile_named_files,
        "catalog_database": catalog_database,
        "presented_views": presented_views,
        "date_columns_voted": date_columns_voted,
        "daily_slice_set": daily_slice_set,
        "order_date_dimension": order_date_dimension,
        "orders_year_over_year": orders_year_over_year,
        "priority_share_by_year": priority_share_by_year,
    }


# ---------------------------------------------------------------------- oracle SQL

def _q(name: str) -> str:
    return '"' + name + '"'


def _sql_columns(table: str, kinds=None) -> list[str]:
    return [c for c, k in SCHEMAS[table] if kinds is None or k in kinds]


def _union_sql(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _sql_detect(table: str, predicate: str, mode: str) -> list[str]:
    parts = []
    keys = ", ".join(ORDER_KEYS[table])
    for c in _sql_columns(table, ("string",)):
        if mode == "first":
            inner = f"SELECT first(CAST({c} AS VARCHAR) ORDER BY {keys}) AS f FROM {table}"
            parts.append(
                f"SELECT '{table}' AS table_name, '{c}' AS column_name FROM ({inner}) WHERE {predicate.format(x='f')}"
            )
        else:
            parts.append(
                f"SELECT '{table}' AS table_name, '{c}' AS column_name FROM {table} HAVING "
                f"avg(CASE WHEN {c} IS NULL THEN NULL WHEN {predicate.format(x=c)} THEN 1 ELSE 0 END) >= 0.95"
            )
    return parts


_JSON_PRED = "(contains({x}, '{{') AND contains({x}, ':'))"
_XML_PRED = "contains({x}, '<')"


def _sql_date_columns() -> str:
    p = patterns(True)
    parts = []
    for t in DATE_TABLES:
        for c, k in SCHEMAS[t]:
            if k == "floats":
                continue
            txt = f"CAST({c} AS VARCHAR)"
            match = (f"(regexp_matches({txt}, '{anchored(p['date'])}') OR "
                     f"regexp_matches({txt}, '{anchored(p['date_alt'])}'))")
            parsed = f"TRY_CAST({c} AS TIMESTAMP)"
            parts.append(
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, min({parsed}) AS min_date, max({parsed}) AS max_date, "
                f"CAST(datediff('day', CAST(min({parsed}) AS DATE), CAST(max({parsed}) AS DATE)) AS INTEGER) AS days "
                f"FROM {t} HAVING avg(CASE WHEN {c} IS NULL THEN NULL WHEN {match} THEN 1 ELSE 0 END) >= 0.95"
            )
    return _union_sql(parts)


def _sql_value_counts() -> str:
    cells = []
    for t in VALUE_COUNT_TABLES:
        for c in _sql_columns(t, ("string",)):
            cells.append(f"SELECT '{t}' AS t, '{c}' AS c, {c} AS v FROM {t}")
    return (
        f"WITH u AS ({_union_sql(cells)}), "
        "f AS (SELECT t, c, v, COUNT(*) AS n FROM u WHERE v IS NOT NULL GROUP BY t, c, v), "
        "s AS (SELECT t, c, v, n / SUM(n) OVER (PARTITION BY t, c) AS share FROM f) "
        "SELECT t AS table_name, c AS column_name, v AS value, share FROM s WHERE share >= 0.05"
    )


def _sql_value_counts_wide() -> str:
    cols = sorted(_sql_columns("orders", ("string",)))
    cells = _union_sql([f"SELECT '{c}' AS c, {c} AS v FROM orders" for c in cols])
    pivots = ", ".join(f"max(CASE WHEN c = '{c}' THEN share END) AS {c}" for c in cols)
    return (
        f"WITH u AS ({cells}), "
        "f AS (SELECT c, v, COUNT(*) AS n FROM u WHERE v IS NOT NULL GROUP BY c, v), "
        "s AS (SELECT c, v, n / SUM(n) OVER (PARTITION BY c) AS share FROM f) "
        f"SELECT v AS value, {pivots} FROM s WHERE share >= 0.05 GROUP BY v"
    )


def _sql_unique_table_set() -> str:
    parts = []
    for t in TABLE_NAMES:
        for c, _ in SCHEMAS[t]:
            parts.append(
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) AS row_count FROM {t} "
                f"HAVING COUNT({c}) = COUNT(DISTINCT {c}) AND COUNT({c}) > 0"
            )
    return _union_sql(parts)


def _sql_unique_columns() -> str:
    parts = []
    for c in _sql_columns("customer"):
        parts.append(
            f"SELECT '{c}' AS column_name, COUNT(*) AS row_count FROM customer "
            f"HAVING COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) = COUNT(*)"
        )
    return _union_sql(parts)


_SQL_EXACT = (
    "WITH x AS (SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(20,2)) * 1000000 + l_orderkey "
    "AS DECIMAL(38,2)) AS price_key, CAST(l_orderkey * 8 + l_linenumber AS DECIMAL(20,0)) AS line_key, "
    "CASE WHEN l_discount = 0 THEN CAST('nan' AS DOUBLE) ELSE l_discount END AS discount, CAST(l_shipdate AS DATE) AS ship_date, "
    "CAST(l_orderkey || '-' || l_linenumber AS BLOB) AS raw, [l_orderkey, l_linenumber] AS pair, "
    "{{'l_returnflag': l_returnflag, 'l_linestatus': l_linestatus}} AS flags FROM lineitem) {0}"
)


def _sql_unique_exact() -> str:
    return _SQL_EXACT.format(_union_sql([
        f"SELECT '{c}' AS column_name, COUNT(*) AS row_count FROM x HAVING COUNT(DISTINCT {c}) = COUNT(*)"
        for c in ("l_orderkey", "l_linenumber", "price_key", "line_key", "discount", "ship_date", "raw", "pair", "flags")]))


def _sql_describe_exact() -> str:
    parts = []
    for c in ("ship_date", "raw", "pair", "flags"):
        top = "CAST(first(v ORDER BY n DESC, v ASC) AS VARCHAR)" if c == "ship_date" else "NULL::VARCHAR"
        parts.append(f"SELECT '{c}' AS column_name, CAST(SUM(n) AS BIGINT) AS count, COUNT(*) AS \"unique\", {top} AS top, "
                     f"max(n) AS freq FROM (SELECT {c} AS v, COUNT(*) AS n FROM x GROUP BY 1)")
    return _SQL_EXACT.format(_union_sql(parts))


def _sql_describe_mixed() -> str:
    parts = []
    for t in TABLE_NAMES:
        for c, k in SCHEMAS[t]:
            if k in ("string", "ts", "floats"):
                top = "NULL::VARCHAR" if k == "floats" else "CAST(first(v ORDER BY n DESC, v ASC) AS VARCHAR)"
                parts.append(
                    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(coalesce(SUM(n), 0) AS BIGINT) AS count, "
                    f"COUNT(*) AS \"unique\", {top} AS top, max(n) AS freq FROM "
                    f"(SELECT {c} AS v, COUNT(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY 1)")
    return _union_sql(parts)


_SQL_TEXT_DATES = (
    "(SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 2 = 1 THEN strftime(o_orderdate, '%d/%m/%Y') "
    "ELSE strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') END AS o_orderdate, o_orderpriority, o_orderdate AS d FROM orders)"
)


def _sql_null_counts() -> str:
    j = "SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
    cols = _sql_columns("documents") + ["quality", "toxic"]
    parts = []
    for c in cols:
        nn = f"COUNT({c})"
        nulls = f"(COUNT(*) - COUNT({c}))"
        parts.append(
            f"SELECT '{c}' AS column_name, {nulls} AS null_count, {nn} AS non_null_count, "
            f"CASE WHEN {nn} > 0 THEN {nulls} / {nn} END AS null_ratio_nonnull, "
            f"CASE WHEN COUNT(*) > 0 THEN {nulls} / COUNT(*) END AS null_ratio_rows FROM j"
        )
    return f"WITH j AS ({j}) " + _union_sql(parts)


def _sql_describe_numeric(table: str = "lineitem", padded: bool = False) -> str:
    parts = []
    pad = "NULL::BIGINT AS unique, NULL::VARCHAR AS top, NULL::BIGINT AS freq, " if padded else ""
    for c in _sql_columns(table, ("int", "long", "double")):
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, COUNT({c}) AS count, {pad}round(avg({x}), 4) AS mean, "
            f"round(stddev_samp({x}), 4) AS std, round(min({x}), 4) AS min, "
            f"round(quantile_cont({x}, 0.25), 4) AS p25, round(quantile_cont({x}, 0.5), 4) AS p50, "
            f"round(quantile_cont({x}, 0.75), 4) AS p75, round(max({x}), 4) AS max FROM {table}"
        )
    return _union_sql(parts)


def _sql_describe_non_numeric(padded: bool = False) -> str:
    parts = []
    pad = (", NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS p25, "
           "NULL::DOUBLE AS p50, NULL::DOUBLE AS p75, NULL::DOUBLE AS max") if padded else ""
    for c in _sql_columns("orders", ("string", "ts")):
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(SUM(n) AS BIGINT) AS count, COUNT(*) AS unique, "
            f"CAST(first(v ORDER BY n DESC, v ASC) AS VARCHAR) AS top, max(n) AS freq{pad} FROM "
            f"(SELECT {c} AS v, COUNT(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY 1)"
        )
    return _union_sql(parts)


def _sql_contained() -> str:
    parts = []
    for t in TABLE_NAMES:
        for c, k in SCHEMAS[t]:
            tv = sql_tagged_value(c, dtype(t, c))
            if tv is None:
                continue
            parts.append(f"SELECT DISTINCT '{t}' AS t, '{c}' AS c, {tv} AS v FROM {t} WHERE {c} IS NOT NULL")
    return (
        f"WITH u AS ({_union_sql(parts)}), "
        "n AS (SELECT t, c, COUNT(*) AS k FROM u WHERE v IS NOT NULL GROUP BY t, c), "
        "m AS (SELECT a.t AS t1, a.c AS c1, b.t AS t2, b.c AS c2, COUNT(*) AS k FROM u a JOIN u b ON a.v = b.v "
        "GROUP BY a.t, a.c, b.t, b.c) "
        "SELECT m.t1 AS table_1, m.c1 AS col_1, m.t2 AS table_2, m.c2 AS col_2 FROM m "
        "JOIN n ON m.t1 = n.t AND m.c1 = n.c WHERE m.k = n.k AND m.c1 <> m.c2 "
        "AND strpos(m.c1, 'Id') = 0 AND strpos(m.c2, 'Id') = 0"
    )


def _sql_find_value() -> str:
    parts = []
    for t in TABLE_NAMES:
        for c in _sql_columns(t, ("string",)):
            parts.append(
                f"SELECT '{c}' AS column_name, '{t}' AS table_name, '{FIND_VALUE}' AS value FROM {t} "
                f"HAVING bool_or({c} = '{FIND_VALUE}')"
            )
    return _union_sql(parts)


def _sql_data_dictionary() -> str:
    parts = []
    for t in TABLE_NAMES:
        keys = ", ".join(ORDER_KEYS[t])
        for c, k in SCHEMAS[t]:
            if k == "floats":
                continue
            first = f"(SELECT first(CAST({c} AS VARCHAR) ORDER BY {keys}) AS f FROM {t})"
            label = sql_semantic_type("f")
            parts.append(
                f"SELECT * FROM (SELECT '{c}' AS column_name, '{t}' AS table_name, {label} AS dtype FROM {first}) "
                "WHERE dtype IS NOT NULL"
            )
    return _union_sql(parts)


def _sql_table_set_shapes() -> str:
    return _union_sql([
        f"SELECT '{t}' AS table_name, COUNT(*) AS rows, CAST({len(SCHEMAS[t])} AS INTEGER) AS cols FROM {t}"
        for t in TABLE_NAMES
    ])


def _sql_column_types() -> str:
    """Names and types from the engine's own DESCRIBE of the file, in Spark's type names."""
    return (
        "SELECT column_name, CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' "
        "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS dtype FROM (DESCRIBE SELECT * FROM lineitem)"
    )


def _sql_customer_strings() -> str:
    cols = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c, _ in SCHEMAS["customer"])
    return f"SELECT {cols} FROM customer"


def _sql_top(period_sql: str, group_sql: str, join: str, names: tuple[str, str, str]) -> str:
    p, g, u = names
    return (
        f"WITH c AS (SELECT {period_sql} AS {p}, {group_sql} AS {g}, COUNT(*) AS {u} {join} GROUP BY 1, 2) "
        f"SELECT {p}, {g}, {u} FROM c QUALIFY dense_rank() OVER (PARTITION BY {p} ORDER BY {u} DESC) = 1"
    )


def oracle_sql() -> dict[str, str]:
    years = "CAST(year(o.o_orderdate) AS INTEGER)"
    return {
        "item_views_by_year": SQL_ITEM_VIEWS_BY_YEAR,
        "item_orders_by_year": f"SELECT {years} AS year, COUNT(*) AS total_item_view {_JOIN_OL} GROUP BY 1",
        "item_view_rank_by_year": (
            f"WITH c AS (SELECT {years} AS year, l.l_partkey AS item_id, COUNT(*) AS total_item_view {_JOIN_OL} "
            "GROUP BY 1, 2) SELECT year, total_item_view, item_id, "
            "CAST(dense_rank() OVER (PARTITION BY year ORDER BY total_item_view DESC) AS INTEGER) AS view_ranking FROM c"
        ),
        "most_used_platform_by_year": _sql_top(years, "o.o_orderpriority", _JOIN_OL,
                                               ("year", "most_used_platform", "total_platform_usage")),
        "most_used_brand_by_day": _sql_top("CAST(dayofmonth(e.ts) AS INTEGER)", "p.p_brand", _JOIN_EV,
                                           ("day", "most_used_brand", "total_brand_usage")),
        "flatten_payload": (
            "SELECT event_id, ts, user_id, event_type, value, json_extract_string(props, '$.k') AS k FROM events"
        ),
        "flatten_json_auto": "SELECT *, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
        "rename_columns": (
            "SELECT c_custkey, c_name AS customer_name, c_nationkey, c_acctbal, c_mktsegment AS market_segment "
            "FROM customer"
        ),
        "cast_columns": (
            "SELECT CAST(event_id AS BIGINT) AS event_id, CAST(ts AS DATE) AS ts, CAST(user_id AS INTEGER) AS user_id, "
            "event_type, CAST(CAST(value AS VARCHAR) AS FLOAT) AS value, props FROM events"
        ),
        "cast_all_to_string": _sql_customer_strings(),
        "year_column": "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year FROM orders",
        "month_column": "SELECT *, CAST(month(o_orderdate) AS INTEGER) AS o_orderdate_month FROM orders",
        "daily_slice": f"SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '{DAY}'",
        "csv_roundtrip_comma": "SELECT * FROM part",
        "csv_roundtrip_pipe": "SELECT * FROM documents",
        "read_any_format": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
        "partitioned_roundtrip": (
            "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year FROM orders WHERE year(o_orderdate) = 1998"
        ),
        "managed_overwrite": "SELECT * FROM customer",
        "managed_append": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
        "medallion_views_by_year": SQL_ITEM_VIEWS_BY_YEAR,
        "incremental_views_by_year": SQL_ITEM_VIEWS_BY_YEAR,
        "medallion_top_brand_by_year": _sql_top("CAST(year(e.ts) AS INTEGER)", "p.p_brand", _JOIN_EV,
                                                ("year", "most_used_platform", "total_platform_usage")),
        "profile_head": "SELECT * FROM customer ORDER BY c_custkey LIMIT 5",
        "column_types": _sql_column_types(),
        "profile_shape": "SELECT COUNT(*) AS rows, CAST(5 AS INTEGER) AS cols FROM customer",
        "table_set_shapes": _sql_table_set_shapes(),
        "describe_non_numeric": _sql_describe_non_numeric(),
        "describe_numeric": _sql_describe_numeric(),
        "describe_all": (
            "SELECT column_name, count, CAST(\"unique\" AS DOUBLE) AS \"unique\", top, CAST(freq AS DOUBLE) AS freq, "
            "mean, std, min, p25, p50, p75, max FROM ("
            + _sql_describe_non_numeric(padded=True) + "\nUNION ALL\n" + _sql_describe_numeric("orders", True) + ")"
        ),
        "duplicate_count": "SELECT CAST(COUNT(*) - COUNT(DISTINCT text) AS BIGINT) AS duplicate_qty FROM documents",
        "duplicate_rows": (
            "SELECT CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT role, text FROM conversations)) AS BIGINT) "
            "AS duplicate_qty FROM conversations"
        ),
        "duplicate_rows_table_set": _union_sql([
            f"SELECT '{t}' AS table_name, CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {t})) AS BIGINT) "
            f"AS duplicate_qty FROM {t}" for t in TABLE_NAMES]),
        "describe_mixed": _sql_describe_mixed(),
        "unique_exact_keys": _sql_unique_exact(),
        "describe_exact_values": _sql_describe_exact(),
        "unique_columns": _sql_unique_columns(),
        "unique_columns_table_set": _sql_unique_table_set(),
        "null_counts": _sql_null_counts(),
        "detect_json_columns": _union_sql([p for t in DETECT_TABLES for p in _sql_detect(t, _JSON_PRED, "first")]),
        "detect_json_share": _union_sql([p for t in DETECT_TABLES for p in _sql_detect(t, _JSON_PRED, "share")]),
        "detect_xml_columns": _union_sql([p for t in DETECT_TABLES for p in _sql_detect(t, _XML_PRED, "first")]),
        "date_columns": _sql_date_columns(),
        "value_counts": _sql_value_counts(),
        "value_counts_wide": _sql_value_counts_wide(),
        "contained_columns": _sql_contained(),
        "contained_columns_pruned": _sql_contained(),
        "unique_columns_pruned": _sql_unique_table_set(),
        "find_value": _sql_find_value(),
        "data_dictionary": _sql_data_dictionary(),
        "profile_report": profiling.report_sql(TABLE_NAMES),
        "flatten_json_found": "SELECT *, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
        "flatten_json_mixed": (
            "SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN l_linenumber <> 1 THEN l_orderkey ELSE -1 END AS \"order\", "
            "CASE WHEN l_linenumber <> 1 THEN l_partkey ELSE -1 END AS of_l_partkey, CASE WHEN l_linenumber <> 1 THEN l_suppkey ELSE -1 END "
            "AS of_l_suppkey, CASE WHEN l_linenumber <> 1 THEN CAST(l_linenumber AS BIGINT) ELSE -1 END AS lines_0, "
            "CASE WHEN l_linenumber <> 1 THEN CAST(l_linenumber + 1 AS BIGINT) ELSE -1 END AS lines_1 FROM lineitem"
        ),
        "describe_numeric_refined": _sql_describe_numeric(),
        "describe_numeric_ranked": _sql_describe_numeric(),
        "null_percent": (
            "SELECT column_name, printf('%.1f%%', 100 * null_ratio_rows) AS null_share FROM (" + _sql_null_counts() + ")"
        ),
        "list_value_counts": (
            "WITH u AS (SELECT unnest(string_split(text, ' ')) AS v FROM benchmark), f AS (SELECT v, COUNT(*) AS n FROM u "
            "GROUP BY v), s AS (SELECT v, n / SUM(n) OVER () AS share FROM f) "
            "SELECT 'words' AS column_name, v AS value, share FROM s WHERE share >= 0.01"
        ),
        "lenient_documents": "SELECT doc_id, text || chr(65533) AS text FROM documents",
        "date_columns_text": (
            "SELECT 'o_orderdate' AS column_name, min(e) AS min_date, max(e) AS max_date, CAST(datediff('day', "
            "CAST(min(e) AS DATE), CAST(max(e) AS DATE)) AS INTEGER) AS days FROM (SELECT CASE WHEN o_orderkey % 2 = 1 THEN "
            "date_trunc('day', o_orderdate)::TIMESTAMP ELSE date_trunc('second', o_orderdate) END AS e FROM orders)"
        ),
        "daily_slice_text": (
            f"SELECT o_orderkey, o_orderdate, o_orderpriority FROM {_SQL_TEXT_DATES} WHERE CAST(d AS DATE) = DATE '{TEXT_DAY}'"
        ),
        "report_with_own_profiler": _union_sql([
            f"SELECT '{t}' AS table_name, 'shape' AS profile, NULL::VARCHAR AS column_name, '{m}' AS metric, "
            f"CAST({n} AS DOUBLE) AS num_value, NULL::VARCHAR AS str_value, NULL::DOUBLE AS longest_text FROM {t}"
            for t in TABLE_NAMES for m, n in (("rows", "COUNT(*)"), ("cols", f"any_value({len(SCHEMAS[t])})"))
        ] + [
            f"SELECT '{t}', 'longest', NULL, NULL, NULL, NULL, CAST(max(greatest(0, 0"
            + "".join(f", length({c})" for c in _sql_columns(t, ("string",))) + f")) AS DOUBLE) FROM {t}" for t in TABLE_NAMES]),
        "report_sink": (
            f"SELECT *, '{DAY}' AS run_date FROM ({profiling.report_sql(TABLE_NAMES)}) WHERE profile IN ('null_counts', 'null_ratio')"
        ),
        "table_set_sink": _sql_table_set_shapes(),
        "profile_named_files": (
            "SELECT table_name || '.parquet' AS table_name, * EXCLUDE (table_name) FROM ("
            + profiling.report_sql(NAMED_FILES) + ")"
        ),
        "catalog_database": f"SELECT *, true AS in_catalog FROM ({_sql_table_set_shapes()})",
        "date_columns_voted": _union_sql([
            f"SELECT '{c}' AS column_name, min(d) AS min_date, max(d) AS max_date, CAST(datediff('day', CAST(min(d) AS DATE), "
            f"CAST(max(d) AS DATE)) AS INTEGER) AS days FROM (SELECT {x} AS d FROM lineitem)"
            for c, x in (("european", "date_trunc('day', l_shipdate)::TIMESTAMP"), ("american", "date_trunc('day', l_shipdate)::TIMESTAMP"),
                         ("iso", "date_trunc('day', l_shipdate)::TIMESTAMP"), ("l_shipdate", "l_shipdate"))]),
        "daily_slice_set": _union_sql([
            f"SELECT '{t}' AS table_name, COUNT(*) AS rows, CAST({n} AS INTEGER) AS cols FROM {t}{where}" for t, n, where in (
                ("orders", 3, f" WHERE CAST(o_orderdate AS DATE) = DATE '{TEXT_DAY}'"),
                ("lineitem", 3, f" WHERE CAST(l_shipdate AS DATE) = DATE '{TEXT_DAY}'"),
                ("events", 6, f" WHERE CAST(ts AS DATE) = DATE '{TEXT_DAY}'"), ("customer", 5, ""))]),
        "order_date_dimension": (
            "SELECT d AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) "
            "AS month, CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week FROM (SELECT "
            "CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo, "
            "CAST(max(o_orderdate) AS DATE) AS hi FROM orders))"
        ),
        "orders_year_over_year": (
            f"WITH t AS (SELECT {years} AS year, COUNT(*) AS n {_JOIN_OL} GROUP BY 1), y AS (SELECT unnest(range(lo, hi + 1)) AS year "
            "FROM (SELECT min(year) AS lo, max(year) AS hi FROM t)), f AS (SELECT CAST(y.year AS INTEGER) AS year, coalesce(n, 0) "
            "AS total_item_view FROM y LEFT JOIN t USING (year)), p AS (SELECT *, lag(CAST(total_item_view AS DOUBLE)) OVER (ORDER BY year) AS previous "
            "FROM f) SELECT *, total_item_view - previous AS change, CASE WHEN previous <> 0 THEN (total_item_view - previous) / previous "
            "END AS change_ratio FROM p"
        ),
        "priority_share_by_year": (
            "WITH c AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority, COUNT(*) AS orders FROM orders "
            "GROUP BY 1, 2) SELECT *, orders / sum(orders) OVER (PARTITION BY year) AS share FROM c"
        ),
        "presented_views": (
            f"SELECT {years} AS \"Year\", COUNT(*) AS \"Total Item View\" {_JOIN_OL} GROUP BY 1 ORDER BY 1 DESC"
        ),
    }
