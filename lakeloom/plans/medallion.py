"""The layered load: raw -> bronze -> silver -> gold (L1-L4, K1-K4).

Layers talk only through written tables in a shared folder, so every layer is
restartable and a lost executor only costs the tasks of the current write.
Row counts come from ``Observation`` metrics of the writes themselves (no extra jobs).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.operators.marts import dense_rank_counts, fact_dim_counts, top_with_ties
from lakeloom.operators.transforms import (
    cast_all_to_string,
    cast_columns,
    derive_time_columns,
    flatten_payload,
    q,
    rename_columns,
)
from lakeloom.sinks.catalog import write_to_managed_table
from lakeloom.sinks.files import write_bronze_csv, write_counted, write_table
from lakeloom.sources.files import read_bronze_csv, read_table


@dataclass
class SilverSpec:
    """How one bronze table becomes a silver table (config-driven, no name magic)."""

    json_column: str | None = None
    json_schema: StructType | str | None = None
    keep: Sequence[str] | None = None
    rename: Mapping[str, str] = field(default_factory=dict)
    casts: Mapping[str, str] = field(default_factory=dict)
    derive: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    partition_by: Sequence[str] = ()


@dataclass
class GoldSpec:
    """The three yearly marts over ``fact JOIN dim``."""

    fact: str
    dim: str
    fact_key: str
    dim_key: str
    period: str
    filter_column: str | None = None
    filter_value: str | None = None
    platform: str | None = None
    platform_from_dim: bool = False


def to_bronze(df: DataFrame) -> DataFrame:
    """Raw table as all-string text."""
    return cast_all_to_string(df)


def to_silver(bronze: DataFrame, spec: SilverSpec) -> DataFrame:
    """Flatten, rename, cast and derive partition columns (L2: P2-P6)."""
    df = bronze
    if spec.json_column:
        df = flatten_payload(df, spec.json_column, spec.json_schema, keep=spec.keep)
    elif spec.keep is not None:
        df = df.select(*[q(c) for c in spec.keep])
    df = rename_columns(df, spec.rename)
    if spec.casts:
        df = cast_columns(df, spec.casts)
    if spec.derive:
        df = derive_time_columns(df, spec.derive)
    return df


def view_counts(events: DataFrame, items: DataFrame, spec: GoldSpec) -> DataFrame:
    """(period, item_id[, platform], views): the one aggregate all three marts roll up from."""
    fact = events
    if spec.filter_column is not None:
        fact = fact.where(q(spec.filter_column) == F.lit(spec.filter_value))
    period = q(spec.period).alias("year")
    if spec.platform and not spec.platform_from_dim:
        return fact_dim_counts(fact, items, spec.fact_key, spec.dim_key, [period, q(spec.platform).alias("platform")],
                               keep_key_as="item_id", count_name="views")
    dim_groups = [q(spec.platform).alias("platform")] if spec.platform else []
    return fact_dim_counts(fact, items, spec.fact_key, spec.dim_key, [period], keep_key_as="item_id",
                           count_name="views", dim_group_by=dim_groups)


def gold_marts(base: DataFrame) -> dict[str, DataFrame]:
    """The three marts from the shared (year, item_id, platform, views) rollup (L3)."""
    totals = base.groupBy("year").agg(F.sum("views").alias("total_item_view"))
    per_item = base.groupBy("year", "item_id").agg(F.sum("views").alias("total_item_view"))
    ranking = dense_rank_counts(per_item, "year", "total_item_view", "view_ranking").select(
        "year", "total_item_view", "item_id", "view_ranking"
    )
    marts = {"eventviewitembyyear": totals, "itemviewnumbersbyyear": ranking}
    if "platform" in base.columns:
        per_platform = base.groupBy("year", "platform").agg(F.sum("views").alias("total_platform_usage"))
        top = top_with_ties(per_platform, "year", "total_platform_usage").select(
            "year", F.col("platform").alias("most_used_platform"), "total_platform_usage"
        )
        marts["mostusedplatformbyyearrank"] = top
    return marts


@dataclass
class MedallionResult:
    bronze: dict[str, str]
    silver: dict[str, str]
    gold: dict[str, str]
    rows: dict[str, int]
    managed: dict[str, str] = field(default_factory=dict)


def run_medallion(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    silver_specs: Mapping[str, SilverSpec],
    gold_spec: GoldSpec,
    bronze_format: str = "parquet",
    table_format: str = "parquet",
    managed_schema: str | None = None,
    managed_location: str | None = None,
) -> MedallionResult:
    """Bronze, silver, gold in order (L4), each layer written under ``root``.

    Bronze is parquet by default; ``bronze_format="csv"`` writes the pipe-separated text of the reference's
    bronze layer; silver and gold are ``table_format`` (parquet by default).
    With ``managed_schema`` the gold marts are also saved as managed tables (K4).
    """
    root = root.rstrip("/")
    rows: dict[str, int] = {}
    bronze_paths, silver_paths, gold_paths = {}, {}, {}
    for name, df in raw.items():
        path = f"{root}/bronze/{name}"
        b = to_bronze(df)
        if bronze_format == "csv":
            rows[f"bronze.{name}"] = write_counted(b, lambda d, p=path: write_bronze_csv(d, p))
        else:
            rows[f"bronze.{name}"] = write_counted(b, lambda d, p=path: write_table(d, p, bronze_format))
        bronze_paths[name] = path
    for name, path in bronze_paths.items():
        b = read_bronze_csv(spark, path) if bronze_format == "csv" else read_table(spark, path, bronze_format)
        spec = silver_specs.get(name, SilverSpec())
        s = to_silver(b, spec)
        out = f"{root}/silver/{name}"
        rows[f"silver.{name}"] = write_counted(
            s, lambda d, o=out, sp=spec: write_table(d, o, table_format, partition_by=sp.partition_by)
        )
        silver_paths[name] = out
    events = read_table(spark, silver_paths[gold_spec.fact], table_format)
    items = read_table(spark, silver_paths[gold_spec.dim], table_format)
    # the shared rollup is written once: it cuts the lineage and feeds all three marts
    base_path = f"{root}/gold/viewcounts"
    rows["gold.viewcounts"] = write_counted(view_counts(events, items, gold_spec),
                                            lambda d: write_table(d, base_path, table_format))
    base = read_table(spark, base_path, table_format)
    # the dimension and the fact themselves, the fact partitioned by its period (K3)
    for name, df, parts in (("dimitems", items, ()), ("factevents", events, (gold_spec.period,))):
        out = f"{root}/gold/{name}"
        rows[f"gold.{name}"] = write_counted(
            df, lambda d, o=out, p=parts: write_table(d, o, table_format, partition_by=p))
        gold_paths[name] = out
    for name, mart in gold_marts(base).items():
        out = f"{root}/gold/{name}"
        rows[f"gold.{name}"] = write_counted(mart, lambda d, o=out: write_table(d, o, table_format))
        gold_paths[name] = out
    managed = {}
    if managed_schema:
        for name, path in gold_paths.items():
            managed[name] = write_to_managed_table(read_table(spark, path, table_format), name, managed_schema,
                                                   fmt=table_format, location=managed_location)
    return MedallionResult(bronze_paths, silver_paths, gold_paths, rows, managed)


# Configuration of the driver-table stand-in: events (fact, JSON payload) and part (items).
EVENTS_SILVER = SilverSpec(
    json_column="props",
    json_schema="k STRING",
    keep=["event_id", "ts", "user_id", "event_type", "value"],
    rename={"event_type": "event_name", "k": "item_key"},
    casts={"event_id": "bigint", "user_id": "int", "ts": "date", "value": "float"},
    derive={"ts": {"ts_year": "year"}},
    partition_by=("ts_year",),
)
PART_SILVER = SilverSpec(
    keep=["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    casts={"p_partkey": "bigint", "p_size": "int", "p_retailprice": "float"},
)
EVENTS_GOLD = GoldSpec(
    fact="events",
    dim="part",
    fact_key="item_key",
    dim_key="p_partkey",
    period="ts_year",
    filter_column="event_name",
    filter_value="view",
    platform="p_brand",
    platform_from_dim=True,
)
