"""Incremental (delta) loads with Structured Streaming.

The batch medallion rewrites every layer on each run. Here new raw files are picked up
as they land:

* ``stream_silver``: raw files -> silver transform (stateless projections: flatten,
  rename, cast, derive) -> partitioned file sink. The sink's commit log makes each file
  count exactly once across restarts; the checkpoint lives in the shared folder.
* ``stream_view_totals``: silver stream joined to the static item dimension, counted
  per period in a streaming aggregate (state = one row per period), rewritten as the
  gold table after every micro-batch.

Both use ``trigger(availableNow=True)``: process what has landed, then stop, which is
how a scheduled incremental job runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.operators.marts import _key_expr
from lakeloom.operators.transforms import q
from lakeloom.plans.medallion import GoldSpec, SilverSpec, to_silver


def stream_silver(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    spec: SilverSpec,
    source_format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> int:
    """Load newly landed files of ``source`` into the silver table at ``target``.

    Returns the number of micro-batches run. Re-running with the same checkpoint only
    processes files that arrived since.
    """
    reader = spark.readStream.schema(schema).format(source_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    silver = to_silver(reader.load(source), spec)
    writer = (
        silver.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if spec.partition_by:
        writer = writer.partitionBy(*spec.partition_by)
    query = writer.start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return len(query.recentProgress)


def stream_view_totals(
    spark: SparkSession,
    silver_path: str,
    items: DataFrame,
    gold_path: str,
    checkpoint: str,
    spec: GoldSpec,
    period_name: str = "year",
    total_name: str = "total_item_view",
) -> None:
    """Yearly view totals maintained incrementally from the silver fact (gold, L3)."""
    schema = spark.read.parquet(silver_path).schema  # the silver table fixes its own schema
    events = spark.readStream.schema(schema).parquet(silver_path)
    if spec.filter_column is not None:
        events = events.where(q(spec.filter_column) == F.lit(spec.filter_value))
    key_t = items.schema[spec.dim_key].dataType
    fact = events.select(q(spec.period).alias(period_name), _key_expr(events, spec.fact_key, key_t).alias("__key"))
    dim = items.select(q(spec.dim_key).alias("__key")).where(F.col("__key").isNotNull())
    # stream-static join: each micro-batch joins its rows against the dimension
    counts = fact.join(dim, "__key").groupBy(period_name).agg(F.count(F.lit(1)).alias(total_name))

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(gold_path)

    query = (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(publish)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
