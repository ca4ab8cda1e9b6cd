"""Incremental loads: a second run only picks up files that landed since the first."""

from pyspark.sql import functions as F

from lakeloom.plans import medallion
from lakeloom.streaming import stream_silver, stream_view_totals

SF = "/root/testdata/sf0.001"


def test_incremental_silver_and_gold(spark, scratch):
    root = scratch("stream")
    events = spark.read.parquet(f"{SF}/events.parquet")
    part = medallion.to_silver(spark.read.parquet(f"{SF}/part.parquet"), medallion.PART_SILVER)
    first, second = events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1")
    first.write.parquet(f"{root}/landing/batch=1")
    ckpt_s, ckpt_g = f"{root}/_ckpt/silver", f"{root}/_ckpt/gold"
    stream_silver(spark, f"{root}/landing", events.schema, f"{root}/silver", ckpt_s, medallion.EVENTS_SILVER)
    assert spark.read.parquet(f"{root}/silver").count() == first.count()
    stream_view_totals(spark, f"{root}/silver", part, f"{root}/gold", ckpt_g, medallion.EVENTS_GOLD)
    views_first = first.where("event_type = 'view'").count()
    assert spark.read.parquet(f"{root}/gold").first()["total_item_view"] == views_first

    second.write.parquet(f"{root}/landing/batch=2")  # new files land
    stream_silver(spark, f"{root}/landing", events.schema, f"{root}/silver", ckpt_s, medallion.EVENTS_SILVER)
    silver = spark.read.parquet(f"{root}/silver")
    assert silver.count() == events.count()  # nothing loaded twice
    assert silver.select(F.countDistinct("event_id")).first()[0] == events.count()
    stream_view_totals(spark, f"{root}/silver", part, f"{root}/gold", ckpt_g, medallion.EVENTS_GOLD)
    assert spark.read.parquet(f"{root}/gold").first()["total_item_view"] == 188
