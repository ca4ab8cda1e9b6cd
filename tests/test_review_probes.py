"""Cases that the driver tables do not hold: ties of long text, refinement, `\\N`, time of day."""

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import profilers, quantiles, transforms
from lakeloom.operators.parallel import spread
from lakeloom.plans import medallion, profiling
from lakeloom.sinks.files import write_bronze_csv
from lakeloom.sources.files import read_bronze_csv


def test_top_of_tied_long_texts_is_the_smallest_text(spark):
    long = ["z" * 100, "y" * 64 + "b" * 40, "y" * 64 + "a" * 40]
    for values, want in ((["aaa", long[0]], "aaa"), (long, long[2]), ([long[0], long[1], long[1]], long[1])):
        df = spark.createDataFrame([(v,) for v in values], "s string")
        got = {r["column_name"]: r["top"] for r in profilers.describe_non_numeric(df).collect()}
        assert got == {"s": want}


@pytest.mark.parametrize("limit", [3, 50, 1_000_000])
def test_quantiles_are_exact_at_any_limit(spark, limit):
    values = [float((k * 7919) % 1000) for k in range(1000)] + [5.0] * 700
    df = spark.createDataFrame([(v,) for v in values], "x double")
    values.sort()
    got = {r["prob"]: r["value"] for r in quantiles.exact_quantiles(df, ["x"], limit=limit).collect()}
    for p, v in got.items():
        h = (len(values) - 1) * p
        lo = int(h)
        assert v == pytest.approx(values[lo] + (h - lo) * (values[min(lo + 1, len(values) - 1)] - values[lo]))


def test_text_dates_keep_their_time(spark):
    rows = [("05.06.2013 23:15:00",), ("05/06/2013 07:08",), ("05.06.2013",), ("2013-06-05 01:02:03",), ("05.06.2013 noon",)]
    df = spark.createDataFrame(rows, "t string").select(transforms.parse_datetime(F.col("t")).cast("string").alias("t"))
    assert [r["t"] for r in df.collect()] == [
        "2013-06-05 23:15:00", "2013-06-05 07:08:00", "2013-06-05 00:00:00", "2013-06-05 01:02:03", "2013-06-05 00:00:00",
    ]


def test_backslash_n_is_text(spark, scratch):
    path = scratch("bronze-n")
    rows = [("\\N", "1"), (None, "2"), ("", "3")]
    write_bronze_csv(spark.createDataFrame(rows, "a string, b string"), path)
    assert sorted(map(tuple, read_bronze_csv(spark, path).collect()), key=lambda r: r[1]) == rows


def test_report_sink_takes_any_tool(spark, scratch):
    path = scratch("report")
    found = spark.createDataFrame([("t", "c", 3)], "table_name string, column_name string, hits long")
    profiling.write_report(found, path)
    assert spark.read.parquet(path).count() == 1
    profiling.write_report(found, path, run_date="2024-01-01")
    assert spark.read.parquet(path).columns[-1] == "run_date"


def test_no_job_runs_when_a_shuffled_input_is_spread(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert spread(df, min_partitions=64, min_bytes=0) is df


def test_gold_holds_the_dimension_and_the_partitioned_fact(spark, scratch):
    events = spark.createDataFrame(
        [(1, "2023-01-05 10:00:00", 1, "view", 1.0, '{"k": "7"}'), (2, "2024-01-05 10:00:00", 1, "view", 1.0, '{"k": "7"}')],
        "event_id long, ts string, user_id long, event_type string, value double, props string",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    part = spark.createDataFrame(
        [(7, "n", "b", "t", 1, 2.0)],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    )
    done = medallion.run_medallion(
        spark, {"events": events, "part": part}, scratch("gold"),
        {"events": medallion.EVENTS_SILVER, "part": medallion.PART_SILVER}, medallion.EVENTS_GOLD,
    )
    assert {"dimitems", "factevents"} <= set(done.gold)
    fact = spark.read.parquet(done.gold["factevents"])
    assert fact.columns[-1] == "ts_year" and sorted(r["ts_year"] for r in fact.collect()) == [2023, 2024]
    assert spark.read.parquet(done.gold["dimitems"]).count() == 1
