"""Sinks (managed tables, report, presentation) and skew behaviour."""

from pyspark.sql import functions as F

from lakeloom.operators.marts import presentation, views_by_period
from lakeloom.operators.transforms import daily_slice
from lakeloom.plans.profiling import profile_report, write_report
from lakeloom.sinks.catalog import table_exists, write_to_managed_table
from lakeloom.sinks.files import write_counted, write_table

SF = "/root/testdata/sf0.001"


def test_managed_table_modes_and_partitions(spark, scratch):
    df = spark.createDataFrame([(2020, "a"), (2021, "b")], "y int, v string")
    loc = scratch("mschema.db")
    assert not table_exists(spark, "t", "lakeloom_mtest")
    name = write_to_managed_table(df, "t", "lakeloom_mtest", partition_cols=["y"], location=loc)
    assert table_exists(spark, "t", "lakeloom_mtest")
    write_to_managed_table(df, "t", "lakeloom_mtest", partition_cols=["y"], mode="append", location=loc)
    assert spark.table(name).count() == 4
    write_to_managed_table(df, "t", "lakeloom_mtest", partition_cols=["y"], mode="overwrite", location=loc)
    assert spark.table(name).count() == 2
    spark.sql("DROP SCHEMA lakeloom_mtest CASCADE")


def test_presentation_names_survive_parquet_and_sort(spark, scratch):
    df = spark.createDataFrame([(2017, 3), (2018, 5), (None, 1)], "year int, total_item_view long")
    shown = presentation(df)
    assert shown.columns == ["Year", "Total Item View"]
    assert [r["Year"] for r in shown.collect()] == [2018, 2017, None]
    path = scratch("spaced")
    shown.write.parquet(path)
    assert spark.read.parquet(path).columns == ["Year", "Total Item View"]


def test_report_sink_partitioned_by_profile(spark, scratch):
    nation = spark.read.parquet(f"{SF}/nation.parquet")
    report = profile_report({"nation": nation})
    path = scratch("report")
    write_report(report, path, run_date="2026-01-01")
    back = spark.read.parquet(path)
    assert {r.profile for r in back.select("profile").distinct().collect()} >= {"shape", "null_counts", "col_types"}
    assert back.where("profile = 'shape' AND metric = 'rows'").first().num_value == 25.0


def test_observed_row_count_and_dynamic_overwrite(spark, scratch):
    path = scratch("dyn")
    df = spark.createDataFrame([(1, 2020), (2, 2021)], "id int, y int")
    assert write_counted(df, lambda d: write_table(d, path, partition_by=["y"])) == 2
    write_table(spark.createDataFrame([(3, 2021)], "id int, y int"), path, partition_by=["y"], dynamic_overwrite=True)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 3]


def test_daily_slice_on_text_dates(spark):
    df = spark.createDataFrame([("a", "2024-01-15 10:00:00"), ("b", "2024-01-16 09:00:00")], "k string, at string")
    assert [r.k for r in daily_slice(df, "2024-01-15").collect()] == ["a"]
    no_dates = spark.createDataFrame([("x",)], "k string")
    assert daily_slice(no_dates, "2024-01-15").count() == 1


def test_hot_key_holding_a_third_of_the_fact(spark):
    # one item gets a third of all views; the counts stay exact and the fact is
    # pre-aggregated on the map side before any exchange
    n = 3000
    fact = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("item"),
        F.lit(2024).alias("year"),
    )
    dim = spark.range(500).select(F.col("id").alias("item_id"))
    out = views_by_period(fact, dim, "item", "item_id", "year")
    assert out.first()["total_item_view"] == n
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > 0


def test_profile_directory_and_files(spark, scratch):
    from lakeloom.plans.profiling import profile_directory, profile_files
    from lakeloom.sinks.files import write_csv

    root = scratch("dir")
    region = spark.read.parquet(f"{SF}/region.parquet")
    nation = spark.read.parquet(f"{SF}/nation.parquet")
    write_csv(region, f"{root}/region.csv")
    nation.write.parquet(f"{root}/nation.parquet")
    report = profile_directory(spark, root, out=f"{root}_report")
    shapes = {(r.table_name, r.num_value) for r in report.where("profile = 'shape' AND metric = 'rows'").collect()}
    assert shapes == {("region", 5.0), ("nation", 25.0)}
    files = profile_files(spark, [f"{root}/region.csv"])
    assert files.where("profile = 'shape' AND metric = 'cols'").first().num_value == 2.0


def test_rebalanced_partitioned_write(spark, scratch):
    path = scratch("rebal")
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("p"))
    write_table(df, path, partition_by=["p"], rebalance=True)
    back = spark.read.parquet(path)
    assert back.count() == 1000 and back.where("p = 1").count() == 333


def test_custom_profiler_of_another_shape(spark):
    from lakeloom.plans.profiling import DEFAULT_PROFILERS, profile

    def max_len(df, t):
        return df.select(F.lit(t).alias("table_name"), F.lit("max_len").alias("profile"),
                         F.max(F.length("n_name")).cast("double").alias("num_value"))

    nation = spark.read.parquet(f"{SF}/nation.parquet")
    report = profile(nation, "nation", {"shape": DEFAULT_PROFILERS["shape"], "max_len": max_len})
    row = report.where("profile = 'max_len'").first()
    assert row.num_value > 0 and row.metric is None
