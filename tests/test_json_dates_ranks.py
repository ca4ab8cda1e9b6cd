"""JSON columns found in one aggregate, voted date formats, distributed ranks, salted rank levels, time intelligence."""

import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.functions.json import infer_json_schemas
from lakeloom.operators import marts, profilers
from lakeloom.operators.quantiles import distributed_ranks, exact_quantiles
from lakeloom.operators.tablesets import sliced
from lakeloom.operators.transforms import daily_slice, flatten_json_auto, vote_date_formats

JSON = [(1, '{"a": 1, "l": [{"z": 5}]}', "plain", "[1]"), (2, "7", "{not json", "[2]"), (3, None, "text", None),
        (4, ' {"a": 2, "c.d": "x", "k": 9}', '{"a": 1}', "[3]")]


def test_json_columns_by_share_first_row_and_name(spark):
    df = spark.createDataFrame(JSON, "k int, j string, t string, lists string")
    out = flatten_json_auto(df)
    assert out.columns == ["k", "j", "t", "lists", "a", "c.d", "j.k", "l"]
    got = {r["k"]: (r["a"], r["j.k"]) for r in out.collect()}
    assert got == {1: (1, None), 2: (None, None), 3: (None, None), 4: (2, 9)}  # a scalar cell disables nothing
    assert flatten_json_auto(df, mode="first", order_by="k").columns == out.columns
    assert flatten_json_auto(df.where("k > 1"), mode="first", order_by="k").columns == df.columns
    assert "a" in flatten_json_auto(df.select("k", "t"), ["t"]).columns
    assert flatten_json_auto(df.select("k", "t")).columns == ["k", "t"]
    assert flatten_json_auto(df.limit(0)).columns == df.columns
    with pytest.raises(ValueError):
        flatten_json_auto(df, mode="first")


def test_lists_are_expanded_on_request(spark):
    df = spark.createDataFrame([('{"v": [4, 5, 6]}',), ('{"v": [7]}',), ("{}",)], "j string")
    out = flatten_json_auto(df, expand_lists=2)
    assert out.columns == ["j", "v", "v.0", "v.1"]
    assert sorted(((r["v.0"], r["v.1"]) for r in out.collect()), key=str) == [(4, 5), (7, None), (None, None)]


def test_schemas_of_all_columns_come_from_one_job(spark):
    df = spark.createDataFrame(JSON, "k int, j string, t string, lists string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("schemas", "schemas")
    try:
        assert set(infer_json_schemas(df, ["j", "t", "lists"])) == {"j", "t"}
        assert len(tracker.getJobIdsForGroup("schemas")) <= 2  # AQE may run the exchange as a job of its own
    finally:
        spark.sparkContext.setJobGroup("none", "none")


def test_cells_elect_the_order_of_day_and_month(spark):
    df = spark.createDataFrame([("05.06.2013", "05/06/2013", "05-06-2013", "x"), ("17.06.2013", "06/17/2013", None, "y"),
                                ("01.07.2013 10:30:00", "07/01/2013", "07-06-2013", "z")],
                               "dmy string, mdy string, open string, other string")
    votes = {c: v for (_, c), v in vote_date_formats({"t": df}).items()}
    assert (votes["dmy"].day_first, votes["mdy"].day_first, votes["open"].day_first) == (True, False, True)
    assert votes["other"].share == 0.0 and votes["open"].share == 1.0
    assert vote_date_formats({"t": df}, default_day_first=False)["t", "open"].day_first is False
    got = {r["column_name"]: (str(r["min_date"]), r["days"]) for r in profilers.date_columns(df, day_first=None).collect()}
    assert got == {"dmy": ("2013-06-05 00:00:00", 26), "mdy": ("2013-05-06 00:00:00", 56), "open": ("2013-06-05 00:00:00", 2)}
    assert vote_date_formats({"t": df.limit(0)})["t", "dmy"].share == 0.0


def test_a_day_of_a_set_with_text_dates(spark):
    us = spark.createDataFrame([("06/17/2013", 1), ("06/18/2013", 2)], "d string, k int")
    eu = spark.createDataFrame([("17.06.2013 08:00:00", 3), ("18.06.2013", 4)], "d string, k int")
    typed = spark.createDataFrame([(date(2013, 6, 17), 5)], "d date, k int")
    none = spark.createDataFrame([(6,)], "k int")
    got = {t: [r["k"] for r in df.collect()] for t, df in sliced({"us": us, "eu": eu, "typed": typed, "none": none}, "2013-06-17").items()}
    assert got == {"us": [1], "eu": [3], "typed": [5], "none": [6]}
    assert [r["k"] for r in daily_slice(eu, "2013-06-18", date_column="d").collect()] == [4]


def test_a_text_date_is_worked_out_once_a_row(spark):
    df = spark.createDataFrame([(" 17.06.2013 ",), ("17/06/2013 23:59",), ("17-06-2013 25:00",), ("2013/06/17",), ("2013.06.17 08:00",),
                                ("2013-06-17T01:02:03",), ("17.06/2013",), ("31.02.2013",), ("06/17/2013",), (None,)], "raw string")
    day = daily_slice(df.select(F.reverse(F.reverse("raw")).alias("d")), "2013-06-17", date_column="d", day_first=True)
    assert sorted(r["d"] for r in day.collect()) == sorted([" 17.06.2013 ", "17/06/2013 23:59", "17-06-2013 25:00", "2013/06/17",
                                                            "2013.06.17 08:00", "2013-06-17T01:02:03"])
    where = next(line for line in day._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line)
    assert where.count("reverse(reverse(") == 1  # a filter works out a value at every place that names it


def test_distributed_ranks_equal_a_window(spark):
    rng = random.Random(3)
    rows = [("a" if k % 3 else "b", 0, 0, float(v), rng.randint(1, 5)) for k, v in enumerate(rng.sample(range(5000), 900))]
    values = spark.createDataFrame(rows, "column string, bid int, below long, v double, cnt long")
    w = Window.partitionBy("column", "bid").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = {(r["column"], r["v"], r["cum"]) for r in values.withColumn("cum", F.sum("cnt").over(w)).collect()}
    assert {(r["column"], r["v"], r["cum"]) for r in distributed_ranks(values).collect()} == want


@pytest.mark.parametrize("limit,refine,accuracy", [(0, False, 100), (5, True, 4), (50, True, 1000)])
def test_quantiles_by_any_road(spark, limit, refine, accuracy):
    rng = random.Random(9)
    x = [rng.choice([0.0, 1.0, rng.gauss(0, 5)]) for _ in range(1200)]
    df = spark.createDataFrame([(v,) for v in x] + [(None,), (float("nan"),)], "x double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], (0.0, 0.25, 0.5, 0.9, 1.0), limit=limit, refine=refine,
                                                          accuracy=accuracy).collect()}
    for p, v in got.items():
        assert v == pytest.approx(float(np.percentile(x, 100 * p)), abs=1e-12)


def test_quantiles_read_files_again_and_hold_no_copy_of_the_cells(spark, scratch, monkeypatch):
    rng = random.Random(4)
    rows = [(rng.randint(1, 7), rng.choice([rng.gauss(0, 5), None]), 4) for _ in range(3000)]
    path = scratch("quantiles")
    spark.createDataFrame(rows, "few int, many double, one int").repartition(3).write.parquet(path)
    df = spark.read.parquet(path)

    def refuse(self, *level):
        raise AssertionError("cells were persisted")

    monkeypatch.setattr(type(df), "persist", refuse)
    got = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, df.columns, (0.1, 0.25, 0.5), limit=100, accuracy=1000).collect()}
    for i, c in enumerate(df.columns):
        cells = [r[i] for r in rows if r[i] is not None]
        for p in (0.1, 0.25, 0.5):
            assert got[c, p] == pytest.approx(float(np.percentile(cells, 100 * p)), abs=1e-12)


def test_rank_levels_are_salted(spark):
    counts = spark.createDataFrame([(2020, k, 1) for k in range(300)] + [(2020, 900, 7), (None, 1, 2), (None, 2, 5)],
                                   "year int, item int, n long")
    got = marts.dense_rank_counts(counts, "year", "n", "r", copies=16)
    assert got.columns == ["year", "item", "n", "r"]
    w = Window.partitionBy("year").orderBy(F.col("n").desc())
    assert sorted(map(str, got.collect())) == sorted(map(str, counts.withColumn("r", F.dense_rank().over(w)).collect()))


def test_time_intelligence(spark):
    totals = spark.createDataFrame([(2019, 10), (2022, 30), (None, 5)], "year int, n long")
    got = [(r["year"], r["n"], r["previous"], r["change_ratio"]) for r in marts.year_over_year(totals, "year", "n").orderBy("year").collect()]
    assert got == [(2019, 10, None, None), (2020, 0, 10.0, -1.0), (2021, 0, 0.0, None), (2022, 30, 0.0, None)]
    parts = spark.createDataFrame([("a", 1), ("a", 3), (None, 5)], "g string, n long")
    assert sorted((r["n"], r["share"]) for r in marts.share_of_total(parts, "n", "g").collect()) == [(1, 0.25), (3, 0.75), (5, 1.0)]
    assert sum(r["share"] for r in marts.share_of_total(parts, "n").collect()) == pytest.approx(1.0)
    days = marts.date_dimension(spark.createDataFrame([("2024-02-27",), ("2024-03-01",), (None,)], "d string"), "d")
    assert [str(r["date"]) for r in days.orderBy("date").collect()] == ["2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01"]
    assert marts.date_dimension(spark.createDataFrame([], "d date"), "d").collect() == []
