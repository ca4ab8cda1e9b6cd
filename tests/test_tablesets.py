"""The table-set fixture of FIXTURES §4: containment, find-value, uniqueness, dictionary."""

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import tablesets


@pytest.fixture()
def tables(spark):
    return {
        "a": spark.createDataFrame([(1,), (2,)], "x long"),
        "b": spark.createDataFrame([(1,), (2,), (3,)], "y int"),
        "c": spark.createDataFrame([("1",), ("2",)], "z string"),
        "d": spark.createDataFrame([(1.0,), (2.0,)], "w double"),
        "e": spark.createDataFrame([], "v int"),
    }


def test_contained_columns_compare_by_class(tables):
    got = {tuple(r) for r in tablesets.contained_columns(tables).collect()}
    assert got == {("a", "x", "b", "y"), ("a", "x", "d", "w"), ("d", "w", "a", "x"), ("d", "w", "b", "y")}


def test_contained_columns_name_rule_and_many_columns(spark):
    # 70 columns (more than one 64-bit mask word); equal names and 'Id' names never pair
    cols = [f"c{i}" for i in range(70)]
    rows = [tuple(j if i % 2 == 0 else j % 3 for i in range(70)) for j in range(6)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in cols))
    other = spark.createDataFrame([(0,), (1,), (2,)], "userId int")
    got = {tuple(r) for r in tablesets.contained_columns({"t": df, "u": other}).collect()}
    odd, even = [c for i, c in enumerate(cols) if i % 2], [c for i, c in enumerate(cols) if i % 2 == 0]
    want = {("t", a, "t", b) for a in odd for b in odd + even if a != b}
    want |= {("t", a, "t", b) for a in even for b in even if a != b}
    assert got == want


def test_find_value(tables):
    assert [tuple(r) for r in tablesets.find_value(tables, "1").collect()] == [("z", "c", "1")]
    empty = tablesets.find_value(tables, "nowhere")
    assert empty.count() == 0 and empty.columns == ["column_name", "table_name", "value"]


def test_unique_columns_table_set(spark, tables):
    tables = dict(tables, f=spark.createDataFrame([(1,), (1,), (None,)], "r int"))
    got = {(r.table_name, r.column_name, r.row_count) for r in tablesets.unique_columns_table_set(tables).collect()}
    assert got == {("a", "x", 2), ("b", "y", 3), ("c", "z", 2), ("d", "w", 2)}


def test_data_dictionary_first_row(spark):
    df = spark.createDataFrame([(2, "zz", "-5"), (1, "ann@x.org", "12.5")], "id int, mail string, num string")
    got = {(r.column_name, r.dtype) for r in tablesets.data_dictionary({"t": df}, order_by={"t": "id"}).collect()}
    assert got == {("id", "int"), ("mail", "email"), ("num", "float")}
    share = {(r.column_name, r.dtype) for r in tablesets.data_dictionary({"t": df}, mode="share", threshold=0.5).collect()}
    assert ("id", "int") in share


def test_shapes(tables):
    got = {(r.table_name, r.rows, r.cols) for r in tablesets.table_set_shapes(tables).collect()}
    assert ("e", 0, 1) in got and ("b", 3, 1) in got


def test_custom_name_filter_matches_reference_rule(tables):
    by_rule = {tuple(r) for r in tablesets.contained_columns(tables).collect()}
    by_callable = {tuple(r) for r in
                   tablesets.contained_columns(tables, name_filter=tablesets.reference_name_filter).collect()}
    everything = {tuple(r) for r in tablesets.contained_columns(tables, name_filter=None).collect()}
    assert by_rule == by_callable and by_rule <= everything


def test_nulls_as_values_and_daily_slice(spark):
    t = {
        "p": spark.createDataFrame([(1,), (None,)], "x int"),
        "q": spark.createDataFrame([(1,), (2,), (None,)], "y int"),
        "r": spark.createDataFrame([(1,), (2,)], "z int"),
    }
    ignore = {tuple(r) for r in tablesets.contained_columns(t).collect()}
    as_value = {tuple(r) for r in tablesets.contained_columns(t, null_is_value=True).collect()}
    assert ("p", "x", "r", "z") in ignore and ("p", "x", "r", "z") not in as_value
    assert ("p", "x", "q", "y") in as_value

    events = spark.createDataFrame(
        [("A", "2024-01-15 10:00:00"), ("B", "2024-01-16 10:00:00")], "code string, ts string"
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    hits = tablesets.find_value({"e": events}, "B", day="2024-01-15", slice_by_day=True)
    assert hits.count() == 0
    assert tablesets.find_value({"e": events}, "B").count() == 1
