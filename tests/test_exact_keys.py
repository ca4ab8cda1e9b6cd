"""Exact typed keys, describe of every non-numeric column, duplicates by fingerprint."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import profilers
from lakeloom.operators.tablesets import contained_columns, unique_columns_table_set


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.sql("""SELECT * FROM VALUES
      (CAST(9007199254740992.1 AS DECIMAL(20,1)), DOUBLE('NaN'), X'01', map('a', 1, 'b', 2), named_struct('x', 1, 'y', array(0.5D)),
       DATE'2024-01-01', TIMESTAMP_NTZ'2024-03-31 02:30:00', 1Y),
      (CAST(9007199254740992.2 AS DECIMAL(20,1)), 1.0D, X'02', map('b', 2, 'a', 1), named_struct('x', 1, 'y', array(-0.0D)),
       DATE'2024-01-02', TIMESTAMP_NTZ'2024-03-31 03:30:00', 2Y),
      (CAST(5 AS DECIMAL(20,1)), -0.0D, X'', NULL, named_struct('x', 1, 'y', CAST(NULL AS ARRAY<DOUBLE>)),
       DATE'2024-01-02', TIMESTAMP_NTZ'2024-03-31 04:30:00', 2Y)
      AS t(dec, dbl, bin, entries, nested, day, wall, few)""")


def names(df):
    return sorted(r["column_name"] for r in df.collect())


def test_decimals_nan_binary_and_nested_values_are_exact(awkward):
    unique = ["bin", "dbl", "dec", "nested", "wall"]
    assert names(profilers.unique_columns(awkward)) == unique
    assert names(profilers.unique_columns(awkward, null_is_value=False)) == unique
    assert names(unique_columns_table_set({"t": awkward})) == unique
    assert names(unique_columns_table_set({"t": awkward}, prune=True)) == unique


def test_wall_clock_times_do_not_meet_where_clocks_are_set(spark, awkward):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # 02:30 does not exist on that day
    try:
        assert "wall" in names(profilers.unique_columns(awkward))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_repeated_nan_and_decimals_repeat(spark):
    df = spark.createDataFrame([(Decimal("0.10"), float("nan")), (Decimal("0.10"), float("nan"))], "d decimal(38,18), x double")
    assert names(profilers.unique_columns(df)) == []


def test_numbers_of_different_types_compare_by_value(spark):
    a = spark.createDataFrame([(1, Decimal("2.50"), 3.0), (2, Decimal("3.00"), 2.5)], "i int, d decimal(10,2), f double")
    b = spark.createDataFrame([(1.0, Decimal("2.5"), Decimal("123456789012345678901234567890")), (2.0, Decimal("3"), None)],
                              "x double, y decimal(38,4), z decimal(38,0)")
    got = {tuple(r) for r in contained_columns({"a": a, "b": b}).collect()}
    want = {("a", "i", "b", "x"), ("b", "x", "a", "i"), ("a", "d", "b", "y"), ("b", "y", "a", "d"), ("a", "d", "a", "f"),
            ("a", "f", "a", "d"), ("a", "f", "b", "y"), ("b", "y", "a", "f")}
    assert got == want
    assert {tuple(r) for r in contained_columns({"a": a, "b": b}, prune=True).collect()} == want


def test_describe_has_every_non_numeric_column(awkward):
    got = {r["column_name"]: r for r in profilers.describe_non_numeric(awkward).collect()}
    assert set(got) == {"bin", "entries", "nested", "day", "wall"}
    assert (got["day"]["count"], got["day"]["unique"], got["day"]["top"], got["day"]["freq"]) == (3, 2, "2024-01-02", 2)
    assert (got["entries"]["count"], got["entries"]["unique"], got["entries"]["top"]) == (2, 1, None)
    assert got["bin"]["unique"] == 3 and got["wall"]["top"] == "2024-03-31 02:30:00"


def test_describe_of_a_column_without_values(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, t string")
    assert [tuple(r) for r in profilers.describe_non_numeric(df).collect()] == [("t", 0, 0, None, None)]
    assert profilers.describe_non_numeric(df.select("k")).collect() == []


def test_duplicates_of_whole_rows(spark, awkward):
    assert profilers.duplicate_count(awkward).first()["duplicate_qty"] == 0
    twice = awkward.unionByName(awkward).unionByName(awkward.limit(1))
    assert profilers.duplicate_count(twice).first()["duplicate_qty"] == 4
    assert profilers.duplicate_count(awkward.limit(0)).first()["duplicate_qty"] == 0
    long = spark.createDataFrame([("x" * 500, None), ("x" * 500, None), ("x" * 499 + "y", None)], "t string, n int")
    assert profilers.duplicate_count(long).first()["duplicate_qty"] == 1


@pytest.mark.parametrize("prune", [False, True])
def test_pruning_changes_no_row(spark, prune):
    import random

    rng = random.Random(1)
    frames = {
        f"t{t}": spark.createDataFrame(
            [(rng.randint(0, 30 * (t + 1)), float(rng.randint(0, 9)), rng.choice("abc") * (t + 1), rng.random() > 0.5,
              date(2024, 1, rng.randint(1, 9 + t)), rng.choice([None, "x", "yy"])) for _ in range(80 + 40 * t)],
            f"a{t} int, b{t} double, c{t} string, e{t} boolean, f{t} date, g{t} string")
        for t in range(3)
    }
    columns = {(t, c): {r[0] for r in df.select(c).where(F.col(c).isNotNull()).collect()} for t, df in frames.items() for c in df.columns}

    def kind(values):
        kinds = {type(v) for v in values}
        return "number" if kinds <= {int, float} and bool not in kinds else str(kinds)

    want = {(*a, *b) for a, x in columns.items() for b, y in columns.items()
            if a[1] != b[1] and x and kind(x) == kind(y) and x <= y}
    assert {tuple(r) for r in contained_columns(frames, prune=prune).collect()} == want
    nothing = {"t": frames["t0"].limit(0)}
    assert contained_columns(nothing, prune=prune).collect() == []
