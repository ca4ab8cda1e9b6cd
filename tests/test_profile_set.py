"""The one-pass profile: every report against the single profilers, awkward columns, scans counted."""

import re

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import profilers, table_profile
from lakeloom.operators.table_profile import numbered_columns, value_counts_of_set
from lakeloom.plans.profiling import DEFAULT_PROFILERS, REPORTS, profile, profile_report

ROWS = [(1, "a", '{"a": 1}', "<p>", "31/01/2024", ["x", "y"], "L" * 200), (2, "a", '{"b": 2}', "<b/>", "05/02/2024", ["x"], "L" * 200),
        (3, "b", "{: }", None, "01/03/2024", None, "K" * 90), (3, None, None, None, None, [None, "x"], None),
        (3, None, None, None, None, [None, "x"], None)]
DDL = "k int, s string, j string, x string, d string, tags array<string>, `long.text` string"


@pytest.fixture(scope="module")
def report(spark):
    df = spark.createDataFrame(ROWS, DDL)
    rows = profile_report({"t": df, "empty": df.limit(0).select("k", "s")}, order_by={"t": ["k", "s"], "empty": "k"}).collect()
    return [r for r in rows if r["table_name"] == "t"], [r for r in rows if r["table_name"] == "empty"]


def values(rows, profile_name, metric, field="num_value"):
    return {r["column_name"]: r[field] for r in rows if r["profile"] == profile_name and r["metric"] == metric}


def test_every_report_is_there(report):
    assert {r["profile"] for r in report[0]} == set(REPORTS) - {"unique_cols"} | {"null_ratio"}
    assert values(report[0], "shape", "rows") == {None: 5.0} and values(report[0], "duplicate_count", "duplicate_qty") == {None: 1.0}


def test_reports_of_an_empty_table(report):
    empty = report[1]
    assert values(empty, "shape", "rows") == {None: 0.0} and values(empty, "shape", "cols") == {None: 2.0}
    assert values(empty, "null_ratio", "of_rows") == {"k": None, "s": None}
    assert values(empty, "describe_non_num", "count") == {"s": 0.0}
    assert not [r for r in empty if r["profile"] in ("json_cols", "xml_cols", "date_cols", "value_counts", "head")]


def test_describe_null_counts_and_detectors(report):
    rows = report[0]
    assert values(rows, "describe_non_num", "top", "str_value") == {
        "s": "a", "j": '{"a": 1}', "x": "<b/>", "d": "01/03/2024", "tags": None, "long.text": "L" * 200}
    assert values(rows, "describe_non_num", "unique")["tags"] == 3.0
    assert values(rows, "null_ratio", "of_non_null")["s"] == pytest.approx(2 / 3)
    assert values(rows, "json_cols", "share") == {"j": 1.0} and values(rows, "xml_cols", "share") == {"x": 1.0}
    assert values(rows, "date_cols", "min_date", "str_value") == {"d": "2024-01-31 00:00:00"}
    assert values(rows, "date_cols", "days") == {"d": 30.0}


def test_dominant_values_of_lists_and_long_texts(report):
    shares = {(r["column_name"], r["str_value"]): r["num_value"] for r in report[0] if r["profile"] == "value_counts"}
    assert shares["tags", "x"] == 0.8 and shares["tags", "y"] == 0.2
    assert shares["long.text", "L" * 200] == pytest.approx(2 / 3) and shares["long.text", "K" * 90] == pytest.approx(1 / 3)


def test_head_is_ordered(report):
    heads = values(report[0], "head", "row_1")
    assert heads["k"] == 1.0 and heads["tags"] == 2.0
    assert values(report[0], "head", "row_2", "str_value")["long.text"] == "L" * 200


def test_equal_to_the_single_profilers(spark):
    from tests.conftest import SMOKE_SF

    df = spark.read.parquet(f"{SMOKE_SF}/conversations.parquet")
    rows = profile(df, "c").collect()
    single = {r["column_name"]: r for r in profilers.describe_non_numeric(df).collect()}
    assert values(rows, "describe_non_num", "top", "str_value") == {c: r["top"] for c, r in single.items()}
    assert values(rows, "describe_non_num", "freq") == {c: float(r["freq"]) for c, r in single.items()}
    want = {(r["column_name"], r["value"]) for r in profilers.value_counts(df).collect()}
    assert {(r["column_name"], r["str_value"]) for r in rows if r["profile"] == "value_counts"} == want
    assert set(values(rows, "unique_cols", "row_count")) == {r["column_name"] for r in profilers.unique_columns(df).collect()}
    assert values(rows, "duplicate_count", "duplicate_qty")[None] == profilers.duplicate_count(df).first()["duplicate_qty"]


def test_one_scan_and_one_shuffle_for_all_counts(spark):
    from tests.conftest import SMOKE_SF

    tables = {t: spark.read.parquet(f"{SMOKE_SF}/{t}.parquet") for t in ("nation", "supplier", "pages")}
    plan = value_counts_of_set(tables, numbered_columns(tables))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan", plan)) == len(tables)
    assert plan.count("hashpartitioning(") == 1


def test_reports_can_be_chosen_and_mixed(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    assert {r["profile"] for r in profile(df, reports=["shape", "null_counts"]).collect()} == {"shape", "null_counts", "null_ratio"}
    alone = DEFAULT_PROFILERS["shape"](df, "t").collect()
    assert sorted((r["metric"], r["num_value"]) for r in alone) == [("cols", 1.0), ("rows", 2.0)]
    with pytest.raises(ValueError):
        profile(df, reports=["shapes"])


def test_values_that_are_null_or_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    rows = profile(df, "t").collect()
    assert values(rows, "null_counts", "null_count") == {"x": 1.0} and values(rows, "unique_cols", "row_count") == {"x": 3.0}


@pytest.fixture()
def counted(monkeypatch):
    """The (kind, name) of the columns whose values were counted, a set a call."""
    seen, real = [], table_profile.value_counts_of_set

    def spy(tables, columns, *options):
        seen.append({(x.kind, x.name) for x in columns})
        return real(tables, columns, *options)

    monkeypatch.setattr(table_profile, "value_counts_of_set", spy)
    return seen


def test_shapes_count_no_values(spark, counted):
    df = spark.createDataFrame(ROWS, DDL)
    rows = profile_report({"t": df, "empty": df.limit(0)}, reports=["shape", "col_types"]).collect()
    assert counted == []
    assert {(r["table_name"], r["metric"]): r["num_value"] for r in rows if r["profile"] == "shape"} == {
        ("t", "rows"): 5.0, ("t", "cols"): 7.0, ("empty", "rows"): 0.0, ("empty", "cols"): 7.0}


def test_nulls_count_no_values(spark, counted):
    df = spark.createDataFrame(ROWS, DDL)
    rows = profile_report({"t": df, "empty": df.limit(0)}, reports=["null_counts"]).collect()
    assert counted == []
    assert values([r for r in rows if r["table_name"] == "t"], "null_counts", "null_count") == {
        "k": 0.0, "s": 2.0, "j": 2.0, "x": 3.0, "d": 2.0, "tags": 1.0, "long.text": 2.0}
    assert set(values([r for r in rows if r["table_name"] == "empty"], "null_ratio", "of_rows").values()) == {None}


def test_a_report_alone_equals_its_part_of_all(spark, report, counted):
    df = spark.createDataFrame(ROWS, DDL)
    names = {"null_counts": ("null_counts", "null_ratio")}
    for name in set(REPORTS) - {"head"}:
        alone = sorted(map(str, profile(df, "t", reports=[name]).collect()))
        assert alone == sorted(str(r) for r in report[0] if r["profile"] in names.get(name, (name,))), name
    assert {("row", None)} in counted and {("cell", c) for c in ("s", "j", "x", "d", "long.text")} in counted
