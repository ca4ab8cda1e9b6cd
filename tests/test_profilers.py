"""The profiling fixture of FIXTURES §4 and the detectors."""

import math
import random

import numpy as np
import pytest

from lakeloom.functions.json import infer_json_schema
from lakeloom.operators import profilers
from lakeloom.operators.quantiles import exact_quantiles
from lakeloom.operators.transforms import flatten_json_auto

ROWS = [(1, "a", 7, 1, None), (2, "a", None, 2, None), (3, "b", None, 3, None), (4, None, None, 4, None),
        (5, "", None, None, None)]
DDL = "k int, s string, one int, gap int, nul string"


@pytest.fixture()
def fx(spark):
    return spark.createDataFrame(ROWS, DDL)


def test_null_counts(fx):
    got = {r.column_name: r for r in profilers.null_counts(fx).collect()}
    assert {c: r.null_count for c, r in got.items()} == {"k": 0, "s": 1, "one": 4, "gap": 1, "nul": 5}
    assert got["s"].null_ratio_nonnull == 0.25 and got["one"].null_ratio_nonnull == 4.0
    assert got["nul"].null_ratio_nonnull is None and got["nul"].null_ratio_rows == 1.0


def test_unique_columns_both_rules(fx):
    assert sorted(r.column_name for r in profilers.unique_columns(fx).collect()) == ["gap", "k"]
    m1 = sorted(r.column_name for r in profilers.unique_columns(fx, null_is_value=False).collect())
    assert m1 == ["gap", "k", "one"]


def test_value_counts_and_describe(fx):
    got = {(r.column_name, r.value): r.share for r in profilers.value_counts(fx).collect()}
    assert got == {("s", "a"): 0.5, ("s", "b"): 0.25, ("s", ""): 0.25}
    d = {r.column_name: r for r in profilers.describe_non_numeric(fx).collect()}
    assert (d["s"]["count"], d["s"]["unique"], d["s"]["top"], d["s"]["freq"]) == (4, 3, "a", 2)


def test_duplicates(spark, fx):
    assert profilers.duplicate_count(fx).first().duplicate_qty == 0
    more = fx.unionByName(spark.createDataFrame([ROWS[3]], DDL))
    assert profilers.duplicate_count(more).first().duplicate_qty == 1


def test_long_text_values_are_digested_but_reported_whole(spark):
    long_a, long_b = "x" * 500, "y" * 300
    df = spark.createDataFrame([(long_a,)] * 3 + [(long_b,)], "t string")
    d = profilers.describe_non_numeric(df).first()
    assert (d["top"], d["freq"], d["unique"]) == (long_a, 3, 2)
    vc = {r.value: r.share for r in profilers.value_counts(df).collect()}
    assert vc == {long_a: 0.75, long_b: 0.25}
    assert profilers.duplicate_count(df).first().duplicate_qty == 2


def test_value_counts_explode_lists(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a"],), (None,)], "tags array<string>")
    got = {r.value: r.share for r in profilers.value_counts(df).collect()}
    assert got == {"a": 2 / 3, "b": 1 / 3}


def test_date_columns_pairs_each_column_and_parses_day_first(spark):
    df = spark.createDataFrame([("2024-01-31", "05.06.2013", "x"), ("2024-03-01", "17.06.2013", "y")],
                               "iso string, dmy string, other string")
    got = {r.column_name: r.days for r in profilers.date_columns(df).collect()}
    assert got == {"iso": 30, "dmy": 12}


def test_detectors_first_and_share(spark):
    df = spark.createDataFrame([(1, '{"a": 1}', "<p>x</p>"), (2, "plain", "<b/>"), (3, '{"b": 2}', "text")],
                               "id int, j string, x string")
    assert [r.column_name for r in profilers.detect_json_columns(df, mode="first", order_by="id").collect()] == ["j"]
    assert profilers.detect_json_columns(df, mode="share").count() == 0
    assert [r.column_name for r in profilers.detect_json_columns(df, mode="share", threshold=0.6).collect()] == ["j"]
    assert [r.column_name for r in profilers.detect_xml_columns(df, mode="first", order_by="id").collect()] == ["x"]
    with pytest.raises(ValueError):
        profilers.detect_json_columns(df, mode="first")


def test_flatten_json_auto(spark):
    rows = [('{"a":1,"b":{"c":2,"d":[1,2]}}',), ('{"a":null}',), (None,), ("{bad",)]
    df = spark.createDataFrame(rows, "j string")
    assert infer_json_schema(df, "j") is not None
    out = flatten_json_auto(df)
    assert out.columns == ["j", "a", "b.c", "b.d"]
    got = [tuple(r) for r in out.collect()]
    assert got[0][1:] == (1, 2, [1, 2])
    assert got[1][1:] == (None, None, None)
    assert got[2][1:] == (None, None, None) and got[3][1:] == (None, None, None)


def test_shape_head_types(spark, fx):
    assert tuple(profilers.shape(fx).first()) == (5, 5)
    assert [r.k for r in profilers.head(fx, 2, order_by="k").collect()] == [1, 2]
    assert [tuple(r) for r in profilers.column_types(fx).collect()][:2] == [("k", "int"), ("s", "string")]


def _pandas_quantile(values, p):
    return float(np.percentile(np.array(values, dtype=float), p * 100, method="linear"))


@pytest.mark.parametrize("limit,accuracy", [(1_000_000, 10_000), (40, 50)])
def test_exact_quantiles_match_numpy_even_with_refinement(spark, limit, accuracy):
    rnd = random.Random(7)
    a = [rnd.randint(0, 50) for _ in range(3000)]          # many ties
    b = [rnd.gauss(0, 1) for _ in range(2999)] + [None]    # continuous, a null
    df = spark.createDataFrame(list(zip(a, b)), "a int, b double")
    got = {(r.column, r.prob): r.value for r in
           exact_quantiles(df, ["a", "b"], (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0), limit=limit,
                           accuracy=accuracy).collect()}
    for col, vals in (("a", a), ("b", [x for x in b if x is not None])):
        for p in (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0):
            assert math.isclose(got[(col, p)], _pandas_quantile(vals, p), rel_tol=1e-12, abs_tol=1e-12)


def test_describe_numeric_matches_pandas(spark):
    import pandas as pd

    rnd = random.Random(3)
    pdf = pd.DataFrame({"x": [rnd.random() * 100 for _ in range(500)], "y": [rnd.randint(1, 9) for _ in range(500)]})
    got = {r.column_name: r for r in profilers.describe_numeric(spark.createDataFrame(pdf)).collect()}
    want = pdf.describe()
    for c in ("x", "y"):
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                             ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert math.isclose(float(got[c][ours]), float(want.loc[theirs, c]), rel_tol=1e-9)


def test_awkward_column_names(spark):
    from lakeloom.operators.tablesets import contained_columns, unique_columns_table_set
    from lakeloom.plans.profiling import profile

    names = ["event.payload", "a b", "it's", "back\\slash", "tick`name"]
    df = spark.createDataFrame([(1, "x", 2.5, "p", True), (2, None, 2.5, "q", False)],
                               ", ".join(f"`{n.replace('`', '``')}` {t}" for n, t in
                                         zip(names, ["int", "string", "double", "string", "boolean"])))
    nulls = {r.column_name: r.null_count for r in profilers.null_counts(df).collect()}
    assert nulls == {"event.payload": 0, "a b": 1, "it's": 0, "back\\slash": 0, "tick`name": 0}
    uniq = {r.column_name for r in profilers.unique_columns(df).collect()}
    assert uniq == {"event.payload", "a b", "back\\slash", "tick`name"}
    assert {r.column_name for r in unique_columns_table_set({"t": df}).collect()} == {
        "event.payload", "a b", "back\\slash", "tick`name"}
    assert contained_columns({"t": df}).count() == 0
    report = profile(df, "t")
    assert report.where("profile = 'null_counts' AND column_name = 'it''s'").count() == 2
