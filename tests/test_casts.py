import pytest
from pyspark.sql import functions as F

from lakeloom.functions.casts import legacy_cast
from lakeloom.operators.transforms import cast_all_to_string, cast_columns, derive_time_columns, rename_columns

# text -> int as the non-ANSI cast gives it (FIXTURES §3)
CASES = [("7", 7), ("7.0", 7), ("7.9", 7), (" 7 ", 7), ("-3", -3), ("google", None), ("", None), (None, None),
         ("12abc", None), ("99999999999", None)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_legacy_cast_int_independent_of_ansi(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(v,) for v, _ in CASES], "v string")
        got = [r[0] for r in df.select(legacy_cast("v", "int")).collect()]
        assert got == [e for _, e in CASES]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_cast_columns_float_date_and_missing(spark):
    df = spark.createDataFrame([("1.5", "2018-01-05T10:00:00Z"), ("x", "not a date")], "p string, t string")
    out = cast_columns(df, {"p": "float", "t": "date"}).collect()
    assert out[0]["p"] == pytest.approx(1.5) and str(out[0]["t"]) == "2018-01-05"
    assert out[1]["p"] is None and out[1]["t"] is None
    with pytest.raises(KeyError):
        cast_columns(df, {"absent": "int"})


def test_cast_all_to_string_keeps_dotted_names(spark):
    df = spark.createDataFrame([(1, 2.5)], "`event.payload` int, `a b` double")
    out = cast_all_to_string(df)
    assert out.columns == ["event.payload", "a b"]
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string", "string"]


def test_rename_ignores_missing_and_derive_rejects_unknown(spark):
    df = spark.createDataFrame([(1, "2020-03-04")], "a int, d string").withColumn("d", F.to_date("d"))
    assert rename_columns(df, {"a": "b", "zz": "y"}).columns == ["b", "d"]
    out = derive_time_columns(df, {"d": {"d_year": "year", "d_month": "month"}}).first()
    assert (out["d_year"], out["d_month"]) == (2020, 3)
    with pytest.raises(ValueError):
        derive_time_columns(df, {"d": {"x": "not_a_function"}})


def test_lenient_text_and_percent_text(spark):
    from lakeloom.functions.casts import lenient_text, percent_text

    df = spark.createDataFrame([(bytearray(b"ok"),), (bytearray(b"a\xffb"),)], "b binary")
    assert [r.t for r in df.select(lenient_text(F.col("b")).alias("t")).collect()] == ["ok", "a�b"]
    r = spark.createDataFrame([(0.25,), (None,), (4.0,)], "x double").select(percent_text(F.col("x")).alias("p"))
    assert [x.p for x in r.collect()] == ["25.0%", None, "400.0%"]
