import duckdb
import pytest
from pyspark.sql import functions as F

from lakeloom.functions.patterns import is_date_text, semantic_type, sql_semantic_type

# value -> label with the reference's patterns (FIXTURES §3); None = no label
REFERENCE = {
    "2024-01-31": "date", "2024-01-31 10:00:00": "date", "31/01/2024": "date", "1234567890": "date",
    "+31 6 1234": "phone_num", "ann@x.org": "email", "ann.lee@x.org": "text", "hello": "text",
    "12.5": "float", ".5": "float", "12": "int", "12abc": "int", "abc12": "text", "-5": None, "": None,
    "<a/>": None, '{"k": 1}': None,
}
# our strict defaults change exactly the two documented defects
STRICT = dict(REFERENCE, **{"1234567890": "int", "ann.lee@x.org": "email"})


@pytest.mark.parametrize("strict,expected", [(False, REFERENCE), (True, STRICT)])
def test_semantic_types_match_fixture_and_duckdb(spark, strict, expected):
    values = list(expected)
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = dict((r.v, r.t) for r in df.select("v", semantic_type(F.col("v"), strict).alias("t")).collect())
    assert got == expected
    con = duckdb.connect()
    con.execute("CREATE TABLE t(v VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in values])
    duck = dict(con.execute(f"SELECT v, {sql_semantic_type('v', strict)} FROM t").fetchall())
    assert duck == expected


def test_mixed_label_is_opt_in(spark):
    df = spark.createDataFrame([("abc12",), ("12abc",), ("hello",)], "v string")
    got = [r.t for r in df.select(semantic_type(F.col("v"), True, mixed=True).alias("t")).collect()]
    assert got == ["a_numeric", "a_numeric", "text"]


def test_date_text_strictness(spark):
    df = spark.createDataFrame([("2024-01-31",), ("1234567890",), ("05.06.2013",)], "v string")
    strict = [r.d for r in df.select(is_date_text(F.col("v"), True).alias("d")).collect()]
    loose = [r.d for r in df.select(is_date_text(F.col("v"), False).alias("d")).collect()]
    assert strict == [True, False, True] and loose == [True, True, True]
