from lakeloom.sinks.files import write_bronze_csv, write_csv
from lakeloom.sources.files import format_of, read_any, read_bronze_csv, read_csv
import pytest

# values that must survive the bronze text round trip unchanged (FIXTURES §3)
TRICKY = ["", None, " x ", "a|b", 'q"q', "l1\nl2", "c\r\nd", "back\\slash", "plain"]


def test_bronze_round_trip_is_lossless(spark, scratch):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(TRICKY)], "id int, v string")
    path = scratch("bronze")
    write_bronze_csv(df, path)
    back = read_bronze_csv(spark, path, schema=df.schema)
    assert sorted(back.collect(), key=lambda r: r.id) == sorted(df.collect(), key=lambda r: r.id)


def test_bronze_without_schema_is_all_text(spark, scratch):
    df = spark.createDataFrame([(1, 2.5, "x")], "a int, b double, c string")
    path = scratch("bronze_text")
    write_bronze_csv(df, path)
    back = read_bronze_csv(spark, path)
    assert [f.dataType.simpleString() for f in back.schema.fields] == ["string"] * 3
    assert back.first().asDict() == {"a": "1", "b": "2.5", "c": "x"}


def test_documents_round_trip(spark, scratch):
    src = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = scratch("docs")
    write_bronze_csv(src, path)
    back = read_bronze_csv(spark, path, schema=src.schema)
    assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0


def test_read_any_by_extension(spark, scratch):
    src = spark.read.parquet("/root/testdata/sf0.001/region.parquet")
    root = scratch("any")
    write_csv(src, f"{root}/r.csv")
    src.write.parquet(f"{root}/r.parquet")
    assert read_any(spark, f"{root}/r.csv", schema=src.schema).exceptAll(src).count() == 0
    assert read_any(spark, f"{root}/r.parquet").exceptAll(src).count() == 0
    assert read_csv(spark, f"{root}/r.csv", infer_schema=True).count() == 5
    with pytest.raises(ValueError):
        format_of("table.xlsx")
