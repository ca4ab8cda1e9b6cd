"""Every registered query runs at sf0.001 and agrees with its DuckDB oracle."""

import duckdb
import pytest

import __spark_entry__ as entry
from lakeloom.plans import catalogue
from lakeloom.plans.tables import TABLE_NAMES
from tools.check_oracles import digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    rows = entry.entry(spark).collect()
    assert rows and rows[0]["year"] == 2024 and rows[0]["total_item_view"] == 188


def test_every_query_has_an_oracle():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())
    assert set(catalogue.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert digest(got) == digest(want)
