"""The mart fixture of FIXTURES §2: events with a JSON payload joined to items."""

import json

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.marts import dense_rank_counts, top_with_ties
from lakeloom.plans.medallion import GoldSpec, SilverSpec, gold_marts, run_medallion, to_silver, view_counts

PAYLOAD = "event_name STRING, platform STRING, parameter_name STRING, parameter_value STRING"


def _payload(name, platform, pname, pvalue):
    return json.dumps({"event_name": name, "platform": platform, "parameter_name": pname, "parameter_value": pvalue})


RAW_EVENTS = [
    ("e1", "2018-01-05T10:00:00Z", "1", _payload("view_item", "web", "item_id", "1")),
    ("e2", "2018-02-01T10:00:00Z", "2", _payload("view_item", "web", "item_id", "1")),
    ("e3", "2018-03-01T10:00:00Z", "1", _payload("view_item", "ios", "item_id", "2")),
    ("e4", "2018-03-01T11:00:00Z", "3", _payload("view_item", "ios", "item_id", "2")),
    ("e5", "2018-04-01T10:00:00Z", "1", _payload("view_item", "web", "referrer", "google")),
    ("e6", "2018-04-02T10:00:00Z", "1", _payload("view_item", "web", "item_id", "99")),
    ("e7", "2018-05-01T10:00:00Z", "1", _payload("add_to_cart", "web", "item_id", "1")),
    ("e8", "2017-12-31T23:59:59Z", "4", _payload("view_item", "android", "item_id", "3.0")),
    ("e9", "2017-06-01T10:00:00Z", "4", _payload("view_item", None, "item_id", "3")),
    ("e10", "2017-06-02T10:00:00Z", "4", None),
    ("e11", "2017-06-03T10:00:00Z", "4", '{"event_name": bad'),
    ("e12", "not a date", "abc", _payload("view_item", "web", "item_id", "1")),
    ("e13", "2018-06-01T10:00:00Z", "5", _payload("view_item", "android", "item_id", "3")),
]
RAW_ITEMS = [("1", "10.0"), ("2", "20.5"), ("3", "5.25")]

EVENT_SPEC = SilverSpec(
    json_column="event.payload",
    json_schema=PAYLOAD,
    keep=["event_id", "event_time", "user_id"],
    rename={"parameter_name": "sub_event_name", "parameter_value": "sub_event_name_value"},
    casts={"user_id": "int", "event_time": "date"},
    derive={"event_time": {"event_time_year": "year"}},
    partition_by=("event_time_year",),
)
ITEM_SPEC = SilverSpec(casts={"id": "int", "price": "float"})
GOLD = GoldSpec(fact="events", dim="items", fact_key="sub_event_name_value", dim_key="id", period="event_time_year",
                filter_column="event_name", filter_value="view_item", platform="platform")

YEARLY = {(2018, 5), (2017, 2), (None, 1)}
RANKING = {(2018, 2, 1, 1), (2018, 2, 2, 1), (2018, 1, 3, 2), (2017, 2, 3, 1), (None, 1, 1, 1)}
TOP = {(2018, "ios", 2), (2018, "web", 2), (2017, None, 1), (2017, "android", 1), (None, "web", 1)}


@pytest.fixture()
def raw(spark):
    events = spark.createDataFrame(RAW_EVENTS, "event_id string, event_time string, user_id string, `event.payload` string")
    items = spark.createDataFrame(RAW_ITEMS, "id string, price string")
    return events, items


def _check(marts):
    assert set(map(tuple, marts["eventviewitembyyear"].select("year", "total_item_view").collect())) == YEARLY
    assert set(map(tuple, marts["itemviewnumbersbyyear"].collect())) == RANKING
    assert set(map(tuple, marts["mostusedplatformbyyearrank"].collect())) == TOP


def test_marts_from_memory(spark, raw):
    events, items = raw
    silver_events = to_silver(events, EVENT_SPEC)
    assert silver_events.columns == ["event_id", "event_time", "user_id", "event_name", "platform", "sub_event_name",
                                     "sub_event_name_value", "event_time_year"]
    base = view_counts(silver_events, to_silver(items, ITEM_SPEC), GOLD)
    _check(gold_marts(base))


def test_marts_from_files_equal_marts_from_memory(spark, raw, scratch):
    events, items = raw
    result = run_medallion(spark, {"events": events, "items": items}, scratch("medallion"),
                           {"events": EVENT_SPEC, "items": ITEM_SPEC}, GOLD)
    marts = {k: spark.read.parquet(v) for k, v in result.gold.items()}
    _check(marts)
    assert result.rows["bronze.events"] == 13 and result.rows["silver.items"] == 3
    # the silver fact is partitioned by year on disk
    assert any("event_time_year=2018" in p for p in spark.read.parquet(result.silver["events"]).inputFiles())


def test_duplicate_dimension_keys_multiply_and_empty_dimension(spark, raw):
    events, items = raw
    silver_events = to_silver(events, EVENT_SPEC)
    dup_items = to_silver(items.unionByName(items.where("id = '1'")), ITEM_SPEC)
    yearly = dict(map(tuple, gold_marts(view_counts(silver_events, dup_items, GOLD))["eventviewitembyyear"].collect()))
    assert yearly == {2018: 7, 2017: 2, None: 2}
    empty = to_silver(items.where("false"), ITEM_SPEC)
    marts = gold_marts(view_counts(silver_events, empty, GOLD))
    assert all(m.count() == 0 for m in marts.values())
    assert marts["itemviewnumbersbyyear"].columns == ["year", "total_item_view", "item_id", "view_ranking"]


def test_dense_rank_and_top_with_ties_match_windows(spark):
    rows = [(y, i, c) for y in (2020, 2021, None) for i, c in enumerate([5, 5, 3, 9, 1, 3, 9, 2])]
    df = spark.createDataFrame(rows, "year int, item int, cnt long")
    from pyspark.sql import Window

    w = Window.partitionBy("year").orderBy(F.desc("cnt"))
    want = set(map(tuple, df.withColumn("r", F.dense_rank().over(w)).collect()))
    got = set(map(tuple, dense_rank_counts(df, "year", "cnt", "r").select("year", "item", "cnt", "r").collect()))
    assert got == want
    top = set(map(tuple, top_with_ties(df, "year", "cnt").collect()))
    assert top == {(y, i, 9) for y in (2020, 2021, None) for i in (3, 6)}
