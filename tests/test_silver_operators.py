from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tarnflow.operators import features, incremental, standardize
from tests.conftest import plan_of

MARK = datetime(2024, 1, 15, tzinfo=timezone.utc)


def test_safe_casts(spark):
    df = spark.createDataFrame(
        [("2024-01-01T05:00:00Z", "2024-01-01"), ("bad", "bad"), (None, None)], "event_ts string, event_date string"
    )
    out = standardize.ensure_date(standardize.ensure_timestamp(df, "event_ts"), "event_date")
    assert [f.dataType.typeName() for f in out.schema] == ["timestamp", "date"]
    assert [(r[0] is None, r[1] is None) for r in out.collect()] == [(False, False), (True, True), (True, True)]
    assert standardize.ensure_timestamp(df, "absent") is df and standardize.ensure_date(df, "absent") is df
    ntz = spark.sql("SELECT timestamp_ntz'2024-01-01 05:00:00' AS event_ts, timestamp'2024-01-01 05:00:00' AS event_date")
    out = standardize.ensure_date(standardize.ensure_timestamp(ntz, "event_ts"), "event_date")
    assert out.select(F.hour("event_ts"), F.col("event_date").cast("string")).first() == (5, "2024-01-01")


def test_add_if_absent(spark):
    df = spark.createDataFrame([("x",)], "batch_id string")
    assert standardize.add_if_absent(df, "batch_id", "y").first().batch_id == "x"
    added = standardize.add_if_absent(df.drop("batch_id"), "batch_id", standardize.run_batch_id()).first()
    assert added.batch_id.startswith("run_2") and len(added.batch_id) == 18


def test_standardize_filters_and_keeps_latest(spark):
    rows = [
        ("a", "2024-01-01T01:00:00Z", "b1", "old"),
        ("a", "2024-01-01T02:00:00Z", "b1", "new"),
        (None, "2024-01-01T02:00:00Z", "b1", "no key"),
        ("b", "junk", "b1", "no time"),
        ("c", "2024-01-01T02:00:00Z", "b1", "tie"),
        ("c", "2024-01-01T02:00:00Z", "b2", "tie, later batch"),
        ("d", "2024-01-01T02:00:00Z", "b1", "x"),
        ("d", "2024-01-01T02:00:00Z", "b1", "y"),
    ]
    df = spark.createDataFrame(rows, "event_id string, event_ts string, batch_id string, url string")
    got = {r.event_id: r.url for r in standardize.standardize(df).collect()}
    assert got == {"a": "new", "c": "tie, later batch", "d": "y"}
    # The order of the input does not matter.
    again = spark.createDataFrame(rows[::-1], df.schema).repartition(3)
    assert {r.event_id: r.url for r in standardize.standardize(again).collect()} == got
    assert "_rank" not in standardize.standardize(df).columns


def test_standardize_tolerates_missing_columns(spark):
    only_key = spark.createDataFrame([("a",), ("a",), (None,)], "event_id string")
    assert standardize.standardize(only_key).count() == 2
    only_time = spark.createDataFrame([("2024-01-01",), ("bad",)], "event_ts string")
    assert standardize.standardize(only_time).count() == 1


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A key that holds a third of the rows leaves each task as one row."""
    df = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.timestamp_seconds("id").alias("event_ts"),
    )
    latest = standardize.keep_latest(df)
    below_exchange = plan_of(latest).split("Exchange hashpartitioning(event_id")[1]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange
    assert latest.where("event_id = 'hot'").select(F.unix_seconds("event_ts")).collect() == [(29997,)]
    assert latest.count() == 20001


DEVICES = {
    "iPhone 15": "apple_mobile", "IPAD": "apple_mobile", "Pixel 8": "android_mobile",
    "  Samsung S23 ": "android_mobile", "Android ipad": "apple_mobile", "MacBook Pro": "apple_desktop",
    "old mac mini": "apple_desktop", "machine": "other", "imac": "other", "Windows Laptop": "windows_desktop",
    "mac windows": "apple_desktop", "": "other", None: "other",
}
REGIONS = {
    "Nova Scotia": "atlantic", "New Brunswick": "atlantic", "Prince Edward Island": "atlantic",
    "Newfoundland and Labrador": "atlantic", "Alberta": "prairies", "Saskatchewan": "prairies",
    "Manitoba": "prairies", " Ontario ": "ontario", "Quebec": "quebec", "quebec": "unknown",
    "British Columbia": "bc", "Ontario\t": "unknown", "Yukon": "unknown", None: "unknown",
}
CATEGORIES = {
    " PageView": "engagement", "CLICKS": "engagement", "referral": "engagement", "log_in": "account",
    "Log_Off": "account", "signups": "account", "Delete_Account ": "churn_signal", "purchase": "other", None: "other",
}


@pytest.mark.parametrize(
    "source, target, table",
    [("device", "device_family", DEVICES), ("country", "geo_region", REGIONS), ("event_type", "event_category", CATEGORIES)],
)
def test_buckets(spark, source, target, table):
    df = spark.createDataFrame(list(enumerate(table)), f"i int, {source} string")
    rows = features.add_features(df).orderBy("i").collect()
    assert {k: r[target] for k, r in zip(table, rows)} == table


def test_strings_and_hour(spark):
    df = spark.sql(
        "SELECT '  WEB ' AS platform, '\\tClicks ' AS event_type, ' a b ' AS device, ' Ontario ' AS country,"
        " ' keep ' AS os, timestamp'2024-01-01 23:59:59' AS event_ts"
    )
    row = features.add_features(df).first()
    assert (row.platform, row.event_type, row.device, row.country, row.os) == ("web", "\tclicks", "a b", "Ontario", " keep ")
    assert row.event_hour == 23


def test_missing_columns_get_defaults(spark):
    row = features.add_features(spark.createDataFrame([("a",)], "event_id string")).first().asDict()
    assert row == {"event_id": "a", "device_family": "unknown", "geo_region": "unknown", "event_category": "other"}


def test_sample(spark):
    df = spark.createDataFrame([(f"e{i}", "web", 1) for i in range(9)], "event_id string, platform string, x int")
    out = features.sample_rows(df, order_by="event_id")
    assert out.columns == ["event_id", "platform"]
    assert [r.event_id for r in out.collect()] == ["e0", "e1", "e2", "e3", "e4"]
    assert features.sample_rows(df, rows=2).count() == 2


def test_incremental_is_strict_and_drops_nulls(spark):
    times = [MARK - timedelta(hours=1), MARK, MARK + timedelta(microseconds=1), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, event_ts timestamp")
    assert [r.i for r in incremental.newer_than_mark(df, MARK).collect()] == [2]
    late = incremental.newer_than_mark(df, MARK, late_tolerance=timedelta(hours=2))
    assert [r.i for r in late.orderBy("i").collect()] == [0, 1, 2]


def test_stats_and_next_mark(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (timestamp'2024-01-15 00:00:00'), (timestamp'2024-01-16 01:00:00'),"
        " (timestamp'2024-01-16 01:00:00.5'), (CAST(NULL AS timestamp)) AS v(event_ts)"
    )
    assert tuple(incremental.run_stats(df, MARK).first()) == (4, 2, "2024-01-16 01:00:00.500000")
    assert tuple(incremental.run_stats(df.where("false"), MARK).first()) == (0, 0, None)
    assert incremental.next_mark(df).first()[0] == "2024-01-16T01:00:00.500000Z"
    assert incremental.next_mark(df.where("false")).first()[0] is None
