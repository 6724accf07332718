import os
from datetime import datetime, timedelta, timezone
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tarnflow import schemas
from tarnflow.operators import incremental
from tarnflow.sources import mark as marks
from tarnflow.sources import names, raw, storage
from tests.conftest import plan_of

MARK = datetime(2024, 1, 15, tzinfo=timezone.utc)


def raw_df(spark, rows):
    """Raw rows from (event_id, time, batch_id)."""
    df = spark.createDataFrame(rows, "event_id string, t string, batch_id string")
    df = df.withColumn("event_ts", F.col("t").cast("timestamp")).drop("t")
    df = df.withColumn("event_date", F.to_date("event_ts")).withColumn("ingested_at", F.lit(MARK))
    missing = [f for f in schemas.RAW.fields if f.name not in df.columns]
    df = df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    return df.select(*schemas.RAW.names)


def test_raw_round_trip_layout_and_precision(spark, folder):
    df = raw_df(spark, [("a", "2024-01-14 01:02:03.123987", "123e4"), ("b", "2024-01-15 00:00:00", "b1")])
    raw.write_raw(df, folder)
    raw.write_raw(df.where("event_id = 'b'"), folder)  # append
    assert sorted(d for d in os.listdir(folder) if "=" in d) == ["event_date=2024-01-14", "event_date=2024-01-15"]
    rows = raw.read_raw_events(spark, folder, MARK).orderBy("event_id").collect()
    assert [(r.event_id, r.batch_id) for r in rows] == [("a", "123e4"), ("b", "b1"), ("b", "b1")]
    assert rows[0].event_ts.microsecond == 123000
    assert any(f.endswith(".snappy.parquet") for f in os.listdir(f"{folder}/event_date=2024-01-15"))


def test_old_date_folders_are_not_listed(spark, folder):
    days = [f"2024-01-{d:02}" for d in range(1, 21)]
    raw.write_raw(raw_df(spark, [(d, d, f"b{d}") for d in days]), folder)
    os.mkdir(f"{folder}/event_date=2024-01-02/event_date=2024-01-03")  # would break a listing
    os.mkdir(f"{folder}/event_date=2024-01-02/other=1")
    scan = raw.read_raw_events(spark, folder, MARK, lookback_days=3)
    assert {r.event_id for r in scan.collect()} == set(days[11:])
    assert raw.read_raw_events(spark, f"{folder}/none", MARK).count() == 0
    assert raw.read_raw_events(spark, folder, MARK + timedelta(days=60)).count() == 0


def test_nothing_written_without_rows(spark, folder):
    raw.write_raw(raw_df(spark, [("a", "2024-01-14", "b")]).where("false"), folder)
    assert not [f for _, _, files in os.walk(folder) for f in files if f.endswith(".parquet")]


def test_scan_prunes_partitions_and_pushes_the_mark(spark, folder):
    raw.write_raw(
        raw_df(spark, [("a", "2024-01-11", "b"), ("b", "2024-01-12", "b"), ("c", "2024-01-20", "b")]), folder
    )
    scan = raw.read_raw_events(spark, folder, MARK, lookback_days=3)
    assert {r.event_id for r in scan.collect()} == {"b", "c"}  # the start date is included
    plan = plan_of(incremental.newer_than_mark(scan, MARK).select("event_id"))
    assert "event_date#" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "GreaterThan(event_ts," in plan.split("PushedFilters:")[1]
    assert "ReadSchema: struct<event_id:string,event_ts:timestamp>" in plan


def test_reads_zone_less_files_written_elsewhere(spark, folder):
    """A raw table made by PyArrow with timestamp(ms) and no zone means UTC."""
    os.makedirs(f"{folder}/event_date=2024-01-20/batch_id=77")
    table = pa.table(
        {"event_id": ["a"], "event_ts": pa.array([datetime(2024, 1, 20, 10)], pa.timestamp("ms"))}
    )
    pq.write_table(table, f"{folder}/event_date=2024-01-20/batch_id=77/part-0.parquet")
    row = raw.read_raw_events(spark, folder, MARK).select("*", F.hour("event_ts").alias("h")).first()
    assert (row.event_id, row.batch_id, row.h, row.username) == ("a", "77", 10, None)


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, marks.EPOCH),
        ("{}", marks.EPOCH),
        ("", marks.EPOCH),
        ("junk", marks.EPOCH),
        ('{"last_processed_event_ts": null}', marks.EPOCH),
        ('{"last_processed_event_ts": "soon"}', marks.EPOCH),
        ('{"last_processed_event_ts": "2025-01-01T10:15:30Z"}', datetime(2025, 1, 1, 10, 15, 30, tzinfo=timezone.utc)),
        ('{\n "last_processed_event_ts":\n "2025-01-01T10:15:30.123456+02:00"}', datetime(2025, 1, 1, 8, 15, 30, 123456, tzinfo=timezone.utc)),
        ('{"last_processed_event_ts": "2025-01-01T10:15:30"}', datetime(2025, 1, 1, 10, 15, 30, tzinfo=timezone.utc)),
    ],
)
def test_read_mark(spark, tmp_path, text, expected):
    path = tmp_path / "mark.json"
    if text is not None:
        path.write_text(text)
    assert marks.read_mark(spark, str(path)) == expected
    if expected == marks.EPOCH and text is not None:
        with pytest.raises(ValueError):
            marks.read_mark(spark, str(path), strict=True)
    else:
        assert marks.read_mark(spark, str(path), strict=True) == expected


def test_write_mark_replaces_in_place(spark, tmp_path):
    path = f"{tmp_path}/mark.json"
    marks.write_mark(spark, path, "2025-01-01T00:00:00Z")
    marks.write_mark(spark, path, "2025-01-02T00:00:00.5Z")
    assert marks.read_mark(spark, path) == datetime(2025, 1, 2, 0, 0, 0, 500000, tzinfo=timezone.utc)
    assert [f for f in os.listdir(tmp_path) if f.endswith(".tmp")] == []


def test_mark_micros_round_trip():
    for mark in (marks.EPOCH, MARK, datetime(1969, 12, 31, 23, 59, 59, 999999, tzinfo=timezone.utc)):
        assert marks.from_micros(marks.to_micros(mark)) == mark


def test_scan_start_before_the_epoch():
    assert str(raw.scan_start(marks.EPOCH)) == "1969-12-29"
    assert str(raw.scan_start(MARK + timedelta(hours=23), timedelta(0))) == "2024-01-15"


def test_names():
    assert names.candidates("db.t") == ["db.t"]
    assert names.candidates(" cat . db.t ") == ["cat.db.t", "db.t"]
    assert names.quote_name("db.a`b") == "`db`.`a``b`"
    for bad in ("t", "a.b.c.d", "", "..t"):
        with pytest.raises(ValueError):
            names.candidates(bad)


def test_resolve_by_existence(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    spark.sql("CREATE TABLE IF NOT EXISTS lake.present (event_id string) USING parquet")
    assert names.resolve(spark, "lake.present") == "`lake`.`present`"
    assert names.resolve(spark, "spark_catalog.lake.present") == "`spark_catalog`.`lake`.`present`"
    assert names.resolve(spark, "no_such_catalog.lake.present") == "`lake`.`present`"
    with pytest.raises(ValueError):
        names.resolve(spark, "lake.absent")


def test_staged_table_is_read_back_and_removed(spark, folder):
    df = spark.range(10).withColumn("part", F.col("id") % 2)
    with storage.staged(spark, df) as table:
        path = table.inputFiles()[0].removeprefix("file:").removeprefix("//").rsplit("/", 1)[0]
        assert table.count() == 10 and table.dtypes == df.dtypes and os.path.isdir(path)
    assert not os.path.exists(path)


@pytest.mark.parametrize(
    "configured, expected",
    [(None, "/house/_tarnflow"), ("s3a://shared/ck/", "s3a://shared/ck/_tarnflow")],
)
def test_scratch_follows_the_session(configured, expected):
    session = SimpleNamespace(
        conf={"spark.sql.warehouse.dir": "/house"} | ({"spark.checkpoint.dir": configured} if configured else {})
    )
    assert storage.scratch_root(session) == expected
