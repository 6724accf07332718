import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tarnflow import schemas
from tarnflow.plans import silver as silver_plan
from tarnflow.plans.ingest import run_ingest, run_ingest_stream
from tarnflow.plans.silver import run_silver
from tarnflow.sources import mark as marks
from tarnflow.sources import raw, storage
from tarnflow.streaming.silver_stream import run_silver_stream
from tests.test_ingest_operators import AS_OF, GOOD, change, land
from tests.test_sources import raw_df


class Lake:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.raw, self.mark, self.silver = f"{folder}/raw", f"{folder}/mark.json", f"{folder}/silver"

    def add(self, *rows):
        raw.write_raw(raw_df(self.spark, list(rows)), self.raw)

    def run(self, **options):
        return run_silver(self.spark, self.raw, self.mark, self.silver, **options)

    def stream(self, **options):
        run_silver_stream(self.spark, self.raw, f"{self.folder}/progress", self.silver, **options)

    def rows(self):
        table = self.spark.read.schema(schemas.SILVER).parquet(self.silver)
        return {(r.event_id, str(r.event_ts), r.batch_id) for r in table.collect()}


@pytest.fixture
def lake(spark, folder):
    return Lake(spark, folder)


def test_ingest_writes_both_tables_in_one_pass(spark, folder):
    land(
        f"{folder}/in",
        {"dt": "2024-01-05", "batch_id": "b1", "events": [GOOD, change(dt="2024-01-04"), change(id=""), change(platform="tv")]},
        {"dt": "2024-01-06", "batch_id": "b2", "events": [7]},
        {"dt": "2024-01-06", "batch_id": "b3", "events": []},
    )
    run = run_ingest(spark, f"{folder}/in", f"{folder}/lake", ingested_at=AS_OF, as_of=AS_OF)
    assert (run.received, run.total_good, run.total_bad) == (5, 2, 3)
    # Filed under the envelope's date, also the event with an older date of its own.
    assert os.listdir(f"{folder}/lake/feed=session_events") == ["event_date=2024-01-05"]
    good = raw.read_raw_events(spark, raw.raw_path(f"{folder}/lake"), marks.EPOCH)
    assert good.columns and set(good.columns) == set(schemas.RAW.names)
    assert {(str(r.event_date), r.event_ts.microsecond, r.ingested_at is None) for r in good.collect()} == {
        ("2024-01-05", 123000, False),
    }
    bad = raw.read_quarantine(spark, raw.quarantine_path(f"{folder}/lake")).collect()
    assert {(r.dq_stage, r.dq_reason, r.raw is None, str(r.event_date)) for r in bad} == {
        ("schema", "missing_id", False, "2024-01-05"),
        ("dq", "invalid_platform", False, "2024-01-05"),
        ("schema", "unexpected_normalize_error", False, "2024-01-06"),
    }
    assert {r.platform for r in bad if r.dq_stage == "dq"} == {"tv"}
    assert json.loads(next(r.raw for r in bad if r.dq_reason == "missing_id"))["session_id"] == "s1"
    summary = {r.batch_id: (r.received, r.good, r.bad_schema, r.bad_dq) for r in run.summary.collect()}
    assert summary == {"b1": (4, 2, 1, 1), "b2": (1, 0, 1, 0), "b3": (0, 0, 0, 0)}

    again = run_ingest(spark, f"{folder}/in", f"{folder}/lake", ingested_at=AS_OF, as_of=AS_OF)
    assert again.summary.agg(F.sum("received")).first()[0] == 5  # its own rows only
    assert good.sparkSession.read.parquet(raw.raw_path(f"{folder}/lake")).count() == 4  # appended


def test_a_repeated_run_id_replaces_its_rows(spark, folder):
    land(f"{folder}/in", {"dt": "2024-01-05", "batch_id": "b1", "events": [GOOD, change(id="")]})
    for _ in range(2):
        run = run_ingest(spark, f"{folder}/in", f"{folder}/lake", as_of=AS_OF, run_id="r1")
    assert spark.read.parquet(raw.raw_path(f"{folder}/lake")).count() == 1
    assert raw.read_quarantine(spark, raw.quarantine_path(f"{folder}/lake")).count() == 1
    assert run.summary.select("received", "good", "bad_schema").collect() == [(2, 1, 1)]


def test_nothing_that_landed_vanishes(spark, folder):
    """Cut-off, doubled and trailed documents are kept whole and counted, apart from events."""
    envelope = json.dumps({"dt": "2024-01-05", "batch_id": "b1", "events": [GOOD]})
    odd = [envelope + envelope, envelope + " tail", envelope[:-3], "7", envelope + "," + envelope, envelope + "] x", envelope + "} x"]
    land(f"{folder}/in", envelope, *odd, "", "[" + envelope + "," + envelope + "]")
    run = run_ingest(spark, f"{folder}/in", f"{folder}/lake", ingested_at=AS_OF, as_of=AS_OF)
    assert (run.received, run.total_good, run.total_bad, run.bad_envelopes) == (3, 3, 0, len(odd))
    kept = raw.read_quarantine(spark, raw.quarantine_path(f"{folder}/lake")).collect()
    assert sorted(r.raw for r in kept) == sorted(odd)
    assert {(r.dq_stage, r.dq_reason) for r in kept} == {("envelope", "malformed_envelope")}
    summary = {r.batch_id: (r.received, r.good, r.bad_envelope) for r in run.summary.collect()}
    assert summary == {"b1": (3, 3, 0), "unknown": (0, 0, len(odd))}


def test_spread_does_not_multiply_files(spark, folder):
    envelopes = [
        {"dt": f"2024-01-{d:02}", "batch_id": f"b{d}", "events": [change(dt=f"2024-01-{d:02}")] * 50} for d in range(1, 21)
    ]
    land(f"{folder}/in", *envelopes)
    files = []
    for spread in (None, 16):
        root = f"{folder}/lake{spread}"
        run_ingest(spark, f"{folder}/in", root, as_of=AS_OF, spread=spread)
        files.append(sum(f.endswith(".parquet") for _, _, names in os.walk(root) for f in names))
    assert files[0] <= 25 and files[1] <= 25


def test_streamed_ingest_takes_each_file_once(spark, folder):
    places = (f"{folder}/in", f"{folder}/lake", f"{folder}/progress")
    land(places[0], {"dt": "2024-01-05", "batch_id": "b1", "events": [GOOD]})
    run_ingest_stream(spark, *places, as_of=AS_OF)
    run_ingest_stream(spark, *places, as_of=AS_OF)
    os.rename(f"{places[0]}/landed.json", f"{folder}/old.json")
    land(places[0] + "/more", {"dt": "2024-01-05", "batch_id": "b2", "events": [change(id="e2")]})
    os.rename(f"{places[0]}/more/landed.json", f"{places[0]}/second.json")
    run_ingest_stream(spark, *places, as_of=AS_OF)
    assert {r.event_id for r in spark.read.parquet(raw.raw_path(places[1])).collect()} == {"e1", "e2"}


def test_event_with_an_old_date_of_its_own_reaches_silver(spark, folder):
    lake, mark = f"{folder}/lake", f"{folder}/mark.json"
    marks.write_mark(spark, mark, "2024-01-19T10:00:00Z")
    event = change(event_timestamp="2024-01-20T09:00:00Z", dt="2024-01-01")
    land(f"{folder}/in", {"dt": "2024-01-20", "batch_id": "b", "events": [event]})
    run_ingest(spark, f"{folder}/in", lake, as_of=AS_OF)
    run_silver(spark, raw.raw_path(lake), mark, f"{folder}/silver")
    rows = spark.read.parquet(f"{folder}/silver").collect()
    assert [(r.event_id, str(r.event_date)) for r in rows] == [("e1", "2024-01-20")]


def test_late_tolerance_reaches_behind_the_lookback(lake):
    lake.add(("a", "2024-01-20", "b1"))
    lake.run()
    lake.add(("late", "2024-01-13", "b2"))
    assert lake.run(late_tolerance=timedelta(days=10), lookback_days=3).rows_new == 2
    assert {r[0] for r in lake.rows()} == {"a", "late"}


def test_scratch_does_not_disturb_a_reader_of_the_root(spark, folder):
    land(f"{folder}/in", {"dt": "2024-01-05", "batch_id": "b1", "events": [GOOD]})
    run = run_ingest(spark, f"{folder}/in", f"{folder}/lake", as_of=AS_OF)
    with storage.staged(spark, spark.range(3)):
        assert run.summary.count() == 1
        assert spark.read.parquet(f"{folder}/lake").count() == 1


def test_ingest_of_a_hot_batch(spark, folder):
    """One batch id in many envelopes holds most rows; nothing is lost or merged."""
    envelopes = [{"dt": "2024-01-05", "batch_id": "hot", "events": [GOOD] * 40} for _ in range(50)]
    land(f"{folder}/in", *envelopes, {"dt": "2024-01-05", "batch_id": "cold", "events": [GOOD]})
    run = run_ingest(spark, f"{folder}/in", f"{folder}/lake", as_of=AS_OF, spread=4)
    assert {r.batch_id: r.good for r in run.summary.collect()} == {"hot": 2000, "cold": 1}


def test_two_increments(lake):
    lake.add(("a", "2024-01-10 01:00:00", "b1"), ("a", "2024-01-10 02:00:00.5", "b1"), ("b", "2024-01-11", "b1"))
    first = lake.run()
    assert (first.rows_raw_scanned, first.rows_new, first.max_event_ts_new) == (3, 3, "2024-01-11 00:00:00")
    assert first.mark == "2024-01-11T00:00:00Z" and len(first.sample) == 2
    assert marks.read_mark(lake.spark, lake.mark) == datetime(2024, 1, 11, tzinfo=timezone.utc)
    assert lake.rows() == {("a", "2024-01-10 02:00:00.500000", "b1"), ("b", "2024-01-11 00:00:00", "b1")}

    lake.add(("a", "2024-01-12", "b2"), ("c", "2024-01-12 05:00:00", "b2"))
    second = lake.run()
    # Everything from 2024-01-08 on is scanned, only what is after the mark is new.
    assert (second.rows_raw_scanned, second.rows_new, second.mark) == (5, 2, "2024-01-12T05:00:00Z")
    expected = {("a", "2024-01-12 00:00:00", "b2"), ("b", "2024-01-11 00:00:00", "b1"), ("c", "2024-01-12 05:00:00", "b2")}
    assert lake.rows() == expected
    assert not os.path.exists(f"{lake.silver}/event_date=2024-01-10")

    third = lake.run()
    assert (third.rows_new, third.max_event_ts_new, third.mark, third.sample) == (0, None, None, [])
    assert lake.rows() == expected and marks.read_mark(lake.spark, lake.mark).hour == 5


def test_crash_between_merge_and_mark_is_harmless(lake, monkeypatch):
    lake.add(("a", "2024-01-10", "b1"))
    lake.run()
    lake.add(("a", "2024-01-11", "b2"), ("b", "2024-01-11", "b2"))

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(silver_plan.marks, "write_mark", crash)
        with pytest.raises(RuntimeError):
            lake.run()
    assert marks.read_mark(lake.spark, lake.mark).day == 10
    merged = lake.rows()
    assert lake.run().rows_new == 2
    assert lake.rows() == merged and marks.read_mark(lake.spark, lake.mark).day == 11


def test_mark_stays_when_the_merge_fails(lake, monkeypatch):
    lake.add(("a", "2024-01-10", "b1"))
    lake.run()
    lake.add(("b", "2024-01-11", "b1"))

    def crash(*_):
        raise RuntimeError("merge failed")

    monkeypatch.setattr(silver_plan, "merge_increment", crash)
    with pytest.raises(RuntimeError):
        lake.run()
    assert marks.read_mark(lake.spark, lake.mark).day == 10


def test_late_row_is_lost_in_batch_unless_tolerated_and_kept_in_the_stream(lake):
    lake.add(("a", "2024-01-10", "b1"))
    lake.run()
    lake.stream()
    lake.add(("late", "2024-01-09 23:00:00", "b2"))
    assert lake.run().rows_new == 0
    assert {r[0] for r in lake.rows()} == {"a"}
    lake.stream()
    assert {r[0] for r in lake.rows()} == {"a", "late"}
    lake.add(("later", "2024-01-09 22:00:00", "b3"))
    tolerant = lake.run(late_tolerance=timedelta(hours=6))
    assert {r[0] for r in lake.rows()} == {"a", "late", "later"}
    assert tolerant.mark == "2024-01-10T00:00:00Z"  # the mark never moves back


def test_older_row_in_a_later_run(lake):
    lake.add(("a", "2024-01-10", "b1"))
    lake.run()
    lake.add(("a", "2024-01-09", "b2"))
    lake.run(late_tolerance=timedelta(days=2), newer_than="event_ts")
    assert lake.rows() == {("a", "2024-01-10 00:00:00", "b1")}
    lake.add(("a", "2024-01-11", "b3"), ("a", "2024-01-10 12:00:00", "b4"))
    lake.run()
    assert lake.rows() == {("a", "2024-01-11 00:00:00", "b3")}


def test_rows_without_key_count_as_new_but_do_not_move_the_mark(lake):
    lake.add(("a", "2024-01-10", "b1"), (None, "2024-01-12", "b1"))
    run = lake.run()
    assert (run.rows_new, run.max_event_ts_new, run.mark) == (2, "2024-01-12 00:00:00", "2024-01-10T00:00:00Z")


def test_mark_can_be_capped(lake):
    lake.add(("a", "2024-01-10 00:04:00", "b1"))
    run = lake.run(cap_mark_at=datetime(2024, 1, 10, tzinfo=timezone.utc))
    assert run.mark == "2024-01-10T00:00:00Z"


def test_stream_by_one_file_at_a_time_keeps_the_latest(lake):
    for day in (12, 10, 14, 11):
        lake.add(("a", f"2024-01-{day}", f"b{day}"), (f"k{day}", f"2024-01-{day}", f"b{day}"))
    lake.stream(max_files_per_trigger=1)
    assert lake.rows() == {("a", "2024-01-14 00:00:00", "b14")} | {
        (f"k{d}", f"2024-01-{d} 00:00:00", f"b{d}") for d in (10, 11, 12, 14)
    }
    before = lake.rows()
    lake.stream()
    assert lake.rows() == before


def test_zone_is_checked(lake):
    lake.add(("a", "2024-01-10", "b1"))
    lake.spark.conf.set("spark.sql.session.timeZone", "America/Halifax")
    try:
        with pytest.raises(ValueError, match="UTC"):
            lake.run()
        with pytest.raises(ValueError, match="UTC"):
            lake.stream()
    finally:
        lake.spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_one_target_must_be_given(lake):
    with pytest.raises(ValueError, match="either"):
        run_silver(lake.spark, lake.raw, lake.mark)
    with pytest.raises(ValueError, match="either"):
        run_silver_stream(lake.spark, lake.raw, lake.folder, lake.silver, table="db.t")
