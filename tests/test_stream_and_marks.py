"""Dedupe across micro-batches, late rows, guarded marks, and the key filters of an upsert."""

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tarnflow import schemas
from tarnflow.operators import incremental
from tarnflow.operators import upsert as upserts
from tarnflow.plans import silver as silver_plan
from tarnflow.plans.silver import run_silver
from tarnflow.sources import mark as marks
from tarnflow.sources import raw, storage
from tarnflow.streaming.dedupe_stream import run_dedupe_stream
from tests.test_sources import raw_df

MARK = datetime(2024, 1, 15, tzinfo=timezone.utc)


# ---- dedupe across micro-batches ----


def test_repeats_in_three_batches_come_through_once(spark, folder):
    rows = [(f"e{k}", f"2024-01-{10 + k:02}", "b") for k in range(6)]
    for part in (rows[:3], rows[1:5] + rows[1:2], rows, [(None, "2024-01-10", "b"), ("no time", None, "b")]):
        raw.write_raw(raw_df(spark, part), f"{folder}/raw")
        run_dedupe_stream(spark, f"{folder}/raw", f"{folder}/progress", f"{folder}/once", timedelta(days=30))
    got = spark.read.schema(schemas.RAW).parquet(f"{folder}/once").collect()
    assert sorted((r.event_id, str(r.event_ts)[:10]) for r in got) == [(i, t) for i, t, _ in rows]


def test_the_state_stays_small(spark, folder):
    """Thirty days of new keys, of which the state holds those of the last few."""
    held = []
    for day in range(30):
        at = (MARK + timedelta(days=day)).strftime("%Y-%m-%d")
        raw.write_raw(raw_df(spark, [(f"e{day}-{k % 20}", at, "b") for k in range(40)]), f"{folder}/raw")
        if day % 5 == 4:
            run_dedupe_stream(spark, f"{folder}/raw", f"{folder}/progress", f"{folder}/once", timedelta(days=2), max_files_per_trigger=1)
            held.append(spark.read.format("statestore").load(f"{folder}/progress").count())
    assert spark.read.parquet(f"{folder}/once").count() == 30 * 20
    assert held[-1] <= 2 * 3 * 20 and max(held) <= 2 * 3 * 20


# ---- late rows ----


def rows_at(spark, ingested, *rows):
    return raw_df(spark, list(rows)).withColumn("ingested_at", F.lit(ingested).cast("timestamp"))


class Lake:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.places = (f"{folder}/raw", f"{folder}/mark.json", f"{folder}/silver")

    def add(self, ingested, *rows):
        raw.write_raw(rows_at(self.spark, ingested, *rows), self.places[0])

    def run(self, **options):
        return run_silver(self.spark, *self.places, late_path=f"{self.folder}/late", **options)

    def late(self):
        table = storage.read_parquet_if_exists(self.spark, f"{self.folder}/late")
        return sorted(r.event_id for r in table.collect()) if table else []


def test_every_scanned_row_goes_somewhere(spark, folder):
    lake = Lake(spark, folder)
    lake.add("2024-01-15 01:00:00", ("a", "2024-01-14", "b"), ("b", "2024-01-15", "b"))
    first = lake.run()
    assert (first.rows_new, first.rows_late, first.rows_seen) == (2, 0, 0) and lake.late() == []
    lake.add("2024-01-16 01:00:00", ("late", "2024-01-14 12:00:00", "b"), ("on the mark", "2024-01-15", "b"), ("c", "2024-01-16", "b"))
    second = lake.run()
    assert (second.rows_raw_scanned, second.rows_new, second.rows_late, second.rows_seen, second.rows_untimed) == (5, 1, 2, 2, 0)
    assert lake.late() == ["late", "on the mark"]
    third = lake.run()
    assert (third.rows_new, third.rows_late, third.rows_seen) == (0, 0, 5) and lake.late() == ["late", "on the mark"]


def test_late_rows_without_an_increment_are_kept_once(spark, folder):
    lake = Lake(spark, folder)
    lake.add("2024-01-15 01:00:00", ("b", "2024-01-15", "b"))
    lake.run()
    for k in range(3):  # the mark stays, so each run finds the late rows of the ones before
        lake.add(f"2024-01-16 0{k}:00:00", (f"late{k}", "2024-01-14", "b"))
        assert lake.run().rows_late == k + 1
    assert lake.late() == ["late0", "late1", "late2"]
    lake.add("2024-01-17 00:00:00", ("c", "2024-01-17", "b"), ("late3", "2024-01-14", "b"))
    lake.run()
    assert lake.late() == ["late0", "late1", "late2", "late3"]


def test_a_run_that_failed_keeps_late_rows_once(spark, folder, monkeypatch):
    lake = Lake(spark, folder)
    lake.add("2024-01-15 01:00:00", ("b", "2024-01-15", "b"))
    lake.run()
    lake.add("2024-01-16 01:00:00", ("late", "2024-01-14", "b"), ("c", "2024-01-16", "b"))
    monkeypatch.setattr(marks, "write_mark", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        lake.run()
    monkeypatch.undo()
    lake.run()
    assert lake.late() == ["late"]


def test_routes_add_up_and_tolerance_moves_late_rows(spark):
    rows = rows_at(spark, "2024-01-16", ("a", "2024-01-14", "b"), ("b", "2024-01-16", "b"), ("c", None, "b"))
    for seen, tolerance, want in (
        (None, timedelta(0), {"late": 1, "increment": 1, "untimed": 1}),
        (datetime(2024, 1, 17, tzinfo=timezone.utc), timedelta(0), {"seen": 1, "increment": 1, "untimed": 1}),
        (None, timedelta(days=2), {"increment": 2, "untimed": 1}),
    ):
        routed = rows.groupBy(incremental.route(MARK, seen, tolerance).alias("to")).count()
        assert {r[0]: r[1] for r in routed.collect()} == want
        assert incremental.late_rows(rows, MARK, seen, tolerance).count() == want.get("late", 0)


# ---- guarded marks ----


def test_the_second_writer_is_refused(spark, folder):
    path = f"{folder}/mark.json"
    first, second = marks.read_document(spark, path), marks.read_document(spark, path)
    assert first == marks.Mark(marks.EPOCH, None, 0)
    assert marks.write_mark(spark, path, "2024-01-15T00:00:00Z", first, "2024-01-16T00:00:00Z") == 1
    with pytest.raises(marks.MarkMoved):
        marks.write_mark(spark, path, "2024-01-10T00:00:00Z", second)
    stored = marks.read_document(spark, path)
    assert stored == marks.Mark(MARK, MARK + timedelta(days=1), 1)
    marks.write_mark(spark, path, "2024-01-20T00:00:00Z", stored)
    for stale in (first, stored):  # however long it slept
        with pytest.raises(marks.MarkMoved):
            marks.write_mark(spark, path, "2024-01-01T00:00:00Z", stale)
    assert marks.read_mark(spark, path) == datetime(2024, 1, 20, tzinfo=timezone.utc)


def test_a_writer_that_died_half_way_has_moved_the_mark(spark, folder, monkeypatch):
    path = f"{folder}/mark.json"
    marks.write_mark(spark, path, "2024-01-10T00:00:00Z")
    read, real = marks.read_document(spark, path), storage.replace_text
    monkeypatch.setattr(storage, "replace_text", lambda *_: (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError):
        marks.write_mark(spark, path, "2024-01-15T00:00:00Z", read)
    monkeypatch.setattr(storage, "replace_text", real)
    assert marks.read_mark(spark, path) == MARK
    with pytest.raises(marks.MarkMoved):
        marks.write_mark(spark, path, "2024-01-11T00:00:00Z", read)
    # A slow writer that replaces the document late does not take the mark back either.
    marks.write_mark(spark, path, "2024-01-20T00:00:00Z")
    storage.replace_text(spark, path, '{"last_processed_event_ts": "2024-01-15T00:00:00Z", "generation": 2}')
    assert marks.read_mark(spark, path) == datetime(2024, 1, 20, tzinfo=timezone.utc)


def test_of_two_runs_over_one_mark_the_second_is_refused(spark, folder, monkeypatch):
    places = (f"{folder}/raw", f"{folder}/mark.json", f"{folder}/silver")
    raw.write_raw(raw_df(spark, [("a", "2024-01-14", "b")]), places[0])
    run_silver(spark, *places)
    raw.write_raw(raw_df(spark, [("b", "2024-01-15", "b")]), places[0])
    real = silver_plan.merge_increment

    def overtaken(*args, **options):
        real(*args, **options)
        monkeypatch.setattr(silver_plan, "merge_increment", real)
        run_silver(spark, *places)  # another run, from start to end, in the meantime

    monkeypatch.setattr(silver_plan, "merge_increment", overtaken)
    with pytest.raises(marks.MarkMoved):
        run_silver(spark, *places)
    assert marks.read_document(spark, places[1]).generation == 2
    assert {r.event_id for r in spark.read.parquet(places[2]).collect()} == {"a", "b"}


def test_a_file_is_created_once(spark, folder):
    assert storage.create_text(spark, f"{folder}/x", "one") and not storage.create_text(spark, f"{folder}/x", "two")
    assert spark.read.text(f"{folder}/x").first()[0] == "one"


# ---- key filters ----


def rows_read(df) -> int:
    """Rows that the scans of ``df`` took out of Parquet, after row groups were skipped."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    plan = execution.executedPlan()
    plan = plan.executedPlan() if hasattr(plan, "executedPlan") and "Adaptive" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    total = 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return total


@pytest.fixture
def small_row_groups(spark):
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    settings.setInt("parquet.block.size", 64 << 10)
    yield
    settings.unset("parquet.block.size")


def test_random_keys_read_few_row_groups(spark, folder, small_row_groups):
    rows = spark.range(200_000).select(
        F.md5(F.col("id").cast("string")).alias("event_id"), F.lit(date(2024, 1, 5)).alias("event_date"), F.col("id").alias("n")
    )
    upserts.upsert_parquet(spark, folder, rows, check_unique=False)
    table = spark.read.parquet(folder)
    assert rows_read(table.select("event_id").where("event_id > '0'")) == 200_000
    # A thousand random keys, ten of them known to the table.
    keys = spark.range(1000).select(
        F.md5(F.when(F.col("id") < 10, F.col("id") * 19_997).otherwise(F.col("id") + 1_000_000).cast("string")).alias("event_id")
    )
    found = upserts.matching_rows(table.select("event_id", "n"), keys, "event_id")
    assert 0 < rows_read(found) < 0.15 * 200_000
    assert sorted(r.n for r in found.collect()) == [k * 19_997 for k in range(10)]
    source = keys.withColumns({"event_date": F.lit(date(2024, 1, 6)), "n": F.lit(-1).cast("long")})
    want = upserts.upsert(rows, source)
    upserts.upsert_parquet(spark, folder, source)
    assert sorted(map(str, spark.read.parquet(folder).select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_many_keys_take_the_join_and_agree(spark, folder, monkeypatch):
    rows = [(f"k{i}", date(2024, 1, 1 + i % 5), i) for i in range(300)]
    target = spark.createDataFrame(rows, "event_id string, event_date date, n int")
    source = spark.createDataFrame([(f"k{i}", date(2024, 1, 7), -i) for i in range(250, 350)] + [(None, date(2024, 1, 7), 0)], target.schema)
    answers = []
    for most in (1000, 5):
        monkeypatch.setattr(upserts, "KEYS_AT_ONCE", most)
        path = f"{folder}/{most}"
        upserts.upsert_parquet(spark, path, target)
        upserts.upsert_parquet(spark, path, source)
        answers.append(sorted(map(str, spark.read.parquet(path).collect())))
    assert answers[0] == answers[1] and len(answers[0]) == 351
    none = spark.createDataFrame([(None, date(2024, 1, 7), 0)], target.schema)
    assert upserts.matching_rows(target, none, "event_id").count() == 0
