"""Compaction of the raw table, replay of the quarantine, and running accounting."""

import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tarnflow import schemas
from tarnflow.operators.quality import batch_summary, merged_summaries
from tarnflow.plans import replay
from tarnflow.plans.ingest import classify, read_run, run_ingest, run_ingest_stream
from tarnflow.sources import accounting, compaction, raw, storage
from tests.test_ingest_operators import AS_OF, GOOD, change, land

DAYS = ("2024-01-05", "2024-01-06")


def ingest(spark, folder, run, *ids, platform="web", days=DAYS):
    """One run with an event per id and day, one reject and one empty batch."""
    path = f"{folder}/landed/{run}-{len(os.listdir(folder + '/landed')) if os.path.exists(folder + '/landed') else 0}"
    land(
        path,
        *[
            {"dt": d, "batch_id": f"{run}-{d}", "events": [change(id=f"{i}-{d}", dt=d) for i in ids] + [change(id=f"bad {run}", platform="tv")]}
            for d in days
        ],
        {"dt": days[0], "batch_id": f"empty {run}", "events": []},
    )
    return run_ingest(spark, path, f"{folder}/lake", ingested_at=AS_OF, as_of=AS_OF, run_id=run)


def held(spark, folder):
    lake = f"{folder}/lake"
    good = spark.read.schema(schemas.RAW).parquet(raw.raw_path(lake)).collect()
    bad = raw.read_quarantine(spark, raw.quarantine_path(lake)).collect()
    return sorted((r.event_id, str(r.event_date), r.batch_id) for r in good), sorted(
        (r.event_id, str(r.event_date), r.raw) for r in bad
    )


def files(folder):
    return sum(f.endswith(".parquet") for d, _, names in os.walk(f"{folder}/lake") for f in names if "/feed=" in d)


def test_many_small_runs_become_few_files(spark, folder):
    for k in range(5):
        ingest(spark, folder, f"r{k}", f"e{k}", f"f{k}")
    before, count = held(spark, folder), files(folder)
    done = compaction.compact(spark, f"{folder}/lake", older_than=timedelta(0))
    assert held(spark, folder) == before
    assert (done.files, done.packed) == (count, 5) and files(folder) == 5  # two days, twice, and the empty ones
    again = compaction.compact(spark, f"{folder}/lake", older_than=timedelta(0))
    assert (again.folders, again.packed) == (0, 0)  # nothing left to do
    ingest(spark, folder, "r9", "late")
    both = compaction.compact(spark, f"{folder}/lake", older_than=timedelta(0))
    assert both.packed == 5 and files(folder) == 5  # packed folders take part
    run = read_run(spark, f"{folder}/lake", "r3", raw.DEFAULT_FEED, DAYS)
    summary = {r.batch_id: (r.received, r.good, r.bad_dq) for r in batch_summary(run).collect()}
    assert summary == {"r3-2024-01-05": (3, 2, 1), "r3-2024-01-06": (3, 2, 1), "empty r3": (0, 0, 0)}


def test_young_runs_and_large_folders_stay(spark, folder):
    for k in range(3):
        ingest(spark, folder, f"r{k}", f"e{k}")
    assert compaction.compact(spark, f"{folder}/lake").folders == 0
    assert compaction.compact(spark, f"{folder}/lake", target_bytes=1, older_than=timedelta(0)).folders == 0


@pytest.mark.parametrize("pack_again", [False, True])
def test_a_packed_run_that_is_repeated_replaces_its_rows(spark, folder, pack_again):
    for k in range(4):
        ingest(spark, folder, f"r{k}", f"e{k}")
    compaction.compact(spark, f"{folder}/lake", older_than=timedelta(0))
    if pack_again:
        ingest(spark, folder, "r7", "more")
        compaction.compact(spark, f"{folder}/lake", older_than=timedelta(0))
    run = ingest(spark, folder, "r2", "corrected")
    ids = {i for i, _, _ in held(spark, folder)[0]}
    more = {"more"} if pack_again else set()
    assert ids == {f"{i}-{d}" for i in {"e0", "e1", "e3", "corrected"} | more for d in DAYS}
    assert len(held(spark, folder)[1]) == 2 * (5 if pack_again else 4)
    assert run.summary.agg(F.sum("good")).first()[0] == 2


def test_crashes_lose_nothing(spark, folder, monkeypatch):
    for k in range(4):
        ingest(spark, folder, f"r{k}", f"e{k}")
    before, lake = held(spark, folder), f"{folder}/lake"
    steps = {"rename_path": storage.rename_path, "delete_path": storage.delete_path, "replace_text": storage.replace_text}

    class Crash(Exception):
        pass

    for name, real in steps.items():
        for after in (0, 1, 3):
            calls = []

            def failing(*args, real=real, calls=calls, after=after):
                calls.append(args)
                if len(calls) > after:
                    raise Crash
                return real(*args)

            monkeypatch.setattr(storage, name, failing)
            try:
                compaction.compact(spark, lake, older_than=timedelta(0))
            except Crash:
                pass
            monkeypatch.setattr(storage, name, real)
            assert set(before[0]) <= set(held(spark, folder)[0]) and set(before[1]) <= set(held(spark, folder)[1])
            compaction.recover(spark, lake)
            assert held(spark, folder) == before
            ingest(spark, folder, f"{name}{after}", f"x{name}{after}")
            before = held(spark, folder)
    compaction.compact(spark, lake, older_than=timedelta(0))
    assert held(spark, folder) == before and not storage.child_folders(spark, f"{lake}/{compaction.COMMITS}")


def test_nothing_is_removed_before_all_is_in_place(spark, folder):
    lake = f"{folder}/lake"
    ingest(spark, folder, "r0", "e0")
    commit = f"{lake}/{compaction.COMMITS}/x"
    storage.replace_text(spark, f"{commit}/{compaction.RECORD}", '{"add": ["feed=a/event_date=b/run_id=c"], "remove": ["feed=session_events"]}')
    with pytest.raises(OSError):
        compaction.recover(spark, lake)
    assert held(spark, folder)[0]


def test_first_fit_decreasing():
    rng = random.Random(3)
    for _ in range(200):
        sizes = [rng.randint(1, 12) for _ in range(rng.randint(0, 40))]
        got, room = compaction.first_fit_decreasing(sizes, 10), []
        want = [0] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            at = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
            if at == len(room):
                room.append(max(10, sizes[i]))
            room[at] -= sizes[i]
            want[i] = at
        assert got == want


# ---- replay ----


def land_rejects(spark, folder):
    land(
        f"{folder}/in",
        {"dt": DAYS[0], "batch_id": "b1", "events": [GOOD, change(id="t1", platform="tv"), change(id="t2", platform="tv", dt=None)]},
        {"dt": DAYS[1], "batch_id": "b2", "events": [change(id="", platform="tv"), change(id="f", event_timestamp="2024-03-01T00:00:00Z"), 7]},
        {"dt": "not a date", "batch_id": "b3", "events": [change(id="d1")]},
        '{"dt": "2024-01-05", "events": [',
    )
    run_ingest(spark, f"{folder}/in", f"{folder}/lake", ingested_at=AS_OF, as_of=AS_OF, run_id="first")


def good_ids(spark, folder):
    rows = spark.read.schema(schemas.RAW).parquet(raw.raw_path(f"{folder}/lake")).collect()
    return sorted((r.event_id, r.batch_id, str(r.event_date)) for r in rows)


def test_replay_moves_what_passes_once(spark, folder):
    land_rejects(spark, folder)
    bad = raw.read_quarantine(spark, raw.quarantine_path(f"{folder}/lake")).count()
    options = dict(ingested_at=AS_OF, as_of=AS_OF)
    assert replay.replay_quarantine(spark, f"{folder}/lake", **options) == replay.Replay(6, 1)  # d1: filed by day now
    tv = replay.replay_quarantine(spark, f"{folder}/lake", platforms=("web", "mobile", "tv"), **options)
    assert tv == replay.Replay(5, 2)
    assert replay.replay_quarantine(spark, f"{folder}/lake", platforms=("web", "mobile", "tv"), **options) == replay.Replay(3, 0)
    assert good_ids(spark, folder) == [("d1", "b3", str(AS_OF.date())), ("e1", "b1", DAYS[0]), ("t1", "b1", DAYS[0]), ("t2", "b1", DAYS[0])]
    moved = {(r.dq_stage, r.dq_reason) for r in replay.read_moved(spark, f"{folder}/lake").collect()}
    assert moved == {("schema", "invalid_dt"), ("dq", "invalid_platform")}
    # The quarantine is never rewritten; a batch that lands twice is rejected twice and moves once.
    assert raw.read_quarantine(spark, raw.quarantine_path(f"{folder}/lake")).count() == bad
    run_ingest(spark, f"{folder}/in", f"{folder}/lake", ingested_at=AS_OF, as_of=AS_OF, run_id="second")
    assert replay.replay_quarantine(spark, f"{folder}/lake", platforms=("web", "mobile", "tv"), **options).moved == 0


@pytest.mark.parametrize("name, after", [("replace_text", 0), ("replace_text", 1)])
def test_a_move_that_stopped_is_carried_out_once(spark, folder, monkeypatch, name, after):
    land_rejects(spark, folder)
    real, calls = getattr(storage, name), []

    def failing(*args):
        calls.append(args)
        if len(calls) > after:
            raise RuntimeError("crash")
        return real(*args)

    monkeypatch.setattr(storage, name, failing)
    with pytest.raises(RuntimeError):
        replay.replay_quarantine(spark, f"{folder}/lake", ingested_at=AS_OF, as_of=AS_OF, platforms=("web", "mobile", "tv"))
    monkeypatch.setattr(storage, name, real)
    for _ in range(2):
        replay.replay_quarantine(spark, f"{folder}/lake", ingested_at=AS_OF, as_of=AS_OF, platforms=("web", "mobile", "tv"))
    assert [i for i, _, _ in good_ids(spark, folder)] == ["d1", "e1", "t1", "t2"]


def test_replay_without_a_quarantine(spark, folder):
    assert replay.replay_quarantine(spark, f"{folder}/lake") == replay.Replay(0, 0)


# ---- accounting ----


def test_a_repeated_run_replaces_its_part(spark, folder):
    lake = f"{folder}/lake"
    runs = {k: ingest(spark, folder, k, *ids) for k, ids in (("r1", "ab"), ("r2", "c"))}
    for k, run in runs.items():
        accounting.account(run.summary, lake, k)
    accounting.account(ingest(spark, folder, "r1", "a").summary, lake, "r1")
    total = accounting.running_totals(spark, lake).first()
    assert (total.received, total.good, total.bad_dq, total.runs) == (8, 4, 4, 2)
    assert total.dq_reasons == {"invalid_platform": 4}
    by_run = {r.run_id: (r.good, r.dq_reasons) for r in accounting.running_totals(spark, lake, by=("run_id",)).collect()}
    assert by_run == {"r1": (2, {"invalid_platform": 2}), "r2": (2, {"invalid_platform": 2})}
    empty = accounting.running_totals(spark, f"{folder}/none").first()
    assert (empty.received, empty.runs, empty.dq_reasons) == (0, 0, {})


def test_the_stream_keeps_its_accounting(spark, folder):
    places = (f"{folder}/in", f"{folder}/lake", f"{folder}/progress")
    land(places[0], {"dt": DAYS[0], "batch_id": "b1", "events": [GOOD, change(id="")]})
    run_ingest_stream(spark, *places, ingested_at=AS_OF, as_of=AS_OF)
    total = accounting.running_totals(spark, places[1]).first()
    assert (total.received, total.good, total.bad_schema, total.runs) == (2, 1, 1, 1)


def test_summaries_merge_in_any_grouping(spark, folder):
    land(f"{folder}/in", *[{"dt": d, "batch_id": b, "events": [GOOD, change(platform="tv"), change(event_timestamp="2024-03-01T00:00:00Z"), 7]} for d in DAYS for b in "xyz"])
    from tarnflow.sources.envelopes import read_envelopes

    rows = classify(read_envelopes(spark, f"{folder}/in"), AS_OF, AS_OF)
    whole = batch_summary(rows)
    parts = [batch_summary(rows.where(F.col("batch_id") == b)) for b in "xyz"]
    merged = merged_summaries(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(batch_summary(rows.where("false"))), "batch_id", "event_date")
    assert sorted(map(str, merged.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
    twice = merged_summaries(merged_summaries(whole, "batch_id")).first()
    once = merged_summaries(whole).first()
    assert twice == once and once.dq_reasons == {"event_ts_in_future": 6, "invalid_platform": 6}
