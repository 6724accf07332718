import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tarnflow.operators import quality
from tarnflow.plans.ingest import classify
from tarnflow.sources.envelopes import read_envelopes

AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
GOOD = {
    "id": "e1",
    "session_id": "s1",
    "attributes": {"username": "u", "device": "iPad", "os": "iOS", "geo": "Quebec"},
    "event_type": "clicks",
    "event_timestamp": "2024-01-05T10:11:12.123456+00:00",
    "platform": "web",
    "dt": "2024-01-05",
    "url": "https://x/",
}


def land(folder, *envelopes):
    import os

    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/landed.json", "w") as out:
        for envelope in envelopes:
            out.write((envelope if isinstance(envelope, str) else json.dumps(envelope)) + "\n")
    return folder


def judge(spark, folder, events, **envelope):
    path = land(folder, {"dt": "2024-01-05", "batch_id": "b", "events": events, **envelope})
    rows = classify(read_envelopes(spark, path), AS_OF, AS_OF).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(len(events)))
    return rows


def change(**fields):
    event = {**GOOD, **fields}
    return {k: v for k, v in event.items() if v is not ...}


REASONS = [
    (change(), None),
    # one missing field each: absent, null, empty
    (change(id=...), "missing_id"),
    (change(id=None), "missing_id"),
    (change(id=""), "missing_id"),
    (change(session_id=""), "missing_session_id"),
    (change(event_type=None), "missing_event_type"),
    (change(platform=...), "missing_platform"),
    # falsy values of other types count as missing, truthy ones are taken as text
    (change(id=0), "missing_id"),
    (change(id=False), "missing_id"),
    (change(id=[]), "missing_id"),
    (change(id={}), "missing_id"),
    (change(session_id=0.0), "missing_session_id"),
    (change(id="0"), None),
    (change(id="false"), None),
    (change(id="[]"), None),
    (change(id=7), None),
    # times
    (change(event_timestamp="not-a-ts"), "invalid_event_timestamp"),
    (change(event_timestamp=...), "invalid_event_timestamp"),
    (change(event_timestamp=""), "invalid_event_timestamp"),
    (change(event_timestamp=0), "invalid_event_timestamp"),
    (change(event_timestamp=1704448272), "unexpected_normalize_error"),
    (change(event_timestamp=["2024-01-05"]), "unexpected_normalize_error"),
    # dates
    (change(dt="bad-date"), "invalid_dt"),
    (change(dt=5), "invalid_dt"),
    (change(dt=...), None),
    (change(dt=""), None),
    (change(dt=0), None),
    # first failure wins
    (change(id="", session_id="", platform=None), "missing_id"),
    (change(session_id=None, event_timestamp=5), "missing_session_id"),
    (change(event_timestamp="bad", dt="bad"), "invalid_event_timestamp"),
    (change(event_timestamp=5, dt="bad"), "unexpected_normalize_error"),
    # attributes
    (change(attributes=...), None),
    (change(attributes=None), None),
    (change(attributes={}), None),
    (change(attributes=[]), None),
    (change(attributes=""), None),
    (change(attributes=0), None),
    (change(attributes="text"), "unexpected_normalize_error"),
    (change(attributes=[1]), "unexpected_normalize_error"),
    (change(attributes="text", id=""), "missing_id"),
    (change(attributes="text", dt="bad"), "invalid_dt"),
    # no object at all
    (7, "unexpected_normalize_error"),
    ("text", "unexpected_normalize_error"),
    ("", "unexpected_normalize_error"),
    (None, "unexpected_normalize_error"),
    ([GOOD], "unexpected_normalize_error"),
    (True, "unexpected_normalize_error"),
    ({}, "missing_id"),
    # rules run on valid rows only, platform first
    (change(platform="tv"), "invalid_platform"),
    (change(platform="WEB"), "invalid_platform"),
    (change(platform=" web"), "invalid_platform"),
    (change(platform="tv", event_timestamp="2030-01-01"), "invalid_platform"),
    (change(platform="tv", id=None), "missing_id"),
    (change(event_timestamp="2030-01-01"), "event_ts_in_future"),
]


def test_reasons(spark, folder):
    rows = judge(spark, folder, [event for event, _ in REASONS])
    got = [(json.dumps(e), r.dq_reason) for (e, _), r in zip(REASONS, rows)]
    assert got == [(json.dumps(e), reason) for e, reason in REASONS]
    rules = ("invalid_platform", "event_ts_in_future")
    for (_, reason), row in zip(REASONS, rows):
        assert row.dq_stage == (None if reason is None else "dq" if reason in rules else "schema")


def test_future_rule_edges(spark, folder):
    limit = AS_OF + timedelta(minutes=5)
    times = [limit, limit + timedelta(microseconds=1), limit + timedelta(milliseconds=1)]
    rows = judge(spark, folder, [change(event_timestamp=t.isoformat()) for t in times])
    assert [r.dq_reason for r in rows] == [None, "event_ts_in_future", "event_ts_in_future"]


def test_flatten(spark, folder):
    row = judge(spark, folder, [GOOD])[0]
    assert (row.event_id, row.username, row.device, row.os, row.country) == ("e1", "u", "iPad", "iOS", "Quebec")
    assert (row.url, row.screen, row.batch_id, str(row.event_date)) == ("https://x/", None, "b", "2024-01-05")
    assert json.loads(row.raw) == GOOD


def test_repeated_json_key_keeps_the_last(spark, folder):
    event = json.dumps(GOOD)[:-1] + ', "id": "e2"}'
    path = land(folder, '{"dt":"2024-01-05","batch_id":"b","events":[' + event + "]}")
    assert classify(read_envelopes(spark, path), AS_OF, AS_OF).first().event_id == "e2"


def test_envelope_defaults_and_accounting(spark, folder):
    late_dt = change(dt="2024-01-04")
    path = land(
        folder,
        {"dt": "2024-01-05", "batch_id": "b1", "events": [GOOD, late_dt, change(id=""), change(platform="tv")]},
        {"events": [change(dt=None)]},
        {"dt": None, "batch_id": None, "events": [GOOD]},
        {"dt": "2024-01-06", "batch_id": "empty", "events": []},
        {"dt": "2024-01-06", "batch_id": "absent"},
        {"dt": "bad", "batch_id": "bad_dt", "events": [GOOD]},
        {"dt": "2024-01-07", "batch_id": "odd", "events": {"a": 1}},
        "this is no JSON",
    )
    done = classify(read_envelopes(spark, path), AS_OF, AS_OF)
    summary = {
        (r.batch_id, str(r.event_date)): (r.received, r.good, r.bad_schema, r.bad_dq, r.dq_reasons)
        for r in quality.batch_summary(done).collect()
    }
    # The summary goes by the envelope's date, not by the row's own.
    assert summary[("b1", "2024-01-05")] == (4, 2, 1, 1, {"invalid_platform": 1})
    assert summary[("empty", "2024-01-06")] == (0, 0, 0, 0, {})
    assert summary[("absent", "2024-01-06")] == (0, 0, 0, 0, {})
    assert summary[("bad_dt", "2024-01-31")] == (1, 0, 1, 0, {})
    assert all(n[0] == n[1] + n[2] + n[3] for n in summary.values())
    # Default batch id and date; the two unreadable documents carry no batch id that could be trusted.
    assert summary[("unknown", "2024-01-31")][:4] == (2, 2, 0, 0)
    by_reason = {(r.dq_stage, r.dq_reason): r.n for r in quality.reason_histogram(done).collect()}
    assert by_reason == {
        ("schema", "missing_id"): 1,
        ("schema", "invalid_dt"): 1,
        ("dq", "invalid_platform"): 1,
        ("envelope", "malformed_envelope"): 2,
    }
    totals = quality.ingest_totals(quality.batch_summary(done)).first()
    assert (totals.total_good, totals.total_bad) == (4, 3)
    good, bad = quality.split_good_bad(done)
    assert {str(r.event_date) for r in good.where("batch_id = 'b1'").collect()} == {"2024-01-04", "2024-01-05"}
    assert bad.count() == 5 and bad.where("raw is null").count() == 0


def test_totals_of_nothing(spark):
    empty = spark.createDataFrame([], "good bigint, bad_schema bigint, bad_dq bigint, bad_envelope bigint")
    assert tuple(quality.ingest_totals(empty).first()) == (0, 0, 0)


def test_concat_bad_keeps_duplicates_and_fills_columns(spark):
    left = spark.createDataFrame([(1, "x"), (1, "x")], "seq int, dq_reason string")
    right = spark.createDataFrame([("y", "{}")], "dq_reason string, raw string")
    rows = quality.concat_bad(left, right).collect()
    assert sorted(map(str, rows)) == sorted(
        ["Row(seq=1, dq_reason='x', raw=None)"] * 2 + ["Row(seq=None, dq_reason='y', raw='{}')"]
    )


def test_multi_line_and_spread(spark, folder):
    path = land(folder, json.dumps({"dt": "2024-01-05", "batch_id": "b", "events": [GOOD] * 50}, indent=1))
    events = read_envelopes(spark, path, multi_line=True, spread=6)
    assert events.rdd.getNumPartitions() == 6
    assert events.select(F.count("pos"), F.count_distinct("pos")).first() == (50, 50)


def test_parse_happens_once(spark, folder):
    """A filter on the verdict does not duplicate the JSON parse, and nothing shuffles."""
    from tests.conftest import plan_of

    path = land(folder, {"events": [GOOD]})
    plan = plan_of(quality.good_rows(classify(read_envelopes(spark, path), AS_OF, AS_OF)))
    # Line, list of documents, envelope, event: one parse each.
    assert plan.count("from_json") == 4 and "Exchange" not in plan
