import random
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tarnflow.functions import parsing
from tarnflow.functions.buckets import bucket_by_regex, bucket_by_values


def parse_all(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", F.unix_micros(parsing.iso_timestamp(F.col("t"))).alias("us")).collect()
    return [row.us for row in sorted(rows)]


def micros(text):
    value = datetime.fromisoformat(text.replace("Z", "+00:00"))
    value = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    delta = value - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (delta.days * 86400 + delta.seconds) * 1_000_000 + delta.microseconds


def test_iso_timestamp_accepts(spark):
    texts = [
        "2025-01-01T10:15:30Z",
        "2025-01-01T10:15:30+00:00",
        "2025-01-01T10:15:30",
        "2025-01-01 10:15:30",
        "2025-01-01T10:15:30+02:00",
        "2025-01-01T10:15:30.1Z",
        "2025-01-01T10:15:30,123Z",
        "2025-01-01T10:15:30.123456789-05:30",
        "2025-01-01T10:15+02:00",
        "2025-01-01T10+02:00",
        "2025-01-01T10:15",
        "2025-01-01",
        "2024-02-29T23:59:59.999999Z",
    ]
    assert parse_all(spark, texts) == [micros(t) for t in texts]


@pytest.mark.parametrize(
    "text",
    ["2025", "10:15", "2025011", "2025-W54", "2025W538", "20250101T1", "", "not-a-ts", "2025-02-30", "2025-01-01T25:00:00Z",
     " 2025-01-01T10:15:30Z", "2025-01-01T10:15:30Z\n", "2025-1-1", "0000-01-01", "now", None],
)
def test_iso_timestamp_refuses(spark, text):
    assert parse_all(spark, [text]) == [None]


def test_iso_timestamp_like_python(spark):
    """Random texts of the accepted grammar mean the same instant as in Python."""
    rng = random.Random(7)
    texts = []
    for _ in range(400):
        text = f"{rng.randint(1900, 2100)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
        if rng.random() < 0.9:
            text += rng.choice("T ") + f"{rng.randint(0, 23):02}"
            if rng.random() < 0.9:
                text += f":{rng.randint(0, 59):02}"
                if rng.random() < 0.9:
                    text += f":{rng.randint(0, 59):02}"
                    if rng.random() < 0.6:
                        text += rng.choice(".,") + "".join(rng.choices("0123456789", k=rng.randint(1, 8)))
            offset = f"{rng.choice('+-')}{rng.randint(0, 14):02}"
            text += rng.choice(["", "Z", offset, f"{offset}:30", f"{offset}45"])
        texts.append(text)
    assert parse_all(spark, texts) == [micros(t) for t in texts]


def test_iso_date(spark):
    df = spark.createDataFrame(
        [("2025-01-31",), ("2025-02-30",), ("bad-date",), ("202501",), ("2025-01-31T00:00:00",), ("",), (None,)],
        "t string",
    )
    got = [str(r[0]) for r in df.select(parsing.iso_date(F.col("t"))).collect()]
    assert got == ["2025-01-31"] + ["None"] * 6


BASIC = [
    "20240119", "20240229", "20230229", "20241301", "2024-W03", "2024-W03-5", "2024W03", "2024W035", "2020-W53-7",
    "2021-W53-1", "2024-W00-1", "2024-W03-8", "2024-W03-0", "2024W03-5", "2024-W035", "2026-W01-1", "2024-0119", "202401-19",
]
TIMES = ["T10", "T1000", "T100000", "T100000.5", "T100000,123456", "T10:00:00", "T100000Z", "T1000+0530", "T10-03", " 100000", "x10:00"]


def python_value(kind, text):
    try:
        return kind.fromisoformat(text)
    except ValueError:
        return None


def test_basic_and_week_dates_like_python(spark):
    df = spark.createDataFrame([(t,) for t in BASIC], "t string")
    got = {r.t: r.d for r in df.select("t", parsing.iso_date(F.col("t")).alias("d")).collect()}
    assert got == {t: python_value(date, t) for t in BASIC}


def test_basic_timestamps_like_python(spark):
    texts = [d + t for d in [*BASIC, "2024-01-19"] for t in ["", *TIMES]]
    want = []
    for text in texts:
        value = python_value(datetime, text)
        want.append(None if value is None else micros(value.isoformat()))
    got = parse_all(spark, texts)
    assert [(t, g) for t, g in zip(texts, got)] == list(zip(texts, want))


def test_iso_utc_text_drops_zero_fraction(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, timestamp'2025-01-01 10:15:30'), (2, timestamp'2025-01-01 10:15:30.123'),"
        " (3, CAST(NULL AS timestamp)) AS v(i, t)"
    ).orderBy("i")
    rows = df.select(parsing.iso_utc_text(F.col("t")), parsing.plain_text(F.col("t"))).collect()
    assert [r[0] for r in rows] == ["2025-01-01T10:15:30Z", "2025-01-01T10:15:30.123000Z", None]
    assert [r[1] for r in rows] == ["2025-01-01 10:15:30", "2025-01-01 10:15:30.123000", None]


def test_to_millis_truncates(spark):
    row = spark.sql("SELECT timestamp'2025-01-01 00:00:00.123987' AS t").select(
        F.unix_micros(parsing.to_millis(F.col("t"))) % 1_000_000
    )
    assert row.first()[0] == 123_000


def test_bucket_order_and_default(spark):
    df = spark.createDataFrame([("ab",), ("b",), ("x",), (None,)], "c string")
    by_regex = bucket_by_regex(F.col("c"), [("a", "first"), ("b", "second")], "none")
    by_value = bucket_by_values(F.col("c"), [(("b", "ab"), "first"), (("b",), "second")], "none")
    rows = df.select(by_regex, by_value).collect()
    assert [r[0] for r in rows] == ["first", "second", "none", "none"]
    assert [r[1] for r in rows] == ["first", "first", "none", "none"]
