"""Session events derived from the ``events`` table, with faults set by arithmetic on the id."""

from __future__ import annotations

import atexit
import uuid
from contextlib import suppress
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnflow import schemas
from tarnflow.operators.quality import good_rows
from tarnflow.plans.ingest import classify
from tarnflow.session import configure
from tarnflow.sources.storage import delete_path, scratch_root

AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
MARK = datetime(2024, 1, 15, tzinfo=timezone.utc)
LOOKBACK_DAYS = 3

DEVICES = "'iPhone 15', 'Pixel 8', ' Samsung S23 ', 'iPad', 'MacBook Pro', 'Windows Laptop', 'old mac mini', NULL"
SYSTEMS = "'iOS', 'Android', 'macOS', 'Windows', 'Linux'"
PLACES = (
    "'Alberta', 'British Columbia', 'Manitoba', 'New Brunswick', 'Newfoundland and Labrador', "
    "'Nova Scotia', 'Ontario', 'Prince Edward Island', 'Quebec', 'Saskatchewan', "
    "' Ontario ', 'quebec', NULL"
)
COLUMNS = {
    "seq": "i",
    "id": "CASE WHEN i % 101 <> 0 THEN 'e' || IF(i % 14 = 0, i DIV 2, IF(i % 3 = 1, i - 1, i)) END",
    "session_id": "IF(i % 103 = 0, '', 's' || user_id)",
    "username": "'u' || user_id",
    "device": f"get(array({DEVICES}), CAST(i % 8 AS INT))",
    "os": f"get(array({SYSTEMS}), CAST(i % 5 AS INT))",
    "geo": f"get(array({PLACES}), CAST(i % 13 AS INT))",
    "event_type": """CASE WHEN i % 107 = 0 THEN NULL WHEN i % 17 = 0 THEN 'other_thing' ELSE
        CASE event_type WHEN 'click' THEN ' Clicks ' WHEN 'view' THEN 'PageView' WHEN 'signup' THEN 'signups'
             WHEN 'purchase' THEN 'delete_account' WHEN 'error' THEN 'log_in' ELSE event_type END END""",
    "platform": """CASE WHEN i % 127 = 0 THEN NULL WHEN i % 113 = 0 THEN 'WEB' WHEN i % 109 = 0 THEN 'tv'
        ELSE IF(i % 2 = 0, 'web', 'mobile') END""",
    "event_timestamp": """CASE WHEN i % 131 = 0 THEN 'not-a-ts' WHEN i % 137 = 0 THEN '2024-03-01T00:00:00.000Z'
        WHEN i % 179 = 0 THEN date_format(ts, "yyyyMMdd'T'HHmmss.SSS'Z'")
        ELSE date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'") END""",
    "dt": """CASE WHEN i % 139 = 0 THEN 'bad-date' WHEN i % 149 = 0 THEN NULL
        WHEN i % 151 = 0 THEN date_format(ts - INTERVAL 10 DAYS, 'yyyy-MM-dd')
        WHEN i % 181 = 0 THEN extract(YEAROFWEEK FROM ts) || '-W' || lpad(weekofyear(ts), 2, '0') || '-' || (weekday(ts) + 1)
        WHEN i % 197 = 0 THEN date_format(ts, 'yyyyMMdd')
        ELSE date_format(ts, 'yyyy-MM-dd') END""",
    "url": "IF(i % 2 = 0, 'https://example.com/' || (i % 8), NULL)",
    "browser_version": "IF(i % 2 = 0, 'Chrome/' || (90 + i % 40) || '.0', NULL)",
    "screen": "IF(i % 2 = 1, 'Home', NULL)",
    "screen_size": "IF(i % 2 = 1, '1080x2400', NULL)",
    "app_version": "IF(i % 2 = 1, (1 + i % 5) || '.' || (i % 21) || '.0', NULL)",
    "batch_id": "IF(i % 157 = 0, NULL, 'b' || (i % 5))",
    "envelope_dt": "IF(i % 163 = 0, NULL, date_format(ts, 'yyyy-MM-dd'))",
}


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived table, one row per event of the driver's table.

    That table is one file of one row group, which Spark reads in one task: dealt out, so that what
    follows runs on all cores, as it does for the many files that land in practice.
    """
    configure(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumnRenamed("event_id", "i")
    events = events.repartition(spark.sparkContext.defaultParallelism, "i")
    return events.selectExpr(*[f"{rule} AS {name}" for name, rule in COLUMNS.items()])


def event_struct():
    """One event as the producer nests it."""
    flat = ("id", "session_id", "event_type", "event_timestamp", "platform", "dt")
    extra = ("url", "browser_version", "screen", "screen_size", "app_version")
    return F.struct(
        *flat, F.struct("username", "device", "os", "geo").alias("attributes"), *extra
    )


def event_text():
    """The event as JSON; some are plain strings, some have attributes that are no object."""
    odd = F.to_json(event_struct().dropFields("attributes").withField("attributes", F.lit("text")))
    return (
        F.when(F.col("seq") % 167 == 0, '"just text"')
        .when(F.col("seq") % 173 == 0, odd)
        .otherwise(F.to_json(event_struct()))
    )


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the envelope scan gives for the derived table, without the files in between."""
    return feed(spark, sf_dir).select(
        "seq",
        "envelope_dt",
        "batch_id",
        F.lit(None).cast("string").alias("malformed"),
        (F.col("seq") % 2000).cast("int").alias("pos"),
        F.when(F.col("seq") % 167 == 0, "just text").otherwise(event_text()).alias("raw"),
    )


def odd_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no single envelope, by id: cut off, two documents, text behind; and envelopes
    without events."""
    broken = """CASE (seq DIV 191) % 3
        WHEN 0 THEN '{"dt": "2024-01-05", "events": [{"id": "x' || seq || '"'
        WHEN 1 THEN '{"dt": "2024-01-05", "batch_id": "two", "events": [{"id": "' || seq || '"}]}{"events": []}'
        ELSE '{"dt": "2024-01-05", "events": []} tail' || seq END"""
    empty = """'{"dt": "' || day || '", "batch_id": "empty' || (seq % 7) || '", "events": []}'"""
    rows = feed(spark, sf_dir).withColumn("day", F.substring("envelope_dt", 1, 10))
    return rows.where("seq % 191 = 0").selectExpr("seq", f"{broken} AS value").unionAll(
        rows.where("seq % 193 = 0 AND day IS NOT NULL").selectExpr("seq", f"{empty} AS value")
    )


def land_envelopes(spark: SparkSession, sf_dir: str, path: str, part: str = "true") -> None:
    """Write the derived table as envelope files, odd lines with it. An envelope never holds more
    than 400 events.

    The envelopes of a batch land together, at most 50 of them: a big batch is several files.
    ``part`` is a condition on ``seq``; what is there already stays.
    """
    envelopes = (
        feed(spark, sf_dir)
        .where(part)
        .withColumnsRenamed({"envelope_dt": "day"})
        .withColumns({"_chunk": F.expr("seq div 2000"), "_file": F.expr("seq div 100000")})
        .repartition("day", "batch_id", "_file")
        .groupBy("day", "batch_id", "_file", "_chunk")
        .agg(F.collect_list(event_text()).alias("events"))
        .select(
            F.concat(
                F.regexp_replace(
                    F.to_json(F.struct(F.col("day").alias("dt"), F.size("events").alias("count"), "batch_id")),
                    r"\}$", ',"events":[',
                ),
                F.array_join("events", ","),
                F.lit("]}"),
            ).alias("value")
        )
    )
    odd = odd_lines(spark, sf_dir).where(part).select("value")
    envelopes.unionAll(odd.coalesce(1)).write.mode("append").text(path)


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(landed_events(spark, sf_dir), AS_OF, AS_OF, keep=["seq"])


def raw_rows(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Good rows as the raw table holds them: under the envelope's date."""
    good = good_rows(classified(spark, sf_dir)).withColumn("event_date", F.col("envelope_date"))
    return good.select(*keep, *schemas.RAW.names)


def scratch(spark: SparkSession) -> str:
    """A new folder, on storage every executor reaches, for tables a query writes.

    The answer is read from it after the query returns, so it goes when the process ends.
    """
    folder = f"{scratch_root(spark)}_checks/{uuid.uuid4().hex}"
    atexit.register(_drop, spark, folder)
    return folder


def _drop(spark: SparkSession, folder: str) -> None:
    with suppress(Exception):  # the JVM may be gone already
        delete_path(spark, folder)
