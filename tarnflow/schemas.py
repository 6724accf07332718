"""Schemas of the landed envelopes, the raw table, the quarantine and the silver table."""

from __future__ import annotations

from pyspark.sql import types as T

# One landed JSON document. Events stay raw text so that the quarantine can hold the payload and
# one odd event cannot spoil its batch.
ENVELOPE = T.StructType(
    [
        T.StructField("dt", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("events", T.ArrayType(T.StringType())),
        T.StructField("_malformed", T.StringType()),
    ]
)

# One event. Scalars of another type are taken as their text.
EVENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_timestamp", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("dt", T.StringType()),
        T.StructField(
            "attributes",
            T.StructType(
                [
                    T.StructField("username", T.StringType()),
                    T.StructField("device", T.StringType()),
                    T.StructField("os", T.StringType()),
                    T.StructField("geo", T.StringType()),
                ]
            ),
        ),
        T.StructField("url", T.StringType()),
        T.StructField("browser_version", T.StringType()),
        T.StructField("screen", T.StringType()),
        T.StructField("screen_size", T.StringType()),
        T.StructField("app_version", T.StringType()),
        T.StructField("_malformed", T.StringType()),
    ]
)

RAW = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("device", T.StringType()),
        T.StructField("os", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("browser_version", T.StringType()),
        T.StructField("screen", T.StringType()),
        T.StructField("screen_size", T.StringType()),
        T.StructField("app_version", T.StringType()),
    ]
)

# What classification adds to the raw columns.
VERDICT = T.StructType(
    [
        T.StructField("envelope_date", T.DateType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("raw", T.StringType()),
        T.StructField("dq_stage", T.StringType()),
        T.StructField("dq_reason", T.StringType()),
    ]
)

QUARANTINE = T.StructType(RAW.fields + VERDICT.fields)

# Everything the one-pass ingest writes: both tables, the run that wrote it, the feed partition.
WRITTEN = T.StructType(
    QUARANTINE.fields
    + [T.StructField("run_id", T.StringType()), T.StructField("feed", T.StringType())]
)

SILVER = T.StructType(
    RAW.fields
    + [
        T.StructField("event_hour", T.IntegerType()),
        T.StructField("device_family", T.StringType()),
        T.StructField("geo_region", T.StringType()),
        T.StructField("event_category", T.StringType()),
    ]
)

MARK_DDL = "last_processed_event_ts string"
#: The same document with what runs keep beside the mark.
MARK_DOCUMENT = f"{MARK_DDL}, last_ingested_at string, generation int"
