"""Flatten events, fill defaults and give every invalid event its first failing reason."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnflow import schemas
from tarnflow.functions import fixed_values as fixed
from tarnflow.functions import parsing
from tarnflow.sources.mark import mark_literal

SCHEMA_STAGE = "schema"
ENVELOPE_STAGE = "envelope"

_TESTED = ("id", "session_id", "event_type", "platform", "dt")


def normalize_events(
    events: DataFrame,
    ingested_at: datetime | Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``read_envelopes`` to the raw columns plus the schema-stage verdict.

    ``keep`` names further input columns to carry along, such as a source file name.

    Narrow, and each event is parsed once by ``from_json``. ``event_ts`` keeps its
    microseconds here, because the future rule looks at them; the sinks cut to milliseconds.
    """
    if ingested_at is None:
        ingested_at = F.current_timestamp()
    elif isinstance(ingested_at, datetime):
        ingested_at = mark_literal(ingested_at)

    parsed = events.select(
        *keep,
        "pos",
        "raw",
        "malformed",
        F.nullif("envelope_dt", F.lit("")).alias("envelope_dt"),
        F.coalesce(F.nullif("batch_id", F.lit("")), F.lit(fixed.UNKNOWN_BATCH)).alias("batch_id"),
        ingested_at.alias("ingested_at"),
        F.from_json("raw", schemas.EVENT, {"columnNameOfCorruptRecord": "_malformed"}).alias("e"),
    )
    flat = (
        parsed.withColumn("odd", F.col("e").isNull() | F.col("e._malformed").isNotNull())
        .select("*", "e.*", "e.attributes.*")
        .withColumns(
            {
                "event_ts": parsing.iso_timestamp(F.col("event_timestamp")),
                "landed_date": parsing.iso_date(F.col("envelope_dt")),
            }
        )
    )
    # JSON types matter to a few odd events only: those are parsed once more, as a variant.
    suspect = F.col("odd") | F.col("event_ts").isNull()
    for name in _TESTED:
        suspect = suspect | F.coalesce(parsing.maybe_falsy(F.col(name)), F.lit(False))
    typed = flat.withColumn("doc", F.when(suspect, F.try_parse_json("raw")))
    tested = typed.withColumns({name: _present(name) for name in _TESTED}).withColumn(
        "own_date", parsing.iso_date(F.col("dt"))
    )
    # The verdict, key and time go through a one-element inline (no shuffle), as these get filtered
    # on: a filter stays above. Pushed below, it would repeat the whole parse, once to filter, once
    # to project. The other columns are projected above; those that nobody asks for are not built.
    kept_above = F.struct(
        _first_failure().alias("dq_reason"),
        F.col("id").alias("event_id"),
        F.col("event_ts").alias("_ts"),
        F.col("own_date").alias("_own"),
    )
    judged = tested.select("*", F.inline_outer(F.array(kept_above)))
    landed_date = F.coalesce("landed_date", F.col("ingested_at").cast("date"))
    settled = judged.select(
        *keep,
        "event_id",
        "session_id",
        "username",
        "event_type",
        "platform",
        F.col("_ts").alias("event_ts"),
        F.when(F.col("dt").isNull(), landed_date).otherwise(F.col("_own")).alias("event_date"),
        "batch_id",
        "ingested_at",
        "device",
        "os",
        F.col("geo").alias("country"),
        "url",
        "browser_version",
        "screen",
        "screen_size",
        "app_version",
        landed_date.alias("envelope_date"),
        "pos",
        F.coalesce("raw", "malformed").alias("raw"),
        "dq_reason",
    )
    stage = F.when(F.col("dq_reason") == fixed.MALFORMED_ENVELOPE, ENVELOPE_STAGE).when(
        F.col("dq_reason").isNotNull(), SCHEMA_STAGE
    )
    return settled.withColumn("dq_stage", stage)


def _present(name: str) -> Column:
    """Text of a field, NULL when its value is falsy."""
    empty = (F.col(name) == "") | (
        F.col("doc").isNotNull() & ~parsing.json_truthy("doc", f"$.{name}")
    )
    return F.when(~empty, F.col(name))


def _first_failure() -> Column:
    """The first reason that applies, NULL for a valid event (and for an empty batch)."""
    not_an_object = F.col("odd") & ~F.coalesce(
        parsing.json_at("doc", "$").startswith("{"), F.lit(False)
    )
    bad_time = F.when(
        parsing.json_truthy("doc", "$.event_timestamp")
        & ~parsing.json_at("doc", "$.event_timestamp").startswith('"'),
        fixed.UNEXPECTED,
    ).otherwise(fixed.INVALID_EVENT_TIMESTAMP)
    bad_own_date = F.col("dt").isNotNull() & F.col("own_date").isNull()
    bad_landed_date = F.col("envelope_dt").isNotNull() & F.col("landed_date").isNull()
    return (
        F.when(F.col("malformed").isNotNull(), fixed.MALFORMED_ENVELOPE)
        .when(F.col("pos").isNull(), F.lit(None).cast("string"))
        .when(not_an_object, fixed.UNEXPECTED)
        .when(F.col("id").isNull(), fixed.MISSING_ID)
        .when(F.col("session_id").isNull(), fixed.MISSING_SESSION_ID)
        .when(F.col("event_type").isNull(), fixed.MISSING_EVENT_TYPE)
        .when(F.col("platform").isNull(), fixed.MISSING_PLATFORM)
        .when(F.col("event_ts").isNull(), bad_time)
        .when(bad_own_date | bad_landed_date, fixed.INVALID_DT)
        # Attributes that are no object make the event odd without making it invalid so far.
        .when(F.col("odd") & parsing.json_truthy("doc", "$.attributes"), fixed.UNEXPECTED)
    )
