"""Incremental reads: what is newer than the mark, the next mark, the run statistics."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnflow.functions import parsing
from tarnflow.sources.mark import mark_literal


def is_new(mark: datetime, late_tolerance: timedelta = timedelta(0)) -> Column:
    """Strictly after the mark. A bare column against a literal, so it reaches the Parquet scan."""
    return F.col("event_ts") > mark_literal(mark - late_tolerance)


def newer_than_mark(
    df: DataFrame, mark: datetime, late_tolerance: timedelta = timedelta(0)
) -> DataFrame:
    """Rows after the mark; rows without a time drop out.

    A row at or before the mark is no part of any increment, unless ``late_tolerance`` reaches back to
    it; ``late_rows`` has those that came after the mark had passed them.
    """
    return df.where(is_new(mark, late_tolerance))


#: Where a scanned row goes.
INCREMENT, LATE, SEEN, UNTIMED = "increment", "late", "seen", "untimed"


def route(
    mark: datetime,
    seen_until: datetime | None = None,
    late_tolerance: timedelta = timedelta(0),
) -> Column:
    """Where a scanned row goes: one of four, so their counts add up to the rows scanned.

    ``increment`` is after the mark. Behind it, ``late`` rows were ingested after ``seen_until``, the latest
    ingest time the run that stored the mark has looked at, and ``seen`` ones before; without
    ``seen_until`` (no run yet) all are late. ``untimed`` rows have no event time.
    """
    unseen = F.lit(True) if seen_until is None else F.col("ingested_at") > mark_literal(seen_until)
    return (
        F.when(F.col("event_ts").isNull(), UNTIMED)
        .when(is_new(mark, late_tolerance), INCREMENT)
        .when(F.coalesce(unseen, F.lit(True)), LATE)
        .otherwise(SEEN)
    )


def late_rows(
    df: DataFrame,
    mark: datetime,
    seen_until: datetime | None = None,
    late_tolerance: timedelta = timedelta(0),
) -> DataFrame:
    """The late rows of a scan. Both bounds are bare columns against literals: files of earlier runs
    are skipped by their ingest times, and files of the increment by their event times."""
    behind = df.where(F.col("event_ts") <= mark_literal(mark - late_tolerance))
    if seen_until is None:
        return behind
    return behind.where((F.col("ingested_at") > mark_literal(seen_until)) | F.col("ingested_at").isNull())


def next_mark(df: DataFrame) -> DataFrame:
    """Latest event time as ISO text, NULL when there are no rows."""
    return df.agg(F.max("event_ts").alias("_max")).select(
        parsing.iso_utc_text(F.col("_max")).alias("last_processed_event_ts")
    )


def run_stats(
    scanned: DataFrame, mark: datetime, late_tolerance: timedelta = timedelta(0)
) -> DataFrame:
    """Rows scanned, rows new and the latest new event time, in one aggregate.

    Reads one narrow column. It is a query of its own and not a metric observed on the way to the
    dedupe shuffle: a map stage that is run again after a lost executor would be counted twice.
    """
    new = is_new(mark, late_tolerance)
    return scanned.agg(
        F.count("*").alias("rows_raw_scanned"),
        F.count_if(new).alias("rows_new"),
        parsing.plain_text(F.max(F.when(new, F.col("event_ts")))).alias("max_event_ts_new"),
    )
