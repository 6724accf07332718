"""The silver job: incremental read, clean-up, features, upsert, next mark, statistics."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tarnflow.functions import fixed_values as fixed
from tarnflow.functions import parsing
from tarnflow.operators import incremental
from tarnflow.operators.features import add_features, sample_rows
from tarnflow.operators.standardize import (
    add_if_absent,
    ensure_date,
    ensure_timestamp,
    run_batch_id,
    standardize,
)
from tarnflow.operators.upsert import merge_into_table, upsert_parquet
from tarnflow.session import require_utc
from tarnflow.sources import mark as marks
from tarnflow.sources import storage
from tarnflow.sources.raw import read_raw_events


@dataclass(frozen=True)
class SilverRun:
    rows_raw_scanned: int
    rows_new: int
    max_event_ts_new: str | None
    mark: str | None
    """The mark this run stored, None when it left the mark alone."""
    sample: list[Row]
    rows_late: int = 0
    """Rows behind the mark that no run has seen; with new, seen and untimed ones: all rows scanned."""
    rows_seen: int = 0
    rows_untimed: int = 0


def silver_rows(increment: DataFrame) -> DataFrame:
    """Raw rows to silver rows: types, null filters, dedupe, features."""
    increment = add_if_absent(increment, "batch_id", run_batch_id())
    return increment.transform(standardize).transform(add_features)


def run_silver(
    spark: SparkSession,
    raw_path: str,
    mark_path: str,
    silver_path: str | None = None,
    table: str | None = None,
    lookback_days: int = fixed.LOOKBACK_DAYS,
    late_tolerance: timedelta = timedelta(0),
    cap_mark_at: datetime | None = None,
    newer_than: str | None = None,
    strict_mark: bool = False,
    buckets: int | None = None,
    late_path: str | None = None,
) -> SilverRun:
    """One increment into a Parquet table (``silver_path``) or a catalog table (``table``).

    The mark moves only after the merge is through, so a crash in between repeats the same rows,
    which the upsert makes harmless. ``buckets`` splits the days of a new Parquet table by key, so
    that increments with old keys look at and rewrite less (see ``upsert_parquet``).

    Two runs at a time are refused where it matters: the second one to store its mark gets ``MarkMoved``,
    and the mark stays what the first one made it.

    ``late_path`` keeps the rows that came after the mark had passed them, as a table of raw rows by date
    and by the mark they came behind. A run that is repeated replaces what it kept.
    """
    if (silver_path is None) == (table is None):
        raise ValueError("give either silver_path or table")
    require_utc(spark)
    read = marks.read_document(spark, mark_path, strict_mark)
    mark = read.event_ts

    # One DataFrame, one file listing: statistics, mark and merge all see the same files.
    scanned = read_raw_events(spark, raw_path, mark, lookback_days, late_tolerance)
    scanned = ensure_date(ensure_timestamp(scanned, "event_ts"), "event_date")
    stats = _measure(scanned, read, late_tolerance, cap_mark_at)
    sample: list[Row] = []
    if stats["rows_new"]:
        rows = silver_rows(incremental.newer_than_mark(scanned, mark, late_tolerance))
        if silver_path and storage.read_parquet_if_exists(spark, silver_path) is None:
            # First load: straight into the table, the backfill is not written twice.
            upsert_parquet(spark, silver_path, rows, check_unique=False, buckets=buckets)
            loaded = storage.read_parquet_if_exists(spark, silver_path)
            sample = sample_rows(loaded).collect() if loaded else []
        else:
            with storage.staged(spark, rows) as increment:
                merge_increment(spark, increment, silver_path, table, newer_than)
                sample = sample_rows(increment).collect()
    if late_path and stats["rows_late"]:
        late = incremental.late_rows(scanned, mark, read.ingested_at, late_tolerance)
        write_late(late, late_path, mark)
    if stats["rows_new"] and stats["mark"]:
        marks.write_mark(spark, mark_path, stats["mark"], read, stats["seen_until"])
    return SilverRun(
        rows_raw_scanned=stats["rows_raw_scanned"],
        rows_new=stats["rows_new"],
        max_event_ts_new=stats["max_event_ts_new"],
        mark=stats["mark"],
        sample=sample,
        rows_late=stats["rows_late"],
        rows_seen=stats["rows_seen"],
        rows_untimed=stats["rows_untimed"],
    )


def write_late(late: DataFrame, path: str, mark: datetime) -> None:
    """Keep late raw rows by date and by the mark they came behind (``behind``, its microseconds)."""
    (
        late.withColumn("behind", F.lit(marks.to_micros(mark)))
        .hint("rebalance", "event_date")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "behind").parquet(path)
    )


def merge_increment(
    spark: SparkSession,
    increment: DataFrame,
    silver_path: str | None,
    table: str | None,
    newer_than: str | None,
) -> None:
    """Upsert silver rows that are staged and unique by key."""
    if table:
        merge_into_table(spark, increment, table, newer_than=newer_than)
    else:
        upsert_parquet(
            spark,
            silver_path,
            increment,
            newer_than=newer_than,
            source_is_staged=True,
            check_unique=False,
        )


def _measure(
    scanned: DataFrame,
    read: marks.Mark,
    late_tolerance: timedelta,
    cap_mark_at: datetime | None,
) -> Row:
    """Statistics, routes and next mark in one scan of three columns.

    The mark is the latest time among the rows that get into silver. Keeping the latest row per
    key keeps the maximum, so it need not wait for the dedupe: rows with a key are enough.
    """
    mark = read.event_ts
    new = incremental.is_new(mark, late_tolerance)
    latest = F.max(F.when(new & F.col("event_id").isNotNull(), F.col("event_ts")))
    if cap_mark_at is not None:
        latest = F.when(latest.isNotNull(), F.least(latest, marks.mark_literal(cap_mark_at)))
    latest = F.when(latest.isNotNull(), F.greatest(latest, marks.mark_literal(mark)))
    to = incremental.route(mark, read.ingested_at, late_tolerance)
    return scanned.agg(
        F.count("*").alias("rows_raw_scanned"),
        F.count_if(new).alias("rows_new"),
        *[F.count_if(to == kind).alias(f"rows_{kind}") for kind in ("late", "seen", "untimed")],
        parsing.plain_text(F.max(F.when(new, F.col("event_ts")))).alias("max_event_ts_new"),
        parsing.iso_utc_text(latest).alias("mark"),
        parsing.iso_utc_text(F.max("ingested_at")).alias("seen_until"),
    ).first()
