"""The raw (bronze) table and its quarantine: one-pass ingest sink, single sinks, pruned scan."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnflow import schemas
from tarnflow.functions import fixed_values as fixed
from tarnflow.functions import parsing
from tarnflow.sources import storage

PARTITIONS = ("event_date",)
DEFAULT_FEED = "session_events"


def raw_path(root: str, feed: str = DEFAULT_FEED) -> str:
    return f"{root.rstrip('/')}/feed={feed}"


def quarantine_path(root: str, feed: str = DEFAULT_FEED) -> str:
    return f"{root.rstrip('/')}/feed={feed}_bad"


def write_ingest(
    classified: DataFrame,
    root: str,
    run_id: str | Column,
    feed: str = DEFAULT_FEED,
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Good rows, rejected rows and markers of empty batches in ONE pass over the envelopes.

    The verdict becomes the first folder level, so one job feeds both tables and both become
    visible with the same commit. Below it lie the envelope's date and the run. Rows are brought
    together by table and date, in files of the advisory size (a big date is split), and batch ids
    are clustered within a file, so its statistics skip batches. Columns that only one side uses
    are all NULL on the other and cost nothing.

    A run that is repeated under the same id replaces what it wrote before; ``run_id`` as a column takes
    the rows of several runs at once. ``watch`` may observe the rows on the stage that writes them.
    """
    rejected = F.col("dq_reason").isNotNull()
    is_event = F.col("pos").isNotNull()
    zone = (
        F.when(rejected, f"{feed}_bad").when(is_event, feed).otherwise(f"{feed}_empty")
    )
    out = classified.withColumns(
        {
            "feed": zone,
            "event_date": F.col("envelope_date"),
            "event_ts": parsing.to_millis(F.col("event_ts")),
            "ingested_at": parsing.to_millis(F.col("ingested_at")),
            "raw": F.when(rejected, F.col("raw")),
            "run_id": F.lit(run_id),
        }
    )
    _write(out, root, ("feed", *PARTITIONS, "run_id"), "overwrite", watch)


def filed(rows: DataFrame) -> DataFrame:
    """Rows as the raw table holds them: under the envelope's date, times in milliseconds.

    The event's own date only takes part in the checks. A new event with an old date of its own
    must lie where the next incremental read looks.
    """
    if "envelope_date" in rows.columns:
        rows = rows.withColumn("event_date", F.col("envelope_date"))
    return rows.select(
        *[
            parsing.to_millis(F.col(f.name)).alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in schemas.RAW.fields
        ]
    )


def write_raw(good: DataFrame, path: str) -> None:
    """Append good rows to a raw table; nothing is written when there are none."""
    _write(filed(good), path, PARTITIONS, "append")


def write_quarantine(bad: DataFrame, path: str) -> None:
    """Append rejected rows with payload and reason, filed under the envelope's date."""
    _write(bad.withColumn("event_date", F.col("envelope_date")), path, PARTITIONS, "append")


def _write(
    df: DataFrame, path: str, partitions: tuple[str, ...], mode: str, watch=lambda rows: rows
) -> None:
    (
        watch(df.hint("rebalance", *partitions))
        .sortWithinPartitions(*partitions, "batch_id")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .option("compression", "snappy")
        .parquet(path)
    )


def scan_start(mark: datetime, back: timedelta = timedelta(days=fixed.LOOKBACK_DAYS)):
    """First event_date worth reading for a mark."""
    return (mark - back).date()


def within_scan(mark: datetime, lookback_days: int = fixed.LOOKBACK_DAYS) -> Column:
    """Partition predicate: on the bare partition column, so that it prunes folders."""
    return F.col("event_date") >= F.lit(scan_start(mark, timedelta(days=lookback_days)))


def read_raw_events(
    spark: SparkSession,
    path: str,
    mark: datetime,
    lookback_days: int = fixed.LOOKBACK_DAYS,
    late_tolerance: timedelta = timedelta(0),
) -> DataFrame:
    """Raw rows from ``mark - lookback_days`` on, or from further back if late rows are tolerated.

    Only the date level is listed; folders before the start are neither opened nor listed. The
    schema is given and not inferred: no footer is read for planning.
    """
    start = scan_start(mark, max(timedelta(days=lookback_days), late_tolerance))
    folders = [
        folder
        for folder in storage.child_folders(spark, path)
        if (value := folder.rsplit("event_date=", 1)[-1]) >= start.isoformat() and value[:1].isdigit()
    ]
    if not folders:
        return spark.createDataFrame([], schemas.RAW)
    rows = spark.read.schema(schemas.RAW).option("basePath", path).parquet(*folders)
    return rows.select(*schemas.RAW.names).where(F.col("event_date") >= F.lit(start))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.QUARANTINE).parquet(path).select(*schemas.QUARANTINE.names)
