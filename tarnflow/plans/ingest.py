"""The ingest job: landed envelopes to raw table, quarantine and batch accounting."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarnflow import schemas
from tarnflow.functions import fixed_values as fixed
from tarnflow.operators import quality
from tarnflow.operators.normalize import ENVELOPE_STAGE, normalize_events
from tarnflow.session import require_utc
from tarnflow.sources import accounting, compaction, raw
from tarnflow.sources.envelopes import envelope_events, read_envelopes
from tarnflow.sources.storage import path_exists


@dataclass(frozen=True)
class IngestRun:
    run_id: str
    received: int
    total_good: int
    total_bad: int
    bad_envelopes: int
    """Lines that are no envelope; they are in quarantine, outside the counts of events."""
    summary: DataFrame
    """Per-batch accounting of this run; evaluated when it is used."""


def classify(
    events: DataFrame,
    ingested_at: datetime | None = None,
    as_of: datetime | None = None,
    keep: Sequence[str] = (),
    platforms: Sequence[str] = fixed.ALLOWED_PLATFORMS,
) -> DataFrame:
    """Events with both verdicts, narrow over the envelope scan."""
    return quality.apply_dq(normalize_events(events, ingested_at, keep), as_of, platforms)


def run_ingest(
    spark: SparkSession,
    envelopes: str | list[str],
    root: str,
    feed: str = raw.DEFAULT_FEED,
    ingested_at: datetime | None = None,
    as_of: datetime | None = None,
    multi_line: bool = False,
    spread: int | None = None,
    run_id: str | None = None,
) -> IngestRun:
    """Add every envelope under ``envelopes`` to the feed under ``root``.

    The envelopes are read and parsed once. The totals are observed on the stage that writes: each
    task counts once, also when it is retried. Given the ``run_id`` of an earlier run over the same
    envelopes, the run replaces that one's rows, also where they were packed since (``compaction``);
    ``run_ingest_stream`` keeps track of files itself.
    """
    lines = read_envelopes(spark, envelopes, multi_line, spread)
    run = _ingest(spark, lines, root, feed, ingested_at, as_of, run_id or uuid.uuid4().hex)
    if run_id:
        compaction.release(spark, root, feed, run_id)
    return run


def _ingest(
    spark: SparkSession,
    events: DataFrame,
    root: str,
    feed: str,
    ingested_at: datetime | None,
    as_of: datetime | None,
    run_id: str,
) -> IngestRun:
    require_utc(spark)
    started = datetime.now(timezone.utc)
    is_event = F.col("pos").isNotNull()
    totals = Observation()
    metrics = (
        F.count("pos").alias("received"),
        F.count_if(is_event & F.col("dq_reason").isNull()).alias("good"),
        F.count_if(is_event & F.col("dq_reason").isNotNull()).alias("bad"),
        F.count_if(F.col("dq_stage") == ENVELOPE_STAGE).alias("bad_envelopes"),
        F.collect_set("event_date").alias("dates"),
    )
    classified = classify(events, ingested_at or started, as_of or started)
    raw.write_ingest(classified, root, run_id, feed, lambda rows: rows.observe(totals, *metrics))
    counted = totals.get
    return IngestRun(
        run_id=run_id,
        received=counted["received"],
        total_good=counted["good"],
        total_bad=counted["bad"],
        bad_envelopes=counted["bad_envelopes"],
        summary=quality.batch_summary(read_run(spark, root, run_id, feed, counted["dates"])),
    )


def read_run(spark: SparkSession, root: str, run_id: str, feed: str, dates) -> DataFrame:
    """What one run wrote: good, rejected and empty-batch rows, from its own folders only.

    Of a run that was packed since, from the folders that hold its rows now.
    """
    folders = [
        folder
        for table in (feed, f"{feed}_bad", f"{feed}_empty")
        for day in dates
        if path_exists(spark, folder := f"{root.rstrip('/')}/feed={table}/event_date={day}/run_id={run_id}")
    ]
    if not folders:
        packed = compaction.packed_folders(spark, root, feed, run_id)
        if packed:
            rows = compaction.stored_rows(spark, root, [f"{root.rstrip('/')}/{f}" for f in packed])
            own = rows.where(F.col("origin") == run_id).withColumn("run_id", F.col("origin"))
            return own.select(*schemas.WRITTEN.names)
        return spark.createDataFrame([], schemas.WRITTEN)
    return spark.read.schema(schemas.WRITTEN).option("basePath", root).parquet(*folders)


def run_ingest_stream(
    spark: SparkSession,
    envelopes: str,
    root: str,
    checkpoint: str,
    feed: str = raw.DEFAULT_FEED,
    ingested_at: datetime | None = None,
    as_of: datetime | None = None,
    spread: int | None = None,
) -> None:
    """Ingest what has landed since the last call, each file once, then stop.

    ``checkpoint`` keeps the files that were taken. A micro-batch that is repeated after a failure
    has the same run id and replaces what it wrote, so nothing doubles. The summary of each micro-batch
    goes into the accounting table (``sources.accounting``), under its run.
    """
    require_utc(spark)
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def ingest(lines: DataFrame, batch: int) -> None:
        session, run_id = lines.sparkSession, f"{name}-{batch:08d}"
        run = _ingest(session, envelope_events(lines, spread), root, feed, ingested_at, as_of, run_id)
        compaction.release(session, root, feed, run_id)
        accounting.account(run.summary, root, run_id, feed)

    query = (
        spark.readStream.text(envelopes)
        .writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
