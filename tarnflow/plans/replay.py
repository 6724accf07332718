"""Replay of the quarantine: rejects are judged again under new rules, and what passes is moved.

Rejects keep their payload, so they can be parsed and judged as if they landed now: with a later clock,
more platforms, or corrected code. What passes is appended to the raw table; the quarantine itself is never
rewritten, a table of content keys says which of its rows have moved. The key is a digest of payload, batch,
date and place in the envelope, so equal rejects (a batch that landed twice) move once.

Safe to repeat, and after a crash: the keys of a move are written first, under the move's id, then its rows,
under the same id as their run, then a note that it is done. A move without that note is carried out again
when the next one starts, which replaces the rows it had written.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnflow import schemas
from tarnflow.functions import fixed_values as fixed
from tarnflow.operators.quality import good_rows
from tarnflow.plans.ingest import classify
from tarnflow.session import require_utc
from tarnflow.sources import raw, storage

#: Notes in the folder of a move: its keys are complete, its rows are in the raw table.
READY, DONE = "_READY", "_DONE"
MOVED = "content_key string, dq_stage string, dq_reason string, move_id string"


@dataclass(frozen=True)
class Replay:
    """What one call judged and moved."""

    judged: int
    moved: int


def moved_path(root: str, feed: str = raw.DEFAULT_FEED) -> str:
    return f"{root.rstrip('/')}/feed={feed}_moved"


def content_key() -> Column:
    """Digest of a reject: what it says and where it came from."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("raw", "batch_id", "event_date", "pos")]
    return F.sha2(F.concat_ws("\1", *parts), 256)


def read_moved(spark: SparkSession, root: str, feed: str = raw.DEFAULT_FEED) -> DataFrame:
    path = moved_path(root, feed)
    if not storage.path_exists(spark, path):
        return spark.createDataFrame([], MOVED)
    return spark.read.schema(MOVED).parquet(path)


def rejects(spark: SparkSession, root: str, feed: str = raw.DEFAULT_FEED) -> DataFrame:
    """Rejected events with their keys, each content once; lines that are no envelope hold no event."""
    bad = raw.read_quarantine(spark, raw.quarantine_path(root, feed)).where("pos IS NOT NULL")
    return bad.withColumn("content_key", content_key()).dropDuplicates(["content_key"])


def open_rejects(spark: SparkSession, root: str, feed: str = raw.DEFAULT_FEED) -> DataFrame:
    """Rejects that have not moved."""
    return rejects(spark, root, feed).join(read_moved(spark, root, feed), "content_key", "left_anti")


def judged_again(
    rejected: DataFrame,
    ingested_at: datetime | None = None,
    as_of: datetime | None = None,
    platforms: Sequence[str] = fixed.ALLOWED_PLATFORMS,
) -> DataFrame:
    """Rejects parsed and judged anew, with ``content_key`` and their old verdict."""
    events = rejected.select(
        "content_key",
        F.struct("dq_stage", "dq_reason").alias("old"),
        F.col("event_date").cast("string").alias("envelope_dt"),
        "batch_id", "pos", "raw",
        F.lit(None).cast("string").alias("malformed"),
    )
    return classify(events, ingested_at, as_of, keep=["content_key", "old"], platforms=platforms)


def replay_quarantine(
    spark: SparkSession,
    root: str,
    feed: str = raw.DEFAULT_FEED,
    ingested_at: datetime | None = None,
    as_of: datetime | None = None,
    platforms: Sequence[str] = fixed.ALLOWED_PLATFORMS,
) -> Replay:
    """Move the rejects that pass under the rules given into the raw table of the feed."""
    require_utc(spark)
    now = datetime.now(timezone.utc)
    ingested_at, as_of = ingested_at or now, as_of or now
    finish_moves(spark, root, feed, ingested_at)
    if not storage.path_exists(spark, raw.quarantine_path(root, feed)):
        return Replay(0, 0)
    with storage.staged(spark, open_rejects(spark, root, feed)) as waiting:
        passed = good_rows(judged_again(waiting, ingested_at, as_of, platforms))
        move = uuid.uuid4().hex
        keys = passed.select("content_key", "old.dq_stage", "old.dq_reason")
        folder = f"{moved_path(root, feed)}/move_id={move}"
        keys.write.parquet(folder)
        storage.replace_text(spark, f"{folder}/{READY}", move)
        moved = spark.read.schema(MOVED).parquet(folder).count()
        judged = waiting.count()
    finish_moves(spark, root, feed, ingested_at)
    return Replay(judged, moved)


def finish_moves(spark: SparkSession, root: str, feed: str, ingested_at: datetime) -> None:
    """Append the rows of every move that is not noted as done; a move that stopped half-way is replaced."""
    for folder in storage.child_folders(spark, moved_path(root, feed)):
        note = f"{folder}/{DONE}"
        if storage.path_exists(spark, note):
            continue
        if not storage.path_exists(spark, f"{folder}/{READY}"):
            storage.delete_path(spark, folder)  # the keys themselves were never complete
            continue
        keys = spark.read.schema("content_key string").parquet(folder)
        chosen = rejects(spark, root, feed).join(keys, "content_key", "left_semi")
        # The verdict was given when the keys were written: here the rows are only built again.
        rows = judged_again(chosen, ingested_at).withColumns(
            {"dq_reason": F.lit(None).cast("string"), "dq_stage": F.lit(None).cast("string")}
        )
        run = f"replay-{folder.rsplit('move_id=', 1)[-1]}"
        raw.write_ingest(rows.select(*schemas.RAW.names, *schemas.VERDICT.names), root, run, feed)
        storage.replace_text(spark, note, run)
