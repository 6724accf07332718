"""Dedupe across micro-batches: each key once, with keyed state that an event-time bound keeps small."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnflow import schemas
from tarnflow.session import require_utc

WITHIN = timedelta(days=3)


def first_per_key(rows: DataFrame, within: timedelta = WITHIN, key: str = "event_id") -> DataFrame:
    """Of a stream of raw rows, the first one of each key.

    The state is a key and a time per key, held by Spark's state store in the executors (in RocksDB where the
    session says so) and dealt by key. A key is forgotten when the watermark, the latest event time less
    ``within``, has passed its time by ``within``: the state holds the keys of twice that span at most,
    however long the stream runs. A repeat that comes later than that comes through again, as
    do rows of a key that was never seen; rows behind the watermark are dropped. Rows without key or time
    are dropped, as in the silver job.
    """
    timed = rows.where(F.col(key).isNotNull() & F.col("event_ts").isNotNull())
    bound = f"{int(within.total_seconds())} seconds"
    return timed.withWatermark("event_ts", bound).dropDuplicatesWithinWatermark([key])


def run_dedupe_stream(
    spark: SparkSession,
    raw_path: str,
    checkpoint: str,
    out_path: str,
    within: timedelta = WITHIN,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> None:
    """Append the raw rows that have landed since the last call to ``out_path``, each key once, then stop.

    Append-only: no row is rewritten and the target is not looked at, unlike an upsert. Files of a
    micro-batch that failed are not part of the table, as Spark's file sink records what is.
    """
    require_utc(spark)
    files = spark.readStream.schema(schemas.RAW)
    if max_files_per_trigger:
        files = files.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        files = files.option("maxBytesPerTrigger", max_bytes_per_trigger)
    query = (
        first_per_key(files.parquet(raw_path), within)
        .writeStream.partitionBy("event_date")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .format("parquet")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
