"""The silver job as a stream: whatever raw files are there and not yet processed, then stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarnflow import schemas
from tarnflow.plans.silver import merge_increment, silver_rows
from tarnflow.session import require_utc
from tarnflow.sources import storage


def run_silver_stream(
    spark: SparkSession,
    raw_path: str,
    checkpoint: str,
    silver_path: str | None = None,
    table: str | None = None,
    newer_than: str | None = "event_ts",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> None:
    """Process all available raw files once, with the progress kept in ``checkpoint``.

    Files are tracked and not times, so a late row is not lost. How files fall into micro-batches
    is not fixed; with ``newer_than`` (the default) the latest row per key wins whatever the
    order, with None the last processed one does. A micro-batch that is repeated after a failure
    merges the same rows again, which changes nothing.
    """
    if (silver_path is None) == (table is None):
        raise ValueError("give either silver_path or table")
    require_utc(spark)

    def merge_batch(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        with storage.staged(session, silver_rows(batch)) as increment:
            if not increment.isEmpty():
                merge_increment(session, increment, silver_path, table, newer_than)

    files = spark.readStream.schema(schemas.RAW)
    if max_files_per_trigger:
        files = files.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        files = files.option("maxBytesPerTrigger", max_bytes_per_trigger)
    query = (
        files.parquet(raw_path)
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
