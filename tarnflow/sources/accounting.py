"""Running accounting: the batch summaries of all runs of a feed, as a table keyed by run.

Summaries are sums, so runs may be merged in any order and grouping. A run that is repeated replaces its
part and never adds to it. The table is small: one row per run, batch and date, one file per run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnflow.operators.quality import merged_summaries
from tarnflow.sources import storage
from tarnflow.sources.raw import DEFAULT_FEED

SUMMARY = (
    "batch_id string, event_date date, received long, good long, bad_schema long, bad_dq long,"
    " bad_envelope long, dq_reasons map<string,bigint>"
)


def accounting_path(root: str, feed: str = DEFAULT_FEED) -> str:
    return f"{root.rstrip('/')}/feed={feed}_accounting"


def account(summary: DataFrame, root: str, run_id: str, feed: str = DEFAULT_FEED) -> None:
    """Store the summary of a run, in the place of what the run stored before."""
    path = f"{accounting_path(root, feed)}/run_id={run_id}"
    names = [c.split()[0] for c in SUMMARY.split(", ")]
    # A folder of its own, so that a run that now has no batches replaces the old rows too.
    summary.select(*names).coalesce(1).write.mode("overwrite").parquet(path)


def read_accounting(spark: SparkSession, root: str, feed: str = DEFAULT_FEED) -> DataFrame:
    path = accounting_path(root, feed)
    schema = f"{SUMMARY}, run_id string"
    if not storage.path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def running_totals(spark: SparkSession, root: str, feed: str = DEFAULT_FEED, by: tuple[str, ...] = ()) -> DataFrame:
    """Totals over all runs, by ``by`` (of ``batch_id``, ``event_date``, ``run_id``), and how many runs."""
    held = read_accounting(spark, root, feed)
    totals = merged_summaries(held, *by)
    if by:
        return totals
    return totals.crossJoin(held.agg(F.countDistinct("run_id").alias("runs")))  # one row and one row
