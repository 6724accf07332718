"""Scan of landed event envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnflow import schemas

_END = "~end of document~"


def read_envelopes(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = False,
    spread: int | None = None,
) -> DataFrame:
    """One row per event of every envelope under ``path``.

    Columns: ``envelope_dt``, ``batch_id`` as landed, ``pos`` (place in the envelope), ``raw``
    (the event's JSON text) and ``malformed`` (the whole line, when it is not exactly one
    envelope, or one array of them). An envelope without events gives one row with a NULL ``pos``,
    so that it can still be counted. With ``multi_line`` a file takes the place of a line.

    An envelope is one JSON record and cannot be split, so the number of files sets the number of
    tasks. ``spread`` adds a hash shuffle into that many partitions right after the explode, for
    the case of a few huge envelopes; with many files it is not needed.
    """
    lines = spark.read.text(path, wholetext=multi_line)
    return envelope_events(lines, spread)


def envelope_events(lines: DataFrame, spread: int | None = None) -> DataFrame:
    """The same from lines of text (column ``value``), batch or stream."""
    # A JSON reader stops at the end of the first value. Here the line stands in an array before an
    # end mark: a second document, or text after the first, breaks the array or moves the mark.
    marked = F.concat(F.lit("["), F.col("value"), F.lit(f',"{_END}"]'))
    values = lines.where(F.trim(F.col("value"), F.lit(" \t\r\n\ufeff")) != "").select(
        "value", F.from_json(marked, "array<string>").alias("values")
    )
    single = (F.size("values") == 2) & (F.get("values", F.lit(1)) == _END)
    whole = values.select("value", F.when(single, F.get("values", F.lit(0))).alias("whole"))
    listed = F.when(
        F.col("whole").startswith("["), F.from_json("whole", "array<string>")
    ).when(F.col("whole").isNotNull(), F.array("whole"))
    documents = whole.select("value", F.explode_outer(listed).alias("document"))
    options = {"columnNameOfCorruptRecord": "_malformed"}
    parsed = documents.select(
        "value", "document", F.from_json("document", schemas.ENVELOPE, options).alias("e")
    )
    broken = F.col("document").isNull() | F.col("e").isNull() | F.col("e._malformed").isNotNull()
    events = parsed.select(
        F.col("e.dt").alias("envelope_dt"),
        F.col("e.batch_id").alias("batch_id"),
        F.when(broken, F.coalesce("document", "value")).alias("malformed"),
        F.posexplode_outer("e.events").alias("pos", "raw"),
    )
    if spread:
        # By content and not round robin: a recomputed task sends every row to the same place.
        events = events.repartition(spread, F.xxhash64("batch_id", "pos", "raw"))
    return events
