"""Compaction of the raw table: the many small folders of a day's runs become few files.

Every run writes a folder per table and date. ``compact`` lists the small ones with the sizes of their files,
fits them into bins of the wanted file size (first fit decreasing, per table and date), and rewrites each bin
as one folder with one file. The rows keep the run they came from in a column ``origin``.

A rewrite is carried out from a record, so that a crash in between loses nothing: the new folders are written
beside the tables, then recorded, then moved in, and then the old ones go. ``recover`` finishes what is
recorded; until it has run, readers may see rows of a bin twice, never less than once. One compaction at a
time, and no run may be repeated while its folder is being packed: runs younger than ``older_than`` are left
alone.

A run that is repeated under its id after it was packed still replaces its rows: ``release`` takes them out
of the folders they were packed into, which a small table of members names.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnflow import schemas
from tarnflow.sources import storage
from tarnflow.sources.mark import mark_literal
from tarnflow.sources.raw import DEFAULT_FEED

TARGET_BYTES = 128 << 20
#: Folders rewritten, or removed, by one record.
FOLDERS_AT_ONCE = 4096
#: Below the lake's root, under names that readers of the tables never open.
COMMITS, MEMBERS, RECORD = "_compactions", "_packed", "READY.json"
PACKED = "packed-"

PLACE = ["feed", "event_date", "run_id"]
STORED = T.StructType(
    [*schemas.QUARANTINE.fields, T.StructField("origin", T.StringType()),
     T.StructField("run_id", T.StringType()), T.StructField("feed", T.StringType())]
)
MEMBER = "origin string, feed string, event_date string, run_id string"


@dataclass(frozen=True)
class Compaction:
    """Folders and files that were packed, and how many folders (of one file each) took their place."""

    folders: int
    files: int
    packed: int


def tables_of(feed: str) -> list[str]:
    return [feed, f"{feed}_bad", f"{feed}_empty"]


def stored_rows(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    """Rows of some folders, with the run each came from as ``origin``."""
    rows = spark.read.schema(STORED).option("basePath", root).parquet(*folders)
    return rows.withColumn("origin", F.coalesce("origin", "run_id"))


def run_sizes(spark: SparkSession, root: str, feed: str = DEFAULT_FEED) -> DataFrame:
    """``(feed, event_date, run_id, bytes, files, changed)``: what the folder of each run holds.

    Spark's own file metadata over a scan without columns: footers are read, in tasks.
    """
    tables = [f"{root}/feed={t}" for t in tables_of(feed) if storage.path_exists(spark, f"{root}/feed={t}")]
    schema = f"{', '.join(f'{c} string' for c in PLACE)}, bytes long, files long, changed timestamp"
    if not tables:
        return spark.createDataFrame([], schema)
    files = spark.read.schema(STORED).option("basePath", root).parquet(*tables).select(
        "feed", F.col("event_date").cast("string").alias("event_date"), "run_id",
        "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time",
    ).distinct()
    return files.groupBy(*PLACE).agg(
        F.sum("file_size").alias("bytes"), F.count("*").alias("files"),
        F.max("file_modification_time").alias("changed"),
    )


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size: largest first, into the first bin with room; what is too big stands alone."""
    bins, room = [0] * len(sizes), []
    # The most room among the bins from one on, by halves: the first bin that fits is found in a few steps.
    width = 1 << max(1, len(sizes)).bit_length()
    most = [0] * (2 * width)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        need = max(1, sizes[i])
        if most[1] >= need:
            at = 1
            while at < width:
                at = 2 * at if most[2 * at] >= need else 2 * at + 1
            at -= width
        else:
            at = len(room)
            room.append(max(capacity, need))
        room[at] -= need
        bins[i] = at
        node = at + width
        most[node] = room[at]
        while node > 1:
            node //= 2
            most[node] = max(most[2 * node], most[2 * node + 1])
    return bins


def packing_plan(sizes: DataFrame, target_bytes: int = TARGET_BYTES) -> list[tuple]:
    """``(feed, event_date, run_id, files, bin)`` of the folders worth packing.

    These are small ones that share a bin, or that hold several files. One short row per small folder
    comes to the driver, as it names them one by one when they are replaced.
    """
    small = sizes.where(F.col("bytes") < target_bytes).select(*PLACE, "files", "bytes").collect()
    chosen = []
    by_day = sorted(map(tuple, small), key=lambda r: (r[0], r[1] or "", r[2]))
    for _, day in groupby(by_day, key=lambda r: r[:2]):
        day = list(day)
        bins = first_fit_decreasing([r[4] for r in day], target_bytes)
        files = Counter()
        for row, bin_ in zip(day, bins):
            files[bin_] += row[3]
        chosen += [(*row[:4], bin_) for row, bin_ in zip(day, bins) if files[bin_] > 1]
    return chosen


def compact(
    spark: SparkSession,
    root: str,
    feed: str = DEFAULT_FEED,
    target_bytes: int = TARGET_BYTES,
    older_than: timedelta = timedelta(hours=1),
) -> Compaction:
    """Pack the small folders of all finished runs of a feed.

    The driver sees one row per folder that is packed, and no data. Days are rewritten in groups of at
    most ``FOLDERS_AT_ONCE`` folders, each under a record of its own.
    """
    root = root.rstrip("/")
    recover(spark, root, clear=True)
    before = mark_literal(datetime.now(timezone.utc) - older_than)
    chosen = packing_plan(run_sizes(spark, root, feed).where(F.col("changed") <= before), target_bytes)
    made = 0
    for start in range(0, len(chosen), FOLDERS_AT_ONCE):
        made += _pack(spark, root, chosen[start : start + FOLDERS_AT_ONCE])
    return Compaction(len(chosen), sum(c[3] for c in chosen), made)


def _folder(feed: str, event_date: str | None, run_id: str) -> str:
    return f"feed={feed}/event_date={event_date or '__HIVE_DEFAULT_PARTITION__'}/run_id={run_id}"


def _pack(spark: SparkSession, root: str, chosen: list[tuple]) -> int:
    name = uuid.uuid4().hex
    folders = [_folder(*c[:3]) for c in chosen]
    bins = spark.createDataFrame(
        [(*c[:3], f"{PACKED}{name}-{c[4]}") for c in chosen], "of string, day string, run string, packed string"
    )
    rows = stored_rows(spark, root, [f"{root}/{f}" for f in folders])
    # At most FOLDERS_AT_ONCE short rows on the other side.
    rows = rows.join(
        F.broadcast(bins),
        (F.col("feed") == F.col("of")) & (F.col("run_id") == F.col("run"))
        & F.col("event_date").cast("string").eqNullSafe(F.col("day")),
    )
    rows = rows.withColumn("run_id", F.col("packed")).drop("of", "day", "run", "packed")
    return _replace(spark, root, name, rows, folders)


def _replace(spark: SparkSession, root: str, name: str, rows: DataFrame, folders: list[str]) -> int:
    """Put ``rows``, which name their new ``run_id``, in the place of ``folders``."""
    commit = f"{root}/{COMMITS}/{name}"
    (
        rows.repartition("feed", "event_date", "run_id")
        .sortWithinPartitions(*PLACE, "origin", "batch_id")
        .write.partitionBy(*PLACE).option("compression", "snappy").parquet(commit)
    )
    added = [
        f"{feed}/{day}/{run}"
        for feed, day, run in sorted({tuple(f.removeprefix(f"{commit}/").split("/")) for f in _leaves(spark, commit)})
    ]
    if added:
        members = stored_rows(spark, commit, [f"{commit}/{f}" for f in added])
        members.select("origin", "feed", F.col("event_date").cast("string").alias("event_date"), "run_id").distinct(
        ).coalesce(1).write.mode("append").parquet(f"{root}/{MEMBERS}")
    storage.replace_text(spark, f"{commit}/{RECORD}", json.dumps({"add": added, "remove": folders}))
    recover(spark, root)
    return len(added)


def _leaves(spark: SparkSession, path: str) -> list[str]:
    out = []
    for feed in storage.child_folders(spark, path):
        for day in storage.child_folders(spark, feed):
            out += storage.child_folders(spark, day)
    return out


def recover(spark: SparkSession, root: str, clear: bool = False) -> None:
    """Carry out the rewrites that are recorded and not finished; with ``clear`` drop those never recorded.

    An old folder only goes when every new one is in place.
    """
    root = root.rstrip("/")
    for commit in storage.child_folders(spark, f"{root}/{COMMITS}"):
        record = f"{commit}/{RECORD}"
        if storage.path_exists(spark, record):
            todo = json.loads(spark.read.text(record, wholetext=True).first()[0])
            for folder in todo["add"]:
                if storage.path_exists(spark, f"{commit}/{folder}"):
                    storage.rename_path(spark, f"{commit}/{folder}", f"{root}/{folder}")
                elif not storage.path_exists(spark, f"{root}/{folder}"):
                    raise OSError(f"{folder} is neither in {commit} nor in the table")
            for folder in todo["remove"]:
                storage.delete_path(spark, f"{root}/{folder}")
            storage.delete_path(spark, commit)
        elif clear:
            storage.delete_path(spark, commit)


def packed_folders(spark: SparkSession, root: str, feed: str, run_id: str) -> list[str]:
    """Folders that hold rows of a run that was packed."""
    root = root.rstrip("/")
    if not storage.path_exists(spark, f"{root}/{MEMBERS}"):
        return []
    members = spark.read.schema(MEMBER).parquet(f"{root}/{MEMBERS}")
    rows = members.where((F.col("origin") == run_id) & F.col("feed").isin(tables_of(feed))).select(*PLACE)
    named = {_folder(*row) for row in rows.distinct().collect()}  # some per table and date of one run
    return sorted(f for f in named if storage.path_exists(spark, f"{root}/{f}"))


def release(spark: SparkSession, root: str, feed: str, run_id: str) -> None:
    """Take the rows of a run out of the folders it was packed into."""
    root = root.rstrip("/")
    recover(spark, root)
    folders = packed_folders(spark, root, feed, run_id)
    if folders:
        name = uuid.uuid4().hex
        rest = stored_rows(spark, root, [f"{root}/{f}" for f in folders]).where(F.col("origin") != run_id)
        renamed = F.concat(F.lit(f"{PACKED}{name}-"), F.regexp_extract("run_id", "([0-9]+)$", 1))
        _replace(spark, root, name, rest.withColumn("run_id", renamed), folders)
