"""Keyed upsert: as a DataFrame, on a partitioned Parquet table, on a catalog table."""

from __future__ import annotations

import json
import uuid
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnflow.sources import names, storage
from tarnflow.sources.names import quote


#: Below the table: commits on their way, and the file that makes one final.
COMMITS, RECORD = "_commits", "READY.json"
#: The partition column of a bucketed table, and the file that holds the number of buckets.
BUCKET, BUCKETS = "key_bucket", "_layout/buckets.txt"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
#: Increments of so few keys are looked up by an IN predicate, which the Bloom filters of the key answer per
#: row group; larger ones by a semi join. One filter says yes to a strange key once in a million.
KEYS_AT_ONCE = 4096
KEYS_FPP = "0.000001"
#: Sizes the writer chooses from by the keys a row group turns out to hold: 8 MB, and halves of it down to 4 KB.
LARGEST_FILTER, FILTER_SIZES = 8 << 20, 12


def assert_unique(source: DataFrame, key: str) -> None:
    """A source that names a key twice has no defined result. NULL keys never match and may repeat."""
    repeated = (
        source.where(F.col(quote(key)).isNotNull())
        .groupBy(quote(key))
        .count()
        .where("count > 1")
        .limit(1)
        .count()
    )
    if repeated:
        raise ValueError(f"source has duplicate values in merge key {key!r}")


def _check_columns(target: T.StructType, source: T.StructType, key: str) -> None:
    if key not in source.names:
        raise ValueError(f"merge key {key!r} is not in the source columns {source.names}")
    if key not in target.names:
        raise ValueError(f"merge key {key!r} is not in the target columns {target.names}")
    unknown = [c for c in source.names if c not in target.names]
    if unknown:
        raise ValueError(f"source columns {unknown} are not in the target")


def _wins(source_ts: Column, target_ts: Column) -> Column:
    """Guard of an update: not older than what is there."""
    return F.coalesce(source_ts >= target_ts, target_ts.isNull())


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str = "event_id",
    newer_than: str | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """The target after the upsert, as a DataFrame.

    A matched row takes every source column, NULLs and older rows included; an unmatched source
    row is inserted; an unmatched target row stays. Columns the source lacks are kept on update
    and NULL on insert. NULL keys never match. With ``newer_than`` an update is only made when
    the source row is not older by that column.

    A left outer join plus an anti join, and not one full outer join: Spark can then broadcast a
    small source (by its size, at run time) or split a skewed target side, which a full outer
    join allows neither of.
    """
    _check_columns(target.schema, source.schema, key)
    if check_unique:
        assert_unique(source, key)
    incoming = source.select(
        F.lit(True).alias("_hit"), *[F.col(quote(c)).alias(f"_in_{c}") for c in source.columns]
    )
    joined = target.join(
        incoming, target[quote(key)] == incoming[quote(f"_in_{key}")], "left_outer"
    )
    apply = F.col("_hit").isNotNull()
    if newer_than:
        apply = apply & _wins(F.col(quote(f"_in_{newer_than}")), F.col(quote(newer_than)))
    updated = joined.select(
        *[
            F.when(apply, F.col(quote(f"_in_{f.name}")).cast(f.dataType))
            .otherwise(F.col(quote(f.name)))
            .alias(f.name)
            if f.name in source.columns and f.name != key
            else F.col(quote(f.name))
            for f in target.schema
        ]
    )
    inserted = _shape(source.join(target.select(quote(key)), key, "left_anti"), target.schema)
    return updated.unionAll(inserted)


def _shape(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types, NULL for those the rows lack."""
    return rows.select(
        *[
            (F.col(quote(f.name)) if f.name in rows.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


def upsert_parquet(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str = "event_id",
    partition: str = "event_date",
    newer_than: str | None = None,
    source_is_staged: bool = False,
    check_unique: bool = True,
    buckets: int | None = None,
) -> None:
    """Upsert into a Parquet table partitioned by a date (or integer) column.

    Only partitions that hold a key of the source are rewritten; they are found by a semi join over
    the key column alone, and nothing else of the table is read. Rows for other partitions are
    appended, so an increment of new keys rewrites nothing.

    ``buckets``, given when the table is made, adds a folder level below the date by hash of the key
    (column ``key_bucket``): lookup and rewrite then touch only buckets that the increment holds. The
    number is kept beside the data and used from then on.

    Files carry Bloom filters on the key, and an increment of few keys is looked up through them. Keys of
    the table are taken to be unique; should an interrupted commit have left two copies of a key, running the same increment
    again folds them into one. One writer at a time. The source is written to a scratch table
    first unless it already is one.
    """
    if not isinstance(source.schema[partition].dataType, (T.DateType, T.IntegralType)):
        raise ValueError(f"partition column {partition!r} must be a date or an integer")
    recover(spark, path)
    target = storage.read_parquet_if_exists(spark, path)
    if target is None:
        if key not in source.columns:
            raise ValueError(f"merge key {key!r} is not in the source columns {source.columns}")
        if check_unique:
            assert_unique(source, key)
        if buckets:
            storage.replace_text(spark, f"{path.rstrip('/')}/{BUCKETS}", str(buckets))
        _write(_bucketed(source, key, buckets), path, _levels(partition, buckets), key)
        return

    buckets = _bucket_count(spark, path)
    source = _bucketed(source, key, buckets)
    _check_columns(target.schema, source.schema, key)
    hold = nullcontext(source) if source_is_staged else storage.staged(spark, source)
    with hold as increment:
        if check_unique:
            assert_unique(increment, key)
        _merge_partitions(spark, path, target, increment, key, _levels(partition, buckets), newer_than)


def _bucketed(rows: DataFrame, key: str, buckets: int | None) -> DataFrame:
    if not buckets:
        return rows
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(quote(key)), F.lit(buckets)).cast("int"))


def _levels(partition: str, buckets: int | None) -> list[str]:
    return [partition, BUCKET] if buckets else [partition]


def _bucket_count(spark: SparkSession, path: str) -> int | None:
    """The number of buckets a table was made with, None for one without."""
    note = f"{path.rstrip('/')}/{BUCKETS}"
    return int(spark.read.text(note).first()[0]) if storage.path_exists(spark, note) else None


def _folder(levels: list[str]) -> Column:
    """The folder of a row, as Spark names it. Made of partition columns, so it prunes folders."""
    parts = [
        F.concat(F.lit(f"{c}="), F.coalesce(F.col(quote(c)).cast("string"), F.lit(NULL_FOLDER)))
        for c in levels
    ]
    return F.concat_ws("/", *parts)


def _merge_partitions(
    spark: SparkSession,
    path: str,
    target: DataFrame,
    source: DataFrame,
    key: str,
    levels: list[str],
    newer_than: str | None,
) -> None:
    target_only = [c for c in target.columns if c not in source.columns]
    carried = [key, *levels, *([newer_than] if newer_than else []), *target_only]
    looked_at = target
    if BUCKET in levels:
        held = [row[0] for row in source.select(BUCKET).distinct().collect()]  # at most all buckets
        looked_at = target.where(F.col(BUCKET).isin(held))
    lookup = matching_rows(looked_at.select(*map(quote, dict.fromkeys(carried))), source, key)
    with storage.staged(spark, lookup) as matched:
        winners = source
        if newer_than:
            held = matched.groupBy(quote(key)).agg(F.max(quote(newer_than)).alias("_held"))
            winners = (
                source.join(held, key, "left_outer")
                .where(_wins(F.col(quote(newer_than)), F.col("_held")))
                .drop("_held")
            )
        leaving_rows = matched.join(winners.select(quote(key)), key, "left_semi")
        # One row per folder, however large the table.
        folder = _folder(levels)
        leaving = {row[0]: row[1] for row in leaving_rows.groupBy(folder).count().collect()}
        arriving = {row[0] for row in winners.select(folder).distinct().collect()}
        emptied = _emptied(target, folder, leaving, leaving.keys() - arriving)
        if target_only:
            extra = matched.groupBy(quote(key)).agg(
                *[F.max_by(quote(c), quote(levels[0])).alias(c) for c in target_only]
            )
            winners = winners.join(extra, key, "left_outer")
        incoming = _shape(winners, target.schema)
        rewritten = folder.isin(*leaving) if leaving else F.lit(False)

        # Appended before the old copies go: a crash in between leaves two copies, never none.
        if arriving - leaving.keys():
            _write(incoming.where(~rewritten), path, levels, key)
        if leaving:
            kept = target.where(rewritten).join(
                winners.select(quote(key)), key, "left_anti"
            )
            merged = kept.select(*map(quote, target.columns)).unionAll(incoming.where(rewritten))
            _commit(spark, merged, path, levels, emptied, key)


def _commit(
    spark: SparkSession, merged: DataFrame, path: str, levels: list[str], emptied: list[str], key: str
) -> None:
    """Replace the partitions of ``merged``, and drop the emptied ones, so that a crash loses nothing.

    The new partitions are written beside the table, under a name readers ignore. The record that
    follows makes the commit: from then on it can be carried out again and again until it is done.
    """
    commit = f"{path.rstrip('/')}/{COMMITS}/{uuid.uuid4().hex}"
    _write(merged, commit, levels, key)
    storage.replace_text(spark, f"{commit}/{RECORD}", json.dumps(emptied))
    recover(spark, path)


def recover(spark: SparkSession, path: str) -> None:
    """Carry out commits that are recorded and not finished; clear away those never recorded.

    Per partition: the old folder goes, the new one takes its name. A new folder that is no longer
    there has taken it already. Runs at the start of every upsert; a reader that comes after a
    crash and before the next upsert calls it itself.
    """
    table = path.rstrip("/")
    for commit in storage.child_folders(spark, f"{table}/{COMMITS}"):
        record = f"{commit}/{RECORD}"
        if storage.path_exists(spark, record):
            for folder in _leaves(spark, commit):
                name = folder.removeprefix(f"{commit}/")
                storage.delete_path(spark, f"{table}/{name}")
                storage.rename_path(spark, folder, f"{table}/{name}")
            for name in json.loads(spark.read.text(record, wholetext=True).first()[0]):
                storage.delete_path(spark, f"{table}/{name}")
        storage.delete_path(spark, commit)


def _leaves(spark: SparkSession, path: str) -> list[str]:
    """The innermost partition folders below ``path``."""
    out = []
    for folder in storage.child_folders(spark, path):
        if "=" in folder.rsplit("/", 1)[-1]:
            deeper = [f for f in storage.child_folders(spark, folder) if "=" in f.rsplit("/", 1)[-1]]
            out += _leaves(spark, folder) if deeper else [folder]
    return out


def matching_rows(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is in the source: the one look at the whole target, so it is narrow.

    The keys of a small source become an IN predicate, which reaches Parquet: a row group is read only
    if the Bloom filter of its keys knows one of them, also where keys are random and no range helps.

    For a larger source the bounds of its keys change no answer. They let Parquet skip row groups where
    keys rise with time, and, being a selective predicate, they let Spark build a run-time Bloom filter
    from the source, so that of a target too big to be joined by broadcast only likely matches
    are shuffled.
    """
    column = F.col(quote(key))
    if isinstance(source.schema[key].dataType, (T.StringType, T.IntegralType, T.DateType)):
        keys = source.select(column).where(column.isNotNull()).limit(KEYS_AT_ONCE + 1).collect()
        if len(keys) <= KEYS_AT_ONCE:
            return target.where(column.isin([k[0] for k in keys]) if keys else F.lit(False))
    low, high = source.agg(F.min(column), F.max(column)).first()
    return target.join(source.select(column).where(column.between(low, high)), key, "left_semi")


def _emptied(target: DataFrame, folder: Column, leaving: dict, suspects: set) -> list[str]:
    """Folders that lose every row. Counting reads file footers only."""
    if not suspects:
        return []
    counts = target.where(folder.isin(*suspects)).groupBy(folder).count().collect()
    return [row[0] for row in counts if row[1] == leaving[row[0]]]


def _write(df: DataFrame, path: str, levels: list[str], key: str) -> None:
    """Append by partition with file sizes left to AQE, and with Bloom filters on the key.

    Rebalancing brings the rows of one partition value together, splits a value that is too big
    for one task (a day may hold a third of all rows) and merges small ones; otherwise every task
    would write a file into every partition it has a row of.
    """
    filters = {
        "adaptive.enabled": "true", "max.bytes": LARGEST_FILTER, f"candidates.number#{key}": FILTER_SIZES,
        f"enabled#{key}": "true", f"fpp#{key}": KEYS_FPP,
    }
    (
        df.hint("rebalance", *map(quote, levels))
        .write.mode("append")
        .options(**{f"parquet.bloom.filter.{name}": value for name, value in filters.items()})
        .option("compression", "snappy")
        .partitionBy(*levels)
        .parquet(path)
    )


def merge_into_table(
    spark: SparkSession,
    source: DataFrame,
    name: str,
    key: str = "event_id",
    newer_than: str | None = None,
) -> str:
    """Upsert into a catalog table that takes row-level operations; returns the name it used."""
    if key not in source.columns:
        raise ValueError(f"merge key {key!r} is not in the source columns {source.columns}")
    table = names.resolve(spark, name)

    def incoming(column: str) -> Column:
        return F.col(f"_increment.{quote(column)}")

    def current(column: str) -> Column:
        return F.col(f"{table}.{quote(column)}")

    merge = source.alias("_increment").mergeInto(table, current(key) == incoming(key))
    guard = [_wins(incoming(newer_than), current(newer_than))] if newer_than else []
    rest = {quote(c): incoming(c) for c in source.columns if c != key}
    merge.whenMatched(*guard).update(rest).whenNotMatched().insert(
        {quote(key): incoming(key), **rest}
    ).merge()
    return table
