"""Shared pieces of the operators: tables on shared storage, sizes, sorted runs in a task."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnflow.sources.storage import delete_path

#: The white space of the contracts: blank and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor reaches.

    The one the cluster names in ``spark.checkpoint.dir``; where that is unset, as in tests, a
    folder in the warehouse, which is shared as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{root.rstrip('/')}/tarnflow-llm"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to shared storage and read back.

    Cuts the lineage: a lost executor costs a re-read, and steps that use the table twice do not
    repeat what made it. ``unstage`` deletes it where nothing reads it any more; the caller's cluster
    expires the rest, as it does for checkpoints.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table


def unstage(*tables: DataFrame) -> None:
    """Delete tables that ``stage`` wrote and that later steps have replaced."""
    for table in tables:
        delete_path(table.sparkSession, table.staged_at)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_sample(rows: DataFrame, most: int, *by: str) -> DataFrame:
    """At most ``most`` rows, those first by hash of ``by``: a sample that does not change.

    A top-k of many rows would have every task send that many; so the hash first thins the rows to
    little more than is wanted over all tasks together.
    """
    share = min(1.0, 1.2 * most / max(1, rows.count()))
    hashed = rows.withColumn("__hash", F.pmod(F.xxhash64(F.lit(4), *by), F.lit(1 << 40)))
    thinned = hashed.where(F.col("__hash") < int(share * (1 << 40)) + 1)
    return thinned.orderBy("__hash", *by).limit(most).drop("__hash")


def crc32_mod(column: str, divisor: int) -> Column:
    """crc32 of a number's decimal text, modulo ``divisor``: the fold of a document."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(divisor))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 18):
    """Parts of Arrow batches that hold at most ``most`` bytes of ``column`` (one row at least).

    Keeps the work space of vectorised code over a text column bounded by the longest text.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if row > start and held + size > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def sorted_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of one key after the other, from batches that are sorted by ``key``.

    Memory holds one run and one batch, so a caller bounds the rows of a key beforehand.
    """
    import numpy as np

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def whole_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Like the input, sorted by ``key``, but cut so that no key's rows lie in two tables."""
    import numpy as np

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        at = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if at or (held and keys[0] != last):
            if held and not at:
                yield pa.Table.from_batches(held)
                held = []
            elif at:
                yield pa.Table.from_batches([*held, batch.slice(0, at)])
                held = []
        held.append(batch.slice(at))
        last = keys[-1]
    if held:
        yield pa.Table.from_batches(held)
