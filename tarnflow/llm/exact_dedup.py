"""Exact dedup behind a two-pass Bloom filter: only possible repeats shuffle. DataFrame code only.

Texts are equal when they agree after every white-space character is deleted; null counts as
empty. Of equal texts the longest original stays, then the smallest id (a null id comes last); of
rows that agree in id and text too, one stays. Empty tables give empty results, other columns
travel along untouched, and the length of a text or the size of a group of copies sets no limit.

Pass one adds each text's two cells to a filter of ``cells`` counters and keeps, as bit words, the
cells hit more than once. Its size is fixed (``cells`` / 64 words at most, 16 MB for the default),
so it may be broadcast at any corpus size; with more texts than cells, more unique texts shuffle,
and results stay the same. Pass two lets a text through unless both its cells were hit again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tarnflow.llm.common import stage

CELLS = 1 << 26


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def text_key(text: Column) -> Column:
    """SHA-256 (hex) of the normalised text."""
    return F.sha2(normalised(text).cast("binary"), 256)


def _cell(key: str, seed: int, cells: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(cells))


def repeated_cells(keys: DataFrame, key: str, cells: int = CELLS) -> DataFrame:
    """Pass one: ``(word, mask)`` of the cells that two or more rows of ``keys`` hit."""
    hits = keys.select(F.explode(F.array(_cell(key, 1, cells), _cell(key, 2, cells))).alias("cell"))
    again = hits.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    return again.groupBy(F.expr("cell div 64").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(cell % 64 AS int)))").alias("mask")
    )


def with_maybe(rows: DataFrame, filter_words: DataFrame, key: str, cells: int = CELLS) -> DataFrame:
    """Pass two: adds ``__maybe``, false only where no other row can have the same key."""
    for seed in (1, 2):
        cell = f"__cell{seed}"
        words = F.broadcast(
            filter_words.select(F.col("word").alias(f"__w{seed}"), F.col("mask").alias(f"__m{seed}"))
        )
        rows = rows.withColumn(cell, _cell(key, seed, cells)).join(
            words, F.expr(f"__cell{seed} div 64 = __w{seed}"), "left"
        )
    hit = " AND ".join(f"coalesce(getbit(__m{s}, cast(__cell{s} % 64 AS int)), 0) = 1" for s in (1, 2))
    return rows.withColumn("__maybe", F.expr(hit)).drop(
        *(f"__{x}{s}" for x in ("cell", "w", "m") for s in (1, 2))
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 cells: int = CELLS) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id, group_size, kept, text_sha256``."""
    digests = stage(
        docs.select(
            F.col(id_col).alias("__id"),
            F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("__chars"),
            text_key(F.col(text_col)).alias("__key"),
        ),
        "digests",
    )
    rows = with_maybe(digests, repeated_cells(digests, "__key", cells), "__key", cells)
    alone = rows.where(~F.col("__maybe")).select(
        "*",
        F.col("__id").alias("__keep"),
        F.lit(1).cast("long").alias("__size"),
        F.lit(True).alias("__kept"),
    )
    maybe = rows.where("__maybe")
    # Written, so that the join sees a plain table and Spark can split a large group of copies.
    groups = stage(
        maybe.groupBy("__key").agg(
            F.count("*").alias("__size"),
            F.min(F.struct(-F.col("__chars"), F.col("__id").isNull(), F.col("__id").alias("id"))).alias("__best"),
        ),
        "groups",
    )
    # Rows that agree in id and text: number them, so that just one stays. Dealt by key and id,
    # so a large group of copies is spread.
    numbered = maybe.repartition("__key", "__id").withColumn(
        "__copy",
        F.row_number().over(W.partitionBy("__key", "__id").orderBy(F.desc("__chars"))),
    )
    found = numbered.join(groups, "__key").select(
        *rows.columns,
        F.col("__best.id").alias("__keep"),
        "__size",
        (F.col("__id").eqNullSafe(F.col("__best.id")) & (F.col("__copy") == 1)).alias("__kept"),
    )
    return alone.unionByName(found).select(
        F.col("__id").alias(id_col),
        F.col("__keep").alias("keep_id"),
        F.col("__size").alias("group_size"),
        F.col("__kept").alias("kept"),
        F.col("__key").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      cells: int = CELLS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that cannot have a copy pass straight through the scan; of the others only one text per
    key comes out of an aggregation of ids, against which they are joined.
    """
    columns = docs.columns
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"),
        F.col(id_col).alias("__id"),
        F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("__chars"),
        text_key(F.col(text_col)).alias("__key"),
    )
    digests = stage(keyed.select("__key", "__id", "__chars"), "digests")
    words = stage(repeated_cells(digests, "__key", cells), "cells")
    rows = with_maybe(keyed, words, "__key", cells)
    alone = rows.where(~F.col("__maybe")).select("__row.*")
    best = (
        with_maybe(digests, words, "__key", cells).where("__maybe").groupBy("__key")
        .agg(F.min(F.struct(-F.col("__chars"), F.col("__id").isNull(), F.col("__id").alias("id"))).alias("b"))
        .select(F.col("__key").alias("__k"), F.col("b.id").alias("__keep"))
    )
    maybe = rows.where("__maybe")
    kept = maybe.join(
        best, (F.col("__key") == F.col("__k")) & F.col("__id").eqNullSafe(F.col("__keep")), "left_semi"
    )
    first = W.partitionBy("__key", "__id").orderBy(F.desc("__chars"))
    kept = kept.withColumn("__copy", F.row_number().over(first)).where("__copy = 1")
    return alone.unionByName(kept.select("__row.*"))
