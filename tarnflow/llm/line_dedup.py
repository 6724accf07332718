"""Line dedup over overlapping three-line windows. DataFrame code only.

A window is three consecutive lines (split at U+000A), known by a 128-bit hash. Of the windows
that occur more than once in the corpus, the first by (id, text hash, line) stays; the lines that
later ones cover are removed, after overlapping ones are merged. Where occurrences overlap within
one text, the lines before the second one stay.

Null texts stay null, and texts of fewer than three lines stay as they are. Rows that agree in id
and text are one document and get the same result; a null id is an id like others, the last in
order. Empty tables give empty results; other columns travel along. A line may occur any number
of times: counts and first occurrences are combined before the shuffle, later ones are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnflow.llm.common import stage

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(h1, h2, id, row, at)``: every window of every text."""
    cut = docs.where(F.instr(F.col(text_col), "\n") > 0).select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("row"), _lines(F.col(text_col)).alias("ls")
    ).where(F.size("ls") >= WINDOW)

    def key(i: Column) -> Column:
        three = [F.get("ls", i + k) for k in range(WINDOW)]
        return F.struct(
            F.xxhash64(F.lit(1), *three).alias("h1"), F.xxhash64(F.lit(2), *three).alias("h2"),
            i.alias("at"),
        )

    places = F.sequence(F.lit(0), F.size("ls") - WINDOW)
    return cut.select("id", "row", F.explode(F.transform(places, key)).alias("w")).select(
        "w.h1", "w.h2", "id", "row", "w.at"
    )


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, row, starts)``: for each text that loses lines, the sorted starts of later windows."""
    found = stage(windows(docs, id_col, text_col).distinct(), "windows")
    place = F.struct(F.col("id").isNull(), F.col("id"), F.col("row"), F.col("at"))
    # Written, so that the join sees a plain table and Spark can split a frequent window.
    repeated = stage(
        found.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .where("n > 1").select("h1", "h2", "first"),
        "repeated",
    )
    later = found.join(repeated, ["h1", "h2"]).where(place != F.col("first"))
    return later.groupBy("id", "row").agg(F.sort_array(F.collect_list("at")).alias("starts"))


def kept_stretches(starts: Column, lines: Column) -> Column:
    """``(from, length)`` of the stretches of lines that no window in ``starts`` covers."""
    n = F.size(starts)
    gaps = F.transform(
        F.sequence(F.lit(0), n),
        lambda i: F.struct(
            F.when(i == 0, 0).otherwise(F.get(starts, i - 1) + WINDOW).alias("from"),
            F.when(i == n, F.size(lines)).otherwise(F.get(starts, i)).alias("to"),
        ),
    )
    return F.filter(
        F.transform(gaps, lambda g: F.struct(g["from"].alias("from"), (g["to"] - g["from"]).alias("length"))),
        lambda g: g["length"] > 0,
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated lines taken out of the text, plus ``n_lines, n_removed``.

    Other columns travel along, whatever their names; columns of ``docs`` that are called ``n_lines`` or
    ``n_removed`` are replaced.
    """
    gone = removals(docs, id_col, text_col).select(
        F.col("id").alias("__id"), F.col("row").alias("__key"), F.col("starts").alias("__starts")
    )
    columns = docs.columns
    # As one column, so that no name of theirs meets one of ours.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"))
    own_id, own_text = F.col("__row").getField(id_col), F.col("__row").getField(text_col)
    joined = rows.join(gone, own_id.eqNullSafe(F.col("__id")) & (F.xxhash64(own_text) == F.col("__key")), "left")
    lines = _lines(own_text)
    hit = F.col("__starts").isNotNull()
    cut = joined.select(
        "__row",
        F.when(hit, lines).alias("__ls"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("__n"),
        F.when(hit, kept_stretches(F.col("__starts"), lines)).alias("__kept"),
    )
    pieces = F.flatten(F.transform("__kept", lambda g: F.slice(F.col("__ls"), g["from"] + 1, g["length"])))
    left = F.aggregate("__kept", F.lit(0), lambda a, g: a + g["length"])
    text = F.when(F.col("__kept").isNull(), own_text).otherwise(F.array_join(pieces, "\n"))
    return cut.select(
        *[
            text.alias(c) if c == text_col else F.col("__row").getField(c).alias(c)
            for c in columns if c not in ("n_lines", "n_removed")
        ],
        F.when(own_text.isNull(), 0).otherwise(F.col("__n")).cast("long").alias("n_lines"),
        F.coalesce(F.col("__n") - left, F.lit(0)).cast("long").alias("n_removed"),
    )
