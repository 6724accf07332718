"""Filter interaction audit: what each filter removes, alone, after others, and on average.

Each filter of a part has a posting list: the sorted places of the rows that fail it. Lists live per
part and id range: rows (a few bits each, no texts) are dealt by ranges of (part, id), so a part that
holds a third of all rows is spread, and a task works on at most ``CHUNK`` rows of a part at once.
Within a range, what filters have removed so far is a k-way union of lists and what the next one removes
is a difference, both by galloping search. Ranges are disjoint, so sizes add up: a task sends one row
of counts per part, filter and set of earlier filters, which is all that any order needs.

The measures of a text are DataFrame expressions, and equal texts are found by an aggregation of their
SHA-256 to the smallest id, joined back as written tables, so that Spark can split a text with many
copies.

A null text counts as empty; words are maximal runs without blank and U+0009 to U+000D; texts may be of
any length. A null part is the empty string. Every row counts, also where rows repeat an id; equal
texts under one id do not fail each other (neither id is smaller), nor does a null id. A document that
has several label rows is good (toxic) where one of them says so. Empty tables give no rows, and extra
columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnflow.llm.common import SPACES, stage

FILTERS = "ABCDE"
#: Most rows of a part whose posting lists are held at once.
CHUNK = 1 << 18
MARKS = "#$%&*|"


def measured(text: Column) -> dict[str, Column]:
    """Whether a text fails the filters that look at it alone."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, f"[{SPACES}]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": n < 200,
        "B": distinct * 100 < n * 50,
        "C": capitals * 100 > F.char_length(text) * 2,
        "D": F.char_length(F.translate(text, MARKS, "")) < F.char_length(text),
    }


def failures(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``(part, id, fails, good, toxic)`` of each row; bit k of ``fails`` stands for filter k."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = measured(F.col(text_col))
    bits = sum((F.when(own[f], 1 << FILTERS.index(f)).otherwise(0) for f in own), F.lit(0))
    rows = stage(
        docs.select(
            F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
            F.col(id_col).cast("long").alias("id"),
            bits.alias("bits"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"),
        ),
        "measures",
    )
    copies = stage(
        rows.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"))
        .where("least < most").select("key", "least"),
        "copies",
    )
    marks = stage(
        labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
        ),
        "marks",
    )
    copied = F.coalesce(F.col("id") > F.col("least"), F.lit(False))
    return rows.join(copies, "key", "left").join(marks, "id", "left").select(
        "part", "id",
        (F.col("bits") + F.when(copied, 1 << FILTERS.index("E")).otherwise(0)).cast("int").alias("fails"),
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )


def gallop(places: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The first place at or after each of ``wanted``; both are sorted.

    Steps double from where the search before ended a block ago, then halve: the cost follows the
    logarithm of the distance between neighbours and not that of the whole list.
    """
    out = np.empty(len(wanted), np.int64)
    start = 0
    for c in range(0, len(wanted), 256):
        block = wanted[c : c + 256]
        step, stop = 1, start
        while stop < len(places) and places[stop] < block[-1]:
            stop = start + step
            step *= 2
        stop = min(stop + 1, len(places))
        out[c : c + 256] = start + np.searchsorted(places[start:stop], block)
        start = int(out[min(c + 256, len(wanted)) - 1])
    return out


def is_in(places: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of ``wanted`` are in ``places``."""
    if not len(places):
        return np.zeros(len(wanted), bool)
    at = gallop(places, wanted)
    return (at < len(places)) & (places[np.minimum(at, len(places) - 1)] == wanted)


def union(lists: list[np.ndarray]) -> np.ndarray:
    """K-way merge, shortest lists first: what is new goes to its place in the longer one."""
    lists = sorted(lists, key=len)
    merged = lists[0] if lists else np.zeros(0, np.int64)
    for longer in lists[1:]:
        new = merged[~is_in(longer, merged)]
        merged = np.insert(longer, gallop(longer, new), new)
    return merged


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per part, set of earlier filters and filter, of rows that come sorted by part and id."""
    full = 1 << len(FILTERS)
    totals: dict[str, np.ndarray] = {}

    def count(part: str, fails: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> None:
        lists = [np.flatnonzero(fails >> k & 1) for k in range(len(FILTERS))]
        out = totals.setdefault(part, np.zeros((full, len(FILTERS), 4), np.int64))
        goods, toxics = np.flatnonzero(good), np.flatnonzero(toxic)
        for before in range(full):
            gone = union([lists[k] for k in range(len(FILTERS)) if before >> k & 1])
            for k in range(len(FILTERS)):
                if not before >> k & 1:
                    removed = lists[k][~is_in(gone, lists[k])]
                    out[before, k] += (
                        len(removed), len(gone), is_in(goods, removed).sum(), is_in(toxics, removed).sum()
                    )

    held: list[tuple] = []
    last, size = None, 0
    for batch in batches:
        part = batch.column("part")
        names = part.to_numpy(zero_copy_only=False)
        values = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("fails", "good", "toxic")]
        edges = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1), len(names)] if len(names) else []
        for a, b in zip(edges, edges[1:]):
            if held and (names[a] != last or size + b - a > CHUNK):
                count(last, *(np.concatenate(x) for x in zip(*held)))
                held, size = [], 0
            held.append(tuple(v[a:b] for v in values))
            last, size = names[a], size + b - a
    if held:
        count(last, *(np.concatenate(x) for x in zip(*held)))
    pairs = [(s, k) for s in range(full) for k in range(len(FILTERS)) if not s >> k & 1]
    for part, counts in totals.items():
        yield pa.record_batch(
            [
                pa.array([part] * len(pairs)),
                pa.array([s for s, _ in pairs], pa.int32()), pa.array([k for _, k in pairs], pa.int32()),
                *(pa.array([counts[s, k, i] for s, k in pairs], pa.int64()) for i in range(4)),
            ],
            ["part", "before", "filter", "removed", "gone", "good_lost", "toxic_lost"],
        )


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per part, order of the filters and step, as the module describes them.

    ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley``.
    """
    spark = docs.sparkSession
    rows = stage(failures(docs, labels, part_col, id_col, text_col), "failures")
    ranged = rows.repartitionByRange("part", "id").sortWithinPartitions("part", "id")
    sums = ["removed", "gone", "good_lost", "toxic_lost"]
    found = ranged.select("part", "fails", "good", "toxic").mapInArrow(
        _audit,
        "part string, before int, filter int, removed long, gone long, good_lost long, toxic_lost long",
    )
    counts = stage(
        found.groupBy("part", "before", "filter").agg(*[F.sum(c).alias(c) for c in sums]), "counts"
    )
    orders = [
        (f"{''.join(FILTERS[k] for k in order)}", step + 1, sum(1 << k for k in order[:step]), order[step])
        for order in permutations(range(len(FILTERS)))
        for step in range(len(FILTERS))
    ]
    steps = spark.createDataFrame(orders, "filter_order string, step int, before int, filter int")
    totals = rows.groupBy("part").agg(F.count("*").alias("rows"))
    everything = (1 << len(FILTERS)) - 1
    alone = counts.select(
        "part", "filter",
        F.when(F.col("before") == 0, F.col("removed")).alias("fails"),
        F.when(
            F.col("before") == F.lit(everything) - F.expr("shiftleft(1, filter)"), F.col("removed")
        ).alias("unique"),
    ).groupBy("part", "filter").agg(F.max("fails").alias("fails"), F.max("unique").alias("unique_fails"))
    # In how many orders the earlier filters are just these: the weight of a difference.
    weights = steps.groupBy("before", "filter").agg(F.count("*").alias("weight"))
    shapley = (
        counts.join(F.broadcast(weights), ["before", "filter"])
        .groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("weight")).alias("shapley"))
    )
    by_part = counts.join(alone, ["part", "filter"]).join(shapley, ["part", "filter"]).join(totals, "part")
    return by_part.join(F.broadcast(steps), ["before", "filter"]).select(
        "part", "filter_order", "step",
        (F.col("rows") - F.col("gone") - F.col("removed")).alias("kept"),
        "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails", "good_lost", "toxic_lost", "shapley",
    )
