"""Vector code compression: product codes learned by active-entry Lloyd rounds, exact in integers.

Components become ``floor(SCALE * x)`` and vectors are cut into ``PARTS`` equal consecutive parts. Each
part has a codebook of ``ENTRIES`` entries that starts as that part of the vectors with the smallest ids.
A round assigns every part to its nearest entry (squared Euclidean distance, ties to the lower index)
and moves each entry to the floor of the mean of its parts; entries nobody uses stay.

The rounds keep every part's entry and its exact distance. A part whose entry did not move compares only
the entries that moved against that distance (those that stayed were no nearer before, and are none
now); every other part looks at all entries again. Distances come from matrix products of integers in
double precision where all sums stay below 2^53, and from 64-bit integers elsewhere, so they are exact.

Spark deals the vectors; a task sends its sums per part and entry, which are added up by entry. Only the
codebooks pass through the driver and to the tasks: ``ENTRIES`` vectors, whatever the count of rows. Each
round's table is written to shared storage, and the one before it is deleted.

Vectors that are null or hold a null, NaN or infinite component are left out. Shorter vectors count as
padded with zeros to the longest one, and that to a multiple of ``PARTS``; an empty vector is all zeros.
Integers are held within +-2^27 (a component of 131,072), where distances fit a long. Rows that repeat an id
are rows like others; a null id comes last in order, and equal ids are ordered by their components. With
fewer than ``ENTRIES`` vectors there are as many entries. Null labels are one label. Empty tables give an
empty result; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnflow.llm.common import scratch_path, stage
from tarnflow.sources.storage import delete_path

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
LARGEST = 1 << 27
#: Rows compared with a codebook at once: bounds the matrix of distances.
BLOCK = 4096


def quantised(vector: Column) -> Column:
    """The integers of a vector."""
    return F.transform(
        vector,
        lambda x: F.greatest(
            F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(F.least(F.greatest(
                x.cast("double") * SCALE, F.lit(-2.0 * LARGEST)), F.lit(2.0 * LARGEST))))
        ).cast("int"),
    )


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """List values as rows of ``width`` numbers, shorter lists padded with zeros."""
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` from each entry."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)), 1)
    if 4 * top * top * max(1, x.shape[1]) < 2**53:
        x, entries = x.astype(np.float64), entries.astype(np.float64)
        product = x @ entries.T
    else:
        product = x @ entries.T
    own = (x * x).sum(axis=1)[:, None] + (entries * entries).sum(axis=1)[None, :]
    return (own - 2 * product).astype(np.int64)


def assign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, at: np.ndarray, far: np.ndarray):
    """Nearest entries of the rows of ``x`` and their distances, given those of the round before."""
    at, far = at.copy(), far.copy()
    active = np.flatnonzero(moved)
    fixed = (at >= 0) & ~moved[at]
    for rows, these in ((np.flatnonzero(~fixed), np.arange(len(entries))), (np.flatnonzero(fixed), active)):
        for c in range(0, len(rows) if len(these) else 0, BLOCK):
            block = rows[c : c + BLOCK]
            found = _distances(x[block], entries[these])
            best = found.argmin(axis=1)
            near, index = found[np.arange(len(block)), best], these[best]
            wins = ~fixed[block] | (near < far[block]) | ((near == far[block]) & (index < at[block]))
            at[block[wins]], far[block[wins]] = index[wins], near[wins]
    return at, far


def _parts(width: int) -> list[slice]:
    d = width // PARTS
    return [slice(p * d, (p + 1) * d) for p in range(PARTS)]


def _assigned(codebooks: np.ndarray, moved: np.ndarray):
    """Adds ``at, far`` to batches of ``vec_id, label, x, at, far``; codebooks: entries as whole vectors."""
    width = codebooks.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, n = _matrix(batch.column("x"), width), len(batch)
            at = _matrix(batch.column("at"), PARTS)
            far = _matrix(batch.column("far"), PARTS)
            for p, cut in enumerate(_parts(width)):
                at[:, p], far[:, p] = assign(x[:, cut], codebooks[:, cut], moved[p], at[:, p], far[:, p])
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * PARTS)
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(v).reshape(-1)))
                for v in (at.astype(np.int32), far)
            ]
            yield pa.record_batch(
                [batch.column(c) for c in ("vec_id", "label", "x")] + lists, ["vec_id", "label", "x", "at", "far"]
            )

    return run


def _sums(entries: int, width: int):
    """A task's sums of the parts of each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = width // PARTS
        counts, sums = np.zeros((PARTS, entries), np.int64), np.zeros((PARTS, entries, d), np.int64)
        for batch in batches:
            x, at = _matrix(batch.column("x"), width), _matrix(batch.column("at"), PARTS)
            for p, cut in enumerate(_parts(width)):
                order = np.argsort(at[:, p], kind="stable")
                used, first = np.unique(at[order, p], return_index=True)
                counts[p, used] += np.diff(np.append(first, len(order)))
                sums[p, used] += np.add.reduceat(x[order, cut], first, axis=0) if len(order) else 0
        part, entry = np.nonzero(counts)
        yield pa.record_batch(
            [
                pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]),
                pa.array(list(sums[part, entry]), pa.list_(pa.int64())),
            ],
            ["part", "entry", "n", "total"],
        )

    return run


def _moved_entries(state: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after a round: floors of the means, unused entries as they were."""
    entries, width = codebooks.shape
    sums = state.select("x", "at").mapInArrow(
        _sums(entries, width), "part int, entry int, n long, total array<long>"
    )
    d = width // PARTS
    if not d:
        return codebooks
    total = sums.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.get("total", F.lit(i))).alias(f"s{i}") for i in range(d)]
    )
    out = codebooks.copy()
    for row in total.collect():  # at most PARTS * ENTRIES rows
        out[row.entry, row.part * d : (row.part + 1) * d] = [row[i + 3] // row.n for i in range(d)]
    return out


def learn_and_assign(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                     label_col: str = "label", entries: int = ENTRIES,
                     rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, label, x, at, far)`` of the kept vectors, and the codebooks (entries as whole vectors)."""
    spark = vectors.sparkSession
    vector = F.col(vector_col)
    schema = "vec_id long, label string, x array<int>, at array<int>, far array<long>"
    start = F.array(*[F.lit(-1)] * PARTS), F.array(*[F.lit(0).cast("long")] * PARTS)
    path = scratch_path(spark, "vectors")
    vectors.where(usable(vector)).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
        quantised(vector).alias("x"), start[0].alias("at"), start[1].alias("far"),
    ).write.parquet(path)
    state = spark.read.schema(schema).parquet(path)
    longest = state.agg(F.max(F.size("x"))).first()[0] or 0
    width = -(-longest // PARTS) * PARTS
    # The smallest ids first, then their vectors: tasks send ids, and whole vectors of the chosen only.
    by_id = [F.col("vec_id").isNull(), F.col("vec_id")]
    ids = state.select("vec_id").orderBy(*by_id).limit(entries).collect()
    last = ids[-1].vec_id if ids else None
    first = state if last is None else state.where(F.col("vec_id") <= last)
    chosen = first.orderBy(*by_id, "x").limit(entries).select("x").collect()
    codebooks = np.zeros((len(chosen), width), np.int64)
    for i, row in enumerate(chosen):
        codebooks[i, : len(row.x)] = row.x
    if not len(codebooks):
        return state, codebooks
    moved = np.ones((PARTS, len(codebooks)), bool)
    for k in range(rounds + 1):
        new = scratch_path(spark, "vectors")
        state.mapInArrow(_assigned(codebooks, moved), schema).write.parquet(new)
        delete_path(spark, path)
        path, state = new, spark.read.schema(schema).parquet(new)
        if k < rounds:
            before, codebooks = codebooks, _moved_entries(state, codebooks)
            moved = np.array([(before[:, cut] != codebooks[:, cut]).any(axis=1) for cut in _parts(width)])
    return state, codebooks


def codebook_text(codebooks: np.ndarray) -> str:
    """All components by part, entry and position within the part."""
    return ",".join(
        str(v) for cut in _parts(codebooks.shape[1]) for v in codebooks[:, cut].reshape(-1).tolist()
    )


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label", entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)``, one row per kept vector."""
    state, codebooks = learn_and_assign(vectors, id_col, vector_col, label_col, entries, rounds)
    coded = state.select(
        "vec_id", "label",
        F.array_join(F.transform("at", lambda a: F.lower(F.lpad(F.hex(a), 2, "0"))), "").alias("code"),
        F.aggregate("far", F.lit(0).cast("long"), lambda a, x: a + x).alias("error"),
    )
    # Written, so that the join sees a plain table and Spark can split a frequent label.
    by_label = stage(
        coded.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error")), "labels"
    )
    digest = F.sha2(F.lit(codebook_text(codebooks)).cast("binary"), 256)
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("__label"))).select(
        F.col("vec_id").alias(id_col), "code", "error", "label_error", digest.alias("codebooks_sha256")
    )
