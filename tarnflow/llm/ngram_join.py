"""N-gram Jaccard join over a count-vector tree.

A text's set holds its distinct five-word shingles. Shingles are hashed into groups, and a text is
the point of its group counts. For any two points the sum over groups of the smaller count bounds
the size of the intersection from above, and that holds for any grouping, fine or coarse:

* Top level, fine groups (one per shingle hash): a text goes down the entries of its rarest
  shingles only. The minima over all other coordinates sum to less than the overlap that a partner
  needs, so two linked texts always meet in an entry. Which order counts as "rare" is free; frequent
  shingles, counted over the corpus, come last, so that entries stay small.
* Below an entry, coarse groups: points of an entry are compared by size and by summed minima.
  Points that may link are tied together (a forest, never all pairs), over all entries.
* Leaves: texts that are tied together meet once more, in blocks of bounded size, with their whole
  sets, and 100 * intersection >= 75 * union decides. A text that is found leaves the pool; pairs
  inside a component that is known need no comparison. A forest of links comes out.

Entries and blocks are split when they exceed a bound, and every pair of parts meets, so a hot
shingle or a large family of copies is neither dropped nor handed to one task.

Texts that are null, empty or without words have empty sets and link with nothing. Texts of fewer
than five words are one shingle. Equal sets link (repeated rows, copies) and are compared once. A
row without an id links with nothing; rows that share an id are one node. Empty tables give empty
results; other columns are ignored by the join and kept by the dedup.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tarnflow.llm.common import slices, stage, whole_runs
from tarnflow.llm.components import connected_components
from tarnflow.llm.text_arrays import shingle_sets

#: Least number of coarse groups.
GROUPS = 64
#: Similarity in hundredths.
SIMILARITY = 75
#: Most points of an entry, or shingles of a leaf block, that meet in one piece of work.
ENTRY_POINTS = 4096
BLOCK_POINTS = 512
BLOCK_SHINGLES = 1 << 19
#: At most this many frequent shingles are sent to the tasks (8 bytes each); they shape the order
#: of the top level, not the result.
FREQUENT = 1 << 18
FREQUENT_FROM = 32
_TOP = np.uint64(1 << 63)


def group_counts(items: np.ndarray) -> np.ndarray:
    """Counts by coarse group, one byte each.

    Longer texts get more groups, a power of two of about one per eight shingles: with fewer, any
    two long texts would look alike. Should a count not fit, all are set to 255, which bounds from
    above for every partner that size alone does not rule out.
    """
    groups = max(GROUPS, 1 << max(0, (len(items) - 1) // 8).bit_length())
    counts = np.bincount((items >> np.uint64(20)).astype(np.int64) & (groups - 1), minlength=groups)
    return np.full(groups, 255, np.uint8) if counts.max() > 254 else counts.astype(np.uint8)


class _Counts:
    """The group counts of some rows, and the summed minima of pairs of them."""

    def __init__(self, column: pa.ChunkedArray):
        raw = column.to_pylist()
        self.groups = np.array([len(r) for r in raw])
        self.place = np.zeros(len(raw), int)
        self.tables = {}
        for g in np.unique(self.groups).tolist():
            rows = np.flatnonzero(self.groups == g)
            self.place[rows] = np.arange(len(rows))
            self.tables[g] = np.frombuffer(b"".join(raw[r] for r in rows), np.uint8).reshape(-1, g)

    def at(self, rows: np.ndarray, groups: int) -> np.ndarray:
        """Counts over ``groups`` groups; finer ones are added up."""
        out = np.zeros((len(rows), groups), np.uint16)
        for g in np.unique(self.groups[rows]).tolist():
            own = self.groups[rows] == g
            out[own] = self.tables[g][self.place[rows[own]]].reshape(-1, g // groups, groups).sum(axis=1, dtype=np.uint16)
        return out

    def minima(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        coarse = np.minimum(self.groups[a], self.groups[b])
        for g in np.unique(coarse).tolist():
            at = np.flatnonzero(coarse == g)
            step = max(1, (1 << 21) // g)
            for c in range(0, len(at), step):
                part = at[c : c + step]
                i, j = a[part], b[part]
                if (self.groups[i] == g).all() and (self.groups[j] == g).all():
                    x, y = self.tables[g][self.place[i]], self.tables[g][self.place[j]]
                else:
                    x, y = self.at(i, g), self.at(j, g)
                out[part] = np.minimum(x, y).sum(axis=1, dtype=np.int64)
        return out


def may_link(n_a, n_b, minima, similarity: int = SIMILARITY):
    """Whether an overlap of ``minima`` would suffice: 100 o >= s (a + b - o)."""
    return (100 + similarity) * minima >= similarity * (n_a + n_b)


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        sets = shingle_sets(part.column("text"))
        keys = [
            (int(s.sum(dtype=np.uint64)) >> 1, int(np.bitwise_xor.reduce(s * (s | np.uint64(1)))) >> 1)
            if len(s) else (0, 0)
            for s in sets
        ]
        yield pa.record_batch(
            [
                part.column("id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([k[0] for k in keys], pa.int64()),
                pa.array([k[1] for k in keys], pa.int64()),
                pa.array([group_counts(s).tobytes() for s in sets], pa.binary()),
            ],
            ["id", "n", "k1", "k2", "vec"],
        )


def _local_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that a task sees in two texts or more, with their counts."""
    held, size = [], 0

    def flush():
        token, count = np.unique(np.concatenate(held), return_counts=True)
        often = count > 1
        return pa.record_batch(
            [pa.array(token[often].view(np.int64)), pa.array(count[often].astype(np.int64))],
            ["token", "n"],
        )

    for part in slices(batches, "text"):
        held += shingle_sets(part.column("text"))
        size += sum(map(len, held[-len(part):])) if len(part) else 0
        if size > 4_000_000:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _entries(frequent: np.ndarray, similarity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            ids, tokens, owners = part.column("id").to_numpy(zero_copy_only=False), [], []
            for i, items in enumerate(shingle_sets(part.column("text"))):
                n = len(items)
                if not n:
                    continue
                take = n + (-similarity * n) // 100 + 1
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, items), len(frequent) - 1)
                    late = frequent[at] == items
                    items = np.concatenate([items[~late], items[late]])
                tokens.append(items[:take])
                owners.append(np.full(min(take, n), ids[i]))
            if tokens:
                yield pa.record_batch(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(owners))],
                    ["token", "id"],
                )

    return run


class _Forest:
    """Edges found in a task, each once."""

    def __init__(self):
        self.seen: set[tuple[int, int]] = set()

    def batch(self, u, v) -> pa.RecordBatch | None:
        new = [p for p in dict.fromkeys(zip(u, v)) if p not in self.seen]
        if len(self.seen) < 1_000_000:
            self.seen.update(new)
        if not new:
            return None
        a, b = zip(*new)
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["u", "v"])


def _spread(pool: np.ndarray, links) -> Iterator[tuple[int, np.ndarray]]:
    """Breadth first: ``links(p, rest)`` masks what links with ``p``; what links leaves the pool."""
    while len(pool) > 1:
        queue, pool = [pool[0]], pool[1:]
        while queue and len(pool):
            p = queue.pop()
            hit = links(p, pool)
            if hit.any():
                found, pool = pool[hit], pool[~hit]
                yield p, found
                queue.extend(found)


def _tie(similarity: int):
    """In each entry, a forest over the points that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()
        for table in whole_runs(batches, "key"):
            key = table.column("key").to_numpy()
            ids, n = table.column("id").to_numpy(), table.column("n").to_numpy()
            vec = _Counts(table.column("vec"))
            cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
            sizes = np.diff(cuts)
            run_size = np.repeat(sizes, sizes)
            us, vs = [], []

            def fits(a, b):
                out = np.minimum(n[a], n[b]) * 100 >= similarity * np.maximum(n[a], n[b])
                at = np.flatnonzero(out)
                out[at] = may_link(n[a[at]], n[b[at]], vec.minima(a[at], b[at]), similarity)
                return out

            # Small entries all at once: rows that are d apart in the same entry.
            for d in range(1, 8):
                a = np.flatnonzero((key[:-d] == key[d:]) & (run_size[:-d] <= 8)) if d < len(key) else np.zeros(0, int)
                if len(a):
                    a = a[fits(a, a + d)]
                    us.append(ids[a])
                    vs.append(ids[a + d])
            for c in np.flatnonzero(sizes > 8):
                pool = np.arange(cuts[c], cuts[c + 1])
                for p, found in _spread(pool, lambda p, rest: fits(np.full(len(rest), p), rest)):
                    us.append(np.full(len(found), ids[p]))
                    vs.append(ids[found])
            if us:
                u, v = np.concatenate(us), np.concatenate(vs)
                lo, hi = np.minimum(u, v), np.maximum(u, v)
                out = forest.batch(lo[lo != hi].tolist(), hi[lo != hi].tolist())
                if out is not None:
                    yield out

    return run


def _leaf_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        sets = shingle_sets(part.column("text"))
        yield pa.record_batch(
            [
                part.column("id"), part.column("cluster"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([group_counts(s).tobytes() for s in sets], pa.binary()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ],
            ["id", "cluster", "n", "vec", "items"],
        )


def _verify(similarity: int):
    """In each leaf block, a forest over the points that do link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()
        for table in whole_runs(batches, "key"):
            key = table.column("key").to_numpy()
            ids, n, vec = table.column("id").to_numpy(), table.column("n").to_numpy(), _Counts(table.column("vec"))
            items = [np.frombuffer(x, np.uint64) for x in table.column("items").to_pylist()]

            def links(p, rest):
                ok = np.minimum(n[p], n[rest]) * 100 >= similarity * np.maximum(n[p], n[rest])
                at = np.flatnonzero(ok)
                minima = vec.minima(np.full(len(at), p), rest[at])
                at = at[may_link(n[p], n[rest[at]], minima, similarity)]
                out = np.zeros(len(rest), bool)
                if len(at):
                    mine = items[p]
                    joined = np.concatenate([items[q] for q in rest[at]])
                    place = np.minimum(np.searchsorted(mine, joined), len(mine) - 1)
                    first = np.concatenate([[0], np.cumsum(n[rest[at]])[:-1]])
                    common = np.add.reduceat((mine[place] == joined).astype(np.int64), first)
                    out[at] = 100 * common >= similarity * (n[p] + n[rest[at]] - common)
                return out

            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1), len(key)]
            us, vs = [], []
            for a, b in zip(cuts, cuts[1:]):
                for p, found in _spread(np.arange(a, b), links):
                    us += [int(ids[p])] * len(found)
                    vs += ids[found].tolist()
            if us:
                out = forest.batch(us, vs)
                if out is not None:
                    yield out

    return run


def _in_blocks(rows: DataFrame, key: str, blocks: Column) -> DataFrame:
    """Adds ``key``: each pair of the ``blocks`` parts of a group meets under one of its values."""
    part = F.pmod(F.xxhash64(F.lit(7), F.col("id")), blocks)
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), blocks - 1),
        lambda other: F.struct(F.least(part, other).alias("i"), F.greatest(part, other).alias("j")),
    )
    return rows.withColumn("pair", F.explode(pairs)).withColumn(
        "key", F.xxhash64(F.col(key), F.col("pair.i"), F.col("pair.j"))
    ).drop("pair")


def _by_key(rows: DataFrame) -> DataFrame:
    return rows.repartition(F.col("key")).sortWithinPartitions("key")


def _most_frequent(frequent: DataFrame, most: int = FREQUENT) -> DataFrame:
    """The upper levels of frequency, as many as hold at most ``most`` shingles in all."""
    total, lowest = 0, None
    for level, count in sorted(map(tuple, frequent.groupBy("level").count().collect()), reverse=True):
        total += count
        if total > most:
            break
        lowest = level
    return frequent.where(F.lit(False) if lowest is None else F.col("level") >= lowest).select("token")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       similarity: int = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles`` and ``component_id``."""
    if not 50 <= similarity <= 100:
        raise ValueError("similarity must lie between 50 and 100 hundredths")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    points = stage(docs.mapInArrow(_points, "id long, n long, k1 long, k2 long, vec binary"), "points")
    known = points.where("n > 0 AND id IS NOT NULL")
    # Written, so that the join sees a plain table and Spark can split a large group of copies.
    groups = stage(
        known.groupBy("k1", "k2", "n").agg(F.min("id").alias("rep"), F.count("*").alias("c")).where("c > 1"),
        "groups",
    )
    copies = stage(
        known.select("id", "k1", "k2", "n").join(groups, ["k1", "k2", "n"]).where("id <> rep")
        .select(F.col("rep").alias("u"), F.col("id").alias("v")).distinct(),
        "copies",
    )
    # Only one text of each set goes on; ids that stand for several texts go on with all of them.
    several = known.groupBy("id").agg(F.countDistinct("k1", "k2", "n").alias("c")).where("c > 1")
    gone = copies.select(F.col("v").alias("id")).join(several, "id", "left_anti")
    reps = docs.where("id IS NOT NULL").join(gone, "id", "left_anti")

    frequent = stage(
        reps.mapInArrow(_local_repeats, "token long, n long").groupBy("token")
        .agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_FROM)
        .select("token", F.floor(8 * F.log2("n")).alias("level")),
        "frequent",
    )
    often = np.sort(_most_frequent(frequent).toPandas()["token"].to_numpy(np.int64).view(np.uint64))

    entries = reps.mapInArrow(_entries(often, similarity), "token long, id long")
    shared = entries.withColumn("c", F.count("*").over(W.partitionBy("token"))).where("c > 1")
    vectors = known.join(gone, "id", "left_anti").select("id", "n", "vec")
    met = _in_blocks(shared.join(vectors, "id"), "token", F.expr(f"(c + {ENTRY_POINTS} - 1) div {ENTRY_POINTS}"))
    ties = _by_key(met.select("key", "id", "n", "vec")).mapInArrow(_tie(similarity), "u long, v long")
    clusters = stage(
        connected_components(ties).select(F.col("node").alias("id"), F.col("component").alias("cluster")),
        "clusters",
    )

    sizes = clusters.join(vectors, "id").groupBy("cluster").agg(
        F.greatest(
            F.expr(f"(count(*) + {BLOCK_POINTS} - 1) div {BLOCK_POINTS}"),
            F.expr(f"(sum(n) + {BLOCK_SHINGLES} - 1) div {BLOCK_SHINGLES}"),
        ).alias("blocks")
    )
    leaves = reps.join(clusters, "id").select("id", "text", "cluster").mapInArrow(
        _leaf_rows, "id long, cluster long, n long, vec binary, items binary"
    )
    leaves = _in_blocks(leaves.join(sizes, "cluster"), "cluster", F.col("blocks"))
    links = _by_key(leaves.select("key", "id", "n", "vec", "items")).mapInArrow(
        _verify(similarity), "u long, v long"
    )
    linked = connected_components(links.unionByName(copies))
    return points.join(linked, points["id"] == linked["node"], "left").select(
        points["id"].alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", points["id"]).alias("component_id"),
    )


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           similarity: int = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, with all their columns.

    Rows without an id stay. Of rows that share an id and a text, all stay: exact dedup is theirs.
    """
    found = jaccard_components(docs.select(id_col, text_col), id_col, text_col, similarity)
    gone = found.where(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("__gone")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
