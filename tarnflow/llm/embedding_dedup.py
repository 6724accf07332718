"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

On a bounded sample, iterative quantisation learns rotations whose signs are balanced binary codes
(after a projection on principal components; further rotations start elsewhere and give further
bits). Every vector is then entered into tables that each index some of its bits. Vectors that agree
in a table's bits meet in its bucket, and the original vectors decide: cosine in double precision
at or above the threshold. Bits per table follow from the number of vectors, so that a bucket holds
few strangers; the number of tables follows from the chance that a pair at the threshold shares a
table under the learned, centred planes. It is counted on sample vectors that are moved to the threshold,
at random, towards each other and around the mean, so that hardly any is missed (``MISS``), also where all lie to one side.

Equal vectors are entered once, with their count. A pair counts in the first table it meets in.
Large buckets are split into parts, and every two parts meet, so no bucket is capped and none lies
in one task; sums and a forest of links leave a task, never its pairs.

Vectors that are null, of length zero, or hold null or non-finite components link with nothing; so
do rows without an id. Vectors of equal length are compared, each length under codes of its own; where
a length is rare, all its vectors meet. Rows that share an id are one node, but each row counts as a
vector. A cosine right at the threshold links. Vectors may be long: the sample is bounded in bytes, and
entries go in batches of bounded size. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnflow.llm.common import bounded_sample, stage, whole_runs
from tarnflow.llm.components import connected_components
from tarnflow.llm.ngram_join import _spread

COSINE = 0.95
SAMPLE = 20_000
#: Bytes of a sample of long vectors, of which fewer are taken.
SAMPLE_BYTES = 1 << 26
#: Share of pairs right at the threshold that the tables may miss; closer pairs are missed less.
MISS = 0.003
BUCKET = 32
#: With more tables than this, buckets get larger instead.
MOST_TABLES = 400
#: Vectors of a length with this many at most need no codes: all of them meet.
FEW = 1024
#: Bytes that a batch of entries may take.
ENTERED = 1 << 24
BLOCK = 1024


@dataclass
class Codes:
    """``sign((x / |x| - mean) @ planes)``, cut into ``tables`` keys of ``bits`` bits."""

    mean: np.ndarray
    planes: np.ndarray
    tables: int
    bits: int

    def keys(self, unit: np.ndarray) -> np.ndarray:
        signs = ((unit - self.mean) @ self.planes) >= 0
        weights = (1 << np.arange(self.bits)).astype(np.int64)
        return signs.reshape(len(unit), self.tables, self.bits).astype(np.int64) @ weights


def table_shape(n: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(tables, bits) for ``n`` vectors."""
    bits = min(24, max(6, math.ceil(math.log2(max(1, n) / BUCKET))))
    keep = (1 - math.acos(cosine) / math.pi) ** bits
    return math.ceil(math.log(miss) / math.log(1 - keep)), bits


def _moved(unit: np.ndarray, mean: np.ndarray, cosine: float, rng: np.random.Generator) -> list[np.ndarray]:
    """``unit`` at ``cosine`` from where it was: in random directions, towards others, around the mean."""
    out = []
    for step in (rng.normal(size=unit.shape), unit[rng.permutation(len(unit))]):
        step = step - (step * unit).sum(axis=1, keepdims=True) * unit
        size = np.linalg.norm(step, axis=1, keepdims=True)
        # (what stands at the vector itself, or has no other direction, stays)
        moved = cosine * unit + math.sqrt(1 - cosine**2) * step / np.maximum(size, 1e-12)
        out.append(np.where(size > 1e-9, moved, unit))
    rest = unit - mean
    far = np.maximum(np.linalg.norm(rest, axis=1, keepdims=True), 1e-12)
    rest, step = rest / far, rng.normal(size=unit.shape)
    step -= (step @ mean)[:, None] * mean / max(mean @ mean, 1e-12)
    step -= (step * rest).sum(axis=1, keepdims=True) * rest
    step /= np.maximum(np.linalg.norm(step, axis=1, keepdims=True), 1e-12)
    turned = np.maximum(1 - (1 - cosine) / far**2, -1)
    out.append(mean + far * (turned * rest + np.sqrt(1 - turned**2) * step))
    return out


def missed(codes: Codes, unit: np.ndarray, cosine: float, seed: int = 1) -> float:
    """Share of pairs at ``cosine`` that agree in no table, in the worst of three kinds of pairs."""
    rng, shares = np.random.default_rng(seed), []
    unit = unit[rng.permutation(len(unit))[:2000]]
    for moved in _moved(unit, codes.mean, cosine, rng):
        lost = 0
        for c in range(0, len(unit), 200):
            lost += (~(codes.keys(unit[c : c + 200]) == codes.keys(moved[c : c + 200])).any(axis=1)).sum()
        shares.append(lost / max(1, len(unit)))
    return max(shares)


def fitted_codes(sample: np.ndarray, n: int, cosine: float = COSINE, miss: float = MISS) -> Codes:
    """Codes with as many tables as ``missed`` asks for; ``table_shape`` gives the least."""
    tables, bits = table_shape(n, cosine, miss)
    # Counted on vectors that the planes were not fitted to, which lose more bits.
    held, fitted = sample[: len(sample) // 5], sample[len(sample) // 5 :]
    while True:
        codes = learn_codes(fitted, tables, bits)
        if missed(codes, held, cosine) <= miss:
            return codes
        tables = math.ceil(1.3 * tables)
        if tables > MOST_TABLES:
            # Fewer bits: larger buckets, whose pairs are all compared; none at all is brute force.
            tables, bits = table_shape(n, cosine, miss)[0], bits - 2
            if bits < 2:
                return learn_codes(sample, 1, 0)


def learn_codes(sample: np.ndarray, tables: int, bits: int, rounds: int = 25, seed: int = 0) -> Codes:
    """Iterative quantisation: alternate between codes and the rotation that fits them best."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    if not bits:
        return Codes(np.zeros(dim), np.zeros((dim, 0)), tables, 0)
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred + 1e-9 * np.eye(dim))
    z = centred @ axes
    planes = []
    while sum(p.shape[1] for p in planes) < tables * bits:
        rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        for _ in range(rounds):
            code = np.where(z @ rotation >= 0, 1.0, -1.0)
            u, _, vt = np.linalg.svd(z.T @ code)
            rotation = u @ vt
        planes.append((axes @ rotation)[:, rng.permutation(dim)])
    return Codes(mean, np.hstack(planes)[:, : tables * bits], tables, bits)


def _unit(raw: list[bytes], dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(-1, dim)
    # Scaled first, so that neither squares overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as bytes of doubles; others as null."""
    for batch in batches:
        out = []
        for v in batch.column("v").to_pylist():
            x = None if not v or any(c is None for c in v) else np.array(v, np.float64)
            usable = x is not None and np.isfinite(x).all() and x.any()
            out.append((x + 0.0).tobytes() if usable else None)
        yield pa.record_batch([batch.column("id"), pa.array(out, pa.binary())], ["id", "raw"])


def _enter(codes: Codes, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.arange(codes.tables, dtype=np.int64) << 32
        for whole in batches:
            step = max(1, min(512, ENTERED // (codes.tables * (8 * dim + 4 * codes.tables))))
            for start in range(0, len(whole), step):
                batch = whole.slice(start, step)
                raw = batch.column("raw").to_pylist()
                keys = codes.keys(_unit(raw, dim))
                at = np.repeat(np.arange(len(batch)), codes.tables)
                codes_raw = [k.astype(np.int32).tobytes() for k in keys]
                yield pa.record_batch(
                    [
                        pa.array((keys + table).ravel()),
                        batch.column("id").take(pa.array(at)), batch.column("n").take(pa.array(at)),
                        pa.array([raw[i] for i in at], pa.binary()),
                        pa.array([codes_raw[i] for i in at], pa.binary()),
                    ],
                    ["bucket", "id", "n", "raw", "codes"],
                )

    return run


def _rerank(cosine: float):
    """In each bucket: link counts by vector, and a forest of the links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, "key"):
            key = table.column("key").to_numpy()
            ids, n = table.column("id").to_numpy(), table.column("n").to_numpy()
            which = (table.column("bucket").to_numpy() >> 32).astype(int)
            part, own = table.column("part").to_numpy(), table.column("own").to_numpy()
            raw, signs = table.column("raw").to_pylist(), table.column("codes").to_pylist()
            length = np.array([len(x) for x in raw])
            place, units, codes_of = np.zeros(len(raw), int), {}, {}
            for d in np.unique(length).tolist():
                rows = np.flatnonzero(length == d)
                place[rows] = np.arange(len(rows))
                units[d] = _unit([raw[r] for r in rows], d // 8)
                codes_of[d] = np.frombuffer(b"".join(signs[r] for r in rows), np.int32).reshape(len(rows), -1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]) | (length[1:] != length[:-1])) + 1), len(key)]
            node, other, links = [], [], []
            for a, b in zip(cuts, cuts[1:]):
                if b - a < 2:
                    continue
                here = slice(place[a], place[a] + b - a)
                unit, codes = units[length[a]][here], codes_of[length[a]][here]
                near = unit @ unit.T >= cosine
                np.fill_diagonal(near, False)
                if not near.any():
                    continue
                # Two parts of a bucket: pairs inside a part count where it meets itself.
                if not own[a]:
                    near &= part[a:b, None] != part[None, a:b]
                i, j = np.nonzero(near)
                t = which[a]
                first = np.ones(len(i), bool)
                for c in range(0, len(i), 100_000):
                    s = slice(c, c + 100_000)
                    first[s] = ~(codes[i[s], :t] == codes[j[s], :t]).any(axis=1)
                count = np.bincount(i[first], weights=n[a + j[first]], minlength=b - a).astype(np.int64)
                for x in np.flatnonzero(count):
                    node.append(int(ids[a + x])), other.append(None), links.append(int(count[x]))
                for p, found in _spread(np.arange(b - a), lambda p, rest: near[p, rest]):
                    node += [int(ids[a + p])] * len(found)
                    other += ids[a + found].tolist()
                    links += [None] * len(found)
            if node:
                yield pa.record_batch(
                    [pa.array(node, pa.int64()), pa.array(other, pa.int64()), pa.array(links, pa.int64())],
                    ["u", "v", "links"],
                )

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    cosine: float = COSINE, sample: int = SAMPLE, miss: float = MISS) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links``, ``component_id``, ``kept``."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    points = stage(
        rows.mapInArrow(_vectors, "id long, raw binary").withColumns(
            {"h1": F.xxhash64(F.lit(1), "raw"), "h2": F.xxhash64(F.lit(2), "raw")}
        ),
        "vectors",
    )
    usable = points.where("raw IS NOT NULL AND id IS NOT NULL")
    distinct = stage(
        usable.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.min("raw").alias("raw")),
        "distinct",
    )
    lengths = {r["d"]: r["count"] for r in distinct.groupBy(F.length("raw").alias("d")).count().collect()}
    if not lengths:
        return _result(points.select("id", F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("component")), id_col)

    few = [d for d, count in lengths.items() if count <= FEW]
    alone = F.lit(np.zeros(1, np.int32).tobytes())
    entered = distinct.where(F.length("raw").isin(few)).select(
        F.lit(0).cast("long").alias("bucket"), "id", "n", "raw", alone.alias("codes")
    )
    for d, count in sorted(lengths.items()):
        if count <= FEW:
            continue
        own = distinct.where(F.length("raw") == d)
        most = max(1, min(sample, SAMPLE_BYTES // d))
        picked = bounded_sample(own, most, "h1", "h2").select("raw").toPandas()
        codes = fitted_codes(_unit([bytes(x) for x in picked["raw"]], d // 8), count, cosine, miss)
        entered = entered.unionByName(
            own.select("id", "n", "raw").mapInArrow(
                _enter(codes, d // 8), "bucket long, id long, n long, raw binary, codes binary"
            )
        )
    entered = entered.withColumn("d", F.length("raw"))
    large = stage(
        entered.groupBy("bucket", "d").agg(F.expr(f"(count(*) + {BLOCK} - 1) div {BLOCK}").alias("parts"))
        .where("parts > 1"),
        "large-buckets",
    )
    dealt = entered.join(large, ["bucket", "d"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64(F.lit(7), "id"), F.col("parts")))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    dealt = dealt.select(
        F.xxhash64("bucket", "d", F.least("part", "with"), F.greatest("part", "with"), F.lit(5)).alias("key"),
        "bucket", "id", "n", "raw", "codes", "part", F.lit(True).alias("own"), "with",
    ).withColumn("own", F.col("part") == F.col("with")).drop("with")
    found = stage(
        dealt.repartition(F.col("key")).sortWithinPartitions("key")
        .mapInArrow(_rerank(cosine), "u long, v long, links long"),
        "links",
    )
    copies = distinct.select("h1", "h2", F.col("id").alias("rep"), "n")
    members = usable.select("id", "h1", "h2").join(copies, ["h1", "h2"])
    edges = found.where("v IS NOT NULL").select("u", "v").unionByName(
        members.where("id <> rep").select(F.col("rep").alias("u"), F.col("id").alias("v"))
    )
    components = connected_components(edges)
    counts = found.where("links IS NOT NULL").groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("links"))
    sums = copies.join(counts, "rep", "left").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n")
    )
    linked = usable.select("id", "h1", "h2").join(sums, ["h1", "h2"]).select("id", "n")
    joined = linked.join(components, F.col("id") == F.col("node"), "left").select("id", "n", "component")
    rest = points.where("raw IS NULL OR id IS NULL").select(
        "id", F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("component")
    )
    return _result(joined.unionByName(rest), id_col)


def _result(rows: DataFrame, id_col: str) -> DataFrame:
    component = F.coalesce("component", "id")
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
