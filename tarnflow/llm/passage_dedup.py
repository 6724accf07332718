"""Substring dedup by paragraph MinHash banding.

Paragraphs are lines of ``LEAST_WORDS`` words or more. Lines of more than ``CUT`` words are also cut where the
hash of a three-word window is the smallest for ``REACH`` words around (and no longer taken whole from
``WHOLE`` words on), so that long lines that agree in part are cut alike. Each line is cut on its own: equal
lines give equal paragraphs. A paragraph's set holds its distinct five-word shingles.

Equal paragraphs are one. Each distinct one has ``BANDS`` keys of ``ROWS`` MinHash values: at a Jaccard
similarity of 0.75 two of them share a key with probability 1 - (1 - 0.75^2)^5 = 98.4 percent, and a phrase
that many paragraphs share makes few buckets. All paragraphs that collide are compared, by exact Jaccard of
their shingle sets (100 * intersection >= 75 * union), and linked ones form classes by connected components.
Large buckets are split into parts, and every two parts meet, so no bucket is capped and none lies in one
task; a forest of links leaves a task, never its pairs. Buckets with the same members are compared once.
The first occurrence of a class by (id, text hash, place) stays.

Exact repeats of ``LEAST_WORDS`` words or more are all found whole, wherever they lie: every window of so many
words has a designated seed, the run of ``SEED`` words in it with the smallest hash, and equal windows have
equal seeds. Only seeds (a sixth of the words) are counted over the corpus; windows are compared where
their seed occurs more than once, each with the first text that holds it. Exact copies of a whole text
are told by its hash and take no part in that.

Stretches that touch or overlap are merged, and a merged stretch of ``LEAST_WORDS`` words or more is a removal.
A word is removed only if it lies in a paragraph that is near an earlier one or in an exact repeat.

Texts that are null or have fewer words than that have no paragraphs; rows without an id are left alone.
Rows that share an id and a text count as one document; texts that share an id are told apart by
their hash. Words are compared with A-Z lower-cased. Places are code points, end exclusive. Empty tables
give empty results; other columns travel along. A text, and the occurrences of a paragraph, set no limit:
counts are combined before the shuffle, and occurrences are joined as written tables, which Spark splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tarnflow.llm.common import scratch_path, slices, stage, unstage, whole_runs
from tarnflow.llm.components import connected_components
from tarnflow.llm.ngram_join import _by_key, _Forest, _in_blocks, _spread
from tarnflow.llm.text_arrays import column_bytes, mix, shingles, words
from tarnflow.sources.storage import delete_path

SIMILARITY = 75
LEAST_WORDS = 20
#: Anchors lie 61 words apart on average.
REACH = 30
CUT, WHOLE = 100, 150
BANDS, ROWS = 5, 2
SEED = 10
#: Occurrences of a seed that are compared in one piece of work; a seed of more is dealt into several, which
#: first agree on the first place of each window.
SHARE = 512
#: Size of the filter of ids that are wanted; bounds what is broadcast to ``CELLS`` / 64 pairs of numbers.
CELLS = 1 << 25
#: Most paragraphs of a bucket in one part.
BLOCK = 512
_SEEDS = np.random.default_rng(5).integers(1, 2**62, BANDS * ROWS, dtype=np.uint64)
_MULTIPLIER = 0x9E3779B97F4A7C15


def _sliding_min(values: np.ndarray, first: int, last: int) -> np.ndarray:
    """The minimum of ``values[i + first]`` to ``values[i + last]``, for every i; by doubling."""
    reach = max(abs(first), abs(last))
    edge = np.full(reach, 2**64 - 1, np.uint64)
    least = np.concatenate([edge, values, edge])[reach + first : reach + len(values) + last]
    width, wanted = 1, last - first + 1
    while width < wanted:
        step = min(width, wanted - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    return least


class Words:
    """The words of a text column: hashes, texts, and places in code points."""

    def __init__(self, column: pa.Array):
        data, places = column_bytes(column)
        self.hashed, self.text, start, end = words(data, places)
        self.first = np.searchsorted(self.text, np.arange(len(column) + 1))
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        base = points[places[:-1]][self.text] if len(self.text) else np.zeros(0, np.int64)
        self.start, self.end = points[start] - base, points[end] - base
        lines = np.concatenate([[0], np.cumsum(data == 10)])
        self.new_line = np.ones(len(self.hashed), bool)
        if len(self.hashed):
            self.new_line[1:] = (self.text[1:] != self.text[:-1]) | (lines[start[1:]] != lines[end[:-1]])


def _anchors(w: Words) -> np.ndarray:
    """Where the hash of a three-word window is the smallest for REACH words around, inside the line.

    Windows that reach past a line's end are none, and lines are set apart, so that equal lines are cut
    alike wherever they stand. (The leftmost of equals, so that one word again and again stays whole.)
    """
    hashed, m, none = w.hashed, len(w.hashed), np.uint64(2**64 - 1)
    line = np.cumsum(w.new_line) - 1
    window = mix(hashed + np.roll(hashed, -1) * np.uint64(3) + np.roll(hashed, -2) * np.uint64(7))
    window[line != np.append(line[2:], [-1, -1])[:m]] = none
    apart = np.arange(m) + REACH * line
    spaced = np.full(apart[-1] + 1, none)
    spaced[apart] = window
    least = (window < _sliding_min(spaced, -REACH, -1)[apart]) & (window <= _sliding_min(spaced, 1, REACH)[apart])
    return least & (window != none)


def _cut(w: Words, least_words: int = LEAST_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words, counts of words, and hashes of the paragraphs of all texts."""
    m = len(w.hashed)
    if not m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    lines = np.append(np.flatnonzero(w.new_line), m)
    begin, count = lines[:-1], np.diff(lines)
    whole = (count >= least_words) & (count < WHOLE)
    begin, count = begin[whole], count[whole]
    if (np.diff(lines) > CUT).any():
        cuts = np.append(np.flatnonzero(w.new_line | _anchors(w)), m)
        size = np.repeat(np.diff(lines), np.diff(lines))[cuts[:-1]]
        pieces = (np.diff(cuts) >= least_words) & (size > CUT)
        begin, count = np.append(begin, cuts[:-1][pieces]), np.append(count, np.diff(cuts)[pieces])
    # A polynomial over the words of a paragraph, taken from running sums with running powers.
    power = np.full(m + 1, _MULTIPLIER, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    inverse = np.full(m + 1, pow(_MULTIPLIER, -1, 2**64), np.uint64)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    sums = np.zeros(m + 1, np.uint64)
    np.cumsum(mix(w.hashed) * power[:m], out=sums[1:])
    return begin, count, mix((sums[begin + count] - sums[begin]) * inverse[begin] + count.astype(np.uint64))


def paragraphs(column: pa.Array, least_words: int = LEAST_WORDS):
    """``(text, first word, words, start, end, hash)`` of the paragraphs of each text, and the words."""
    w = Words(column)
    begin, count, key = _cut(w, least_words)
    owner = w.text[begin]
    return (owner, begin - w.first[owner], count, w.start[begin], w.end[begin + count - 1], key), w


def _grams(w: Words) -> np.ndarray:
    """The hash of every ``SEED`` words in a row, over all texts together."""
    n = max(0, len(w.hashed) - SEED + 1)
    mixed, value = mix(w.hashed), np.zeros(n, np.uint64)
    for j in range(SEED):
        value = value * np.uint64(0xD1342543DE82EF95) + mixed[j : j + n]
    return mix(value)


def windows(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of all windows, where the designated seed of each begins, and the hashes of seeds."""
    wide, value = LEAST_WORDS - SEED + 1, _grams(w)
    if len(value) < wide:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), value
    at = np.flatnonzero(w.text[: len(value) - wide + 1] == w.text[LEAST_WORDS - 1 :])
    seed = np.empty(len(at), np.int64)
    view = np.lib.stride_tricks.sliding_window_view(value, wide)
    for c in range(0, len(at), 1 << 14):
        part = at[c : c + (1 << 14)]
        seed[c : c + (1 << 14)] = part + view[part].argmin(axis=1)
    return at, seed, value


def seeds(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the designated seeds of all windows."""
    _, seed, value = windows(w)
    begin = np.unique(seed)
    # One word again and again would give a seed at every place: of such runs, one a window will do.
    run = np.ones(len(begin), bool)
    run[1:] = (value[begin[1:]] != value[begin[:-1]]) | (np.diff(begin) != 1)
    since = np.arange(len(begin)) - np.maximum.accumulate(np.where(run, np.arange(len(begin)), 0))
    begin = begin[since % (LEAST_WORDS - SEED + 1) == 0]
    return begin, value[begin]


def _shingles_of(hashed: np.ndarray, begin: np.ndarray, count: np.ndarray):
    """Shingles of paragraphs given by their words' places in ``hashed``: ``(hash, paragraph)``."""
    owner = np.repeat(np.arange(len(begin)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
    return shingles(hashed[at], owner, len(begin), 5)


def _lists(values: np.ndarray, sizes) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


UNITS = "id long, h long, key long, place int, n int, start int, end int, bands array<long>"


def _units(least_words: int):
    """Seeds (0), paragraphs (1) and whole texts (2), apart; seeds without ``place`` and what follows."""
    names = [c.split()[0] for c in UNITS.split(", ")]
    types = [pa.int64()] * 3 + [pa.int32()] * 4 + [pa.list_(pa.int64())]

    def batch(part, kind, text, key, *more):
        owner = pa.array(text)
        columns = [part.column("id").take(owner), part.column("h").take(owner), pa.array(key.view(np.int64))]
        columns += [pa.array(c.astype(np.int32)) if isinstance(c, np.ndarray) else c for c in more]
        columns += [pa.nulls(len(text), t) for t in types[len(columns) :]]
        return pa.record_batch([*columns, pa.array(np.full(len(text), kind, np.int32))], [*names, "kind"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 20):
            w = Words(part.column("text"))
            begin, key = seeds(w)
            yield batch(part, 0, w.text[begin], key)
            full = np.flatnonzero(np.diff(w.first))
            if not len(full):
                continue
            # Told by a second hash too, over the words and their places.
            count = np.diff(w.first)[full]
            place = (np.arange(len(w.hashed)) - np.repeat(w.first[full], count)).astype(np.uint64)
            key = np.add.reduceat(mix(w.hashed + place * np.uint64(_MULTIPLIER)), w.first[full])
            zero = np.zeros(len(full), np.int64)
            yield batch(part, 2, full, key, zero, count, w.start[w.first[full]], w.end[w.first[full + 1] - 1])
            begin, count, key = _cut(w, least_words)
            if not len(key):
                continue
            full, of = _shingles_of(w.hashed, begin, count)
            cuts = np.searchsorted(of, np.arange(len(key)))
            bands = np.empty((len(key), BANDS), np.uint64)
            for b in range(BANDS):
                band = np.full(len(key), b + 1, np.uint64)
                for r in range(ROWS):
                    band = mix(band * np.uint64(31) + np.minimum.reduceat(mix(full ^ _SEEDS[b * ROWS + r]), cuts))
                bands[:, b] = band
            owner = w.text[begin]
            yield batch(
                part, 1, owner, key, begin - w.first[owner], count, w.start[begin], w.end[begin + count - 1],
                _lists(bands.reshape(-1).view(np.int64), np.full(len(key), BANDS)),
            )

    return run


LOOKED_UP = (
    "id long, h long, parts int, key long, at int, windows array<long>, starts array<int>, ends array<int>,"
    " items array<int>"
)


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is wanted of each text: the windows of seeds, in a row per place of a seed, and shingle sets."""
    names = [c.split()[0] for c in LOOKED_UP.replace(", ", ",").split(",")]
    none = pa.list_(pa.int32())

    def flat(part, column):
        lists = part.column(column)
        sizes = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
        return np.repeat(np.arange(len(part)), sizes), lists.flatten()

    for part in slices(batches, "text", 1 << 20):
        w = Words(part.column("text"))
        ids = [part.column(c) for c in ("id", "h")]
        owner, wanted = flat(part, "seeds")
        at, seed, value = windows(w)
        if len(owner) and len(at):
            # A seed of a text as one number, and which of the windows have a wanted one.
            text = mix(np.arange(1, len(part) + 1, dtype=np.uint64))
            keys = wanted.field("key").to_numpy().view(np.uint64) ^ text[owner]
            order = np.argsort(keys)
            keys, parts = keys[order], wanted.field("parts").to_numpy()[order]
            mine = value[seed] ^ text[w.text[at]]
            place = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
            hit = np.flatnonzero(keys[place] == mine)
            at, seed, parts = at[hit], seed[hit], parts[place[hit]]
            new = np.ones(len(at), bool)
            # (one word again and again has a seed at every place, all alike)
            new[1:] = (value[seed[1:]] != value[seed[:-1]]) | (np.diff(at) != 1)
            first = np.flatnonzero(new)
            sizes = np.diff(np.append(first, len(at)))
            whole = mix(value[at] * np.uint64(_MULTIPLIER) + value[at + LEAST_WORDS - SEED])
            own = pa.array(w.text[at[first]])
            yield pa.record_batch(
                [
                    *(c.take(own) for c in ids), pa.array(parts[first]), pa.array(value[seed[first]].view(np.int64)),
                    pa.array((at[first] - w.first[w.text[at[first]]]).astype(np.int32)),
                    _lists(whole.view(np.int64), sizes), _lists(w.start[at].astype(np.int32), sizes),
                    _lists(w.end[at + LEAST_WORDS - 1].astype(np.int32), sizes), pa.nulls(len(first), none),
                ],
                names,
            )
        owner, wanted = flat(part, "sets")
        if len(owner):
            count = wanted.field("n").to_numpy().astype(np.int64)
            full, of = _shingles_of(w.hashed, w.first[owner] + wanted.field("place").to_numpy(), count)
            small = (full >> np.uint64(32)).astype(np.uint32).view(np.int32)
            order = np.lexsort((small, of))
            small, of = small[order], of[order]
            new = np.ones(len(of), bool)
            new[1:] = (small[1:] != small[:-1]) | (of[1:] != of[:-1])
            yield pa.record_batch(
                [
                    *(c.take(pa.array(owner)) for c in ids), pa.nulls(len(owner), pa.int32()), wanted.field("key"),
                    pa.nulls(len(owner), pa.int32()), pa.nulls(len(owner), pa.list_(pa.int64())),
                    pa.nulls(len(owner), none), pa.nulls(len(owner), none),
                    _lists(small[new], np.bincount(of[new], minlength=len(owner))),
                ],
                names,
            )


SPANS = "id long, h long, begin int, till int, start int, end int, keep_id long"


class _Windows:
    """All windows of rows that come sorted by key, with the first place of each window of a key."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        lists = [table.column(c).combine_chunks() for c in ("windows", "starts", "ends")]
        lists = [x if isinstance(x, pa.Array) else pa.concat_arrays(x.chunks) for x in lists]
        sizes = lists[0].value_lengths().to_numpy().astype(np.int64)
        self.window, self.start, self.end = (x.flatten().to_numpy() for x in lists)
        self.row = np.repeat(np.arange(len(sizes)), sizes)
        self.ids, self.h, key, at = (table.column(c).to_numpy()[self.row] for c in ("id", "h", "key", "at"))
        self.at = at + np.arange(len(self.row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        order = np.lexsort((self.at, self.h, self.ids, self.window, key))
        new = np.ones(len(order), bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (self.window[order][1:] != self.window[order][:-1])
        self.firsts = order[new]
        self.kept = np.empty(len(order), np.int64)
        self.kept[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]


FIRSTS = "key long, seed long, window long, id long, h long, place int"


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first place of each window of a key."""
    for table in whole_runs(batches, "key"):
        w = _Windows(table)
        f = w.firsts
        rows = pa.array(w.row[f])
        yield pa.record_batch(
            [
                *(table.column(c).combine_chunks().take(rows) for c in ("key", "seed")), pa.array(w.window[f]),
                pa.array(w.ids[f]), pa.array(w.h[f]), pa.array(w.at[f].astype(np.int32)),
            ],
            [c.split()[0] for c in FIRSTS.split(", ")],
        )


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that an earlier place holds too, those side by side as one."""
    for table in whole_runs(batches, "key"):
        w = _Windows(table)
        ids, at, kept = w.ids, w.at, w.kept
        later = np.flatnonzero((ids != ids[kept]) | (w.h != w.h[kept]) | (at >= at[kept] + LEAST_WORDS))
        if not len(later):
            continue
        stays = ids[kept[later]]
        new = np.ones(len(later), bool)
        new[1:] = (np.diff(later) != 1) | (w.row[later[1:]] != w.row[later[:-1]]) | (stays[1:] != stays[:-1])
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(later)) - 1
        yield pa.record_batch(
            [
                pa.array(ids[later[a]]), pa.array(w.h[later[a]]), pa.array(at[later[a]].astype(np.int32)),
                pa.array((at[later[b]] + LEAST_WORDS).astype(np.int32)), pa.array(w.start[later[a]]),
                pa.array(w.end[later[b]]), pa.array(stays[a]),
            ],
            [c.split()[0] for c in SPANS.split(", ")],
        )


def _common(items: np.ndarray, first: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many items each of the sets ``a`` shares with its partner in ``b``."""
    which, at = [], []
    for side in (a, b):
        count = n[side]
        which.append(np.repeat(np.arange(len(side)), count))
        at.append(np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[side], count))
    pair, found = np.concatenate(which), items[np.concatenate(at)]
    order = np.lexsort((found, pair))
    pair, found = pair[order], found[order]
    same = (pair[1:] == pair[:-1]) & (found[1:] == found[:-1])
    return np.bincount(pair[1:][same], minlength=len(a))


def _verify(similarity: int):
    """In each block of a bucket, a forest over the paragraphs that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()
        for table in whole_runs(batches, "key"):
            key, ids = table.column("key").to_numpy(), table.column("id").to_numpy()
            sets = table.column("items").combine_chunks()
            sets = sets if isinstance(sets, pa.Array) else pa.concat_arrays(sets.chunks)
            items = sets.flatten().to_numpy()
            n = sets.value_lengths().to_numpy().astype(np.int64)
            first = np.cumsum(n) - n
            cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
            sizes = np.diff(cuts)
            run_size = np.repeat(sizes, sizes)
            us, vs = [], []
            # Small blocks all at once: rows that are d apart in the same block.
            for d in range(1, min(8, len(key))):
                a = np.flatnonzero((key[:-d] == key[d:]) & (run_size[:-d] <= 8))
                a = a[np.minimum(n[a], n[a + d]) * 100 >= similarity * np.maximum(n[a], n[a + d])]
                for c in range(0, len(a), 1 << 14):
                    x = a[c : c + (1 << 14)]
                    common = _common(items, first, n, x, x + d)
                    x = x[100 * common >= similarity * (n[x] + n[x + d] - common)]
                    us.append(ids[x])
                    vs.append(ids[x + d])
            for c in np.flatnonzero(sizes > 8):
                a, b = cuts[c], cuts[c + 1]
                values, place = np.unique(items[first[a] : first[b - 1] + n[b - 1]], return_inverse=True)
                mine, begin = np.zeros(len(values), bool), first[a:b] - first[a]
                size = n[a:b]

                def links(p, rest):
                    own = place[begin[p] : begin[p] + size[p]]
                    mine[own] = True
                    common = np.add.reduceat(mine[place].astype(np.int32), begin)[rest]
                    mine[own] = False
                    return 100 * common >= similarity * (size[p] + size[rest] - common)

                for p, found in _spread(np.arange(b - a), links):
                    us.append(np.full(len(found), ids[a + p]))
                    vs.append(ids[a + found])
            if us:
                u, v = np.concatenate(us), np.concatenate(vs)
                lo, hi = np.minimum(u, v), np.maximum(u, v)
                out = forest.batch(lo[lo != hi].tolist(), hi[lo != hi].tolist())
                if out is not None:
                    yield out

    return run


ME = ["id", "h"]


def _copies(units: DataFrame) -> DataFrame:
    """Spans of whole texts that a smaller id holds too."""
    texts = units.where("kind = 2").select("id", "h", "key", "n", "start", "end").distinct()
    first = texts.groupBy("h", "key").agg(F.min("id").alias("keep_id"), F.count("*").alias("c")).where("c > 1")
    return texts.join(stage(first, "texts"), ["h", "key"]).where("id > keep_id").select(
        "id", "h", F.lit(0).alias("begin"), F.col("n").alias("till"), "start", "end", "keep_id"
    )


def _repeated_seeds(units: DataFrame, copies: DataFrame) -> DataFrame:
    """``(id, h, key, parts)`` of seeds that occur more than once, copies of texts left out."""
    found = units.where("kind = 0").select("id", "h", "key")
    # Counted apart and written, so that the join sees plain tables and Spark can split a hot seed.
    often = stage(found.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "often")
    met = stage(found.join(often, "key").join(copies.select(*ME), ME, "left_anti"), "met")
    again = stage(met.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "again")
    parts = F.expr(f"cast((c + {SHARE} - 1) div {SHARE} AS int)")
    out = stage(met.join(again, "key").select(*ME, "key", parts.alias("parts")), "seeds")
    unstage(often, met, again)
    return out


def _likely(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` without most of those whose id is not in ``ids``; none whose id is goes.

    One bit per hash of an id, at most ``CELLS`` of them however many ids there are: it saves the shuffle of
    texts that nothing is wanted of, and with more ids than bits it saves none.
    """
    def cell() -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(CELLS))

    bits = stage(
        ids.select(cell().alias("cell")).groupBy(F.expr("cell div 64").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(cell % 64 AS int)))").alias("mask")),
        "bits",
    )
    return rows.withColumn("cell", cell()).withColumn("word", F.expr("cell div 64")).join(
        F.broadcast(bits), "word"
    ).where("getbit(mask, cast(cell % 64 AS int)) = 1").drop("word", "mask", "cell")


def _wanted_of(rows: DataFrame, seeds: DataFrame, sets: DataFrame) -> DataFrame:
    """The windows of ``seeds(id, h, key, parts)`` and the sets of ``sets(id, h, key, place, n)``."""
    seed, part = "struct<key:long,parts:int>", "struct<key:long,place:int,n:int>"
    wants = seeds.select(*ME, F.struct("key", "parts").alias("seed"), F.lit(None).cast(part).alias("part")).unionByName(
        sets.select(*ME, F.lit(None).cast(seed).alias("seed"), F.struct("key", "place", "n").alias("part"))
    )
    # Lists are no longer than their text.
    wanted = stage(
        wants.groupBy(*ME).agg(F.collect_set("seed").alias("seeds"), F.collect_list("part").alias("sets")), "wanted"
    )
    texts = _likely(rows, wanted.select("id")).join(wanted, ME)
    # (a row that repeats an id and a text is the same text)
    texts = texts.groupBy(*ME).agg(F.first("text").alias("text"), F.first("seeds").alias("seeds"), F.first("sets").alias("sets"))
    found = stage(texts.mapInArrow(_look_up, LOOKED_UP), "looked-up")
    unstage(wanted)
    return found


def _repeats(found: DataFrame) -> DataFrame:
    """Spans of windows that an earlier place holds too.

    The occurrences of a seed are dealt into its parts. Of a seed with several, each part gives the first
    place of each window; the first of those that several give joins the others, where it comes first again.
    """
    columns = ["key", "id", "h", "at", "windows", "starts", "ends"]
    dealt = found.where("items IS NULL").withColumn("seed", F.col("key")).withColumn(
        "key", F.xxhash64("seed", F.pmod(F.xxhash64(*ME), F.col("parts").cast("long")))
    )
    several = _by_key(dealt.where("parts > 1").select(*columns, "seed"))
    firsts = stage(several.mapInArrow(_firsts, FIRSTS), "firsts")
    place = F.struct("id", "h", "place")
    kept = firsts.groupBy("seed", "window").agg(F.min(place).alias("kept"), F.count("*").alias("n"))
    kept = stage(kept.where("n > 1"), "kept")  # what only one part holds is settled there
    none = F.array(F.lit(0))
    known = firsts.join(kept, ["seed", "window"]).where(place != F.col("kept")).select(
        "key", "kept.id", "kept.h", F.col("kept.place").alias("at"),
        F.array("window").alias("windows"), none.alias("starts"), none.alias("ends"),
    )
    return _by_key(dealt.select(*columns).unionByName(known)).mapInArrow(_later, SPANS)


def _colliding(units: DataFrame) -> DataFrame:
    """``(band, key)`` of distinct paragraphs that share a band; of buckets with the same members, one."""
    bands = units.where("kind = 1").select("key", F.explode("bands").alias("band"))
    crowds = stage(bands.groupBy("band").agg(F.count("*").alias("c")).where("c > 1").select("band"), "crowds")
    met = stage(bands.join(crowds, "band").select("band", "key").distinct(), "met")
    hashed = F.xxhash64("key")
    members = met.groupBy("band").agg(
        F.count("*").alias("c"), F.bit_xor("key").alias("x"), F.bit_xor(hashed).alias("y")
    ).where("c > 1")
    buckets = stage(members.groupBy("c", "x", "y").agg(F.min("band").alias("band")).select("band", "c"), "buckets")
    out = stage(met.join(buckets, "band").select("band", F.col("key").alias("id"), "c"), "colliding")
    unstage(crowds, met, buckets)
    return out


def _stretches(rows: DataFrame, similarity: int, least_words: int) -> DataFrame:
    """``(id, h, start, end, n_words, keep_id)`` of ``rows(id, h, text)``."""
    spark = rows.sparkSession
    path = scratch_path(spark, "units")
    rows.mapInArrow(_units(least_words), f"{UNITS}, kind int").write.partitionBy("kind").parquet(path)
    units = spark.read.schema(f"{UNITS}, kind int").parquet(path)

    copies = stage(_copies(units), "copies")
    seeds = _repeated_seeds(units, copies)
    colliding = _colliding(units)
    near = colliding.select(F.col("id").alias("key")).distinct()
    cut = units.where("kind = 1").select("key", "id", "h", "place", "n", "start", "end")
    again = cut.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    wanted = stage(near.unionByName(again).distinct(), "wanted")
    # From here on only paragraphs that occur twice or collide.
    occurrences = stage(cut.join(wanted, "key"), "occurrences")
    delete_path(spark, path)
    place = F.struct("id", "h", "place", "n")
    first = stage(occurrences.groupBy("key").agg(F.min(place).alias("first")), "first")
    sets = first.join(near, "key").select("first.id", "first.h", "key", "first.place", "first.n")
    found = _wanted_of(rows, seeds, sets)
    unstage(seeds)
    exact = stage(_repeats(found), "exact")
    found = found.where("items IS NOT NULL").select("key", "items")

    known = found.groupBy(F.col("key").alias("id")).agg(F.min("items").alias("items"))
    blocks = _in_blocks(
        colliding.join(stage(known, "sets"), "id"), "band", F.expr(f"(c + {BLOCK} - 1) div {BLOCK}")
    )
    linked = _by_key(blocks.select("key", "id", "items")).mapInArrow(_verify(similarity), "u long, v long")
    classes = connected_components(linked)
    classed = first.join(classes, F.col("key") == F.col("node"), "left").select(
        "key", "first", F.coalesce("component", "key").alias("class")
    )
    kept = classed.groupBy("class").agg(F.min("first").alias("kept"))
    # Written, so that the join sees a plain table and Spark can split a frequent paragraph.
    repeated = stage(classed.join(kept, "class").select("key", "kept"), "repeated")
    later = (
        occurrences.join(repeated, "key").where(place != F.col("kept"))
        .where("id <> kept.id OR h <> kept.h OR place >= kept.place + kept.n")
        .select(
            *ME, F.col("place").alias("begin"), F.expr("place + n").alias("till"), "start", "end",
            F.col("kept.id").alias("keep_id"),
        )
    )
    later = later.unionByName(exact).unionByName(copies)
    order = W.partitionBy(*ME).orderBy("begin", "till", "keep_id")
    before = F.max("till").over(order.rowsBetween(W.unboundedPreceding, -1))
    runs = later.withColumn("new", F.coalesce(F.col("begin") > before, F.lit(True)).cast("int"))
    runs = runs.withColumn("fresh", F.greatest(F.lit(0), F.col("till") - F.greatest("begin", before)))
    runs = runs.withColumn("run", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return (
        runs.groupBy(*ME, "run")
        .agg(
            F.min("start").alias("start"), F.max("end").alias("end"),
            F.sum("fresh").alias("n_words"),
            F.max(F.struct((F.col("till") - F.col("begin")).alias("n"), (-F.col("keep_id")).alias("of"))).alias("longest"),
        )
        .where(F.col("n_words") >= least_words)
        .select(*ME, "start", "end", "n_words", (-F.col("longest.of")).alias("keep_id"))
    )


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.where("id IS NOT NULL AND text IS NOT NULL").select("id", F.xxhash64("text").alias("h"), "text")


def repeated_stretches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       similarity: int = SIMILARITY, least_words: int = LEAST_WORDS) -> DataFrame:
    """``(id, start, end, n_words, keep_id)``: stretches to remove, and where their first one stays.

    ``keep_id`` is the id that holds the first occurrence of its longest part (the smallest of these). With a larger
    ``least_words`` than ``LEAST_WORDS`` shorter stretches stay; with a smaller one shorter paragraphs go
    too, and of shorter exact repeats those that a seed happens to find.
    """
    found = _stretches(_rows(docs, id_col, text_col), similarity, least_words)
    return found.select(F.col("id").alias(id_col), "start", "end", "n_words", "keep_id")


def remove_stretches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     similarity: int = SIMILARITY, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with the repeated stretches cut out of their texts."""
    from tarnflow.llm.secret_scan import redacted

    span = F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    spans = (
        _stretches(_rows(docs, id_col, text_col), similarity, least_words)
        .groupBy(F.col("id").alias("__id"), F.col("h").alias("__h"))
        .agg(F.sort_array(F.collect_list(span)).alias("__spans"))
    )
    columns = docs.columns
    joined = docs.join(spans, (F.col(id_col) == F.col("__id")) & (F.xxhash64(F.col(text_col)) == F.col("__h")), "left")
    text = F.when(F.col("__spans").isNotNull(), redacted(F.col(text_col), F.col("__spans"), ""))
    return joined.select(
        *[F.coalesce(text, F.col(c)).alias(c) if c == text_col else F.col(f"`{c}`") for c in columns]
    )
