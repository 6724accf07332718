"""Packing token sequences with Karmarkar-Karp multiway differencing.

A document's ids are followed by an end id. Its full windows are cut off first; what is left is
cut into pieces of at most ``PIECE`` ids, small enough to balance. Pieces are dealt evenly to
groups of about ``GROUP_WINDOWS`` windows. In a group, each piece starts as a partition of its own
(one filled window, the rest empty); the two partitions with the largest imbalance are merged, the
fullest window of one on the emptiest of the other, until one is left. The number of windows starts
at the least that could hold the tokens and rises until no window exceeds the capacity.

A null or empty text is one piece with just the end id. Rows that repeat, also with null ids, are
packed each. Texts of any length are fine: a text's windows come out one by one. An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnflow.llm.common import slices, stage

CAPACITY = 2048
PIECE = 512
GROUP_WINDOWS = 192
END_ID = 1
VOCABULARY = "byte_bpe_50k"


@functools.lru_cache(maxsize=2)
def tokenizer(vocabulary: str = VOCABULARY):
    """``text -> ids`` of the tokenizers file of that name.

    The same vocabulary is also there as ranks, which another library encodes four times faster
    to the same ids (a test compares them). It knows no special tokens, so a text that holds one
    of their strings goes through the tokenizers library itself.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    special = [t.content for t in exact.get_added_tokens_decoder().values()]
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(
        vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return fast.encode_to_numpy(text)

    return encode


def cut_points(n: int, capacity: int = CAPACITY, piece: int = PIECE) -> list[int]:
    """Ends of a document's pieces: full windows, then equal parts of at most ``piece`` ids."""
    full = n // capacity
    ends = [capacity * (i + 1) for i in range(full)]
    rest = n - full * capacity
    parts = -(-rest // piece)
    return ends + [full * capacity + rest * (i + 1) // parts for i in range(parts)]


def _pieces(vocabulary: str, capacity: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(vocabulary)
        row = 0
        for part in slices(batches, "text"):
            out: list[tuple] = []
            for doc_id, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                ids = np.append(encode(text or ""), END_ID).astype("<u4")
                start = 0
                for end in cut_points(len(ids), capacity, piece):
                    out.append((doc_id, start, end - start, zlib.crc32(ids[start:end].tobytes()), len(ids), row))
                    start, row = end, row + 1
            columns = zip(*out)
            yield pa.record_batch(
                [pa.array(c, pa.int64()) for c in columns],
                ["id", "start", "length", "ids_crc32", "doc_tokens", "salt"],
            )

    return run


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: ``sizes`` over ``windows`` windows, as lists of positions in ``sizes``."""
    children: list[tuple[int, int]] = []  # node -> the two nodes it joins, for nodes past the items
    n = len(sizes)
    heap = []
    for i, size in enumerate(sizes):
        sums, nodes = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
        sums[0], nodes[0] = size, i
        heap.append((-size if windows > 1 else 0, i, sums, nodes))
    heapq.heapify(heap)
    order = n
    while len(heap) > 1:
        _, _, a, a_nodes = heapq.heappop(heap)
        _, _, b, b_nodes = heapq.heappop(heap)
        b, b_nodes = b[::-1], b_nodes[::-1]  # both fullest first: opposing imbalances meet
        nodes = np.where(a_nodes < 0, b_nodes, a_nodes)
        both = np.flatnonzero((a_nodes >= 0) & (b_nodes >= 0))
        nodes[both] = n + len(children) + np.arange(len(both))
        children.extend(zip(a_nodes[both].tolist(), b_nodes[both].tolist()))
        sums = a + b
        rank = np.argsort(-sums, kind="stable")
        sums, nodes = sums[rank], nodes[rank]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), order, sums, nodes))
        order += 1
    out = []
    for node in heap[0][3].tolist() if heap else []:
        items, todo = [], [node] if node >= 0 else []
        while todo:
            x = todo.pop()
            if x < n:
                items.append(x)
            else:
                todo.extend(children[x - n])
        out.append(sorted(items))
    return out


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of at most ``capacity``, near-equal; more of them whenever one would overflow."""
    if not sizes:
        return []
    if max(sizes) > capacity:
        raise ValueError("a piece exceeds the capacity")
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        packed = differencing(sizes, windows)
        if all(sum(sizes[i] for i in items) <= capacity for items in packed):
            return [items for items in packed if items]
        windows += 1


def _pack_group(capacity: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        whole = (group["length"] == capacity).to_numpy()
        rest = group[~whole]
        packed = pack(rest["length"].tolist(), capacity)
        lengths = rest["length"].to_numpy()
        sequence, offset = np.zeros(len(rest), np.int64), np.zeros(len(rest), np.int64)
        for i, items in enumerate(packed):
            sequence[items] = i
            offset[items] = np.concatenate([[0], np.cumsum(lengths[items])[:-1]])
        own = np.arange(whole.sum()) + len(packed)
        out = pd.concat(
            [rest.assign(sequence=sequence, offset=offset), group[whole].assign(sequence=own, offset=0)]
        )
        out["sequence_id"] = out["part"] * (1 << 32) + out["sequence"]
        return out[["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    return run


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   vocabulary: str = VOCABULARY, capacity: int = CAPACITY, piece: int = PIECE,
                   group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """One row per piece: id, ``start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Tokens are made and hashed where the text is read; only the pieces' sizes shuffle. Groups hold
    a bounded number of tokens on average whatever the ids are, as pieces are dealt by hash with a
    count of the task in it; the one figure that comes to the driver is the sum of all lengths.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    pieces = stage(
        narrow.mapInArrow(
            _pieces(vocabulary, capacity, piece),
            "id long, start long, length long, ids_crc32 long, doc_tokens long, salt long",
        ),
        "pieces",
    )
    total = pieces.where(F.col("length") < capacity).agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (capacity * group_windows)))
    dealt = pieces.withColumn(
        "part", F.pmod(F.xxhash64("id", "start", "ids_crc32", "salt"), F.lit(groups))
    ).drop("salt")
    packed = dealt.groupBy("part").applyInPandas(
        _pack_group(capacity),
        "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
    return packed.withColumnRenamed("id", id_col)
