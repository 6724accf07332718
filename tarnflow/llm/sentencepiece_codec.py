"""SentencePiece encoding and decoding with batched numpy code.

A text is cut into words before every stretch of the blank mark (no piece goes across such a place;
a model in which one does is refused). Distinct words of equal length advance together. Substring
hashes, from running sums over code points, probe the sorted keys of the pieces.

For unigram models this is a Viterbi search: at each end place, the maximum over the pieces that end
there stores the best score and the back pointer, for all words at once. A BPE model's ids are not
those of the best sum of scores: the best-ranked neighbours are merged, again and again. For such a
model, which the public file is, the same batches and probes run merge rounds instead: each round
merges, in all words at once, the pair with the largest score, the leftmost of equals. Words of more
than ``LONG`` characters are merged one by one with a heap.

What is no piece falls back to bytes, or to the unknown id where a model has no bytes. Null and
empty texts have no ids and decode to the empty text. The blank mark in a text is a blank, as it is
for the library. Texts count whole, whatever their length; rows that repeat are encoded alike, null
ids travel along, an empty table gives an empty result and other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnflow.llm.common import slices

MODEL = "piece_bpe_32k.model"
MARK = "▁"
LONG = 256
#: Words a task remembers.
CACHE = 300_000
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_B = 0x9E3779B97F4A7C15
UNIGRAM, BPE = 1, 2


def _running(points: np.ndarray) -> np.ndarray:
    """Running hashes (words x places + 1): h(s..e) = H[e] - H[s] * B^(e - s)."""
    out = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
    for i in range(points.shape[1]):
        out[:, i + 1] = out[:, i] * np.uint64(_B) + points[:, i] + np.uint64(1)
    return out


class Pieces:
    """A model's pieces by hash, and its encoder and decoder."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[int], model_type: int = BPE,
                 dummy_prefix: bool = True):
        self.kind, self.dummy_prefix = model_type, dummy_prefix
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if k == 6 else b"" if k == 3 else p.replace(MARK, " ").encode()
            for p, k in zip(pieces, kinds)
        ]
        self.byte_id = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == 6}
        self.unknown = next((i for i, k in enumerate(kinds) if k == 2), 0)
        if self.unknown < len(pieces):
            self.bytes_of[self.unknown] = " ⁇ ".encode() if kinds and kinds[self.unknown] == 2 else self.bytes_of[self.unknown]
        normal = [i for i, k in enumerate(kinds) if k in (1, 4) and pieces[i]]
        if any(MARK in pieces[i].lstrip(MARK) for i in normal):
            raise ValueError("a piece goes across a blank")
        self.longest = max((len(pieces[i]) for i in normal), default=1)
        keys = {}
        for i in normal:
            keys.setdefault(pieces[i], i)
        self.ids_of = keys
        self.scores = np.array(scores)
        hashes = np.array([self._hash(p) for p in keys], np.uint64)
        order = np.argsort(hashes)
        self.keys = hashes[order]
        self.key_ids = np.array(list(keys.values()))[order] if keys else np.zeros(0, int)
        self.power = np.full(LONG + 2, _B, np.uint64)
        self.power[0] = 1
        self.power = np.multiply.accumulate(self.power)
        self.worst = float(self.scores[normal].min()) - 10 if normal else -10.0

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * _B + ord(c) + 1) % 2**64
        return h

    def probe(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: no piece) and scores (-inf)."""
        if not len(self.keys):
            return np.full(hashes.shape, -1), np.full(hashes.shape, -np.inf)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        hit = self.keys[at] == hashes
        ids = np.where(hit, self.key_ids[at], -1)
        return ids, np.where(hit, self.scores[ids], -np.inf)

    def _sub(self, running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        rows = np.arange(len(running))[:, None] if start.ndim == 2 else np.arange(len(running))
        return running[rows, end] - running[rows, start] * self.power[end - start]

    def merge_rounds(self, points: np.ndarray) -> list[np.ndarray]:
        """BPE: the symbol bounds of each word (rows of code points of one length)."""
        running = _running(points.astype(np.uint64))
        n, length = points.shape
        bounds = np.tile(np.arange(length + 1), (n, 1))
        done: list[np.ndarray | None] = [None] * n
        row = np.arange(n)
        score = self.probe(self._sub(running, bounds[:, :-2], bounds[:, 2:]))[1] if length > 1 else np.zeros((n, 0))
        while len(row):
            best = score.argmax(axis=1) if score.shape[1] else np.zeros(len(row), int)
            more = score[np.arange(len(row)), best] > -np.inf if score.shape[1] else np.zeros(len(row), bool)
            for i in np.flatnonzero(~more):
                done[row[i]] = bounds[i]
            row, bounds, score, best, running = row[more], bounds[more], score[more], best[more], running[more]
            m = len(row)
            if not m:
                break
            keep = np.ones(bounds.shape, bool)
            keep[np.arange(m), best + 1] = False
            bounds = bounds[keep].reshape(m, -1)
            keep = np.ones(score.shape, bool)
            keep[np.arange(m), best] = False
            score = score[keep].reshape(m, -1)
            for side in (best - 1, best):  # the pairs on both sides of the merged symbol
                ok = np.flatnonzero((side >= 0) & (side < score.shape[1]))
                at = side[ok]
                s, e = bounds[ok, at], bounds[ok, at + 2]
                found = running[ok, e] - running[ok, s] * self.power[e - s]
                score[ok, at] = self.probe(found)[1]
        return done

    def viterbi(self, points: np.ndarray) -> list[np.ndarray]:
        """Unigram: the symbol bounds of the best-scored segmentation of each word."""
        running = _running(points.astype(np.uint64))
        n, length = points.shape
        best = np.full((n, length + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, length + 1), int)
        for end in range(1, length + 1):
            starts = np.arange(max(0, end - self.longest), end)
            hashes = running[:, end][:, None] - running[:, starts] * self.power[end - starts][None, :]
            score = self.probe(hashes)[1]
            one = score[:, -1]
            score[:, -1] = np.where(one > -np.inf, one, self.worst)  # a lone unknown character
            total = best[:, starts] + score
            pick = total.argmax(axis=1)
            best[:, end] = total[np.arange(n), pick]
            back[:, end] = starts[pick]
        out = []
        for i in range(n):
            bounds = [length]
            while bounds[-1]:
                bounds.append(int(back[i, bounds[-1]]))
            out.append(np.array(bounds[::-1]))
        return out

    def merge_long(self, word: str) -> list[str]:
        """BPE for one word of any length, with a heap of neighbours."""
        parts, after, before = list(word), [*range(1, len(word)), -1], [-1, *range(len(word) - 1)]
        heap = []

        def offer(i):
            j = after[i] if i >= 0 else -1
            if j >= 0 and (piece := self.ids_of.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-self.scores[piece], i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if parts[i] == a else -1
            if j < 0 or parts[j] != b:
                continue
            parts[i], parts[j], after[i] = a + b, "", after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p]

    def viterbi_long(self, word: str) -> list[str]:
        best, back = [0.0], [0]
        for end in range(1, len(word) + 1):
            options = []
            for start in range(max(0, end - self.longest), end):
                piece = self.ids_of.get(word[start:end])
                if piece is not None or start == end - 1:
                    options.append((best[start] + (self.scores[piece] if piece is not None else self.worst), -start))
            top = max(options)
            best.append(top[0]), back.append(-top[1])
        out, end = [], len(word)
        while end:
            out.append(word[back[end]:end])
            end = back[end]
        return out[::-1]

    def _ids(self, parts: list[str]) -> list[int]:
        out: list[int] = []
        for p in parts:
            piece = self.ids_of.get(p)
            if piece is not None:
                out.append(piece)
            elif self.byte_id:
                out += [self.byte_id[b] for b in p.encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
        return out

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        by_length = defaultdict(list)
        out = {}
        for w in words:
            if len(w) > LONG:
                out[w] = self._ids(self.merge_long(w) if self.kind == BPE else self.viterbi_long(w))
            else:
                by_length[len(w)].append(w)
        for length, group in by_length.items():
            for c in range(0, len(group), 20_000):
                part = group[c : c + 20_000]
                points = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, length)
                found = self.merge_rounds(points) if self.kind == BPE else self.viterbi(points)
                for w, bounds in zip(part, found):
                    cuts = bounds.tolist()
                    out[w] = self._ids([w[a:b] for a, b in zip(cuts, cuts[1:])])
        return out

    def encode_batch(self, texts: list[str | None], known: dict[str, list[int]]) -> list[np.ndarray]:
        cut = [_WORD.findall((MARK if self.dummy_prefix else "") + t.replace(" ", MARK)) if t else [] for t in texts]
        new = {w for words in cut for w in words if w not in known}
        fresh = self.encode_words(list(new))
        known.update(fresh)
        out = [np.array([i for w in words for i in known[w]], np.uint32) for words in cut]
        if len(known) > CACHE:
            known.clear()
        return out

    def decode(self, ids) -> str:
        text = b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text[:1] == " " else text


@functools.lru_cache(maxsize=2)
def load(model: str = MODEL) -> Pieces:
    """The pieces of a public model file; ``model`` is its name or a path."""
    import public_tokenizers
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(model if "/" in model else public_tokenizers.path(model), "rb") as file:
        proto.ParseFromString(file.read())
    spec = proto.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces:
        raise ValueError("models that normalise characters or blanks are not supported")
    return Pieces(
        [p.piece for p in proto.pieces], [p.score for p in proto.pieces], [p.type for p in proto.pieces],
        proto.trainer_spec.model_type, spec.add_dummy_prefix,
    )


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``(id, ids array<int>)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = load(model), {}
        for part in slices(batches, "text", 1 << 21):
            ids = pieces.encode_batch(part.column("text").to_pylist(), known)
            yield pa.record_batch(
                [part.column("id"), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))], ["id", "ids"]
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """``(id, text)`` of every row; a null list of ids gives the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in batches:
            texts = [pieces.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def encode_summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``(id, n_ids, ids_crc32, round_trip)``: both directions in one pass, without the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = load(model), {}
        for part in slices(batches, "text", 1 << 21):
            texts = part.column("text").to_pylist()
            ids = pieces.encode_batch(texts, known)
            same = [pieces.decode(x.tolist()) == (t or "").replace(MARK, " ") for x, t in zip(ids, texts)]
            yield pa.record_batch(
                [
                    part.column("id"), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()), pa.array(same),
                ],
                ["id", "n_ids", "ids_crc32", "round_trip"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_ids long, ids_crc32 long, round_trip boolean").withColumnRenamed("id", id_col)
