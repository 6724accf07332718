"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled 1; the unlabelled web text is every document without a label. The
classifier (one hidden layer over measures of the text) minimises the non-negative unbiased risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with the logistic loss, so that its output estimates the chance of label 1. The class prior is
estimated from the labelled documents that may be learned from: the share of label 1, each count
plus one half. Labelled negatives serve for nothing else.

Measures come from the whole text and nothing else, however long it is, and are taken in the tasks. At
most ``SAMPLE`` positives and ``SAMPLE`` unlabelled documents, those first by hash of the id, are chosen by their
ids, measured, and fitted on the driver (25 numbers each); then every text is measured and scored
in one pass, where it lies.

Null and empty texts have measures of zero and are scored like any other text. An id that repeats
in the labels counts as positive if all its labels are 1. Without positives or without unlabelled
rows the score is the prior for every text. Ties, repeated rows and null ids need no care: each row
is scored by its text alone. An empty table gives an empty result. Extra columns, whatever their names, travel
along where rows are kept and are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnflow.llm.common import bounded_sample, slices
from tarnflow.llm.text_arrays import column_bytes, shingles, words

SAMPLE = 20_000
THRESHOLD = 0.3
MEASURES = 24
BATCH = 1024

_UPPER, _LOWER, _DIGIT, _SPACE, _WORDY = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = True
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_WORDY[:] = _UPPER | _LOWER | _DIGIT
_WORDY[128:] = True
_PROSE = np.zeros(256, bool)
_PROSE[[ord(c) for c in ".,;:?'\"-()"]] = True
_SYMBOL = ~(_WORDY | _SPACE | _PROSE)


def _within(places: np.ndarray, mask: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask)])
    return (sums[places[1:]] - sums[places[:-1]]).astype(float)


def _distinct(values: np.ndarray, owner: np.ndarray, n: int):
    """Per text: how many distinct values, and how often the most frequent one comes."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    lengths = np.diff(np.append(at, len(v)))
    most = np.zeros(n)
    np.maximum.at(most, o[at], lengths)
    return np.bincount(o[at], minlength=n).astype(float), most


def measures(column: pa.Array) -> np.ndarray:
    """``MEASURES`` figures per text: sizes, kinds of characters and words, repetition."""
    n = len(column)
    data, places = column_bytes(column)
    size = np.diff(places).astype(float)
    hashed, text, start, end = words(data, places)
    count = np.bincount(text, minlength=n).astype(float)
    full, owner = shingles(hashed, text, n, 5)
    share = lambda x, of: x / np.maximum(of, 1)
    kinds = {k: _within(places, m[data]) for k, m in
             {"up": _UPPER, "low": _LOWER, "dig": _DIGIT, "sp": _SPACE, "sym": _SYMBOL, "pr": _PROSE}.items()}
    exclaim = _within(places, data == 33)
    lines = _within(places, data == 10) + (size > 0)
    stops = _within(places, (data == 46) | (data == 63) | (data == 33))
    length = (end - start).astype(float)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    wordy = np.concatenate([[0], np.cumsum(_WORDY[data])])
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    by_word = lambda x: np.bincount(text, weights=x, minlength=n)
    distinct, top = _distinct(hashed, text, n)
    grams, top_gram = _distinct(full, owner, n)
    total = np.bincount(owner, minlength=n).astype(float)
    same = np.zeros(n)
    if len(hashed) > 1:
        again = (hashed[1:] == hashed[:-1]) & (text[1:] == text[:-1])
        same = np.bincount(text[1:], weights=again, minlength=n)
    mean = share(by_word(length), count)
    spread = np.sqrt(np.maximum(0, share(by_word(length**2), count) - mean**2))
    letters = kinds["up"] + kinds["low"]
    return np.column_stack([
        np.log1p(size), np.log1p(count), share(kinds["up"], letters), share(kinds["dig"], size),
        share(kinds["sp"], size), share(kinds["sym"], size), np.sqrt(share(kinds["sym"], size)),
        share(kinds["pr"], size), share(exclaim, count), share(distinct, count), share(top, count),
        share(grams, total), share(top_gram, total), share(same, count), mean / 10, spread / 10,
        share(by_word(symbols[end] > symbols[start]), count),
        share(by_word(wordy[end] == wordy[start]), count),
        share(by_word(upper[end] - upper[start] > 1), count),
        share(by_word(upper[end] > upper[start]), count),
        np.log1p(share(count, lines)), np.log1p(share(count, stops)),
        share(distinct, np.maximum(1, count) ** 0.7), (size == 0).astype(float),
    ])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        x = measures(part.column("text")).astype(np.float32)
        cells = pa.ListArray.from_arrays(
            pa.array(np.arange(len(part) + 1, dtype=np.int32) * MEASURES), pa.array(x.ravel())
        )
        yield pa.record_batch([part.column("id"), cells], ["id", "x"])


@dataclass
class Model:
    """``sigmoid(w2 . tanh(W1 z + b1) + b2)`` over standardised measures ``z``."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return 1 / (1 + np.exp(-np.clip(np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2, -30, 30)))


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 24,
           steps: int = 6000, seed: int = 0) -> Model:
    """Minimise the non-negative unbiased risk by Adam on mini-batches."""
    pool = np.vstack([positive, unlabelled]).astype(float)
    if not len(pool):
        pool = np.zeros((1, MEASURES))
    mean, scale = pool.mean(axis=0), pool.std(axis=0) + 1e-3
    rng = np.random.default_rng(seed)
    p = [rng.normal(0, 0.3, (pool.shape[1], hidden)), np.zeros(hidden), np.zeros(hidden), np.array(np.log(prior / (1 - prior)))]
    if len(positive) and len(unlabelled):
        zp, zu = (np.clip((a - mean) / scale, -8, 8) for a in (positive, unlabelled))
        m, v = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
        for t in range(1, steps + 1):
            a, b = zp[rng.integers(0, len(zp), BATCH)], zu[rng.integers(0, len(zu), BATCH)]
            z = np.vstack([a, b])
            h = np.tanh(z @ p[0] + p[1])
            g = h @ p[2] + p[3]
            s = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
            loss_neg = np.logaddexp(0, g)  # loss of calling a text positive that is not
            rest = loss_neg[len(a):].mean() - prior * loss_neg[: len(a)].mean()
            d = np.zeros(len(z))
            if rest >= 0:
                d[: len(a)] = prior * (s[: len(a)] - 1) / len(a) - prior * s[: len(a)] / len(a)
                d[len(a):] = s[len(a):] / len(b)
            else:  # the estimate went negative: step back on that part
                d[: len(a)] = prior * s[: len(a)] / len(a)
                d[len(a):] = -s[len(a):] / len(b)
            dh = d[:, None] * p[2] * (1 - h**2)
            grads = [z.T @ dh + 1e-4 * p[0], dh.sum(0), h.T @ d + 1e-4 * p[2], d.sum()]
            rate = 0.01 * (1 - t / (steps + 1)) + 1e-4
            for i, gr in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * gr
                v[i] = 0.999 * v[i] + 0.001 * gr**2
                p[i] = p[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return Model(mean, scale, p[0], p[1], p[2], float(p[3]), prior)


def _sample(docs: DataFrame, ids: DataFrame, most: int) -> np.ndarray:
    """Measures of the first ``most`` of ``ids`` by hash: a bounded sample that does not change.

    The ids are chosen before a text is looked at; of rows that share an id one counts.
    """
    chosen = bounded_sample(ids.distinct(), most, "id")
    order = [row[0] for row in chosen.collect()]
    few = docs.sparkSession.createDataFrame([(i,) for i in order], ids.schema)
    found = (
        docs.join(F.broadcast(few), "id", "left_semi")  # at most ``most`` ids
        .mapInArrow(_measure, f"id {ids.schema['id'].dataType.simpleString()}, x array<float>")
        .groupBy("id").agg(F.min("x").alias("x")).toPandas()
    )
    by_id = dict(zip(found["id"], found["x"]))
    return np.array([by_id[i] for i in order], float).reshape(-1, MEASURES)


def learn(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """The classifier. ``may_learn`` is a condition on the id: labels of other ids are not looked
    at, and unlabelled text does not come from them either."""
    allowed = F.lit(True) if may_learn is None else may_learn
    known = (
        labels.where(allowed & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("label_id")).agg(F.min(label_col).alias("label"))
    )
    counts = known.groupBy().agg(F.count_if(F.col("label") == 1).alias("p"), F.count("*").alias("n")).first()
    prior = (counts["p"] + 0.5) / (counts["n"] + 1)
    texts = docs.where(allowed & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    ids = texts.select("id")
    trusted = ids.join(known.where("label = 1"), F.col("id") == F.col("label_id"), "left_semi")
    labelled = labels.select(F.col(id_col).alias("any_id")).where("any_id IS NOT NULL").distinct()
    unlabelled = ids.join(labelled, F.col("id") == F.col("any_id"), "left_anti")
    return fit_pu(
        _sample(texts, trusted, sample), _sample(texts, unlabelled, sample), min(max(prior, 0.01), 0.99)
    )


def quality_scores(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None,
                   id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   sample: int = SAMPLE) -> DataFrame:
    """Id and ``score`` (0 to 1) of every row. Texts of the sample are measured to learn, all to score."""
    model = learn(docs, labels, may_learn, id_col, text_col, label_col, sample)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            x = measures(part.column("text")).astype(np.float32)
            yield pa.record_batch([part.column("row"), pa.array(model.score(x.astype(float)))], ["row", "score"])

    rows = docs.select(F.struct(F.col(id_col).alias("id")).alias("row"), F.col(text_col).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(score, f"row {kind}, score double").select(F.col("row.id").alias(id_col), "score")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
              id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of ``docs``, with all their columns, that score ``threshold`` or more.

    Every text is measured once, where it is read, so that no text is joined or moved.
    """
    model = learn(docs, labels, None, id_col, text_col, label_col)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            good = model.score(measures(part.column(text_col)).astype(np.float32).astype(float)) >= threshold
            yield part.filter(pa.array(good))

    return docs.mapInArrow(decide, docs.schema)
