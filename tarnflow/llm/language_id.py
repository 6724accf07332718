"""Language identification by rank-order profiles of letter n-grams.

A profile is a language's ``TOP`` most frequent n-grams (1 to 3 letters, lower case, words marked
off by a blank), counted over every text that may be learned from. A document is ranked in the same
way, and its out-of-place distance to a profile is the sum of the differences in rank, with ``TOP``
for n-grams the profile lacks. The nearest language wins; the score is its share of the closeness
(1 - distance / worst distance) to all languages, 0 to 1.

A null text, or one without a letter, is ``und`` with score 0; so is every text when nothing could
be learned. Ties go to the language that comes first by name. Texts count whole, whatever their
length; rows that repeat are scored alike, null ids travel along, an empty table gives an empty
result. A language is known by the text of its column, so any extra values are just more profiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tarnflow.llm.common import slices

TOP = 300
UNKNOWN = "und"
_BITS = 21  # a code point
_MASK = (1 << _BITS) - 1
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)], bool))
    return _letters[0]


def grams(texts: list[str | None]):
    """``(text, gram, count)``: the counts of every n-gram of every text, by text and gram.

    A gram is its code points in 21 bits each; 0 stands for the end or the beginning of a word.
    """
    lowered = [(t or "").lower() for t in texts]
    sizes = [len(low) for low in lowered]
    if not sum(sizes):
        none = np.zeros(0, np.int64)
        return none, none, none
    # A blank after each text, the last one too, so that its last word has an end.
    whole = "\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(whole, np.uint32).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), np.array(sizes) + 1)
    letter = _letter_table()[points]
    points = np.where(letter, points, 0)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of a stretch of other characters, the first
    points, text = points[keep], text[keep]
    # A blank before each text too, so that its first word has a beginning.
    starts = np.flatnonzero(np.diff(text, prepend=-1))
    points, text = np.insert(points, starts, 0), np.insert(text, starts, text[starts])
    one = points > 0
    two = (text[:-1] == text[1:]) & (one[:-1] | one[1:])
    three = (text[:-2] == text[2:]) & one[1:-1]
    codes = [
        points[one],
        ((points[:-1] << _BITS) | points[1:] | (1 << 62))[two],
        ((points[:-2] << 2 * _BITS) | (points[1:-1] << _BITS) | points[2:])[three] if len(points) > 2 else points[:0],
    ]
    owners = [text[one], text[:-1][two], text[:-2][three] if len(points) > 2 else text[:0]]
    code, owner = np.concatenate(codes), np.concatenate(owners)
    # Short names of the grams at hand: then one sort of small numbers orders text and gram.
    names, place = np.unique(code, return_inverse=True)
    both, count = np.unique(owner * len(names) + place, return_counts=True)
    return both // max(1, len(names)), names[both % max(1, len(names))], count


def top_grams(texts: list[str | None], top: int = TOP):
    """``(text, rank, gram)`` of each text's most frequent n-grams; ties by gram."""
    text, gram, count = grams(texts)
    order = np.lexsort((gram, -count, text))
    text, gram = text[order], gram[order]
    first = np.searchsorted(text, np.arange(len(texts)))
    rank = np.arange(len(text)) - first[text]
    return text[rank < top], rank[rank < top], gram[rank < top]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, dict[int, int]] = {}
    for part in slices(batches, "text"):
        langs = np.array(part.column("lang").to_pylist(), dtype=object)
        text, gram, count = grams(part.column("text").to_pylist())
        for lang in set(langs):
            own = (langs == lang)[text]
            names, place = np.unique(gram[own], return_inverse=True)
            sums = np.bincount(place, weights=count[own], minlength=len(names)).astype(np.int64)
            to = held.setdefault(lang, {})
            for g, c in zip(names.tolist(), sums.tolist()):
                to[g] = to.get(g, 0) + c
        if sum(map(len, held.values())) > 500_000:
            yield from _flush(held)
            held = {}
    yield from _flush(held)


def _flush(held: dict[str, dict[int, int]]) -> Iterator[pa.RecordBatch]:
    for lang, counts in held.items():
        yield pa.record_batch(
            [
                pa.array([lang] * len(counts), pa.string()),
                pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64()),
            ],
            ["lang", "gram", "n"],
        )


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                   top: int = TOP) -> dict[str, np.ndarray]:
    """``language -> grams by rank``, counted over all of ``docs`` with a text and a language.

    Counts are summed in the tasks first; ``top`` numbers per language come to the driver.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counts = (
        rows.where("lang IS NOT NULL AND text IS NOT NULL")
        .mapInArrow(_count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    ranked = counts.withColumn(
        "rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    ).where(F.col("rank") <= top)
    found = ranked.toPandas().sort_values(["lang", "rank"])
    return {lang: part["gram"].to_numpy(np.int64) for lang, part in found.groupby("lang", sort=True)}


def distances(texts: list[str | None], profiles: list[np.ndarray], top: int = TOP):
    """Out-of-place distances (texts x languages) and the count of ranked n-grams per text."""
    text, rank, gram = top_grams(texts, top)
    out = np.zeros((len(texts), len(profiles)))
    for j, profile in enumerate(profiles):
        order = np.argsort(profile)
        place = np.minimum(np.searchsorted(profile[order], gram), max(0, len(profile) - 1))
        known = profile[order][place] == gram if len(profile) else np.zeros(len(gram), bool)
        away = np.where(known, np.abs(order[place] - rank) if len(profile) else 0, top)
        out[:, j] = np.bincount(text, weights=away, minlength=len(texts))
    return out, np.bincount(text, minlength=len(texts))


def _predict(profiles: dict[str, np.ndarray], top: int):
    names = sorted(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            away, ranked = distances(part.column("text").to_pylist(), [profiles[n] for n in names], top)
            close = 1 - away / np.maximum(1, ranked * top)[:, None]
            best = away.argmin(axis=1) if names else np.zeros(len(part), int)
            known = (ranked > 0) & bool(names)
            score = np.zeros(len(part))
            if names:
                total = close.sum(axis=1)
                share = close[np.arange(len(part)), best] / np.where(total > 0, total, 1)
                score = np.where(known, np.where(total > 0, share, 1 / len(names)), 0.0)
            yield pa.record_batch(
                [
                    part.column("id"),
                    pa.array([names[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                    pa.array(np.clip(score, 0, 1)),
                ],
                ["id", "lang_pred", "score"],
            )

    return run


def predict_language(docs: DataFrame, profiles: dict[str, np.ndarray], id_col: str = "doc_id",
                     text_col: str = "text", top: int = TOP) -> DataFrame:
    """``(id, lang_pred, score)`` for each row; profiles go along with the code (a few KB each)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        _predict(profiles, top), f"id {kind}, lang_pred string, score double"
    ).withColumnRenamed("id", id_col)
