"""Queries that SQL cannot express, against a second, plain version over a whole given table."""

import zlib

import numpy as np

from tarnflow.llm import language_id, queries
from tests.llm.test_models_and_packing import plain_profile

SF = "/root/testdata/sf0.001"


def texts(spark, name="documents"):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/{name}.parquet").collect()}


def test_op3_ids_are_the_librarys_on_every_document(spark):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs, got = texts(spark), queries.QUERIES["op3_sentencepiece"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = np.array(library.encode(docs[r.doc_id].text or ""), "<u4")
        assert (r.n_ids, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


def test_op7_ids_are_the_tokenizers_own_on_every_document(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs, got = texts(spark), queries.QUERIES["op7_packing"](spark, SF).toPandas()
    want = {i: np.array([*exact.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4") for i, r in docs.items()}
    assert set(got.doc_id) == set(want)
    for i, pieces in got.groupby("doc_id"):
        pieces, at = pieces.sort_values("start"), 0
        for r in pieces.itertuples():
            assert (r.start, r.doc_tokens) == (at, len(want[i]))
            assert r.ids_crc32 == zlib.crc32(want[i][at : at + r.length].tobytes())
            at += r.length
        assert at == len(want[i])
    for _, sequence in got.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        assert (sequence.offset == sequence.length.cumsum() - sequence.length).all() and sequence.length.sum() <= 2048


def ranks(counts, top):
    """Grams by rank, ties by the operator's own number of the gram."""
    def number(gram):
        points = [ord(c) if c != " " else 0 for c in gram]
        code = points[0]
        for p in points[1:]:
            code = code << language_id._BITS | p
        return code | (1 << 62 if len(points) == 2 else 0)

    return {g: k for k, g in enumerate(sorted(counts, key=lambda g: (-counts[g], number(g)))[:top])}


def test_op8_against_plain_out_of_place_distances(spark):
    docs, top = texts(spark), language_id.TOP
    learn = {}
    for i, r in docs.items():
        if zlib.crc32(str(i).encode()) % 4 != 2 and r.lang is not None and r.text is not None:
            for g, n in plain_profile([r.text], top).items():
                own = learn.setdefault(r.lang, {})
                own[g] = own.get(g, 0) + n
    profiles = {lang: ranks(counts, top) for lang, counts in sorted(learn.items())}
    differ = 0
    for r in queries.QUERIES["op8_language_id"](spark, SF).collect():
        counts = plain_profile([docs[r.doc_id].text or ""], top)
        if not counts:
            assert r.lang_pred == "und" and r.score == 0
            continue
        mine = ranks(counts, top)
        away = {l: sum(abs(p[g] - k) if g in p else top for g, k in mine.items()) for l, p in profiles.items()}
        close = {l: 1 - d / (len(mine) * top) for l, d in away.items()}
        differ += r.lang_pred != min(away, key=lambda l: (away[l], l)) or abs(r.score - close[r.lang_pred] / sum(close.values())) > 1e-9
    assert differ == 0
