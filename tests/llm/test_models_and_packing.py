"""Quality, language id, SentencePiece and packing."""

import random
import zlib

import numpy as np
import pytest

from tarnflow.llm import language_id, packing, quality, sentencepiece_codec
from tarnflow.llm.sentencepiece_codec import UNIGRAM, Pieces
from tests.llm.helpers import ODD, clashing, table

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_labels(spark):
    from tarnflow.llm.queries import op4_quality

    got = {r.doc_id: r for r in op4_quality(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    held = [(got[i].score, q) for i, q in labels if got[i].held_out]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_quality_odd_cases(spark):
    df = clashing(spark, ODD)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (9, None)], "doc_id long, quality int")
    got = quality.quality_scores(df, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    kept = quality.keep_good(df, labels, threshold=0.0)
    assert kept.columns == df.columns and kept.count() == len(ODD)
    none = labels.where("false")
    assert len({r.score for r in quality.quality_scores(df, none).collect()}) == 1
    assert quality.quality_scores(df.where("false"), labels).count() == 0
    assert quality.keep_good(df.where("false"), labels).count() == 0


def test_pu_risk_finds_the_hidden_negatives():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (3000, 3)), rng.normal(3, 1, (600, 3))
    model = quality.fit_pu(good[:1000], np.vstack([good[1000:], bad]), prior=2000 / 2600)
    assert model.score(good).mean() > 0.9 and model.score(bad).mean() < 0.15


def plain_profile(texts, top):
    counts = {}
    for t in texts:
        for word in "".join(c if c.isalpha() else " " for c in t.lower()).split():
            for n in (1, 2, 3):
                padded = word if n == 1 else f" {word} "
                for i in range(len(padded) - n + 1):
                    if n < 3 or padded[i + 1] != " ":
                        g = padded[i : i + n]
                        counts[g] = counts.get(g, 0) + 1
    return counts


def test_grams_agree_with_a_plain_count():
    texts = ["Ab, a-c", "", None, "ß1É", "..."]
    text, gram, count = language_id.grams(texts)
    for k, t in enumerate(texts):
        want = plain_profile([t or ""], 10)
        assert sorted(want.values()) == sorted(count[text == k].tolist())
        assert len(set(gram[text == k].tolist())) == len(want)


def test_language_of_held_out_texts(spark):
    from tarnflow.llm.queries import op8_language_id

    got = {r.doc_id: r for r in op8_language_id(spark, SF).collect()}
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [i for i in got if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert np.mean([got[i].lang_pred == langs[i] for i in held]) > 0.98


def test_language_odd_cases(spark):
    df = clashing(spark, ODD)
    profiles = language_id.learn_profiles(df)
    got = {r.doc_id: r for r in language_id.predict_language(df, profiles).collect()}
    assert got[3].lang_pred == got[4].lang_pred == got[5].lang_pred == "und" and got[1].lang_pred == "en"
    assert got[8].lang_pred == "en" and all(0 <= r.score <= 1 for r in got.values())
    assert language_id.learn_profiles(df.where("false")) == {}
    assert {r.lang_pred for r in language_id.predict_language(df, {}).collect()} == {"und"}
    assert language_id.predict_language(df.where("false"), profiles).count() == 0


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_ids_are_the_librarys(library):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdetaoin \n.é€☃▁ÿ<>/s0x") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    texts += ["a" * 700, "the" * 400, " " * 600, "ab" * 300 + "x y" * 200, "日本語" * 200, "", None]
    got = sentencepiece_codec.load().encode_batch(texts, {})
    assert [x.tolist() for x in got] == library.encode([t or "" for t in texts])


def test_encode_and_decode(spark, library):
    df = clashing(spark, ODD)
    encoded = sentencepiece_codec.encode(df)
    assert sorted((r.doc_id or 0, r.ids) for r in encoded.collect()) == sorted(
        (i or 0, library.encode(t or "")) for i, t in ODD
    )
    decoded = sentencepiece_codec.decode(encoded)
    assert sorted((r.doc_id or 0, r.text) for r in decoded.collect()) == sorted((i or 0, t or "") for i, t in ODD)
    assert all(r.round_trip for r in sentencepiece_codec.encode_summary(df).collect())
    assert sentencepiece_codec.encode(df.where("false")).count() == 0


def best_segmentation(word, scores, worst):
    """Every segmentation, scored."""
    if not word:
        return 0.0
    return max(
        (scores[word[:k]] if word[:k] in scores else worst) + best_segmentation(word[k:], scores, worst)
        for k in range(1, len(word) + 1)
        if word[:k] in scores or k == 1
    )


def test_viterbi_finds_the_best_segmentation():
    rng = random.Random(2)
    names = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(60)})
    scores = {n: -rng.random() * len(n) for n in names if n != "b"}
    pieces = Pieces(["<unk>", *scores], [0.0, *scores.values()], [2, *[1] * len(scores)], UNIGRAM, dummy_prefix=False)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    long = pieces.viterbi_long("abcab")
    got = pieces.encode_words(words)
    back = dict(enumerate(["<unk>", *scores]))
    for w in words:
        total = sum(scores.get(back[i], pieces.worst) for i in got[w])
        assert abs(total - best_segmentation(w, scores, pieces.worst)) < 1e-9
    assert "".join(long) == "abcab"


def test_tokens_are_those_of_the_tokenizers_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.tokenizer()
    for text in ["", "Hello  world's\n\n end", "é☃\U0001f600" * 30, "a<|endoftext|>b", "x" * 3000, " \t\n", "1234 %%% ###"]:
        assert encode(text).tolist() == exact.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(4))
def test_differencing_balances_and_never_overflows(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 512) for _ in range(400)]
    packed = packing.pack(sizes)
    sums = [sum(sizes[i] for i in w) for w in packed]
    assert sorted(i for w in packed for i in w) == list(range(400))
    assert max(sums) <= 2048 and sum(sizes) / (2048 * len(packed)) > 0.95


def test_windows_rise_when_capacity_is_exceeded():
    assert len(packing.pack([1200, 1200, 1200])) == 3  # two would hold the sum but not the pieces
    assert packing.pack([]) == [] and packing.pack([2048]) == [[0]]
    with pytest.raises(ValueError):
        packing.pack([2049])


def test_packed_documents(spark):
    got = packing.pack_documents(clashing(spark, ODD), group_windows=2).toPandas()
    encode = packing.tokenizer()
    want = sorted((i or 0, len(encode(t or "")) + 1) for i, t in ODD)
    first = got[got.start == 0]
    assert sorted(zip(first.doc_id.fillna(0), first.doc_tokens)) == want
    assert got.length.sum() == sum(n for _, n in want)
    for _, seq in got.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert (seq.offset == seq.length.cumsum() - seq.length).all() and seq.length.sum() <= 2048
    ids = np.append(encode(ODD[9][1]), 1).astype("<u4")
    for r in got[got.doc_id == 10].itertuples():
        assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert packing.pack_documents(table(spark, ODD).where("false")).count() == 0
