"""N-gram Jaccard join, passage dedup and embedding near-dedup against brute force."""

import random

import numpy as np
import pytest

from tarnflow.llm import embedding_dedup, ngram_join, passage_dedup
from tarnflow.llm.components import connected_components
from tests.llm.helpers import ODD, clashing, components, jaccard_components, near_copies, shingles, table


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 3), (9, 8), (8, 9), (None, 4), (20, 10), *[(i, i + 1) for i in range(100, 160)]]
    got = connected_components(spark.createDataFrame(edges, "u long, v long"))
    want = components({x for e in edges for x in e if x is not None}, [e for e in edges if None not in e])
    want = {k: v for k, v in want.items() if k not in (4,)}
    assert {r.node: r.component for r in got.collect()} == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("block", [4096, 7])  # 7: entries and leaves are split
def test_jaccard_components(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "ENTRY_POINTS", block)
    monkeypatch.setattr(ngram_join, "BLOCK_POINTS", block)
    monkeypatch.setattr(ngram_join, "FREQUENT_FROM", 5)
    rng = random.Random(3)
    rows = near_copies(rng, 12, 15) + [(i and i + 10_000, t) for i, t in ODD]
    rows += [(20_000 + i, " ".join(f"v{rng.randrange(50)}" for _ in range(n))) for i, n in enumerate([5, 8, 2000, 3, 1])]
    got = ngram_join.jaccard_components(clashing(spark, rows)).collect()
    want = jaccard_components(rows)
    assert len(got) == len(rows)
    assert all(r.component_id == want.get(r.doc_id) for r in got)
    assert sorted(r.n_shingles for r in got) == sorted(len(shingles(t)) for _, t in rows)
    assert len(set(want.values())) < len(rows) - 50


def test_long_texts_have_more_groups(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(6000)]
    other = list(base)
    for k in range(0, 6000, 100):
        other[k] = "changed"
    rows = [(1, " ".join(base)), (2, " ".join(other)), (3, " ".join(f"w{rng.randrange(10**6)}" for _ in range(6000)))]
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(table(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_keep_one_per_component(spark):
    rows = [(1, "a b c d e f g h"), (2, "A b c d e f g h"), (3, None), (4, None), (None, "a b c d e f g h")]
    got = ngram_join.keep_one_per_component(clashing(spark, rows))
    assert sorted((r.doc_id or 0) for r in got.collect()) == [0, 1, 3, 4]
    assert ngram_join.keep_one_per_component(table(spark, rows).where("false")).count() == 0


def test_summed_minima_bound_the_overlap():
    rng = np.random.default_rng(0)
    for n in (1, 40, 700, 5000):
        x = np.unique(rng.integers(0, 2**62, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[: n // 2], rng.integers(0, 2**62, n, dtype=np.uint64)]))
        import pyarrow as pa

        counts = ngram_join._Counts(pa.chunked_array([pa.array([ngram_join.group_counts(s).tobytes() for s in (x, y)])]))
        bound = counts.minima(np.array([0]), np.array([1]))[0]
        assert len(np.intersect1d(x, y)) <= bound <= min(len(x), len(y))


def words(rng, n):
    return " ".join(f"t{rng.randrange(10**6)}" for _ in range(n))


def test_repeated_passages(spark):
    rng = random.Random(5)
    passages = [words(rng, 60) for _ in range(10)]
    rows = [(i, f"{words(rng, rng.randint(0, 70))} {p} {words(rng, rng.randint(0, 70))}") for i, p in enumerate(passages * 2)]
    rows += [(100 + i, words(rng, 150)) for i in range(20)]
    rows += [(i and i + 1000, t) for i, t in ODD]
    got = passage_dedup.repeated_stretches(clashing(spark, rows)).collect()
    hit = {r.doc_id: r for r in got if r.doc_id < 1000}
    assert set(hit) == set(range(10, 20))  # later ones only, clean ones never
    by = dict(rows)
    for i, r in hit.items():
        found, passage = by[i][r.start : r.end].split(), passages[i - 10].split()
        # A near copy at an end of the passage may bring a few words of what stands beside it.
        assert r.keep_id == i - 10 and len(set(found) & set(passage)) >= 0.75 * len(found)
    cut = {r.doc_id: r.text for r in passage_dedup.remove_stretches(clashing(spark, rows)).collect()}
    assert len(cut[12]) < len(by[12]) and cut[3] == by[3] and cut[1003] is None
    assert passage_dedup.repeated_stretches(table(spark, rows).where("false")).count() == 0


def test_near_paragraphs_are_found(spark):
    rng = random.Random(6)
    lines = [words(rng, 30) for _ in range(60)]
    near = [" ".join([*line.split()[:-1], "other"]) for line in lines]
    rows = list(enumerate(lines + near))
    got = {r.doc_id for r in passage_dedup.repeated_stretches(table(spark, rows), least_words=5).collect()}
    assert not got & set(range(60)) and len(got) >= 57


def test_equal_lines_are_cut_alike():
    import pyarrow as pa

    rng = random.Random(8)
    lines = [words(rng, n) for n in (1, 2, 5, 20, 21, 25, 30, 40, 90) for _ in range(12)] + ["", "a a a a a a a a a"]

    def cuts(text):
        owner, place, count, *_, key = passage_dedup.paragraphs(pa.array(text))[0]
        return [[(p, n, k) for o, p, n, k in zip(owner, place, count, key) if o == i] for i in range(len(text))]

    alone = {line: cuts([line])[0] for line in lines}
    for _ in range(3):
        rng.shuffle(lines)
        assert cuts(lines) == [alone[line] for line in lines]  # as texts, in any order
        place, want = 0, []
        for line in lines:  # as lines of one text
            want += [(place + p, n, k) for p, n, k in alone[line]]
            place += len(line.split())
        assert cuts(["\n".join(lines)])[0] == want


def test_equal_lines_in_other_surroundings(spark):
    rng = random.Random(9)
    lines = [words(rng, n) for n in (30, 40) for _ in range(40)]
    rows = [(i, f"{words(rng, 9)}\n{line}\n{words(rng, 9)}") for i, line in enumerate(lines * 2)]
    rng.shuffle(rows)
    for parts in (1, 5):
        got = passage_dedup.repeated_stretches(table(spark, rows).repartition(parts)).collect()
        assert {r.doc_id for r in got} == set(range(80, 160)) and all(r.keep_id == r.doc_id - 80 for r in got)


def test_near_paragraphs_in_crowded_buckets(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(passage_dedup, "BLOCK", 64, raising=False)  # crowded buckets are split
    rng = random.Random(7)

    def whole(line):
        return passage_dedup.paragraphs(pa.array([line]))[0][2].tolist() == [20]

    pairs = []
    phrase = next(p for p in iter(lambda: words(rng, 11), None) if whole(f"{p} {words(rng, 9)}"))
    while len(pairs) < 150:
        line = f"{phrase} {words(rng, 9)}"
        near = " ".join([*line.split()[:-1], "other"])
        if whole(line) and whole(near):
            pairs.append((line, near))
    for x, y in pairs:
        x, y = shingles(x), shingles(y)
        assert 100 * len(x & y) >= 75 * len(x | y)
    rows = list(enumerate([x for x, _ in pairs] + [y for _, y in pairs]))
    got = {r.doc_id: r.keep_id for r in passage_dedup.repeated_stretches(table(spark, rows)).collect()}
    assert not set(got) & set(range(150))
    assert sum(got.get(150 + i) == i for i in range(150)) >= 0.99 * 150


def test_short_exact_repeats_are_found_whole(spark):
    rng = random.Random(10)
    passages = [words(rng, n) for n in (50, 51, 52, 55, 60) for _ in range(40)] + [words(rng, 20) for _ in range(20)]
    rows = []
    for k in range(2):
        for i, p in enumerate(passages):
            around = (words(rng, rng.randint(5, 70)), words(rng, rng.randint(5, 70)))
            # The short ones are lines of their own.
            rows.append((1000 * k + i, f"{around[0]} {p} {around[1]}" if i < 200 else f"{around[0]}\n{p}\n{around[1]}"))
    by = dict(rows)
    got = passage_dedup.repeated_stretches(table(spark, rows)).collect()
    assert len(got) == len(passages) and {r.doc_id: r.keep_id for r in got} == {1000 + i: i for i in range(len(passages))}
    for r in got:
        passage, found = passages[r.keep_id], by[r.doc_id][r.start : r.end]
        # A near paragraph at an end may bring a few words of what stands beside it.
        assert passage in found and len(passage.split()) <= r.n_words <= len(passage.split()) + 10


def test_repeats_in_one_text_keep_the_first(spark):
    rng = random.Random(11)
    p, q = words(rng, 55), words(rng, 7)
    rows = [(1, f"{words(rng, 9)} {p} {p} {words(rng, 9)}"), (2, f"{words(rng, 9)} " + " ".join([q] * 30))]
    cut = {r.doc_id: r.text for r in passage_dedup.remove_stretches(table(spark, rows)).collect()}
    assert cut[1].count(p) == 1 and len(cut[1].split()) == 73
    assert q in cut[2] and len(cut[2].split()) < 9 + 210
    assert passage_dedup.repeated_stretches(table(spark, [(1, "a b"), (1, p), (1, p), (2, p)])).count() == 1


def plain_vectors(rows, cosine=0.95):
    good = [
        (k, i, np.array(v, float)) for k, (i, v) in enumerate(rows)
        if i is not None and v and len(v) == 8 and all(c is not None and np.isfinite(c) for c in v) and any(v)
    ]
    links, edges = {k: 0 for k in range(len(rows))}, []
    for a in range(len(good)):
        for b in range(a):
            x, y = good[a][2], good[b][2]
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                links[good[a][0]] += 1
                links[good[b][0]] += 1
                edges.append((good[a][1], good[b][1]))
    return links, components({i for i, _ in rows if i is not None}, edges)


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(12):
        c = rng.normal(size=8)
        rows += [(c + rng.normal(size=8) * 0.12).tolist() for _ in range(12)]
    rows += [rng.normal(size=8).tolist() for _ in range(150)]
    rows += [rows[0]] * 30 + [(2 * np.array(rows[0])).tolist()]
    rows += [None, [], [0.0] * 8, [None] * 8, [float("nan")] * 8, [float("inf")] * 8, [1.0, 2.0]]
    rows = [*enumerate(rows), (None, rows[0]), (5, rows[5])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, label int, n int")
    got = embedding_dedup.near_duplicates(df).collect()
    links, comp = plain_vectors(rows)
    assert len(got) == len(rows)
    assert sum(r.n_links for r in got) >= 0.97 * sum(links.values())
    assert all(r.n_links == 0 for r in got if r.vec_id is None)
    want = {i: c for i, c in comp.items()}
    assert np.mean([r.component_id == want[r.vec_id] for r in got if r.vec_id is not None]) > 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0
    assert embedding_dedup.near_duplicates(df.where("embedding IS NULL")).count() == 1


@pytest.mark.parametrize("offset", [0.0, 0.7, 0.9])
def test_links_of_vectors_with_an_offset(offset):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = np.hstack([np.full((6000, 1), offset), np.sqrt(1 - offset**2) * x])
    codes = embedding_dedup.fitted_codes(x[:4000], 100_000)
    # Pairs right at the threshold, both at the same distance from the mean.
    a, b = x[4000:], rng.normal(size=(2000, 65))
    b[:, 0] = 0
    rest = a.copy()
    rest[:, 0] = 0
    rest /= np.linalg.norm(rest, axis=1, keepdims=True)
    b -= (b * rest).sum(axis=1, keepdims=True) * rest
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = (0.95 - offset**2) / (1 - offset**2)
    y = np.sqrt(1 - offset**2) * (c * rest + np.sqrt(1 - c**2) * b)
    y[:, 0] = offset
    assert np.allclose((a * y).sum(axis=1), 0.95)
    assert (codes.keys(a) == codes.keys(y)).any(axis=1).mean() >= 0.99


def test_vectors_of_several_lengths(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "FEW", 40, raising=False)
    rng = np.random.default_rng(3)
    rows = []
    for dim, count in ((8, 60), (12, 50), (5, 10), (1, 2)):
        x = rng.normal(size=(count, dim))
        rows += x.tolist() + (x + 0.01 * rng.normal(size=x.shape)).tolist() + x[:1].tolist()
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    links = dict.fromkeys(range(len(rows)), 0)
    for a in range(len(rows)):
        for b in range(a):
            if len(rows[a]) == len(rows[b]):
                x, y = np.array(rows[a]), np.array(rows[b])
                if x @ y >= 0.95 * np.linalg.norm(x) * np.linalg.norm(y):
                    links[a] += 1
                    links[b] += 1
    assert len(got) == len(rows) and {i: r.n_links for i, r in got.items()} == links
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_links_of_a_table_by_codes(spark):
    """Planted pairs at cosine 0.95 to 0.97 among strangers, end to end against brute force."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2500, 64)) + 0.8
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    step = rng.normal(size=(1000, 64))
    step -= (step * x[:1000]).sum(axis=1, keepdims=True) * x[:1000]
    step /= np.linalg.norm(step, axis=1, keepdims=True)
    c = rng.uniform(0.9501, 0.97, (1000, 1))
    rows = np.vstack([x, c * x[:1000] + np.sqrt(1 - c**2) * step])
    assert len(rows) > embedding_dedup.FEW
    near = (rows @ rows.T >= 0.95) & ~np.eye(len(rows), dtype=bool)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df.repartition(4)).collect()}
    want = near.sum(axis=1)
    assert want.sum() >= 2000 and all(got[i] <= want[i] for i in got)
    assert sum(got.values()) >= 0.99 * want.sum()


def test_bounded_samples_and_lists(spark):
    from tarnflow.llm.common import bounded_sample

    rows = spark.range(5000)
    first = {r.id for r in bounded_sample(rows, 300, "id").collect()}
    assert 250 <= len(first) <= 300 and first == {r.id for r in bounded_sample(rows.repartition(7), 300, "id").collect()}
    assert bounded_sample(rows, 9000, "id").count() == 5000 and bounded_sample(rows.where("false"), 5, "id").count() == 0
    levels = spark.createDataFrame([(i, i // 10) for i in range(100)], "token long, level long")
    assert {r.token for r in ngram_join._most_frequent(levels, 35).collect()} == set(range(70, 100))
    assert ngram_join._most_frequent(levels, 5).count() == 0


def plain_repeats(rows, least=20):
    """Words of each text, by (id, place), that lie in an exact repeat of ``least`` words of an earlier one."""
    first, covered = {}, {}
    for i, t in sorted(rows):
        w = t.lower().split()
        for p in range(len(w) - least + 1):
            j, q = first.setdefault(tuple(w[p : p + least]), (i, p))
            if j != i or p >= q + least:
                covered.setdefault(i, set()).update(range(p, p + least))
    return covered


def removed_words(got, rows):
    by, out = dict(rows), {}
    for r in got:
        before = len(by[r.doc_id][: r.start].split())
        out.setdefault(r.doc_id, set()).update(range(before, before + len(by[r.doc_id][r.start : r.end].split())))
    return out


def test_exact_repeats_are_found_to_the_word(spark):
    """Embedded passages of 20 to 60 words: all of their words go, and no other word does."""
    rng = random.Random(12)
    common = words(rng, 12)  # many passages begin alike, so the first place of a seed is often elsewhere
    passages = [words(rng, n) for n in range(20, 61) for _ in range(4)]
    passages += [f"{common} {words(rng, n)}" for n in (8, 9, 15, 30) for _ in range(8)]
    rows = [(1000 * k + i, f"{words(rng, rng.randint(1, 40))} {p} {words(rng, rng.randint(1, 40))}") for k in range(3) for i, p in enumerate(passages)]
    # Unique words between two repeats stay, however few.
    for gap in range(1, 6):
        a, b = passages[60 + gap], passages[80 + gap]
        rows.append((9000 + gap, f"{words(rng, 3)} {a} {words(rng, gap)} {b} {words(rng, 3)}"))
    got = passage_dedup.repeated_stretches(table(spark, rows).repartition(3)).collect()
    removed, want, near = removed_words(got, rows), plain_repeats(rows), plain_near_lines(rows)
    for i in want.keys() | removed.keys():  # short surroundings make a whole line near another one
        assert want[i] <= removed[i] <= want[i] | near.get(i, set())
    assert sum(removed[i] != want[i] for i in removed) <= 0.02 * len(removed)
    for gap in range(1, 6):
        assert len([r for r in got if r.doc_id == 9000 + gap]) == 2


def test_exact_repeats_of_the_table(spark):
    """On the documents, what goes covers all exact repeats, and beside them only near paragraphs."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text IS NOT NULL")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    removed = removed_words(passage_dedup.repeated_stretches(docs).collect(), rows)
    want, near = plain_repeats(rows), plain_near_lines(rows)
    missed = extra = 0
    for i in want.keys() | removed.keys():
        missed += len(want.get(i, set()) - removed.get(i, set()))
        extra += len(removed.get(i, set()) - want.get(i, set()) - near.get(i, set()))
    assert missed == 0 and extra == 0
    hits = sum(len(v & removed.get(i, set())) for i, v in near.items())
    assert hits >= 0.9 * sum(map(len, near.values()))


def plain_near_lines(rows, least=20):
    """Words of paragraphs near or equal to an earlier one, each compared with each (cut as the operator cuts)."""
    import pyarrow as pa

    parts = []
    for i, t in sorted(rows):
        owner, place, count, *_ = passage_dedup.paragraphs(pa.array([t]))[0]
        w = t.split()
        parts += [(i, p, n, shingles(" ".join(w[p : p + n]))) for p, n in sorted(zip(place.tolist(), count.tolist()))]
    links = [
        (a, b) for a in range(len(parts)) for b in range(a)
        if 100 * len(parts[a][3] & parts[b][3]) >= 75 * len(parts[a][3] | parts[b][3])
    ]
    component, out = components(range(len(parts)), links), {}
    for k, (i, p, n, _) in enumerate(parts):
        j, q, m, _ = parts[component[k]]
        if component[k] != k and (i != j or p >= q + m):
            out.setdefault(i, set()).update(range(p, p + n))
    return out


def test_two_texts_under_one_id(spark):
    rng = random.Random(13)
    a, b = words(rng, 40), words(rng, 40)
    rows = [(1, f"{words(rng, 5)} {a}"), (1, f"{words(rng, 9)} {b}"), (2, f"{a} {words(rng, 4)} {b}"), (3, f"{b} {b}")]
    cut = [(r.doc_id, len(r.text.split())) for r in passage_dedup.remove_stretches(table(spark, rows)).collect()]
    assert sorted(cut) == [(1, 45), (1, 49), (2, 4), (3, 0)]


def test_frequent_seeds_in_parts(spark, monkeypatch):
    """Three hundred copies of a passage in parts of seven agree with plain repeats."""
    monkeypatch.setattr(passage_dedup, "SHARE", 7)
    rng = random.Random(14)
    p, q = words(rng, 35), words(rng, 25)
    rows = [(i, f"{words(rng, rng.randint(0, 9))} {p if i % 3 else p[: len(p) // 2]} {q if i % 2 else ''} {words(rng, 3)}") for i in range(300)]
    got = passage_dedup.repeated_stretches(table(spark, rows).repartition(4)).collect()
    removed, want = removed_words(got, rows), plain_repeats(rows)
    for i, places in want.items():
        assert places <= removed[i]
