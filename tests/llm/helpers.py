"""Small tables with every odd case, and plain versions of what the operators compute."""

import re
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ODD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta"),
    (2, "alpha  beta gamma\tdelta epsilon zeta eta theta\n"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "one two"),
    (7, "ONE two"),
    (8, "naïve café ☃ 日本語 \U0001f600 words that are not ascii at all"),
    (9, "x" * 50_000),
    (10, "long " * 20_000),
    (None, "alpha beta gamma delta epsilon zeta eta theta"),
    (11, "one two"),
    (11, "one two"),
]


def table(spark, rows, names="doc_id long, text string, lang string, source string, n_chars long"):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], names)


def clashing(spark, rows):
    """With extra columns whose names operators might want for themselves."""
    df = table(spark, rows)
    for name in (
        "id", "n", "key", "row", "kept", "u", "v", "component", "spans", "blob", "start", "x", "starts", "n_lines",
        "n_removed", "at", "h", "h1", "h2", "keep_id", "score", "text_sha256", "first", "c", "end", "place", "labels",
        "cluster", "items", "vec", "token",
    ):
        df = df.withColumn(name, df["n_chars"])
    return df


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def jaccard_components(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    links = [
        (a, b) for (a, x), (b, y) in combinations(sets, 2)
        if x and y and 100 * len(x & y) >= 75 * len(x | y)
    ]
    return components({i for i, _ in sets}, links)


def near_copies(rng, groups, size, words=60, changes=2):
    """Texts of which many lie close to the threshold."""
    out, vocabulary = [], [f"w{i}" for i in range(3000)]
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, changes)):
                text[rng.randrange(words)] = rng.choice(vocabulary)
            out.append(" ".join(text))
    return list(enumerate(out))
