"""Filter audit, vector codes and page texts: odd cases and plain versions."""

import hashlib
import html
import math
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnflow.llm import filter_audit, html_trees, page_text, queries, vector_codes
from tests.llm.helpers import ODD, clashing

SF = "/root/testdata/sf0.001"

# --- filter audit ------------------------------------------------------------------------------

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
AUDITED = [
    *((i, t, "s") for i, t in ODD),
    *((20 + i, " ".join(f"w{i}x{k}" for k in range(250)), "s") for i in range(3)),
    (30, " ".join(f"W{k}" for k in range(250)), None),
    (31, " ".join(f"W{k}" for k in range(250)), ""),
    (32, " ".join(f"w{k}#" for k in range(250)), "t"),
    (33, "same " * 250, "t"),
    (34, "same " * 250, "u"),
    (35, "", "t"),
]
LABELS = [(20, 1, 0), (21, 0, 1), (22, None, None), (32, 1, 1), (34, 1, 0), (34, 0, 1), (99, 1, 1), (None, 1, 1)]


def plain_audit(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    parts = {}
    for i, t, s in rows:
        t = t or ""
        w = WORDS.findall(t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and i > first[t],
        }
        own = [x for x in labels if i is not None and x[0] == i]
        parts.setdefault(s or "", []).append(
            ({f for f, bad in fails.items() if bad}, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own))
        )
    out = {}
    for part, docs in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                removed = [d for d in docs if f in d[0] and not d[0] & before]
                shapley[f] += len(removed)
                out[part, "".join(order), k + 1] = [
                    sum(not d[0] & (before | {f}) for d in docs), len(removed),
                    sum(f in d[0] and bool(d[0] & before) for d in docs), sum(d[0] == {f} for d in docs),
                    sum(d[1] for d in removed), sum(d[2] for d in removed),
                ]
        for (p, order, k), row in out.items():
            if p == part:
                row.append(shapley[order[k - 1]])
    return out


@pytest.mark.parametrize("chunk", [1 << 18, 3])
def test_audit_against_a_plain_one(spark, monkeypatch, chunk):
    monkeypatch.setattr(filter_audit, "CHUNK", chunk)
    docs = spark.createDataFrame(AUDITED, "doc_id long, text string, source string")
    for name in ("part", "id", "fails", "key", "least", "good", "before", "filter", "step"):
        docs = docs.withColumn(name, F.lit(1))
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("id", F.lit(1))
    got = filter_audit.audit(docs, labels).collect()
    want = plain_audit(AUDITED, LABELS)
    assert len(got) == len(want) == 600 * 4  # null and empty parts are one
    for r in got:
        assert list(r)[3:] == want[r.part, r.filter_order, r.step]


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
    some = spark.createDataFrame(AUDITED, "doc_id long, text string, source string")
    assert {r.good_lost for r in filter_audit.audit(some, labels).collect()} == {0}


def test_galloping_finds_places_and_merges():
    rng = np.random.default_rng(1)
    for n, m in ((0, 5), (5, 0), (1, 1), (1000, 30), (30, 5000), (4000, 4000)):
        a = np.unique(rng.integers(0, 6000, n))
        b = np.unique(rng.integers(0, 6000, m))
        if len(b):
            assert (filter_audit.gallop(a, b) == np.searchsorted(a, b)).all()
        assert (filter_audit.is_in(a, b) == np.isin(b, a)).all()
        c = np.unique(rng.integers(0, 6000, 77))
        assert (filter_audit.union([a, b, c]) == np.unique(np.concatenate([a, b, c]))).all()


# --- vector codes ------------------------------------------------------------------------------


def plain_codes(rows, entries, rounds):
    """Every part against every entry, in each round, with Python's integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept = [(i, [math.floor(1024 * x) for x in v], g) for i, v, g in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 4) * 4
    kept = [(i, v + [0] * (width - len(v)), g) for i, v, g in kept]
    d = width // 4
    books = [[v[p * d : p * d + d] for _, v, _ in kept[:entries]] for p in range(4)]

    def nearest(part, book):
        far = [sum((x - y) ** 2 for x, y in zip(part, e)) for e in book]
        return min(range(len(book)), key=lambda k: (far[k], k)), min(far)

    for k in range(rounds + 1):
        found = [[nearest(v[p * d : p * d + d], books[p]) for p in range(4)] for _, v, _ in kept]
        if k < rounds:
            for p in range(4):
                for e in range(len(books[p])):
                    own = [v[p * d : p * d + d] for (_, v, _), f in zip(kept, found) if f[p][0] == e]
                    if own:
                        books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = {}
    for (_, _, g), f in zip(kept, found):
        errors[g] = errors.get(g, 0) + sum(x[1] for x in f)
    return sorted(
        (str(i), "".join(f"{x[0]:02x}" for x in f), sum(x[1] for x in f), errors[g], digest)
        for (i, _, g), f in zip(kept, found)
    )


def vectors(rng, n, width):
    centres = rng.normal(size=(12, width))
    return [
        (i, [float(np.float32(x)) for x in centres[i % 12] + rng.normal(size=width) * rng.choice([0.0, 0.1, 0.4])], i % 3)
        for i in range(n)
    ]


@pytest.mark.parametrize("entries, width", [(16, 8), (256, 8), (5, 6)])
def test_codes_against_a_plain_run(spark, entries, width):
    rows = vectors(np.random.default_rng(entries), 300, width)
    rows += [(1000, None, 1), (1001, [None] * width, 1), (1002, [float("nan")] * width, 1),
             (1003, [float("inf")] + [0.0] * (width - 1), None), (1004, [], None), (1005, [0.0] * width, None),
             (1006, [1.0] * (width - 1), 7), (3, [0.5] * width, 0), (3, [0.5] * width, 0), (None, [2.0] * width, 0),
             (1007, [100.0] * width, 1)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for name in ("x", "at", "far", "part", "entry", "code"):
        df = df.withColumn(name, F.lit(1))
    got = vector_codes.compress(df, entries=entries).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == plain_codes(rows, entries, 4)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(x) for x in np.random.default_rng(i).integers(-90_000, 90_000, 4)], None) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = vector_codes.compress(df, entries=7).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == plain_codes(rows, 7, 4)


def test_active_entries_agree_with_full_scans():
    rng = np.random.default_rng(3)
    x, book = rng.integers(-6, 6, (500, 3)), rng.integers(-6, 6, (20, 3))
    at, far = vector_codes.assign(x, book, np.ones(20, bool), np.full(500, -1), np.zeros(500, np.int64))
    for _ in range(5):
        moved = rng.random(20) < 0.3
        book = np.where(moved[:, None], rng.integers(-6, 6, (20, 3)), book)
        at, far = vector_codes.assign(x, book, moved, at, far)
        full = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        assert (at == full.argmin(axis=1)).all() and (far == full.min(axis=1)).all()


def test_codes_of_nothing(spark):
    assert vector_codes.compress(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


# --- page texts --------------------------------------------------------------------------------


def text_of(page):
    tree, _, blocks = page_text.parse_page(page)
    tree = html_trees.as_tree(__import__("json").loads(tree))
    kept = set(page_text.content_leaves(tree, list(range(html_trees.size(tree))), set()))
    return " ".join(t for leaf, t in blocks if leaf in kept)


@pytest.mark.parametrize(
    "page, want",
    [
        ("", ""),
        ("just text &amp; more\n\nof it", "just text & more of it"),
        ("<article><p>One<b>two</b> <i>three</i><br>four<p>five<li>six</article>out", "Onetwo three four five six"),
        ("<article><h2>a</h2><p>b</p><h2>c</h2><p>d</p><ul><li>e<li>f</ul><h2>g</h2><p>h</p></article>", "a b c d e f g h"),
        ("<p title='a>b' data-x=\"<p>\">x &lt;p&gt; 1 < 2 &#8217;&nbsp;y</p><!-- <p>z</p> -->", "x <p> 1 < 2 ’ y"),
        ("<body><script>var t='<p>no</p>'</script><style>p{}</style><main><p>yes</p><form>no<input></form></main>", "yes"),
        ("<div class='cookie-notice'>We use cookies</div><div class=post-content><p>Text</p>"
         "<aside>Side</aside><div class='share-bar'>Share</div></div><div id=comments><p>Nice!</p></div>", "Text"),
        ("<header><h1>Site</h1></header><nav>Menu</nav><article><header><h1>Title</h1></header><p>Body</p>"
         "<footer>by me</footer></article><section class=comments><article class=comment>Hm</article></section>", "Title Body"),
        ("<div class='layout has-sidebar'><div class=sidebar>No</div><div><article>Yes</article></div></div>", "Yes"),
        ("<div class='sidebar wrap'><article><p>Inside</p><div class=ad>Buy</div></article></div>", "Inside"),
        ("<p>cut off <b>here</b> and <a href='x", "cut off here and"),
        ("<ul><li><a href=/a>Menu</a><li><a href=/b>More</a></ul><p>Text with <a href=/c>a link</a> in it.</p>",
         "Text with a link in it."),
        ("<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after", "deep after"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<p>a</p><div hidden>no</div><div style='display: none'>no</div><p>b</p>", "a b"),
        ("<article><p>x <span class=ad>buy <span>now</span></span> y</p></article>", "x y"),
    ],
)
def test_text_of_one_page(page, want):
    assert text_of(page) == want


def small_tree(rng, depth=3):
    return (rng.choice("abc"), tuple(small_tree(rng, depth - 1) for _ in range(rng.randint(0, 3))) if depth else ())


def plain_matched(a, b):
    if a[0] != b[0]:
        return 0
    most = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1]):
        for j, y in enumerate(b[1]):
            most[i + 1][j + 1] = max(most[i][j + 1], most[i + 1][j], most[i][j] + plain_matched(x, y))
    return 1 + most[-1][-1]


def test_tree_matching_and_merging():
    rng = random.Random(4)
    for _ in range(400):
        a, b = (("a", small_tree(rng)[1]) for _ in range(2))
        assert html_trees.matched(a, b) == plain_matched(a, b)
        tree, of_a, of_b = html_trees.merge(a, b)
        assert html_trees.size(tree) == html_trees.size(a) + html_trees.size(b) - plain_matched(a, b)
        names = html_trees.labels_above(tree)
        for part, places in ((a, of_a), (b, of_b)):
            assert [names[k] for k in places] == html_trees.labels_above(part) and sorted(places) == list(places)
            assert plain_matched(part, tree) == html_trees.size(part)


def wrapped(k, article, extra=""):
    """A page of a host that says nothing with its markup: what is template shows from the other pages."""
    return (
        f"<html><head><title>t{k}</title></head><body><div><div>The Daily Page</div><div><a href=/{k}>Home {k}</a></div></div>"
        f"<div><div>Sign in to read more stories every day</div><div>{article}</div>{extra}"
        "<div>All rights reserved by us</div></div></body></html>"
    )


def test_constant_nodes_are_template(spark):
    def story(k):
        return "".join(f"<p>Story {k} says thing {j} here.</p>" for j in range(k % 4 + 1))

    rows = [(k, f"https://Host.example/{k}", wrapped(k, story(k))) for k in range(12)]
    # Copies of one article under many urls do not make it template.
    rows += [(100 + k, f"https://host.example:80/copy{k}", wrapped(100 + k, "<p>Copied story of many urls.</p>")) for k in range(60)]
    rows += [(200, None, None), (201, "nonsense", "<p>Alone</p>"), (202, "http://other.example/", "")]
    rows += [(0, "https://host.example/0", wrapped(0, story(0)))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("host", "shape", "tree", "blocks", "kept", "text", "n_chars"):
        df = df.withColumn(name, F.lit(1))
    got = page_text.extract(df.repartition(3)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id < 12:
            assert r.text == " ".join(f"Story {r.page_id} says thing {j} here." for j in range(r.page_id % 4 + 1))
        elif 100 <= r.page_id < 200:
            assert r.text == "Copied story of many urls."
        else:
            assert r.text == {200: "", 201: "Alone", 202: ""}[r.page_id]
        assert r.n_chars == len(r.text)


def test_many_trees_of_a_host_merge_in_groups(spark, monkeypatch):
    monkeypatch.setattr(page_text, "FAN", 3)
    tags = ["p", "ul", "pre", "h2", "table"]
    rows = []
    for k, order in enumerate(permutations(tags)):
        inner = "".join(f"<{t}>{t} {k} x</{t}>" for t in order[: 2 + k % 4])
        rows.append((k, "http://h.example/x", f"<nav>n</nav><article>{inner}</article><footer>f {k}</footer>"))
    got = page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    for r in got:
        order = list(permutations(tags))[r.page_id][: 2 + r.page_id % 4]
        assert r.text == " ".join(f"{t} {r.page_id} x" for t in order)


def test_page_texts_of_nothing(spark):
    assert page_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def plain_article(page):
    """The article of a page as this table writes them, by regular expressions."""
    found = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
    marked = re.sub(r"</?(p|h1)>", "\0", found[1].replace("<br>", " ")) if found else ""
    blocks = re.sub(r"</?b>", "", marked).split("\0")
    return " ".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)


def test_op12_against_a_plain_extraction(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.QUERIES["op12_page_text"](spark, SF).collect()
    assert {r.page_id: r.text for r in got} == {k: plain_article(v) for k, v in pages.items()}
    assert all(r.n_chars == len(r.text) for r in got)
