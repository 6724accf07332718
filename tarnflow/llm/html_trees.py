"""Pages as small trees of block elements, and simple tree matching between such trees.

A tree is ``(label, (child, ...))``. An element's label holds its tag and what its class, id and role say; a
leaf ``#`` stands for text and ``#a`` for text that is mostly links. Siblings that repeat (paragraphs, rows,
records of one class, and patterns of up to ``PERIOD`` siblings) are folded into one, so trees stay small
however long a page is, and a text knows the number of its leaf, in preorder.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from functools import lru_cache

import numpy as np

# HTML's elements by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote button center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr legend li main menu nav noscript object ol option p pre"
    " search section select summary svg table tbody td template tfoot th thead tr ul video audio canvas".split()
)
NOT_P = BLOCK - {"p"}
IN_HEAD = frozenset("title meta link script style base noscript template".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open one of these ends where the next begins, up to the element on the right.
ENDS = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
    "td": ("td th", "table"), "th": ("td th", "table"), "option": ("option", "select"),
}
#: Elements that are never the text of a page.
NEVER = frozenset(
    "nav aside footer form fieldset button select option dialog noscript template object svg video audio canvas"
    " head search menu".split()
)
#: Words in a class, id or role that say the same.
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo"
    " promotion promoted nav navbar navigation menu menus breadcrumb breadcrumbs sidebar related recommended"
    " recommendations share sharing social cookie cookies consent gdpr notice notices notification notifications"
    " alert popup modal overlay newsletter subscribe subscription signup login search form comment comments reply"
    " replies disqus respond pagination pager toolbar skip widget widgets copyright banner footer contentinfo"
    " complementary dialog hidden".split()
)
#: ... outside an article only.
OUTSIDE = frozenset("header masthead topbar side rail bottom".split())
WITHOUT = frozenset("has with no without is".split())
#: What an article lies in, best first.
ROOT_WORDS = frozenset("article articlebody post entry story content".split())

PERIOD = 4
DEPTH = 100
PAIRS = 1 << 22
FOLDED = frozenset("p li tr td th dt dd h1 h2 h3 h4 h5 h6 pre blockquote figure hr".split())

_NAME = "([a-zA-Z][^\\s/>]*+)"
TOKEN = re.compile(
    "<!--.*?(?:-->|\\Z)|<[!?][^>]*+(?:>|\\Z)|</" + _NAME + "[^>]*+(?:>|\\Z)|<" + _NAME
    + "((?:[^>=]++|=\\s*+\"[^\"]*+\"|=\\s*+'[^']*+'|=)*+)(>|\\Z)",
    re.S,
)
ATTRIBUTE = re.compile("([a-zA-Z-]+)(?:\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s>]*)))?")
_CAMEL = re.compile("[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@lru_cache(1 << 14)
def label(tag: str, attributes: str) -> str:
    """A tag with the words of its class, id and role."""
    words = set()
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape("".join(values))
        if name in ("class", "id", "role", "itemprop"):
            for one in value.split():
                parts = [w.lower() for w in _CAMEL.findall(one)]
                words.update(parts if not parts or parts[0] not in WITHOUT else ())
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            words.add("hidden")
        elif name == "style" and "display:none" in value.lower().replace(" ", ""):
            words.add("hidden")
    return " ".join([tag, *sorted(words)])


@lru_cache(1 << 14)
def kind(name: str) -> str:
    """``never``, ``outside`` (never outside an article), a root ``1`` to ``3``, or nothing."""
    tag, *words = name.split(" ")
    words = set(words)
    if tag in NEVER or (tag not in ("article", "main") and words & WORDS):
        return "never"
    if tag == "article":
        return "never" if words & {"comment", "comments", "reply", "hidden"} else "1"
    if tag == "main" or "main" in words or "articlebody" in words:
        return "2"
    if tag == "header" or words & OUTSIDE:
        return "outside"
    return "3" if words & ROOT_WORDS else ""


class _Open:
    __slots__ = ("tag", "node", "inline")

    def __init__(self, tag, node, inline=0):
        self.tag, self.node, self.inline = tag, node, inline


def page_tree(page: str) -> list:
    """``[label, children]``; a child is such a list, or a leaf ``(label, text, its number in the page)``."""
    root: list = ["", []]
    stack = [_Open("", root)]
    held: list[str] = []
    linked = count = 0
    in_link = False

    def flush():
        nonlocal linked, count
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            if stack[-1].tag == "head":
                stack.pop()
            stack[-1].node[1].append(("#a" if 2 * linked > len(text) else "#", text, count))
            count += 1
        linked = 0

    def close(names, barrier=()):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return
            if stack[i].tag in barrier:
                return

    def say(text):
        nonlocal linked
        text = html.unescape(text) if "&" in text else text
        held.append(text)
        if in_link:
            linked += len(text.strip())

    at = 0
    while True:
        token = TOKEN.search(page, at)
        if token is None:
            say(page[at:])
            break
        if token.start() > at:
            say(page[at : token.start()])
        at = token.end()
        closed, opened, attributes, bracket = token.groups()
        if closed:
            tag = closed.lower()
            if tag == "a":
                in_link = False
            elif tag in BLOCK:
                flush()
                in_link = False
                names, barrier = ENDS.get(tag, (tag, ""))
                close((tag,), barrier.split())
            elif stack[-1].inline and stack[-1].tag == tag:
                stack[-1].inline -= 1
                if not stack[-1].inline:
                    flush()
                    stack.pop()
        elif opened and bracket:
            tag = opened.lower()
            if tag in RAW:
                end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            elif tag == "br":
                held.append(" ")
            elif tag == "hr":
                flush()
                close(("p",), NOT_P)
            elif tag in ("html", "body"):
                flush()
                if stack[-1].tag == "head":
                    stack.pop()
            elif tag not in VOID:
                name = label(tag, attributes) if "=" in attributes or "hidden" in attributes else tag
                if tag in BLOCK:
                    flush()
                    in_link = False
                    if stack[-1].tag == "head" and tag not in IN_HEAD:
                        stack.pop()
                    close(("p",), NOT_P)
                    if tag in ENDS:
                        names, barrier = ENDS[tag]
                        close(names.split(), barrier.split())
                    elif tag in HEADING and stack[-1].tag in HEADING:
                        stack.pop()
                    node = [name, []]
                    stack[-1].node[1].append(node)
                    # Deeper ones are read into the one at that depth; their text stays.
                    stack.append(_Open(tag, node if len(stack) < DEPTH else stack[-1].node))
                elif stack[-1].inline and stack[-1].tag == tag:
                    stack[-1].inline += 1
                elif name != tag and kind(name) == "never" and not attributes.rstrip().endswith("/"):
                    flush()
                    node = [name, []]
                    stack[-1].node[1].append(node)
                    stack.append(_Open(tag, node if len(stack) < DEPTH else stack[-1].node, 1))
                if tag == "a":
                    in_link = "href" in attributes
    flush()
    return root


@lru_cache(1 << 16)
def size(tree: tuple) -> int:
    return 1 + sum(size(child) for child in tree[1])


def _matches(xs: tuple, ys: tuple) -> list[tuple[int, int]]:
    """Simple tree matching of two rows of siblings: the pairs, in order, that match the most nodes."""
    head = 0
    while head < min(len(xs), len(ys)) and xs[head] == ys[head]:
        head += 1
    tail = 0
    while tail < min(len(xs), len(ys)) - head and xs[-1 - tail] == ys[-1 - tail]:
        tail += 1
    a, b = xs[head : len(xs) - tail], ys[head : len(ys) - tail]
    inner: list[tuple[int, int]] = []
    if len(a) * len(b) > PAIRS:  # each takes the next of its label: no table of all pairs
        places: dict[str, list[int]] = {}
        for j, y in enumerate(b):
            places.setdefault(y[0], []).append(j)
        after = 0
        for i, x in enumerate(a):
            of = places.get(x[0], [])
            k = bisect_left(of, after)
            if k < len(of):
                inner.append((i, of[k]))
                after = of[k] + 1
    elif a and b:
        most = np.zeros((len(a) + 1, len(b) + 1), np.int32)
        weights: dict[tuple, list[int]] = {}
        for i, x in enumerate(a):
            if x not in weights:
                weights[x] = [matched(x, y) for y in b]
            row = np.maximum(most[i, 1:], most[i, :-1] + weights[x])
            most[i + 1, 1:] = np.maximum.accumulate(row)
        i, j = len(a), len(b)
        while i and j:
            if most[i, j] == most[i - 1, j]:
                i -= 1
            elif most[i, j] == most[i, j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                inner.append((i, j))
        inner.reverse()
    return [
        *((i, i) for i in range(head)),
        *((head + i, head + j) for i, j in inner),
        *((len(xs) - tail + i, len(ys) - tail + i) for i in range(tail)),
    ]


@lru_cache(1 << 16)
def matched(a: tuple, b: tuple) -> int:
    """How many nodes the best match of two trees pairs; their roots must agree."""
    if a[0] != b[0]:
        return 0
    if a == b:
        return size(a)
    return 1 + sum(matched(a[1][i], b[1][j]) for i, j in _matches(a[1], b[1]))


@lru_cache(1 << 14)
def merge(a: tuple, b: tuple) -> tuple[tuple, tuple, tuple]:
    """Both trees in one, and where the nodes of each stand in it (preorder)."""
    if a == b:
        same = tuple(range(size(a)))
        return a, same, same
    children, of_a, of_b, at = [], [0], [0], 1
    i = j = 0
    for x, y in [*_matches(a[1], b[1]), (len(a[1]), len(b[1]))]:
        for rest, places in ((a[1][i:x], of_a), (b[1][j:y], of_b)):
            for child in rest:
                places.extend(range(at, at + size(child)))
                children.append(child)
                at += size(child)
        if x < len(a[1]):
            child, in_a, in_b = merge(a[1][x], b[1][y])
            of_a.extend(at + k for k in in_a)
            of_b.extend(at + k for k in in_b)
            children.append(child)
            at += size(child)
        i, j = x + 1, y + 1
    return (a[0], tuple(children)), tuple(of_a), tuple(of_b)


def _repeats(a: tuple, b: tuple) -> bool:
    """Whether two siblings are records of one kind."""
    return a[0] == b[0] and (a == b or a[0].split(" ")[0] in FOLDED or " " in a[0] or a[0][0] == "#")


def folded(node: list) -> tuple[tuple, list[tuple[int, int, str]]]:
    """A page's tree with repeats folded, and its texts: ``(leaf, number in the page, text)``."""
    rows: list[list] = []  # of (tree, texts) of the siblings so far
    for child in node[1]:
        if isinstance(child, tuple):
            rows.append([(child[0], ()), [(0, child[2], child[1])]])
        else:
            rows.append(list(folded(child)))
        for k in range(1, PERIOD + 1):
            if len(rows) >= 2 * k and all(_repeats(rows[-2 * k + m][0], rows[-k + m][0]) for m in range(k)):
                for m in range(k):
                    into, more = rows[-2 * k + m], rows[-k + m]
                    tree, of_a, of_b = merge(into[0], more[0])
                    if tree != into[0]:
                        into[0], into[1] = tree, [(of_a[i], n, t) for i, n, t in into[1]]
                    into[1].extend((of_b[i], n, t) for i, n, t in more[1])
                del rows[-k:]
                break
    at, texts = 1, []
    for tree, own in rows:
        texts.extend((at + i, n, t) for i, n, t in own)
        at += size(tree)
    return (node[0], tuple(tree for tree, _ in rows)), texts


def labels_above(tree: tuple) -> list[tuple[str, ...]]:
    """For every node in preorder, the labels from the root to it."""
    out: list[tuple[str, ...]] = []

    def walk(node, above):
        above = (*above, node[0])
        out.append(above)
        for child in node[1]:
            walk(child, above)

    walk(tree, ())
    return out


def as_tree(value: list) -> tuple:
    """A tree from its JSON."""
    return value[0], tuple(as_tree(child) for child in value[1])
