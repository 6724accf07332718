"""Main texts of pages by wrapper induction over the pages of a host.

1. Every page is parsed once, into its folded tree (``html_trees``) and its blocks of text, each with the
   leaf it stands at. Both are written; later steps read leaves and hashes, and the last one texts.
2. The distinct trees of a host are merged into its template by simple tree matching, in groups of
   ``FAN`` trees at a time, until one tree is left. So a host of any number of pages is merged by
   many tasks, and copies of a tree are merged once.
3. Every distinct tree is aligned with its host's template, and what stands at each node of it is counted
   over all pages: the share of the most frequent text. Pages that agree in the node's text and in all
   other texts (links and what is no content by its element aside) count once, so that copies of an
   article don't look like a template.
4. A leaf whose text is the same on ``CONSTANT`` percent of the pages (at least ``LEAST_PAGES``) is
   template. The other leaves are slots, and a slot is content unless what it stands in says otherwise: menus,
   headers, footers, sidebars, notices, adverts, forms, comments, by element, class, id or role. Where a
   tree has an article (else a main element, else a block named as content), content lies in it; elsewhere
   every varying slot that is not mostly links is content. The longest block of a page without any
   markup around it is a slot like others.
5. The blocks at content leaves, in page order, joined by one blank, are the page's text.

Blocks are stretches of text between block elements; references are decoded, white space inside becomes
one blank. Scripts, styles, comments and titles are never text. Open elements end where HTML lets them
end or at the end of the page, cut-off tags are dropped, and elements below level ``DEPTH`` are read as part of
that level. A null or empty page, and one without content, has an empty text. Pages without a
host (null or odd url) form one host. Repeated rows and ids are rows like others. Pages may be of any
length: one page is held at a time with the trees around it. Empty tables give an empty result; extra
columns are left out.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnflow.llm.common import scratch_path, slices, sorted_runs, stage
from tarnflow.llm.html_trees import as_tree, folded, kind, labels_above, matched, merge, page_tree, size

CONSTANT = 90
LEAST_PAGES = 3
FAN = 256
HOST = re.compile("^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)")

PARSED = (
    "page_id long, url string, host string, shape long, tree string,"
    " leaves array<struct<leaf:int,hash:long,others:long>>, blocks array<struct<leaf:int,text:string>>"
)


def host_of(url: str | None) -> str:
    found = HOST.match(url or "")
    return found[1].lower() if found else ""


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def parse_page(page: str) -> tuple[str, list[tuple[int, int, int]], list[tuple[int, str]]]:
    """A page's tree as JSON, what stands at each leaf and at all others, and its blocks.

    Texts are known by a hash, and the others of a leaf by the sum of theirs.
    """
    tree, texts = folded(page_tree(page))
    texts.sort(key=lambda t: t[1])
    above, together = labels_above(tree), {}
    for leaf, _, text in texts:
        together.setdefault(leaf, []).append(text)
    hashes = {leaf: _hash("\n".join(parts)) for leaf, parts in together.items()}
    counted = {
        leaf: hashed for leaf, hashed in hashes.items()
        if above[leaf][-1] == "#" and not any(kind(name) == "never" for name in above[leaf])
    }
    total = sum(counted.values())
    others = {leaf: (total - counted.get(leaf, 0) + (1 << 63)) % (1 << 64) - (1 << 63) for leaf in hashes}
    encoded = json.dumps(tree, ensure_ascii=False, separators=(",", ":"))
    return encoded, [(k, v, others[k]) for k, v in hashes.items()], [(k, t) for k, _, t in texts]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [name.split()[0] for name in re.split(",(?= )", PARSED)]
    leaf_type = pa.list_(pa.struct([("leaf", pa.int32()), ("hash", pa.int64()), ("others", pa.int64())]))
    block_type = pa.list_(pa.struct([("leaf", pa.int32()), ("text", pa.string())]))
    for part in slices(batches, "html", 1 << 22):
        pages = part.column("html")
        out = [parse_page(pages[i].as_py() or "") for i in range(len(part))]
        yield pa.record_batch(
            [
                part.column("page_id"), part.column("url"),
                pa.array([host_of(u) for u in part.column("url").to_pylist()], pa.string()),
                pa.array([_hash(t[0]) for t in out], pa.int64()),
                pa.array([t[0] for t in out], pa.string()),
                pa.array([[{"leaf": k, "hash": v, "others": o} for k, v, o in t[1]] for t in out], leaf_type),
                pa.array([[{"leaf": k, "text": x} for k, x in t[2]] for t in out], block_type),
            ],
            names,
        )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One tree per group, of rows that come sorted by group."""
    for run in sorted_runs(batches, "group"):
        trees = sorted({as_tree(json.loads(t)) for t in run.column("tree").to_pylist()}, key=lambda t: (-size(t), t))
        template = trees[0]
        for tree in trees[1:]:
            template = merge(template, tree)[0]
        encoded = json.dumps(template, ensure_ascii=False, separators=(",", ":"))
        yield pa.record_batch(
            [run.column("host").combine_chunks()[:1], pa.array([_hash(encoded)]), pa.array([encoded])],
            ["host", "shape", "tree"],
        )


def templates(shapes: DataFrame) -> DataFrame:
    """``(host, tree)``: the merged tree of each host of ``shapes(host, shape, tree)``."""
    while True:
        sizes = stage(
            shapes.groupBy("host").agg(F.expr(f"(count(*) + {FAN} - 1) div {FAN}").alias("groups")), "groups"
        )
        # Trees of one group lie side by side in one task; a host has as many groups as it needs.
        grouped = shapes.join(sizes, "host").withColumn(
            "group", F.xxhash64("host", F.pmod("shape", F.col("groups")))
        )
        merged = (
            grouped.select("group", "host", "tree").repartition("group").sortWithinPartitions("group")
            .mapInArrow(_merged, "host string, shape long, tree string")
        )
        shapes = stage(merged, "templates")
        if sizes.where("groups > 1").isEmpty():
            return shapes.select("host", "tree")


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each node of a tree stands in its host's template."""
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("tree", "template")))
        places = []
        for tree, template in rows:
            tree, template = as_tree(json.loads(tree)), as_tree(json.loads(template))
            merged, of_tree, of_template = merge(tree, template)
            # A tree fits into its template as a whole; what should not is a slot of its own, past the end.
            known = {m: k for k, m in enumerate(of_template)}
            places.append([known.get(m, size(template) + k) for k, m in enumerate(of_tree)])
        yield pa.record_batch(
            [batch.column("host"), batch.column("shape"), batch.column("tree"),
             pa.array(places, pa.list_(pa.int32()))],
            ["host", "shape", "tree", "slots"],
        )


def content_leaves(tree: tuple, slots: list[int], constant: set[int]) -> list[int]:
    """The leaves of a tree that are content, given the template's slots whose text does not vary."""
    above = labels_above(tree)
    found: dict[str, list[int]] = {"1": [], "2": [], "3": [], "": []}
    for leaf, names in enumerate(above):
        if names[-1][:1] != "#" or slots[leaf] in constant:
            continue
        kinds = [kind(name) for name in names[:-1]]
        root = min((k for k in kinds if k in ("1", "2", "3")), default="")
        if "never" in kinds:
            # A container named like a sidebar that holds the article itself is no sidebar.
            first = kinds.index("never")
            if "1" not in kinds[first:] or names[first].split(" ")[0] not in ("div", "section"):
                continue
            if "never" in kinds[first + 1 :]:
                continue
        if "outside" in kinds and not (root and kinds.index("outside") > kinds.index(root)):
            continue
        if root:
            for level in {k for k in kinds if k in ("1", "2", "3")}:
                found[level].append(leaf)
        if names[-1] == "#":
            found[""].append(leaf)
    return next((leaves for leaves in found.values() if leaves), [])


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("tree", "slots", "constant")))
        kept = [content_leaves(as_tree(json.loads(t)), s, set(c or ())) for t, s, c in rows]
        yield pa.record_batch(
            [batch.column("host"), batch.column("shape"), pa.array(kept, pa.list_(pa.int32()))],
            ["host", "shape", "kept"],
        )


def constant_slots(parsed: DataFrame, shapes: DataFrame) -> DataFrame:
    """``(host, constant)``: the slots of each template whose text is the same on nearly all pages."""
    stands = shapes.select("host", "shape", "slots")
    seen = (
        parsed.select("host", "shape", F.explode("leaves").alias("l"))
        .join(stands, ["host", "shape"])
        .select("host", F.expr("slots[l.leaf]").alias("slot"), "l.others", "l.hash").distinct()
    )
    # Counts of texts first: a slot's rows are combined before they meet.
    texts = seen.groupBy("host", "slot", "hash").agg(F.count("*").alias("n"))
    return (
        texts.groupBy("host", "slot").agg(F.sum("n").alias("pages"), F.max("n").alias("most"))
        .where(f"pages >= {LEAST_PAGES} AND 100 * most >= {CONSTANT} * pages")
        .groupBy("host").agg(F.collect_set("slot").alias("constant"))
    )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per row of ``pages``."""
    spark = pages.sparkSession
    path = scratch_path(spark, "pages")
    pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    ).mapInArrow(_parsed, PARSED).write.option("compression", "zstd").parquet(path)
    parsed = spark.read.schema(PARSED).parquet(path)

    shapes = stage(parsed.groupBy("host", "shape").agg(F.min("tree").alias("tree")), "shapes")
    whole = templates(shapes).withColumnRenamed("tree", "template")
    aligned = stage(
        shapes.join(whole, "host").mapInArrow(
            _aligned, "host string, shape long, tree string, slots array<int>"
        ),
        "aligned",
    )
    constant = stage(constant_slots(parsed, aligned), "constant")
    # Written: Spark knows its size, and sends it to the texts or the texts to it.
    kept = stage(
        aligned.join(constant, "host", "left").mapInArrow(_decided, "host string, shape long, kept array<int>"),
        "content",
    )
    chosen = F.filter("blocks", lambda b: F.array_contains("kept", b["leaf"]))
    text = F.array_join(F.transform(chosen, lambda b: b["text"]), " ")
    return parsed.join(kept, ["host", "shape"]).select(
        F.col("page_id").alias(id_col), F.col("url").alias(url_col), text.alias("text")
    ).withColumn("n_chars", F.char_length("text").cast("long"))
