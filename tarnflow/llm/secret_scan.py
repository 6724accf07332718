"""Secret scans with an incremental blob ledger. DataFrame code only.

Texts are addressed by content (SHA-256). The ledger is a Parquet table that holds, for each pair
of blob and rule version it has seen, the findings. A scan takes any number of versions of any
number of paths, looks only at blobs the ledger lacks for the rule version, appends these, and
joins the findings back to every path and version.

Spans are ``kind:start:end`` of whole matches, in code points, end exclusive. Null counts as
empty; an empty text, or one without findings, gives empty strings and zeros. Equal texts (null
and empty too), repeated rows, ties in start (kinds in listed order) and extra columns are fine;
an empty table gives an empty result. No Python runs on the executors: the places of regex
matches follow from the lengths of the pieces between them.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnflow.llm.common import scratch_path, stage
from tarnflow.sources.storage import path_exists

# The base rules of the contract.
ASSIGN = (
    "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, of which those count whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    probe: str | None = None
    """A pattern every text with a finding matches; a cheap test before the places are worked out."""


BASE = (
    Rule("assign", ASSIGN, 8, 2, ASSIGN.replace("-]+)", "-]{8})")),
    Rule("access", ACCESS, 16, 0, "AKIA[A-Z0-9]{12}"),
    Rule("hex", HEX, 32, 0, "[0-9a-f]{32}"),
)
#: What the method adds: tokens with a fixed prefix, and private keys.
ADDED = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 15),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", 30),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 27),
)
RULES = (*BASE, *ADDED)


def rule_version(rules: tuple[Rule, ...]) -> str:
    """A name that changes with any rule, and with their order."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


#: Pieces between matches whose places are worked out together.
PIECES = 256

SPAN = "array<struct<start:long,rank:int,kind:string,end:long>>"


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Array of (start, rank, kind, end) of a rule's findings in ``text``."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    group = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    gaps = F.split(text, rule.pattern, -1)
    lengths = F.transform(
        F.arrays_zip(gaps.alias("gap"), found.alias("hit"), group.alias("part")),
        lambda x: F.struct(
            F.char_length(x["gap"]).cast("long").alias("gap"),
            F.coalesce(F.char_length(x["hit"]), F.lit(0)).cast("long").alias("hit"),
            F.coalesce(F.char_length(x["part"]), F.lit(0)).alias("part"),
        ),
    )
    # Places are running sums. Pieces go by blocks: the sums of whole blocks come first, so that the arrays
    # that grow by one element at a time are a block's, or one element a block, and not one a finding.
    size = F.size(lengths)
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), (size - 1) / PIECES).cast("int")),
        lambda k: F.slice(lengths, k * PIECES + 1, F.lit(PIECES)),
    )
    sums = F.transform(
        blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda a, x: a + x["gap"] + x["hit"])
    )
    begin = F.aggregate(
        sums,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("out")),
        lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
    )["out"]
    walked = F.flatten(
        F.transform(
            F.arrays_zip(blocks.alias("pieces"), begin.alias("at")), lambda b: _walk(b["pieces"], b["at"], rule, rank)
        )
    )
    return F.when(text.rlike(rule.probe or rule.pattern), walked).otherwise(F.array().cast(SPAN))


def _walk(pieces: Column, start: Column, rule: Rule, rank: int) -> Column:
    """The findings of one block of pieces that begins at ``start``."""
    empty = F.struct(start.alias("at"), F.array().cast(SPAN).alias("out"))
    return F.aggregate(
        pieces,
        empty,
        lambda a, x: F.struct(
            (a["at"] + x["gap"] + x["hit"]).alias("at"),
            F.when(
                x["part"] >= rule.least,
                F.concat(
                    a["out"],
                    F.array(
                        F.struct(
                            (a["at"] + x["gap"]).alias("start"),
                            F.lit(rank).alias("rank"),
                            F.lit(rule.kind).alias("kind"),
                            (a["at"] + x["gap"] + x["hit"]).alias("end"),
                        )
                    ),
                ),
            ).otherwise(a["out"]).alias("out"),
        ),
    )["out"]


def find_spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All findings of a text, by start and then by the order of the rules."""
    return F.array_sort(F.concat(*[_spans(text, rule, i) for i, rule in enumerate(rules)]))


def spans_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _ledger(df_path: str, spark) -> DataFrame:
    schema = f"blob string, rule_version string, spans {SPAN}"
    if not path_exists(spark, df_path):  # the first scan
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(df_path)


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES,
         version: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, blob, spans)`` for each row of ``versions`` (a version of a path).

    The rule version follows from the rules themselves: with other rules, every blob is unseen. (``version``
    sets it by hand, say when what a rule means changed outside its text.)

    ``ledger`` is the folder of the ledger, on shared storage; it grows by the unseen blobs. A
    scan that failed half-way can be repeated; pairs that got in twice are merged when read.
    """
    spark, version = versions.sparkSession, version or rule_version(rules)
    text = F.coalesce(F.col(text_col), F.lit(""))
    blobs = versions.select(
        F.col(id_col).alias("__id"), text.alias("__text"), F.sha2(text.cast("binary"), 256).alias("blob")
    )
    known = _ledger(ledger, spark).where(F.col("rule_version") == version).select("blob")
    # Ids first, so that one text of each unseen blob is scanned and copies never travel.
    unseen = (
        blobs.groupBy("blob").agg(F.min(F.struct(F.col("__id").isNull(), F.col("__id").alias("id"))).alias("f"))
        .join(known, "blob", "left_anti")
        .select(F.col("blob").alias("__b"), F.col("f.id").alias("__first"))
    )
    texts = blobs.join(
        unseen, (F.col("blob") == F.col("__b")) & F.col("__id").eqNullSafe(F.col("__first")), "left_semi"
    )
    fresh = texts.select(
        "blob", F.lit(version).alias("rule_version"), find_spans(F.col("__text"), rules).alias("spans")
    )
    # Blobs without findings are entered too: the ledger must know that they were seen.
    fresh.write.mode("append").parquet(ledger)
    # Written, so that the join sees a plain table and Spark can split a blob with many paths.
    seen = stage(
        _ledger(ledger, spark).where((F.col("rule_version") == version) & (F.size("spans") > 0))
        .dropDuplicates(["blob"]).select("blob", "spans"),
        "findings",
    )
    return blobs.select("__id", "blob").join(seen, "blob", "left").select(
        F.col("__id").alias(id_col),
        "blob",
        F.coalesce("spans", F.array().cast(SPAN)).alias("spans"),
    )


def redacted(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """``text`` with every stretch that spans cover replaced by ``mask``; null stays null."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    walked = F.aggregate(
        spans,
        start,
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    a["out"],
                    text.substr((a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                    F.lit(mask),
                ).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))),
        lambda a: F.concat(a["out"], text.substr((a["at"] + 1).cast("int"), F.char_length(text))),
    )
    return F.when(F.size(spans) > 0, walked).otherwise(text)


def redact_secrets(docs: DataFrame, ledger: str | None = None, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``docs`` with the findings of the scan masked in the texts; no row is dropped."""
    ledger = ledger or scratch_path(docs.sparkSession, "ledger")
    columns = docs.columns
    found = (
        scan(docs, ledger, id_col=id_col, text_col=text_col).where(F.size("spans") > 0)
        .select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans")).dropDuplicates(["__blob"])
    )
    keyed = docs.withColumn("__key", F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    joined = keyed.join(found, F.col("__key") == F.col("__blob"), "left")
    text = F.when(F.col("__spans").isNotNull(), redacted(F.col(text_col), F.col("__spans")))
    return joined.select(
        *[
            F.coalesce(text, F.col(c)).alias(c) if c == text_col else F.col(f"`{c}`")
            for c in columns
        ]
    )
