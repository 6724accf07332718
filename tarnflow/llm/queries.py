"""The registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnflow.llm import (
    embedding_dedup,
    exact_dedup,
    filter_audit,
    language_id,
    line_dedup,
    ngram_join,
    packing,
    page_text,
    passage_dedup,
    quality,
    secret_scan,
    sentencepiece_codec,
    vector_codes,
)
from tarnflow.llm.common import crc32_mod, read_table, scratch_path


def op1_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per stretch that repeats an earlier one: where it lies and who keeps the first."""
    return passage_dedup.repeated_stretches(read_table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_summary(read_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.quality_scores(
        read_table(spark, sf_dir, "documents").select("doc_id", "text"),
        read_table(spark, sf_dir, "labels"),
        may_learn=crc32_mod("doc_id", 5) != 0,
    )
    return scored.select(
        "doc_id",
        (crc32_mod("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, scratch_path(spark, "ledger"))
    base = F.filter("spans", lambda s: s["rank"] < len(secret_scan.BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(rule.kind) for rule in secret_scan.BASE],
        F.sha2(secret_scan.spans_text(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("spans")).alias("spans"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_removed",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language_id.learn_profiles(docs.where(crc32_mod("doc_id", 4) != 2))
    return language_id.predict_language(docs, profiles).select(
        "doc_id", (crc32_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(read_table(spark, sf_dir, "pages"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    return filter_audit.audit(docs.select("doc_id", "text", "source"), labels)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES = {
    "op1_passage_dedup": op1_passage_dedup,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_quality": op4_quality,
    "op5_secret_scan": op5_secret_scan,
    "op6_line_dedup": op6_line_dedup,
    "op7_packing": op7_packing,
    "op8_language_id": op8_language_id,
    "op9_ngram_join": op9_ngram_join,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_vector_codes": op11_vector_codes,
    "op12_page_text": op12_page_text,
    "op13_filter_audit": op13_filter_audit,
    "pipeline": pipeline,
}


def _spans_sql(kind: str, rank: int, pattern: str, options: str, group: int, least: int) -> str:
    """Places of a rule's findings: pieces between matches, then running lengths."""
    hits = f"regexp_extract_all(t, '{pattern}', 0{options})"
    parts = f"regexp_extract_all(t, '{pattern}', {group}{options})"
    gaps = f"string_split_regex(t, '{pattern}'{options})"
    return f"""
    SELECT doc_id, '{kind}' AS kind, {rank} AS rank, b AS start, b + h AS stop FROM (
      SELECT doc_id, p, h,
             sum(g) OVER (PARTITION BY doc_id ORDER BY i) + sum(h) OVER (PARTITION BY doc_id ORDER BY i) - h AS b
      FROM (SELECT doc_id, unnest(range(1, len({hits}) + 1)) AS i,
                   unnest([length(x) FOR x IN {gaps}][:len({hits})]) AS g,
                   unnest([length(x) FOR x IN {hits}]) AS h,
                   unnest([length(x) FOR x IN {parts}]) AS p
            FROM d)) WHERE p >= {least}"""


def _op5_sql() -> str:
    parts = []
    for rank, rule in enumerate(secret_scan.RULES):
        pattern = rule.pattern.replace("'", "''").replace("(?i:(", "((?i:").replace("))[", "))[")
        pattern = pattern if rule.kind != "assign" else (
            "((?i)password|passwd|secret|token|api_?key(?-i))"
            + rule.pattern.split("))", 1)[1].replace("'", "''")
        )
        parts.append(_spans_sql(rule.kind, rank, pattern, "", rule.group, rule.least))
    n = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secret_scan.BASE)
    item = "kind || ':' || start || ':' || stop, ',' ORDER BY start, rank"
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    s AS ({' UNION ALL '.join(parts)}),
    a AS (SELECT doc_id, {n}, string_agg({item}) FILTER (rank < {len(secret_scan.BASE)}) AS base,
                 string_agg({item}) AS spans FROM s GROUP BY doc_id)
    SELECT d.doc_id, {', '.join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in secret_scan.BASE)},
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN a USING (doc_id)"""


def _op11_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """The rounds one after the other, each a comparison of all parts with all entries."""
    entries, parts, scale = vector_codes.ENTRIES, vector_codes.PARTS, vector_codes.SCALE
    nearest = """
    SELECT v.row, v.part, arg_min(b.entry, (d, b.entry)) AS entry, min(d) AS d
    FROM v JOIN c{0} b USING (part),
         LATERAL (SELECT list_sum(list_transform(list_zip(v.x, b.x), lambda p: (p[1] - p[2]) ** 2))::BIGINT AS d)
    GROUP BY v.row, v.part"""
    steps = []
    for k in range(rounds):
        steps.append(f"a{k} AS MATERIALIZED ({nearest.format(k)})")
        steps.append(f"""
    m{k} AS (SELECT part, entry, i, (s - ((s % n) + n) % n) // n AS value FROM (
      SELECT part, entry, i, sum(value)::BIGINT AS s, count(*) AS n
      FROM (SELECT a.part, a.entry, unnest(v.x) AS value, generate_subscripts(v.x, 1) AS i
            FROM a{k} a JOIN v USING (row, part)) GROUP BY part, entry, i)),
    c{k + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(u.x, c.x) AS x FROM c{k} c LEFT JOIN
      (SELECT part, entry, list(value ORDER BY i) AS x FROM m{k} GROUP BY part, entry) u USING (part, entry))""")
    return f"""
    WITH e AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label,
             [floor({scale} * x::DOUBLE)::BIGINT FOR x IN embedding] AS x
      FROM embeddings WHERE embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    v AS MATERIALIZED (SELECT row, part, x[len(x) // {parts} * part + 1 : len(x) // {parts} * (part + 1)] AS x
                       FROM e, range({parts}) r(part)),
    c0 AS MATERIALIZED (SELECT part, row - 1 AS entry, x FROM v WHERE row <= {entries}),
    {', '.join(steps)},
    f AS ({nearest.format(rounds)}),
    b AS (SELECT sha256(string_agg(value, ',' ORDER BY part, entry, i)) AS digest FROM (
      SELECT part, entry, unnest(x)::VARCHAR AS value, generate_subscripts(x, 1) AS i FROM c{rounds})),
    t AS (SELECT row, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code,
                 sum(d)::BIGINT AS error FROM f GROUP BY row)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           (SELECT digest FROM b) AS codebooks_sha256
    FROM t JOIN e USING (row)"""


ORACLE = {
    "op5_secret_scan": _op5_sql(),
    "op6_line_dedup": r"""
    WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
    w AS (SELECT doc_id, unnest(range(1, len(ls) - 1)) AS pos, ls FROM d WHERE len(ls) >= 3),
    k AS (SELECT doc_id, pos, ls[pos] || chr(10) || ls[pos + 1] || chr(10) || ls[pos + 2] AS key FROM w),
    r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, pos) AS rn FROM k),
    gone AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM r WHERE rn > 1),
    lines AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS line FROM d),
    kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS t, count(*) AS n
             FROM lines ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
    SELECT d.doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines,
           (coalesce(len(ls), 0) - coalesce(n, 0))::BIGINT AS n_removed,
           sha256(coalesce(t, '')) AS text_sha256
    FROM d LEFT JOIN kept USING (doc_id)""",
    "op10_exact_dedup": r"""
    WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                      sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
           doc_id = first_value(doc_id) OVER w AS kept, h AS text_sha256
    FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)""",
    "op11_vector_codes": _op11_sql(),
    "op13_filter_audit": r"""
    WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
    l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                 min(doc_id) OVER (PARTITION BY t) AS least FROM d),
    m AS (SELECT doc_id, part,
                 (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
                 + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
                 + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > least, false)::INT AS fails
          FROM w),
    c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
          FROM m LEFT JOIN l USING (doc_id) GROUP BY part, fails),
    f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
    o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
          FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
            AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
    s AS (SELECT filter_order, step, f, bit,
                 (SELECT coalesce(sum(g.bit), 0)::INT FROM f g
                  WHERE position(g.f IN filter_order) < step) AS before
          FROM o, range(1, 6) r(step), f WHERE position(f IN filter_order) = step),
    r AS (SELECT part, filter_order, step, f,
                 sum(n) FILTER (fails & (before | bit) = 0) AS kept,
                 sum(n) FILTER (fails & bit > 0 AND fails & before = 0) AS removed,
                 sum(n) FILTER (fails & bit > 0 AND fails & before > 0) AS redundant,
                 sum(n) FILTER (fails = bit) AS unique_fails,
                 sum(good) FILTER (fails & bit > 0 AND fails & before = 0) AS good_lost,
                 sum(toxic) FILTER (fails & bit > 0 AND fails & before = 0) AS toxic_lost
          FROM c, s GROUP BY ALL)
    SELECT part, filter_order, step::INT AS step,
           coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
           coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
           coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
           (sum(coalesce(removed, 0)) OVER (PARTITION BY part, f))::BIGINT AS shapley
    FROM r""",
}
