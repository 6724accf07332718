"""The pipeline against a plain run of the same steps, and the queries against SQL and brute force."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__ as contract
from tarnflow.llm import quality, queries
from tests.llm.helpers import ODD, clashing, components, jaccard_components, shingles
from tests.llm.test_exact_and_native import plain_groups, plain_spans
from verify import oracle, rows

SF = "/root/testdata/sf0.001"


def test_registration():
    assert queries.QUERIES.keys() <= contract.queries().keys()
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in queries.QUERIES
    natively = {"op5_secret_scan", "op6_line_dedup", "op10_exact_dedup"}
    assert set(queries.ORACLE) == natively | {"op11_vector_codes", "op13_filter_audit"}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_against_sql(spark, name):
    got, want = queries.QUERIES[name](spark, SF).toPandas(), oracle(SF).sql(queries.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_op9_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = jaccard_components(docs)
    got = queries.QUERIES["op9_ngram_join"](spark, SF).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(shingles(t)) for r, (_, t) in zip(sorted(got), sorted(docs)))


def test_op2_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    x = np.array(table.embedding.tolist(), float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    got = queries.QUERIES["op2_embedding_dedup"](spark, SF).toPandas().set_index("vec_id").loc[table.vec_id]
    assert got.n_links.sum() >= 0.97 * near.sum() and (got.n_links.to_numpy() <= near.sum(axis=1)).all()


def test_op1_marks_real_repeats_only(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op1_passage_dedup"](spark, SF).collect()
    assert got
    for r in got:
        words = docs[r.doc_id][r.start : r.end].lower().split()
        assert r.n_words >= 20 and len(words) >= 20
    windows = {}
    for i, t in sorted(docs.items()):
        w = t.lower().split()
        for k in range(len(w) - 79):
            windows.setdefault(tuple(w[k : k + 80]), set()).add(i)
    planted = {max(s) for s in windows.values() if len(s) > 1}
    assert len(planted & {r.doc_id for r in got}) >= 0.95 * len(planted)


def test_op3_round_trip(spark):
    got = queries.QUERIES["op3_sentencepiece"](spark, SF).collect()
    assert got and all(r.round_trip for r in got)


def test_op7_covers_every_id(spark):
    got = queries.QUERIES["op7_packing"](spark, SF).toPandas()
    sums = got.groupby("doc_id").agg(n=("length", "sum"), total=("doc_tokens", "first"))
    assert (sums.n == sums.total).all() and (got.groupby("sequence_id").length.sum() <= 2048).all()


def plain_run(spark, sf_dir):
    """(doc_id, text) before packing, by plain code around the classifier's own scores."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {r.doc_id for r in quality.quality_scores(docs, labels).where(F.col("score") >= 0.3).collect()}
    kept = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    first = {i for i, _ in plain_groups(kept).values()}
    kept = [(i, t) for i, t in kept if i in first]
    component = jaccard_components(kept)
    kept = [(i, t) for i, t in kept if component[i] == i]
    out = []
    for i, t in kept:
        at, text = 0, ""
        for s in filter(None, plain_spans(t).split(",")):
            _, start, end = s.split(":")
            if int(start) >= at:
                text += t[at : int(start)] + "[secret]"
            at = max(at, int(end))
        out.append((i, text + t[at:]))
    return out


def test_pipeline(spark):
    from tarnflow.llm.packing import tokenizer

    encode = tokenizer()
    want = {i: np.append(encode(t), 1).astype("<u4") for i, t in plain_run(spark, SF)}
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert set(got.doc_id) == set(want)
    for r in got.itertuples():
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32


def test_stages_keep_the_columns_and_odd_rows(spark):
    df = clashing(spark, ODD)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "secrets", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SF)
        assert name == "packing" or out.columns == df.columns
        out.count()
        assert stage(spark, df.where("false"), SF).count() == 0
