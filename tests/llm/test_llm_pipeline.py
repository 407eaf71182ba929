import collections

import corpus_pipeline
import numpy as np
from corpora import empty, frame, rows
from helpers import duck_rows, spark_rows
from test_llm_operators import codec_and_reference, components_brute, quality_brute, simhash_brute, words

from gristmill.llm import queries


def test_oracles(spark, sf):
    for name, sql in queries.oracle_sql().items():
        assert spark_rows(queries.queries()[name](spark, sf)) == duck_rows(sql, sf), name


def test_queries_run(spark, sf):
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name, q in queries.queries().items():
        df = q(spark, sf)
        assert df.count() == (spark.read.parquet(f"{sf}/pages.parquet").count() if "url" in name else n), name


def test_stages_against_brute_force(spark, tmp_path):
    docs, want = frame(spark, clash=False), [r for r in rows()]
    columns = docs.columns

    def go(k):
        nonlocal docs
        out = corpus_pipeline.STAGES[k][1](spark, docs, "")
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        return docs.collect()

    def fails(t):
        n, chars, sym, dup, rep, nl = quality_brute(t)
        return n < 10 or 100 * rep > 20 * n or chars < 2 * n or chars > 30 * n or sym > n or 2 * dup > nl

    want = [r for r in want if not fails(r[1])]
    assert collections.Counter(map(tuple, go(0))) == collections.Counter(want) and docs.columns == columns
    texts = {r[1] for r in want}
    got = go(1)
    assert sorted(r["text"] for r in got) == sorted(texts) and docs.columns == columns
    comp = components_brute([simhash_brute(t) for t in texts])
    got = go(2)
    assert collections.Counter(comp[simhash_brute(r["text"])] for r in got) == collections.Counter(set(comp.values())) and docs.columns == columns
    before = {r["text"] for r in got}
    mixed = go(3)
    assert {r["text"] for r in mixed} <= before and docs.columns == columns
    assert max(collections.Counter(r["text"] for r in mixed).values()) <= 3
    _, _, ref = codec_and_reference()
    final = go(4)
    assert collections.Counter(tuple(r["ids"]) for r in final) == collections.Counter(tuple(ref.encode_ordinary(r["text"])) for r in mixed)
    assert all(r["n_tokens"] == len(r["ids"]) for r in final) and np.isfinite(sum(len(words(r["text"])) for r in mixed))


def test_stages_on_an_empty_table(spark):
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0
