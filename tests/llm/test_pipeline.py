"""The pipeline's stages and run, and the registered queries."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lunaria.llm import decontaminate, jaccard, mixing, quality, queries
from lunaria.llm.common import table

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def odd(spark):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([None, "", "same text of five words here", "same text of five words here"])]
    return spark.createDataFrame([*rows, rows[2], (None, "no id", None, None, None), (None, None, None, None, None)], DOC)


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "sharding"]


def test_quality_stage(spark):
    docs = table(spark, DATA, "documents")
    kept = corpus_pipeline.keep_quality(spark, docs, DATA)
    want = {r.doc_id for r in quality.classify(docs, table(spark, DATA, "labels")).where("score >= 0.3").collect()}
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == docs.columns
    assert corpus_pipeline.keep_quality(spark, odd(spark), DATA).count() <= 7


def test_near_duplicate_stage(spark):
    docs = table(spark, DATA, "documents")
    kept = corpus_pipeline.near_duplicates(spark, docs, DATA)
    own = jaccard.jaccard_components(docs, 5, 80)
    assert {r.doc_id for r in kept.collect()} == {r.component_id for r in own.collect()} and kept.columns == docs.columns
    left = corpus_pipeline.near_duplicates(spark, odd(spark), DATA)
    assert sorted((r.doc_id for r in left.collect()), key=str) == [0, 1, 2, None, None]


def test_decontamination_stage(spark):
    docs = table(spark, DATA, "documents")
    kept = corpus_pipeline.remove_benchmark(spark, docs, DATA)
    hit = {r.doc_id for r in decontaminate.contaminated(docs, table(spark, DATA, "benchmark")).collect()}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - hit and hit and kept.columns == docs.columns
    assert corpus_pipeline.remove_benchmark(spark, odd(spark), DATA).count() == 7


def test_mixing_stage(spark):
    docs = table(spark, DATA, "documents")
    out = corpus_pipeline.mix_sources(spark, docs, DATA)
    words = sum(r.taken for r in mixing.mix(docs).collect())
    assert out.columns == docs.columns and out.select(mixing.word_count().alias("n")).agg(F.sum("n")).first()[0] == words


CLASHES = ("__quality", "__id", "__copy_of", "__h1", "__h2", "__hit", "__source", "__plan", "__copy", "score", "label", "size", "rate", "turn")


def test_stages_keep_clashing_columns(spark):
    docs = table(spark, DATA, "documents").limit(60).withColumns({c: F.lit(i) for i, c in enumerate(CLASHES)})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns
        assert all(tuple(r)[-len(CLASHES) :] == tuple(range(len(CLASHES))) for r in out.collect())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() == docs.count()


def test_whole_run(spark):
    out = corpus_pipeline.run(spark, DATA).collect()
    assert out and {r.shard for r in out} <= set(range(16))
    for k in range(16):
        own = sorted(r.slot for r in out if r.shard == k)
        assert own == list(range(len(own)))


def test_queries_with_sql(spark):
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    for name, sql in queries.ORACLE_SQL.items():
        got, want = queries.QUERIES[name](spark, DATA), con.sql(sql)
        columns = sorted(want.columns)
        assert columns == sorted(got.columns)
        a = sorted(repr(tuple(r)) for r in got.select(*columns).collect())  # as rows: pandas has no whole numbers beside nulls
        b = sorted(map(repr, want.select(*columns).fetchall()))
        assert a == b, name


@pytest.mark.parametrize("name", [f"op{n}_" for n in range(1, 14)])
def test_every_query_is_there(name):
    assert sum(q.startswith(name) for q in queries.QUERIES) == 1


def test_near_duplicate_stage_tells_texts_of_one_id_apart(spark):
    a, b = "one text of some eight words or so", "quite another text that holds other words here"
    rows = [(1, a), (1, b), (2, b), (3, a + " but more"), (3, a), (4, b.upper()), (1, a), (5, None), (5, None), (6, "alone in this table with its words")]
    docs = spark.createDataFrame([(i, t, "en", "s", k) for k, (i, t) in enumerate(rows)], DOC)
    left = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, DATA).collect()), key=repr)
    assert left == sorted([(1, a), (1, b), (3, a + " but more"), (5, None), (6, rows[-1][1])], key=repr)
