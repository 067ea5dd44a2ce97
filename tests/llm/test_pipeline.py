"""The pipeline's stages: columns, effect of decisions, odd rows."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spatialfeat.llm import exact_dedup, ngram_join, queries

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    docs = docs.unionByName(docs.limit(3)).withColumn("score", F.lit("own")).withColumn("n_words", F.lit(-1))
    names, counts = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, DATA)
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        counts.append(docs.count())
        if k < 4:
            assert docs.columns == names and {r.score for r in docs.select("score").distinct().collect()} == {"own"}
        if k == 1:
            assert docs.select("text").distinct().count() == counts[-1]
        if k == 2:
            assert ngram_join.link_components(docs).where("doc_id <> component_id").count() == 0
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] <= counts[2] and counts[5] >= counts[4]


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (None, "", "x", "s", 0), (None, "", "x", "s", 0), (2, "word " * 50, "en", "s", 1)]])
def test_stages_on_odd_tables(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DATA).count() >= 0


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_run(spark, name):
    assert queries.queries()[name](spark, DATA).count() > 0


def test_exact_dedup_is_stable(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    once = exact_dedup.dedup(docs)
    assert sorted(map(str, exact_dedup.dedup(once).collect())) == sorted(map(str, once.collect()))
