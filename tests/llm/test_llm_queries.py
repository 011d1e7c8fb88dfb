"""Registered queries against their SQL, and the pipeline stage by stage."""

import os

import pytest

import corpus_pipeline
from oracle_compare import compare, duck
from tickreport.llm import registry
from tickreport.llm.common import saved

SF = "/root/testdata/sf0.001"


def test_registered():
    assert [sum(k.startswith(f"op{n}_") for k in registry.QUERIES) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in registry.QUERIES and set(registry.ORACLES) <= set(registry.QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, name):
    r = compare(spark, duck(SF), name, registry.QUERIES[name], registry.ORACLES[name], SF)
    assert r["ok"], r


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_pipeline(spark):
    docs = first = spark.read.parquet(f"{SF}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF), f"test-{name}")
        counts.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == first.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = labels.where("quality = 1").count()
    assert counts[0] < first.count() and counts[1] >= 0.95 * counts[0] and counts[3] < counts[2] == counts[1]
    assert good > 0
    assert docs.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0
    assert docs.where("start = 0").count() == counts[3]


def test_pipeline_on_awkward_rows(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(1, "one two three", "en", "s", 13), (1, "one two three", "en", "s", 13), (2, None, None, None, None),
            (None, "", "en", "s", 0), (None, "a b", None, "s", 3)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert corpus_pipeline.pack(spark, docs, SF).where("start = 0").count() == docs.count()
