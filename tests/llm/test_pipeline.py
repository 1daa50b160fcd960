"""The corpus queries and the pipeline on the test tables."""

from __future__ import annotations

import pytest
from compare import compare, connect
from frames import AWKWARD, clashing, documents

import corpus_pipeline
from featurekit.llm.common import table
from featurekit.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), ORACLES[name], connect(sf_dir)) == []


def test_every_operator_has_a_query():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))


def test_stages_keep_the_columns_and_the_clean_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, sf_dir)
        assert result.columns == docs.columns, name
        docs = spark.createDataFrame(result.collect(), result.schema)
        counts.append(docs.count())
    language, groups, clean, secrets, _ = counts[1:]
    assert language >= 0.98 * counts[0]
    assert 0.85 * language < groups < language
    assert groups - 60 < clean < groups
    assert secrets == clean


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_awkward_and_empty_tables(spark, sf_dir, stage):
    docs = clashing(documents(spark, AWKWARD))
    assert stage(spark, docs, sf_dir).columns == docs.columns
    assert stage(spark, docs, sf_dir).count() <= 3 * len(AWKWARD)
    assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 500
