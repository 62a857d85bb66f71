"""Registered text queries against their SQL twins, and the pipeline stage by stage, on the smallest tables."""

import os

import pytest

import corpus_pipeline
from compare import duck
from tallyframe.llm.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.mark.parametrize("name", list(ORACLES))
def test_twin(spark, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = duck(FOLDER).execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = sorted(repr(sorted(zip(names, r, strict=True))) for r in cursor.fetchall())
    assert sorted(repr(sorted(r.asDict().items())) for r in df.collect()) == want


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    left, kept = docs, docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, left, FOLDER)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
            kept = out
        assert 0.5 * left.count() < out.count() <= left.count(), name
        left = out
    assert left.where("not exact").count() == 0 and left.count() == kept.count()
