"""Columns with names that the operators use themselves change no result and come back as they were."""

import pytest

from voxloom.llm import decontamination, near_dups, toxicity


@pytest.fixture(scope="module")
def benchmark(spark, texts):
    return spark.createDataFrame([(1, texts[0][:200]), (2, "one")], "item_id long, text string")


def check(docs, clash, run):
    plain, out = run(docs), run(clash)
    others = [c for c in clash.columns if c not in docs.columns]
    assert plain.columns == docs.columns and out.columns == clash.columns
    assert sorted(map(str, out.select(*docs.columns).collect())) == sorted(map(str, plain.collect()))
    assert {tuple(r) for r in out.select(*others).collect()} == {("x",) * len(others)}


def test_keep_one(docs, clash):
    check(docs, clash, near_dups.keep_one)


def test_keep_clean(docs, clash, benchmark):
    check(docs, clash, lambda df: decontamination.keep_clean(df, benchmark))
    rows = [sorted(map(str, decontamination.decontaminate(df, benchmark).collect())) for df in (docs, clash)]
    assert rows[0] == rows[1]


def test_reject(spark, docs, clash):
    labels = spark.createDataFrame([(0, 1), (3, 0), (6, 1)], "doc_id long, toxic int")
    check(docs, clash, lambda df: toxicity.reject(df, labels))
