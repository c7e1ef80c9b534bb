import random
from collections import Counter

import pytest

import corpus_pipeline as cp
from voxloom.llm import packing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(3000)}q" for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    top, rng = tmp_path_factory.mktemp("pipeline"), random.Random(4)
    shared = "This line stands in many documents"
    item = prose(rng, 30)
    rows = [(k, f"{prose(rng, 80)}\n{shared}\n{prose(rng, 20)}", "en", "s", 1) for k in range(40)]
    rows += [(100 + k, rows[k][1].replace("q ", "q  ", 1) + " more", "en", "s", 1) for k in range(5)]  # near copies
    rows += [(200 + k, f"{prose(rng, 60)} idiot trash {prose(rng, 20)} moron", "en", "s", 1) for k in range(60)]
    rows += [(300, f"{prose(rng, 20)} {item} {prose(rng, 20)}", "en", "s", 1), (301, None, None, None, None), (302, "", "en", "s", 0), (None, "no id", "en", "s", 5)]
    rows += [rows[10], rows[10]]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame([(r[0], int(200 <= r[0] < 300)) for r in rows if r[0] is not None], "doc_id long, toxic int").write.parquet(f"{top}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    return str(top)


def test_each_stage_takes_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert tuple(out.columns) == cp.COLUMNS and out.dtypes == docs.select(*cp.COLUMNS).dtypes
        seen[name] = (docs.collect(), out.collect())
        docs = cp.materialize(out, "test-stage")
    before, after = seen["toxicity"]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} <= set(range(200, 260)) and len(before) - len(after) > 50
    before, after = seen["line_dedup"]
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    assert {r.doc_id for r in after if "many documents" in (r.text or "")} == {0} and all(r.n_chars == len(r.text) for r in after)
    before, after = seen["near_dups"]
    ids = Counter(r.doc_id for r in after)
    assert max(ids.values()) == 1 and not set(ids) & set(range(100, 105)) and set(range(40)) <= set(ids) and 301 in ids and 302 not in ids and None in ids
    before, after = seen["decontamination"]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {300}
    before, after = seen["packing"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    assert sum(r.length for r in after) == sum({r.doc_id: r.doc_tokens for r in after}.values())


def test_run_equals_the_stages_and_takes_empty_tables(spark, folder, tmp_path):
    rows = cp.run(spark, folder)
    assert rows.count() > 0 and rows.agg({"length": "max"}).first()[0] <= packing.LENGTH
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []
