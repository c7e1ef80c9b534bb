import math
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from voxloom.llm import toxicity as op

SF = "/root/testdata/sf0.1"


def test_held_out_rows(spark):
    rows = op.op8_toxicity(spark, SF).toPandas().merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    assert (rows["held_out"] == rows["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    test = rows[rows["held_out"]]
    rank = test["score"].rank()
    n1, n0 = (test["toxic"] == 1).sum(), (test["toxic"] == 0).sum()
    assert (rank[test["toxic"] == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.93
    assert ((test["predicted"] == 1) & (test["toxic"] == 0)).sum() <= 0.02 * n0
    assert rows["score"].between(0, 1).all()


def test_edges(spark, docs, clash, no_docs):
    labels = spark.createDataFrame([(0, 1), (3, 0), (3, None), (6, 1), (6, 0), (None, 1)], "doc_id long, toxic int")
    for df in (docs, clash):
        model = op.fit(df, labels)
        got = op.score(df, model)
        assert got.count() == docs.count() and got.where("toxic_score between 0 and 1").count() == docs.count()
        assert set(op.reject(df, labels).columns) == set(df.columns)
    none = op.fit(docs, labels.limit(0))
    assert {r.toxic_score for r in op.score(docs, none).collect()} == {0.5}
    assert op.score(no_docs, none).collect() == []
    same = op.score(docs.withColumn("lang", F.lit("zz")), model).groupBy("text").agg(F.count_distinct("toxic_score").alias("n"))
    assert same.where("n > 1").isEmpty()


def test_training_is_ftrl_proximal():
    rng = np.random.default_rng(6)
    rows = [np.unique(rng.integers(0, 40, 6)) for _ in range(300)]
    labels = np.array([float(3 in r.tolist() or rng.random() < 0.1) for r in rows])
    z, n, weight = defaultdict(float), defaultdict(float), {}
    l1, order = max(op.LEAST_L1, len(rows) / 1000), np.random.default_rng(1)

    def w(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((op.BETA + math.sqrt(n[i])) / op.ALPHA + op.L2)

    for _ in range(op.PASSES):
        for k in order.permutation(len(rows)):
            at = [*rows[k].tolist(), "bias"]
            weight = {i: w(i) for i in at}
            g = 1 / (1 + math.exp(-sum(weight.values()))) - labels[k]
            for i in at:
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / op.ALPHA
                z[i] += g - sigma * weight[i]
                n[i] += g * g
    at, found, bias = op.train(rows, labels)
    want = {i: w(i) for i in range(40) if w(i)}
    assert dict(zip(at.tolist(), found.tolist())).keys() == want.keys() and 0 < len(want) < 40
    assert np.allclose(found, [want[i] for i in at.tolist()]) and math.isclose(bias, w("bias"), rel_tol=1e-9)


def test_the_least_of_several_texts_of_an_id_is_trained_on(spark):
    rows = [(k, f"good text number {k}") for k in range(40)] + [(k, "vile idiot trash") for k in range(40, 80)]
    labels = spark.createDataFrame([(k, int(k >= 40)) for k in range(80)], "doc_id long, toxic int")
    frame = lambda more: spark.createDataFrame(rows + more, "doc_id long, text string")
    model = op.fit(frame([]), labels)
    for more in ([(k, "zzz another text") for k in range(80)], [(k, "zzz another text") for k in range(80)][::-1]):
        assert [x.tolist() if hasattr(x, "tolist") else x for x in op.fit(frame(more), labels)] == [x.tolist() if hasattr(x, "tolist") else x for x in model]
