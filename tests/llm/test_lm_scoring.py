import math
from collections import Counter, defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from voxloom.llm import lm_scoring as op

D = op.DEPTH


def low(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


def brute(train, test):
    """log10 probabilities by recursion over dictionaries."""
    count, children = defaultdict(lambda: [0, 0]), defaultdict(set)

    def walk(text):
        data = bytes(D) + low(text) + b"\0"
        for k in range(D, len(data)):
            node = 1
            for bit in range(7, -1, -1):
                b = data[k] >> bit & 1
                yield tuple((data[k - d : k], node) for d in range(D + 1)), b
                node = node * 2 + b

    for text in train:
        for path, b in walk(text):
            for d, n in enumerate(path):
                count[n][b] += 1
                if d < D:
                    children[n].add(path[d + 1])

    def kt(n):
        a, b = count[n]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @lru_cache(None)
    def weighted(n):
        if len(n[0]) == D:
            return kt(n)
        below = sum(weighted(c) for c in children[n])
        return math.log(0.5 * math.exp(kt(n) - max(kt(n), below)) + 0.5 * math.exp(below - max(kt(n), below))) + max(kt(n), below)

    out = []
    for text in test:
        total = 0.0
        for path, b in walk(text):
            p = None
            for n in reversed(path):
                c = count[n] if n in count else (0, 0)
                own = (c[b] + 0.5) / (sum(c) + 1)
                share = math.exp(kt(n) + math.log(0.5) - weighted(n)) if n in count else 0.5
                p = own if p is None else share * own + (1 - share) * p
            total += math.log10(p)
        out.append(total)
    return out


@pytest.fixture(scope="module")
def small(spark):
    rows = [(k, t) for k, t in enumerate(["abracadabra abra", "Abra cadabra", None, "", "the cat sat on the mat\nthe end", "zażółć gęślą", "a cat sat", "the the the cat", "xyz unseen words 123", "the cat sat on the mat\nthe end"])]
    return spark.createDataFrame([*rows, rows[4], (None, "no id")], "doc_id long, text string").repartition(3)


def test_equals_brute_force(spark, small, monkeypatch):
    held = F.coalesce(F.col("doc_id") % 3 == 2, F.lit(False))
    rows = small.withColumn("h", held).collect()
    train = [r.text for r in rows if not r.h]
    tokens = Counter(w for t in train for w in low(t).split())
    tokens["<end>"] = len(train)
    n, v = tokens.total(), len(tokens)
    base = lambda t: sum(math.log10((tokens[w] + 1) / (n + v + 1)) for w in [*low(t).split(), "<end>"])
    ctw = dict(zip((r.text for r in rows), brute(train, [r.text for r in rows]), strict=True))
    want = sorted((str(r.doc_id), r.h, len(low(r.text).split()) + 1, sum(tokens[w] > 0 for w in low(r.text).split()) + 1, n, round(base(r.text), 6), round(ctw[r.text], 3)) for r in rows)
    # one slice, several, and a model that is joined
    for frequent, grams, most in ((op.FREQUENT, op.SLICE_GRAMS, op.MOST_SLICES), (4, 60, 1000), (4, 60, 1)):
        monkeypatch.setattr(op, "MOST_SLICES", most)
        monkeypatch.setattr(op, "BLOCK_BYTES", 30)
        monkeypatch.setattr(op, "TREE_GRAMS", 20)
        monkeypatch.setattr(op, "FREQUENT", frequent)
        monkeypatch.setattr(op, "SLICE_GRAMS", grams)
        got = op.score(small, held).collect()
        assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 3)) for r in got) == want


def test_edges(docs, clash, no_docs):
    assert op.score(docs, F.lit(False)).count() == docs.count()
    assert op.score(clash, F.col("doc_id") > 10).count() == docs.count()
    assert op.score(no_docs, F.lit(False)).collect() == []
    alone = op.score(docs, F.lit(True)).collect()
    assert len(alone) == docs.count() and all(r.train_tokens == 0 and r.n_known == 0 for r in alone)
