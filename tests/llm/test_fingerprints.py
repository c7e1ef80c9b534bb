import hashlib
import math
import random
from collections import Counter
from functools import cmp_to_key

from pyspark.sql import functions as F

from voxloom.llm import fingerprints as op


def test_edited_texts_and_fingerprints(docs, clash, monkeypatch):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=cmp_to_key(lambda a, b: (-1 if (a[0] if a[0] is not None else -1e18, ) > (b[0] if b[0] is not None else -1e18, ) else 1) if a[0] != b[0] else (a[1] > b[1]) - (a[1] < b[1])))
    want = []
    for k, (i, t) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        want.append((str(i), len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    for df, size in ((docs, 4000), (clash, 3)):
        monkeypatch.setattr(op, "ROWS_A_RANGE", size)
        got = op.fingerprints(df).collect()
        assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
        text = dict(rows)
        prints = {}
        for r in got:
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
            prints.setdefault(text[r.doc_id], set()).add(r.fingerprint)
        assert all(len(p) == 1 for p in prints.values())
        assert len({next(iter(p)) for p in prints.values()}) == len(prints)
        plain = [r for r in got if r.n_chars > 300 and text[r.doc_id].count(" ") > 50]
        assert sum(r.near_edited for r in plain) / len(plain) > 0.4


def test_order_and_increments(spark):
    rows = [(1, "a b c\nd e f"), (2, "d e f\na b c"), (3, "a b c"), (4, "d e f"), (5, "a b c\nd e g")]
    df = op.with_vector(spark.createDataFrame(rows, "doc_id long, text string"), "text", "v")
    v = {r.doc_id: r.v for r in df.collect()}
    assert v[1] == v[2] != v[5]
    one = spark.createDataFrame([(v[3], v[4], v[1])], "a array<long>, b array<long>, c array<long>")
    r = one.select(op.combine(F.col("a"), F.col("b")).alias("s"), op.combine(F.col("c"), F.col("b"), False).alias("d")).first()
    assert r.s == v[1] and r.d == v[3]


def test_empty_table(no_docs):
    assert op.fingerprints(no_docs).collect() == []


def pieces(text):
    """Runs of up to five words that end with a sentence or a line."""
    out = Counter()
    for line in text.split("\n"):
        run = []
        for w in line.split():
            run.append(w)
            if len(run) == 5 or w[-1] in ".!?":
                out[" ".join(run)] += 1
                run = []
        if run:
            out[" ".join(run)] += 1
    return out


def cosine(a, b):
    x, y = pieces(a), pieces(b)
    return sum(n * y[k] for k, n in x.items()) / math.sqrt(sum(n * n for n in x.values()) * sum(n * n for n in y.values()))


def test_likeness_is_the_cosine_of_pieces(spark):
    rng = random.Random(3)
    sentence = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(4, 12))) + "."
    texts = []
    for _ in range(40):
        base = [sentence() for _ in range(40)]
        share = rng.random()
        texts += [" ".join(base), " ".join(s if rng.random() < share else sentence() for s in base)]
    texts += [texts[-1], texts[-1]]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in op.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    off = []
    for i, text in rows:
        after = texts[i - 1]  # descending ids; the first follows the last
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        off += [abs(got[i].near_next - cosine(text, after)), abs(got[i].near_edited - cosine(text, edited))]
    assert got[81].near_next == got[80].near_next == 1.0
    assert sum(off) / len(off) < 0.1 and max(off) < 0.4
