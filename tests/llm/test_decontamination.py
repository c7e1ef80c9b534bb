import random
import re
from collections import Counter

from voxloom.llm import decontamination as op

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return SPLIT.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for i, text in docs:
        w, hit, ids = words(text), set(), set()
        for item_id, item in items:
            x = words(item)
            n = min(13, len(x))
            for s in range(len(x) - n + 1 if n else 0):
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == x[s : s + n]:
                        hit |= set(range(at, at + n))
                        ids.add(str(item_id))
        out.append((str(i), len(w), len(hit), len(ids), ",".join(sorted(ids)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def test_equals_brute_force(spark, texts, docs, no_docs, monkeypatch):
    w = texts[0].split()
    items = [(1, " ".join(w[10:40])), (2, "One"), (12, texts[1][:90]), (3, None), (4, "..."), (5, " ".join(w[10:22])), (5, " ".join(w[10:22])), (7, "the the the the the"), (8, "日本語")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    more = spark.createDataFrame([(900, "the " * 40, "", "", 1), (901, " ".join(w[5:30]) + " zz " + " ".join(w[10:24]).upper(), "", "", 1)], docs.schema)
    df = docs.union(more)
    want = brute([(r.doc_id, r.text) for r in df.collect()], items)
    for block in (op.BLOCK_ANCHORS, 5):
        monkeypatch.setattr(op, "BLOCK_ANCHORS", block)
        got = op.decontaminate(df, benchmark).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in got) == want
    kept = op.keep_clean(df, benchmark)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(x[0] for x in want if not x[5])
    assert op.decontaminate(no_docs, benchmark).collect() == []
    assert not [r for r in op.decontaminate(df, benchmark.limit(0)).collect() if r.n_hit]
    assert sorted(map(str, (r.doc_id for r in got if r.n_near < r.n_items))) == []


def rarest(x, start, frequency):
    """The two rarest places of a window, by (frequency, place)."""
    places = sorted(range(start, min(start + 13, len(x))), key=lambda k: (frequency[x[k]], k))
    return places[0], places[min(1, len(places) - 1)]


def brute_near(docs, items, slop=4):
    frequency, out = Counter(t for _, text in docs for t in words(text)), []
    for i, text in docs:
        w, ids = words(text), set()
        for item_id, item in items:
            x = words(item)
            for s in range(max(1, len(x) - 12) if x else 0):
                p, q = rarest(x, s, frequency)
                if any(a == x[p] and b == x[q] and abs(m - n) <= abs(q - p) + slop for m, a in enumerate(w) for n, b in enumerate(w)):
                    ids.add(item_id)
        out.append((i, len(ids)))
    return sorted(out)


def test_an_index_is_kept_and_grows(spark, tmp_path):
    rng = random.Random(8)
    vocabulary = [f"v{k}" for k in range(60)]
    docs = [(k, " ".join(rng.choices(vocabulary, k=50))) for k in range(12)]
    items = [(1, " ".join(docs[0][1].split()[5:30])), (2, " ".join(rng.choices(vocabulary, k=20))), (3, "v7 v9"), (4, " ".join(docs[11][1].split()[:14]))]
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} long, text string")
    index = op.build_index(frame(docs[:6], "doc_id"), f"file://{tmp_path}/index")
    result = lambda found: sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in found)
    assert result(op.search(index, frame(items[:2], "item_id")).collect()) == brute(docs[:6], items[:2])
    stored = index.terms.count()
    assert result(op.search(index, frame(items[:2], "item_id")).collect()) == brute(docs[:6], items[:2]) and index.terms.count() == stored
    op.add_documents(index, frame(docs[6:], "doc_id"))
    found = op.search(op.open_index(spark, index.path), frame(items, "item_id")).collect()
    assert result(found) == brute(docs, items)
    assert sorted((r.doc_id, r.n_near) for r in found) == brute_near(docs, items)


def test_a_very_long_item(spark):
    rng = random.Random(9)
    item = [f"t{rng.randrange(50_000)}" for _ in range(20_000)]
    docs = [(1, " ".join(item[500:700])), (2, " ".join(item)), (3, "x y z"), (4, " ".join(item[100:112]))]
    got = op.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    assert sorted((r.doc_id, r.n_hit) for r in got.collect()) == [(1, 200), (2, 20_000), (3, 0), (4, 0)]


def test_the_end_of_an_item_is_not_a_whole_window(spark):
    q = [f"q{k}" for k in range(20)]
    # the first words stand elsewhere, so the last ones are the rarest of each window
    docs = [(1, " ".join(q[13:])), (2, " x ".join(q[:13] * 5)), (3, " ".join(q[13:]) + " end"), (4, " ".join(q[7:]))]
    items = [(1, " ".join(q))]
    df, benchmark = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = op.decontaminate(df, benchmark).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in got) == brute(docs, items)
