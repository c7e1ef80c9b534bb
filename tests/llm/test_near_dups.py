import itertools
import tracemalloc
from collections import Counter, defaultdict

import numpy as np

from voxloom.llm import _common
from voxloom.llm import near_dups as op


def shingles(text):
    w = (text or "").encode().lower().translate(_common.CLEAN).split()
    return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else None


def brute(rows):
    texts = sorted({r.text or "" for r in rows})
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for a, b in itertools.combinations(texts, 2):
        x, y = shingles(a), shingles(b)
        if x and y and (x & y).total() >= 0.8 * (x | y).total():
            root[find(a)] = find(b)
    ids = {}
    for r in rows:
        ids.setdefault(find(r.text or ""), []).append(r.doc_id)
    return {c: min((i for i in v if i is not None), default=None) for c, v in ids.items()}, find, {c: len(v) for c, v in ids.items()}


def test_classes_equal_brute_force(docs, clash):
    rows = docs.collect()
    least, find, size = brute(rows)
    want = sorted((str(r.doc_id), str(least[find(r.text or "")]), size[find(r.text or "")]) for r in rows)
    for df in (docs, clash):
        assert sorted((str(r.doc_id), str(r.class_id), r.class_rows) for r in op.classes(df).collect()) == want


def test_keep_one(docs, no_docs):
    rows = docs.collect()
    least, *_ = brute(rows)
    kept = op.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, least.values()))
    assert op.keep_one(no_docs).collect() == [] and op.classes(no_docs).collect() == []


def test_crowded_buckets_lose_no_class(spark):
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(60):
        w = list(base)
        for place in rng.choice(200, 2, replace=False):
            w[place] = f"new{k}_{place}"
        rows.append((k, " ".join(w)))
    other = [f"v{k}" for k in range(100)] + base[:60]
    rows += [(100 + k, " ".join([*other, f"end{k}"])) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    least, find, _ = brute(df.collect())
    assert {r.doc_id: r.class_id for r in op.classes(df).collect()} == {i: least[find(t)] for i, t in rows}


def crowded(spark, sets, shared=(0,)):
    """Signed texts that agree in the bands ``shared`` and in no other."""
    bands = lambda k: [p + 1 if p in shared else 1000 * (k + 1) + p for p in range(op.BANDS)]
    rows = [(k, bytearray(key), bands(k), list(map(int, s)), len(s)) for k, (key, s) in enumerate(sets.items())]
    return spark.createDataFrame(rows, "doc_id long, text_key binary, bands array<long>, shingles array<int>, size int")


def test_a_text_linked_to_the_pivot_links_others_of_its_bucket(spark):
    # pivot "z"; x is 0.85 like it and y 0.72; y is like x alone
    sets = {b"z": range(100), b"x": range(8, 108), b"y": range(16, 116)} | {b"o%d" % k: range(1000 * k, 1000 * k + 50) for k in range(1, 10)}
    roots = {bytes(r.text_key): bytes(r.root) for r in op.components(op.links(crowded(spark, sets))).collect()}
    assert roots == {b"y": b"x", b"z": b"x"}


def test_like_texts_unlike_the_pivot_are_compared_in_their_bucket(spark):
    # u and v agree in two crowded bands alone and are like none of the others
    sets = {b"u": range(100), b"v": range(10, 110)} | {b"z%02d" % k: range(1000 * k, 1000 * k + 50) for k in range(1, 12)}
    found = op.links(crowded(spark, sets, (0, 10))).collect()
    assert [(bytes(r.a), bytes(r.b)) for r in found] == [(b"v", b"u")]


def test_signatures_estimate_the_weighted_similarity():
    a = [f"a{k}" for k in range(300)]
    b = a[:240] + [f"b{k}" for k in range(60)]
    x, y = (op.regions(" ".join(w).encode()) for w in (a, b))
    exact = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    sx, sy = op.signatures_of([x, y, x[:3]])[:2]
    assert abs((sx == sy).mean() - exact) < 0.12 and (sx == op.signatures_of([x])[0]).all()
    twice = op.regions(b"x y " * 30)
    assert len(twice) == len(set(twice.tolist())) == 56


def test_short_texts_are_signed_in_bounded_memory():
    # 3000 texts of one region each look at some 2000 darts each: 170 MB when sliced by regions alone
    found = [op.regions(b"a b %d" % k) for k in range(3000)]
    tracemalloc.start()
    try:
        bands = op.bands_by_slices(found)
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()
    assert (bands[::500] == op.bands_of(op.signatures_of(found[::500]))).all()


def test_no_link_is_lost_round_a_hot_base(spark):
    # a is 0.93 like the base or more and joins its class; b is like its own a (0.8 or more), yet not like the base
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(400)]
    put = lambda words, places, tag: [f"{tag}{k}" if k in places else w for k, w in enumerate(words)]
    rows = [(0, " ".join(base))]
    for k in range(60):
        rows.append((100 + k, " ".join(put(base, {int(rng.integers(400))}, f"n{k}_"))))
    for k in range(40):
        a = put(base, {50 + 3 * k}, f"a{k}_")
        b = put(a, set(range(200 + k, 200 + k + 50)), f"b{k}_")
        rows += [(1000 + k, " ".join(a)), (2000 + k, " ".join(b))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    least, find, _ = brute(df.collect())
    assert {r.doc_id: r.class_id for r in op.classes(df).collect()} == {i: least[find(t)] for i, t in rows}


def test_fractional_weights():
    rng = np.random.default_rng(2)
    names = rng.integers(1, 1 << 63, 300).astype(np.uint64)
    x, y = rng.uniform(0.1, 3, 300), rng.uniform(0.1, 3, 300)
    exact = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    (nx, wx), (ny, wy) = op.weighted_regions(names, x), op.weighted_regions(names, y)
    sx, sy = op.signatures_of([nx, ny], [wx, wy])
    assert abs((sx == sy).mean() - exact) < 0.12
    whole = op.weighted_regions(names, np.full(300, 2.0))
    assert (op.signatures_of([whole[0]], [whole[1]]) == op.signatures_of([whole[0]])).all()


def test_recall_on_the_corpus(spark):
    """Every text whose id is divisible by 20, against all texts: those at 0.8 or more share its class."""
    sf = "/root/testdata/sf0.1"
    class_of = {r.doc_id: r.class_id for r in op.classes(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    regions, holders = {}, defaultdict(list)
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        regions[r.doc_id] = op.regions((r.text or "").encode()).tolist()
        for x in regions[r.doc_id]:
            holders[x].append(r.doc_id)
    pairs = 0
    for query in (i for i in regions if i % 20 == 0):
        shared = Counter(i for x in regions[query] for i in holders[x])
        for other, n in shared.items():
            if other != query and n >= 0.8 * (len(regions[query]) + len(regions[other]) - n):
                pairs += 1
                assert class_of[other] == class_of[query]
    print("pairs at 0.8 or more:", pairs)
    assert pairs > 200
