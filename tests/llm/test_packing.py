import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from voxloom.llm import packing as op
from voxloom.llm import wordbpe


def ids_of(text):
    t = Tokenizer.from_file(wordbpe.default_path())
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


def check(df, length):
    rows, docs = op.pack(df, length).collect(), df.collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens, np.frombuffer(r.ids, "<u4").tolist()))
    short = 0
    for s in sequences.values():
        end = 0
        for offset, n in sorted(s):
            assert offset == end
            end += n
        assert end == length or (end < length and end & (end - 1) == 0)
        short += end < length
    assert sorted(sequences) == list(range(len(sequences))) and short <= length.bit_length()
    want = defaultdict(list)
    for d in docs:
        want[d.doc_id].append(ids_of(d.text))
    assert set(pieces) == set(want)
    for i, lists in want.items():
        got = sorted(pieces[i])
        assert sum(p[1] for p in got) == sum(map(len, lists)) and {p[2] for p in got} == set(map(len, lists))
        if len(lists) == 1:
            assert [x for p in got for x in p[3]] == lists[0]


def test_round_trip(docs, clash, monkeypatch):
    check(docs, 2048)
    monkeypatch.setattr(op, "RANGE_IDS", 500)
    check(clash, 100)


def test_empty_table_and_hilbert(no_docs):
    assert op.pack(no_docs).collect() == []
    side = np.arange(8)
    points = np.stack(np.meshgrid(side, side, side), -1).reshape(-1, 3)
    order = op.hilbert_index(points, 3)
    assert sorted(order) == list(range(512))
    along = points[np.argsort(order)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_neighbours_on_the_curve_share_sequences(spark, monkeypatch):
    import random

    rng = random.Random(12)
    topics = [[f"{w}{t}" for w in ("river", "stone", "cloud", "metal", "paper")] for t in range(8)]
    rows = [(k, " ".join(rng.choices(topics[k % 8], k=60))) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(op, "RANGE_IDS", 5000)
    placed = op.pack(df).select("sequence_id", "offset", "doc_id").orderBy("sequence_id", "offset").collect()
    order = list(dict.fromkeys(r.doc_id % 8 for r in placed)), [r.doc_id for r in placed]
    same = sum(a % 8 == b % 8 for a, b in zip(order[1], order[1][1:], strict=False)) / (len(order[1]) - 1)
    assert len(order[0]) == 8 and same > 0.3  # one in eight by chance
    keys = {r.doc_id: r.key for r in op.tokenized(df).collect()}
    along = [keys[i] for i in dict.fromkeys(order[1])]
    assert along == sorted(along)
