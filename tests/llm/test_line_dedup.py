import re
from collections import Counter

from voxloom.llm import line_dedup as op


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, least_docs, first):
    held, holder = Counter(), {}
    for i, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            held[k] += 1
            if i is not None:
                holder[k] = min(i, holder.get(k, i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not key(x) or held[key(x)] < least_docs or (first and holder.get(key(x)) in (None, i))]
        out.append((str(i), "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


def test_equals_brute_force(spark, docs, clash, no_docs):
    rows = [(k, f"Ünique {k}\n Common Line\t\nx\n\n{'É' if k % 2 else 'é'} ends") for k in range(200, 212)] + [(None, "common line\nonly here")]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    plain = [(r.doc_id, r.text) for r in df.collect()]
    for least in (2, 10):
        for first in (False, True):
            want = brute(plain, least, first)
            for most in (op.MOST_KEYS, 0):  # broadcast, and joined
                got = op.dedup_lines(df, least, keep_first=first, most_keys=most).collect()
                assert sorted((str(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in got) == want
    assert op.dedup_lines(no_docs).collect() == []
    plain = sorted(map(str, op.dedup_lines(docs, 2).collect()))
    for most in (op.MOST_KEYS, 0):
        out = op.dedup_lines(clash, 2, most_keys=most)
        others = [c for c in clash.columns if c not in (*docs.columns, "n_lines")]
        assert out.columns == [*(c for c in clash.columns if c != "n_lines"), "n_lines", "n_dropped"]
        assert sorted(map(str, out.select(*docs.columns, "n_lines", "n_dropped").collect())) == plain
        assert {tuple(r) for r in out.select(*others).collect()} == {("x",) * len(others)}


def test_twice_seen_holds_every_repeated_key(spark):
    df = spark.createDataFrame([(k, f"line {k % 50}\nown {k}") for k in range(100)], "doc_id long, text string").repartition(7)
    bits = op.twice_seen(df)
    assert op._has(bits, op._bits(op._hashes([f"line {k}".encode() for k in range(50)]), len(bits))).all()
    assert op._has(bits, op._bits(op._hashes([f"own {k}".encode() for k in range(100)]), len(bits))).sum() <= 2
