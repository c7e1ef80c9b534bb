import math
import random

import pytest
from pyspark.sql import functions as F

from voxloom.functions import text as tx
from voxloom.operators import packs, pairing, stages
from voxloom.operators import reject as rj
from voxloom.plans import config

ALIGNMENT = "array<struct<text:string,start:double,end:double>>"


def frame(spark, rows, schema):
    return rj.with_rejects(spark.createDataFrame(rows, schema))


def codes(df, key="k"):
    return {r[key]: (r.reject_stage, r.reject_code, r.reject_value) for r in df.collect()}


def test_duration_bounds_and_first_reject(spark):
    rows = [(1, "a", 2.0), (2, "a", 1.9999), (3, "a", 30.0), (4, "a", 30.0001), (5, " ", 1.0), (6, None, 5.0)]
    df = stages.duration_filter(frame(spark, rows, "k int, text string, duration double"))
    assert {k: c[1] for k, c in codes(df).items()} == {1: None, 2: "too_short", 3: None, 4: "too_long", 5: "empty_text", 6: "empty_text"}
    assert {r.k: r.duration for r in df.collect()}[4] == 30.0  # stored rounded, judged whole
    again = stages.duration_filter(df, 3.0, 30.0)
    assert codes(again)[2] == codes(df)[2] and codes(again)[1][1] == "too_short"
    n = {r.name: r.n for r in rj.counters(df).collect()}
    assert n == {"input": 6, "output": 2, "drop:duration": 4}
    assert rj.render_counters(n) == "input=6 output=2 drop:duration=4"


def test_quality(spark):
    nan = float("nan")
    rows = [(1, {"PQ": 6.0, "CE": 1.0, "CU": 1.0, "PC": 9.0}), (2, {"PQ": 5.9996, "CE": 1.0, "CU": 1.0, "PC": 1.0}), (3, {"PQ": nan, "CE": nan, "CU": nan, "PC": nan}), (4, None), (5, {"PQ": 7.0, "CE": 0.5, "CU": 1.0, "PC": 9.0})]
    df = frame(spark, rows, "k int, quality map<string,double>")
    got = codes(stages.quality_filter(df, 6.0, 1.0, None, 8.0))
    assert {k: c[1] for k, c in got.items()} == {1: "audiobox_PC", 2: "audiobox_PQ", 3: None, 4: "audiobox_missing", 5: "audiobox_CE"}
    assert all(c[1] is None for c in codes(stages.quality_filter(df, None)).values())


def test_speakers(spark):
    rows = [(1, None), (2, []), (3, ["0.0 0.5 a", "junk", " 1.0 2.0 b "]), (4, ["0 0.49 a", "1 2 b"]), (5, ["0 0.3 a", "1 1.3 a", "2 4 b"]), (6, ["1.2.3 4 a", "0 1 b"]), (7, ["0.0 5.0 a extra", "0 1 b", "1.2.3 9 b", "b"]), (8, ["0.0 5.0 a extra", "0 1 b"] + ["1 2 c"] * 3)]
    df = stages.speaker_filter(frame(spark, rows, "k int, segments array<string>"))
    got = {r.k: (r.diarization.num_speakers, r.reject_code) for r in df.collect()}
    assert got == {1: (0, None), 2: (0, None), 3: (2, "multi_speaker"), 4: (1, None), 5: (2, "multi_speaker"), 6: (1, None), 7: (1, None), 8: (2, "multi_speaker")}


def test_transcripts(spark):
    rows = [(1, "a b c d", ("a b c d", "en")), (2, "", ("x", "en")), (3, "a", ("", "en")), (4, "a b", ("a  b ", "en")), (5, None, (" ", "en")), (6, "a b c d e f g h i j", ("a b c d e f g h i x", "en"))]
    df = stages.transcript_filter(frame(spark, rows, "k int, text string, transcript struct<text:string,language:string>"), 0.1, phonetic=True)
    got = {r.k: (r.reject_code, r.asr.wer, r.text, r.orig_text) for r in df.collect()}
    assert got[1] == (None, 0.0, "a b c d", "a b c d") and got[4] == (None, 0.0, "a  b ", "a b")
    assert got[2][:2] == ("wer", None) and got[3][:2] == ("wer", 1.0) and got[5][:2] == ("wer", None)
    assert got[6] == (None, 0.1, "a b c d e f g h i x", "a b c d e f g h i j")
    assert math.isinf(codes(df)[2][2])


def test_readings_of_homophones(spark, tmp_path):
    rows = [(1, "他在家", ("她再家", "zh")), (2, "他在家", ("他不家", "zh")), (3, "他3年", ("她三年", "zh")), (4, "he 在", ("he 再", "zh"))]
    df = frame(spark, rows, "k int, text string, transcript struct<text:string,language:string>")
    path = tmp_path / "readings.tsv"
    path.write_text("他\tta\n她\tta\n在\tzai\n再\tzai\n在\tother\n不\tbu\n", encoding="utf-8")
    judged = stages.transcript_filter(df, 0.1, readings=tx.load_readings(str(path)))
    assert {r.k: (r.reject_code, r.asr.wer, r.asr.char_wer) for r in judged.collect()} == {1: (None, 0.0, 0.6667), 2: ("wer", 0.3333, 0.3333), 3: (None, 0.0, 0.6667), 4: (None, 0.0, 0.5)}
    by_config = config.build_steps(config.Settings({"asr": {"enabled": True, "readings": str(path)}}))
    assert {r.k for r in config.run_steps(df.withColumn("language", F.lit("zh")), by_config).where("reject_code is null").collect()} == {1, 3, 4}
    path.write_text("他ta\n", encoding="utf-8")
    with pytest.raises(ValueError, match="not a character"):
        tx.load_readings(str(path))


def spec_pause(items, dur):
    if not items:
        return "pause_no_alignment"
    gap = max([0.0, *(b[1] - a[2] for a, b in zip(items, items[1:], strict=False))])
    head, tail = items[0][1], max(0.0, dur - items[-1][2])
    return "pause_gap" if gap > 1.5 else "pause_head" if head > 1.0 else "pause_tail" if tail > 1.0 else None


def spec_trim(items, d, head=0.1, tail=0.3):
    if not items:
        return None
    s, e = items[0][1], min(items[-1][2], d)
    cs, ce = max(0.0, s - head), min(d, e + tail)
    ph, pt = max(0.0, head - (s - cs)), max(0.0, tail - (ce - e))
    if cs < 0.05 and d - ce < 0.05 and ph < 0.05 and pt < 0.05:
        return None
    return [(u, round(max(0.0, a - (cs - ph)), 3), round(max(0.0, b - (cs - ph)), 3)) for u, a, b in items]


def test_trim_and_pauses(spark):
    rng, rows = random.Random(5), []
    for k in range(200):
        at, items = rng.choice([0.0, 0.05, 0.1, 1.0, 1.001, 2.0]), []
        for _ in range(rng.randrange(6)):
            end = round(at + rng.randrange(50, 400) / 1000, 3)
            items.append(("u", at, end))
            at = round(end + rng.choice([-0.05, 0.0, 0.4, 1.5, 1.501]), 3)
        rows.append((k, items, round(at + rng.choice([-0.2, 0.0, 0.3, 1.0, 1.6]), 3)))
    rows.append((900, None, 3.0))
    schema = f"k int, alignment {ALIGNMENT}, audio_duration double"
    df = frame(spark, rows, schema).withColumn("duration", F.col("audio_duration"))
    assert {k: c[1] for k, c in codes(stages.pause_filter(df)).items()} == {k: spec_pause(i, d) for k, i, d in rows}
    done = stages.apply_trim(stages.trim_plan(df))
    for r in done.collect():
        want = spec_trim(rows[r.k][1] if r.k < 900 else None, r.audio_duration if r.trim is None else rows[r.k][2])
        if want is None:
            assert r.trim is None
        else:
            assert [tuple(x) for x in r.alignment] == want
    assert codes(stages.alignment_filter(df))[900][1] == "align_failed"


def test_packs(spark):
    rng = random.Random(9)
    sizes = [(f"s{k:03}", rng.randrange(1, 60)) for k in range(80)] + [("s000x", 500)]
    want, pack, used, n = {}, 0, 0, 0
    for name, size in sorted(sizes):
        if n and used + size > 100:
            pack, used, n = pack + 1, 0, 0
        used, n = used + size, n + 1
        want[name] = pack
    got = packs.build_packs(spark.createDataFrame(sizes, "name string, size long"), 100)
    assert {r.name: r["pack"] for r in got.collect()} == want
    listed = packs.manifest(got, spark.createDataFrame([(s, 2) for s, _ in sizes], "name string, n long"))
    assert sum(r.num_samples for r in listed.collect()) == 162
    assert packs.unchanged(listed, listed.select("pack_id", "files")).count() == listed.count()
    assert packs.build_packs(spark.createDataFrame([], "name string, size long"), 5).collect() == []


def test_pairing(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,), (4,)], "k int")
    assert {r.side: r.n for r in pairing.unpaired(a, b, ["k"]).collect()} == {"left": 1, "right": 2}
    rows = spark.createDataFrame([("s", k) for k in range(5)] + [("t", 1)], "shard string, ord long")
    assert [pairing.shard_limit(rows, n).count() for n in (None, 0, 1, 3, 99, -1)] == [6, 6, 2, 4, 6, 2]
    assert sorted(tuple(r) for r in pairing.assign_workers(rows, 2).collect()) == [("s", 0), ("t", 1)]
