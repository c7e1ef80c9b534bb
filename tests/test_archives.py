import io
import json
import os
import tarfile

import numpy as np
import pytest

from voxloom.functions import audio
from voxloom.plans.config import Settings
from voxloom.plans.run import run_shards
from voxloom.sources import archives, sinks
from voxloom.streaming.arrivals import process_arrivals


def wav(seconds, rate=16000):
    t = np.arange(int(seconds * rate)) / rate
    return audio.encode_wav((0.3 * np.sin(440 * t)).astype(np.float32)[:, None], rate)


def write(path, members, mode="w"):
    with tarfile.open(path, mode) as t:
        for name, data in members:
            if data is None:
                info = tarfile.TarInfo(name)
                info.type = tarfile.DIRTYPE
                t.addfile(info)
                continue
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


def meta(**x):
    return json.dumps(x).encode()


def shard_a(folder):
    write(folder / "a.tar", [
        ("d", None), ("d/one.json", meta(id="ID1", text="你好吗", language="zh", duration=99, speaker="s")), ("two.wav", wav(4)), ("e/one.wav", wav(3)), ("two.JSON", meta(text="hello there", language="en")),
        ("bad.json", meta(text="x")), ("bad.mp3", b"not audio"), ("lonely.json", meta(text="x")), ("readme.md", b"?"), ("short.wav", wav(1)), ("short.json", meta(text="x", dnsmos=3.1)), ("one.json", meta(text="again")),
    ])


def test_pairs_index_and_bytes(spark, tmp_path):
    shard_a(tmp_path)
    write(tmp_path / "b.tar.gz", [("wavs/u1.wav", wav(2)), ("txts/u1.txt", "u1\t 文本 \n0 1".encode()), ("txts/u2.txt", b"no tab \xff"), ("wavs/u2.wav", wav(2)), ("txts/u3.txt", b""), ("wavs/u3.wav", wav(1))], "w:gz")
    a = {r.stem: r for r in archives.read_samples(spark, f"{tmp_path}/a.tar").collect()}
    assert sorted(a) == ["bad", "one", "short", "two"] and [a[s].key for s in ("one", "two")] == ["ID1", "two"]
    assert (a["one"].source_duration, a["one"].speaker, a["two"].source_duration, a["short"].dnsmos) == (99.0, "s", None, 3.1)
    assert [a[s].ord for s in ("one", "two", "bad", "short")] == [0, 1, 2, 3]
    b = {r.key: (r.text, r.language, r.ext) for r in archives.read_samples(spark, f"{tmp_path}/b.tar.gz", "txt_wav").collect()}
    assert b == {"u1": ("文本", "zh", "wav"), "u2": ("no tab �", "zh", "wav"), "u3": (None, "zh", "wav")}
    assert archives.read_samples(spark, f"{tmp_path}/a.tar", limit=2).count() == 2
    n = {r.shard: (r.unpaired_meta, r.unpaired_audio) for r in archives.unpaired_counts(spark, f"{tmp_path}/a.tar").collect()}
    assert n == {"a": (1, 0)}
    assert {r.shard: r.n for r in archives.count_metadata(spark, f"{tmp_path}/a.tar").collect()} == {"a": 6}
    drops = spark.createDataFrame([("a", "two"), ("b", "u1"), ("a", "none")], "shard string, stem string")
    got = {(r.shard, r.stem): bytes(r.payload) for r in archives.source_audio(spark, drops, f"{tmp_path}/a.tar,{tmp_path}/b.tar.gz").collect()}
    assert got == {("a", "two"): wav(4), ("b", "u1"): wav(2)}


def test_audio_functions():
    x = np.stack([np.linspace(-1, 1, 800), np.linspace(1, -1, 800)], 1).astype(np.float32)
    y, rate = audio.decode(audio.encode_wav(x, 8000))
    assert rate == 8000 and np.abs(x - y).max() < 1e-4
    assert np.abs(audio.mono_16k(y, rate)).max() < 1e-3 and len(audio.mono_16k(y, rate)) == 1600
    assert audio.cut(y, rate, 0.01, 0.05, 0.1, 0.0).shape == (800 + 320, 2)


SECTIONS = {
    "batch_size": 2,
    "duration": {"min_sec": 2.0, "max_sec": 30.0},
    "audiobox": {"enabled": True, "min_pq": 6.0},
    "asr": {"enabled": True, "max_wer": 0.5, "phonetic": False},
    "align": {"enabled": True},
    "trim": {"enabled": True},
    "pause": {"enabled": True},
    "punct": {"enabled": True},
}


def quality():
    return lambda rows: [{"PQ": 7.0 if len(r["audio"]) > 100_000 else 5.0, "CE": 1.0, "CU": 1.0, "PC": 1.0} for r in rows]


def transcript():
    return lambda rows: [{"text": "你好吗" if r["asr_language"] == "Chinese" else "hello there", "language": r["asr_language"]} for r in rows]


def aligner():
    def run(rows):
        if len(rows) > 1:
            raise RuntimeError("a batch fails, rows do not")
        units = rows[0]["align_text"].split() if rows[0]["align_language"] == "English" else list(rows[0]["align_text"])
        return [[{"text": u, "start": 0.5 + k * 0.9, "end": 0.8 + k * 0.9} for k, u in enumerate(units)]]

    return run


def test_run_end_to_end(spark, tmp_path):
    shard_a(tmp_path)
    write(tmp_path / "empty.tar", [])
    out = tmp_path / "out"
    backends = {"quality": quality, "transcript": transcript, "alignment": aligner}
    sections = SECTIONS | {"audiobox": {"enabled": True, "min_pq": 4.0}}
    said = run_shards(spark, f"{tmp_path}/*.tar", str(out), Settings(sections), backends=backends)
    assert said == "input=4 output=2 drop:duration=1 drop:input=1"
    assert sinks.done_shards(str(out)) == ["a", "empty"] and sorted(f for f in os.listdir(out) if not f.startswith(".")) == ["a-clean.tar", "a-drops.jsonl", "empty-clean.tar", "empty-drops.jsonl"]
    with tarfile.open(out / "a-clean.tar") as t:
        names = t.getnames()
        info = json.loads(t.extractfile("ID1.json").read())
        sound, rate = audio.decode(t.extractfile([n for n in names if n.startswith("ID1.") and not n.endswith("json")][0]).read())
    assert len(names) == 4 and info["text"] == "你，好，吗" and info["orig_text"] == "你好吗" and info["speaker"] == "s" and info["source"] == archives.SOURCES["json_audio"]
    assert abs(len(sound) / rate - info["duration"]) < 1e-3 and info["trim"]["cut_head"] == 0.4 and info["alignment"][0]["start"] == 0.1
    drops = [json.loads(x) for x in open(out / "a-drops.jsonl")]
    assert {(d["key"], d["stage"], d["reason"].split(":")[0]) for d in drops} == {("bad", "input", "decode_error"), ("short", "duration", "too_short")}
    assert {d["reason"] for d in drops if d["key"] == "short"} == {"too_short:1.00"}
    assert run_shards(spark, f"{tmp_path}/*.tar", str(out), Settings(sections), backends=backends) == "input=0 output=0"
    clean = {r.key: r for r in archives.read_clean(spark, f"{out}/*-clean.tar").collect()}
    assert sorted(clean) == ["ID1", "two"] and clean["ID1"].shard == "a" and json.loads(clean["two"].meta)["text"] == "hello there"
    assert {(r.shard, r.key, r.stage) for r in archives.read_drops(spark, f"{out}/*-drops.jsonl").collect()} == {("a", "bad", "input"), ("a", "short", "duration")}


def test_reasons():
    assert sinks.render_reason("too_short", 0.125) == "too_short:0.12" and sinks.render_reason("wer", float("inf")) == "wer:inf"
    assert sinks.render_reason("audiobox_PQ", 5.999, {"PQ": 6.0}) == "audiobox_PQ:6.00<6.0" and sinks.render_reason("multi_speaker", 2.0) == "multi_speaker:2"
    assert sinks.render_reason("align_failed", None) == "align_failed"


def test_arrivals(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    shard_a(folder)
    seen: list[str] = []
    for _ in range(2):
        process_arrivals(spark, str(folder), "*.tar", str(tmp_path / "ck"), seen.extend)
    write(folder / "c.tar", [])
    process_arrivals(spark, str(folder), "*.tar", str(tmp_path / "ck"), seen.extend)
    assert [os.path.basename(p) for p in seen] == ["a.tar", "c.tar"]


def test_a_broken_archive_leaves_the_others_finished(spark, tmp_path):
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    for name in ("a", "b", "c"):
        write(folder / f"{name}.tar", [("x.json", meta(text=f"text {name}")), ("x.wav", wav(3))])
    whole = (folder / "b.tar").read_bytes()
    (folder / "b.tar").write_bytes(b"no archive" + whole[10:200])
    settings = Settings({"duration": {"min_sec": 2.0, "max_sec": 30.0}})
    with pytest.raises(RuntimeError, match="1 of 3 shards failed: b;"):
        run_shards(spark, f"{folder}/*.tar", str(out), settings)
    assert sinks.done_shards(str(out)) == ["a", "c"] and not (out / "b-clean.tar").exists()
    before = (out / "a-clean.tar").stat().st_mtime_ns
    (folder / "b.tar").write_bytes(whole)
    assert run_shards(spark, f"{folder}/*.tar", str(out), settings) == "input=1 output=1"
    assert sinks.done_shards(str(out)) == ["a", "b", "c"] and (out / "a-clean.tar").stat().st_mtime_ns == before


def test_a_repeated_stem_and_a_repeated_name(spark, tmp_path):
    write(tmp_path / "a.tar", [("x.json", meta(text="first")), ("x.json", meta(text="second")), ("x.wav", wav(1)), ("y.wav", wav(1)), ("y.wav", wav(2)), ("y.json", meta(text="y"))])
    rows = {r.key: r for r in archives.read_samples(spark, f"{tmp_path}/a.tar").collect()}
    assert rows["x"].text == "second" and bytes(rows["y"].audio) == wav(2)  # the latest before the pair is complete
    (tmp_path / "more").mkdir()
    write(tmp_path / "more" / "a.tar", [])
    with pytest.raises(ValueError, match="two archives are called a"):
        run_shards(spark, f"{tmp_path}/*.tar,{tmp_path}/more/*.tar", str(tmp_path / "out"), Settings({}))


def test_audio_from_the_cache_first(spark, tmp_path):
    shard_a(tmp_path)
    (tmp_path / "cache" / "a").mkdir(parents=True)
    (tmp_path / "cache" / "a" / "two.flac").write_bytes(b"kept")
    drops = spark.createDataFrame([("a", "two"), ("a", "one")], "shard string, stem string")
    found = archives.source_audio(spark, drops, f"{tmp_path}/a.tar", archives.read_cache(spark, str(tmp_path / "cache")))
    assert {(r.stem, r.ext, bytes(r.payload)) for r in found.collect()} == {("two", "flac", b"kept"), ("one", "wav", wav(3))}
