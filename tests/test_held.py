"""What a worker holds does not grow with the archive or the batch."""

import json
import tarfile

import numpy as np

from voxloom.functions import audio
from voxloom.plans import synthetic
from voxloom.sources import archives


def test_scan_lets_members_go_and_hands_on_small_batches(tmp_path):
    import io

    path, wav = tmp_path / "a.tar", audio.encode_wav(np.zeros((160, 1), np.float32), 16_000)
    with tarfile.open(path, "w") as out:
        for k in range(archives.BATCH_ROWS + 7):
            for name, data in ((f"{k}.json", json.dumps({"text": k % 2 == 0 if k < 2 else f"t{k}"}).encode()), (f"{k}.wav", wav)):
                info = tarfile.TarInfo(name)
                info.size = len(data)
                out.addfile(info, io.BytesIO(data))
    held = []
    with tarfile.open(path) as archive:
        for _ in archives._files(archive):
            held.append(len(archive.members))
    assert len(held) == 2 * archives.BATCH_ROWS + 14 and max(held) <= 1
    batches = list(archives._Reader({"mode": "samples", "path": str(path)}).read(archives._Shard(str(path))))
    assert [b.num_rows for b in batches] == [archives.BATCH_ROWS, 7]
    rows = [r for b in batches for r in b.to_pylist()]
    assert [r["ord"] for r in rows] == list(range(archives.BATCH_ROWS + 7)) and rows[-1]["text"] == f"t{archives.BATCH_ROWS + 6}"
    assert [r["text"] for r in rows[:2]] == ["true", "false"] and all(r["audio"] == wav and r["shard"] == "a" for r in rows)
    few = list(archives._Reader({"mode": "samples", "path": str(path), "limit": "3"}).read(archives._Shard(str(path))))
    assert [b.num_rows for b in few] == [3]


def test_writers_let_members_go(spark, tmp_path, monkeypatch):
    held, kept = [], tarfile.TarFile.addfile

    def addfile(self, *a):
        held.append(len(self.members))
        kept(self, *a)

    class Rows:
        def __getattr__(self, _):
            return lambda *a: self

        def foreachPartition(self, write):
            from pyspark.sql import Row

            write(iter([Row(shard="s", ord=k, key=str(k), text="t", language="en", audio=b"x") for k in range(5)]))

    monkeypatch.setattr(tarfile.TarFile, "addfile", addfile)
    synthetic.write_archives(Rows(), str(tmp_path))
    assert held == [0] * 10


def test_recordings_are_as_encoded(spark):
    rows = synthetic.with_audio(spark.range(0, 1200, 7).withColumnRenamed("id", "doc_id"))
    assert "Python" not in rows._jdf.queryExecution().toString()
    for r in rows.collect():
        assert bytes(r.audio) == audio.encode_wav(np.full((1600 + r.doc_id % 1000, 1), r.doc_id % 100 / 100, np.float32), 16_000)


def test_new_audio_is_handed_on_in_pieces(monkeypatch):
    import pyarrow as pa
    from pyspark.sql import types as T

    class Frame:
        schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("audio", T.BinaryType()), T.StructField("ext", T.StringType()), T.StructField("_trim", T.StringType())])

        def mapInArrow(self, run, _):
            return run

    monkeypatch.setattr(audio, "NEW_BYTES", 1000, raising=False)
    wav = audio.encode_wav(np.full((160, 1), 0.5, np.float32), 16_000)
    plan = {"cut_start": 0.0, "cut_end": 0.005, "pad_head": 0.0, "pad_tail": 0.0}
    plans, sounds = [plan, None, plan, plan] * 5, [wav, wav, None, b"RIFFx"] * 5
    b = pa.record_batch([pa.array(map(str, range(20))), pa.array(sounds, pa.binary()), pa.array(["wav"] * 20), pa.array(plans)], names=["key", "audio", "ext", "_trim"])
    out = list(audio.with_trimmed(Frame())(iter([b])))
    assert len(out) > 2 and max(x.num_rows for x in out) < 15
    rows = [r for x in out for r in x.to_pylist()]
    assert [r["key"] for r in rows] == [str(k) for k in range(20)]
    assert [r["new_duration"] for r in rows] == [0.005, None, None, None] * 5
    assert [r["trim_error"] for r in rows] == [None, None, "TypeError", "EOFError"] * 5 and rows[1]["audio"] == wav
