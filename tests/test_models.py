import os

import pytest
from pyspark.errors import PythonException

from voxloom.functions import text as tx
from voxloom.operators import models, packs
from voxloom.operators import reject as rj


def rows(spark, n=32, parts=8):
    df = spark.createDataFrame([(k, f"t{k}", 2.0) for k in range(n)], "k long, text string, duration double").repartition(parts)
    return rj.with_rejects(df)


def test_a_worker_process_makes_one_model(spark, tmp_path):
    folder = str(tmp_path)

    def factory():
        with open(os.path.join(folder, f"made-{os.getpid()}-{len(os.listdir(folder))}"), "w"):
            pass
        return lambda rows: [f"{os.getpid()}" for _ in rows]

    df = models.annotate(rows(spark), "rewrite", factory, ["text"], 4)
    processes = {r.rewrite for r in df.collect()} | {r.rewrite for r in df.collect()}
    assert sorted(f.split("-")[1] for f in os.listdir(folder)) == sorted(processes)


def test_two_factories_of_one_function_are_two_models(spark):
    def factory(answer):
        return lambda: lambda rows: [answer for _ in rows]

    for answer in ("x", "y"):
        assert {r.rewrite for r in models.annotate(rows(spark), "rewrite", factory(answer), ["text"]).collect()} == {answer}


def picky(bad):
    def make():
        def run(rows):
            if any(r["text"] in bad for r in rows):
                raise RuntimeError("cannot")
            return [[{"text": r["text"], "start": 0.0, "end": 1.0}] for r in rows]

        return run

    return make


def test_only_alignment_falls_back_row_by_row(spark):
    got = {r.k: r.alignment for r in models.annotate(rows(spark), "alignment", picky({"t3"}), ["text"], 8).collect()}
    assert [k for k, x in got.items() if x is None] == [3]
    for kind, answer in (("quality", None), ("transcript", None)):
        with pytest.raises(PythonException, match="gave nothing"):
            models.annotate(rows(spark), kind, lambda answer=answer: lambda rows: [answer for _ in rows], ["text"]).collect()

    def failing():
        def run(rows):
            raise RuntimeError("cannot")

        return run

    with pytest.raises(PythonException, match="cannot"):
        models.annotate(rows(spark), "segments", failing, ["text"]).collect()


def test_time_is_told(spark, tmp_path):
    df = models.annotate(rows(spark, 10, 2), "segments", lambda: lambda rows: [[] for _ in rows], ["text"])
    df = models.annotate(df, "rewrite", lambda: lambda rows: ["x" for _ in rows], ["text"])
    df.write.parquet(f"{tmp_path}/timed")
    told = {r.stage: r for r in rj.throughput(models.timed_rows(spark.read.parquet(f"{tmp_path}/timed"))).collect()}
    assert set(told) == {"segments", "rewrite"} and abs(sum(r.share for r in told.values()) - 1) < 1e-9
    assert all(r.seconds > 0 and abs(r.times_real_time * r.seconds - 20) < 1e-6 for r in told.values())


def test_rewriting_asks_for_both_texts():
    asked = []

    def ask(prompts, most):
        asked.append((prompts, most))
        return ["x"] * len(prompts)

    run = models.chat_rewriter(ask)()
    assert run([{"text": "12", "orig_text": "twelve"}, {"text": "3456", "orig_text": None}]) == ["x", "x"]
    (first, second), most = asked[0]
    assert "twelve" in first and "12" in first and models.NO_REFERENCE in second and most == 40


def test_packs_are_sent_once(spark):
    listed = spark.createDataFrame([("p1", ["a"]), ("p0", ["b", "c"]), ("p2", ["d"])], "pack_id string, files array<string>")
    done = spark.createDataFrame([("p0", ["b", "c"]), ("p2", ["x"])], "pack_id string, files array<string>")
    sent, kept = [], []
    assert packs.upload(listed, done, lambda p, f: sent.append((p, f)), lambda p, f: kept.append(p)) == ["p1", "p2"]
    assert sent == [("p1", ["a"]), ("p2", ["d"])] and kept == ["p1", "p2"]


def test_default_error_rate_of_cjk_rows(spark):
    cases = [("今天天气很好", "今天天气很好"), ("我有2个 Ａpples", "我有二个 apples"), ("全角ＡＢＣ", "全角abc"), ("你好吗", "你好"), ("2021年", "二零二一年"), ("100%", "百分之一百"), ("ｶﾞ", "ガ")]
    df = spark.createDataFrame(cases, "a string, b string")
    got = [r.w for r in df.select(tx.compute_wer(tx.F.col("a"), tx.F.col("b"), True).alias("w")).collect()]
    assert got[:3] == [0.0, 0.0, 0.0] and abs(got[3] - 1 / 3) < 1e-9 and got[4] == 0.0 and got[6] == 0.0


def test_memory_of_devices(spark, monkeypatch):
    import sys
    from types import SimpleNamespace

    cuda = SimpleNamespace(device_count=lambda: 2, max_memory_allocated=lambda k: 10 + k, max_memory_reserved=lambda k: 20 + k)
    monkeypatch.setitem(sys.modules, "torch", SimpleNamespace(cuda=cuda))
    assert models._device_peaks() == [(0, 10, 20), (1, 11, 21)]
    cuda.device_count = lambda: 1 // 0
    assert models._device_peaks() == []
    assert models.device_memory(spark).collect() == []  # the workers have no such package
