"""Model adapters: annotations by any backend, run over live rows in Arrow batches.

A backend is a factory without arguments that gives a function from a list of row dicts to a list of annotations. It is
made once a worker process.
Annotations that are already at hand (``precomputed``) join by key instead.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Field and type of each stage's annotation.
KINDS = {
    "quality": "map<string,double>",
    "segments": "array<string>",
    "transcript": "struct<text:string,language:string>",
    "rewrite": "string",
    "alignment": "array<struct<text:string,start:double,end:double>>",
}
#: Kinds that a model may give null for: no alignment was found, nobody speaks.
NULLABLE = ("alignment", "segments")
_BACKENDS: dict[tuple[str, str], Callable] = {}
_MADE: dict[tuple[str, str], Callable] = {}

# Fixed value: the instruction for rewriting written forms; {ref} is the second transcript.
REWRITE_PROMPT = """把下面文本中的阿拉伯数字、符号等书面形式改写成中文口语读法。这是语音转写文本,改写结果必须与音频读法一致:
- 严格按读法逐字改写,禁止意译、换说法、增删内容;其余文字和标点一字不动;
- 优先参考「参考转写」中的读法(它来自同一段音频的另一份转写);
- 年份、电话、编号逐位读;数量按数值读;百分号读"百分之"。

示例:
- 1876年出生 → 一八七六年出生
- 投资210亿元 → 投资二百一十亿元
- 有50%的把握 → 有百分之五十的把握
- 拨打110 → 拨打幺幺零
- 下午2:30开会 → 下午两点三十分开会
- 房间号1204 → 房间号幺二零四

参考转写: {ref}
待改写文本: {text}
只输出改写后的文本,不要任何解释。"""
# Fixed value: stands for a second transcript where there is none.
NO_REFERENCE = "(无)"


def register_backend(kind: str, name: str, factory: Callable[[], Callable[[list[dict]], list]]) -> None:
    _BACKENDS[kind, name] = factory


def rewrite_prompt(text: str, reference: str | None) -> str:
    """What a rewriting model is asked for a text and its other transcript."""
    return REWRITE_PROMPT.format(ref=reference or NO_REFERENCE, text=text)


def chat_rewriter(ask: Callable[[list[str], int], list[str]]) -> Callable[[], Callable[[list[dict]], list]]:
    """A backend for rewrites from ``ask(prompts, most_new_tokens)``, which gives one answer a prompt."""

    def make():
        def run(rows: list[dict]) -> list:
            prompts = [rewrite_prompt(r["text"], r.get("orig_text")) for r in rows]
            return ask(prompts, min(512, 2 * max(len(r["text"]) for r in rows) + 32))

        return run

    return make


def precomputed(df: DataFrame, kind: str, rows: DataFrame, on: str = "key") -> DataFrame:
    return df.drop(kind).join(rows.select(on, kind), on, "left")


def _model(name: tuple[str, str], make: Callable[[], Callable[[list[dict]], list]]) -> Callable[[list[dict]], list]:
    """The worker process's own model of that name. Found by import, not pickled with a task, so that tasks share it."""
    if name not in _MADE:
        _MADE[name] = make()
    return _MADE[name]


def _one_by_one(model, rows: list[dict]) -> list:
    """What the model gives for each row alone; null for a row that fails."""
    out = []
    for row in rows:
        try:
            out.extend(model([row]))
        except Exception:  # noqa: BLE001  models raise many kinds
            out.append(None)
    return out


def annotate(df: DataFrame, kind: str, factory: Callable[[], Callable[[list[dict]], list]] | str, inputs: list[str], batch_size: int = 32, gate=None, name: str | None = None) -> DataFrame:
    """Adds the annotation ``kind`` to live rows (that pass ``gate``); others get null.

    A worker process makes one model for each kind and ``name`` (None: one for each factory that differs in any way).
    Errors of a model end the job, as does a row that it gives null for; but a batch that cannot be aligned is tried
    again row by row, and a row that fails alone gets null, which the alignment stage rejects. The map ``timing`` holds
    each row's share of the seconds that its batch took, by kind.
    """
    make = _BACKENDS[kind, factory] if isinstance(factory, str) else factory
    flag = F.col("reject_code").isNull() & (gate if gate is not None else F.lit(True))
    df = df.drop(kind).withColumn("_run", F.coalesce(flag, F.lit(False)))
    field, seconds = T.StructField(kind, T._parse_datatype_string(KINDS[kind])), T.StructField("_seconds", T.DoubleType())
    kept = [f for f in df.schema.fields if f.name != "_run"]
    schema, arrow = T.StructType([*kept, field, seconds]), to_arrow_type(field.dataType)
    own = name or (factory if isinstance(factory, str) else hashlib.md5(cloudpickle.dumps(make)).hexdigest())

    def run(batches):
        model = _model((kind, own), make)
        for b in batches:
            at = {c: b.schema.get_field_index(c) for c in [*inputs, "_run"]}
            live = [k for k, x in enumerate(b.column(at["_run"]).to_pylist()) if x]
            data = {c: b.column(at[c]) for c in inputs}
            out: list = [None] * b.num_rows
            took: list = [None] * b.num_rows
            for lo in range(0, len(live), batch_size):
                places = live[lo : lo + batch_size]
                rows = [{c: data[c][k].as_py() for c in inputs} for k in places]
                began = time.perf_counter()
                try:
                    found = model(rows)
                except Exception:
                    if kind != "alignment":
                        raise
                    found = _one_by_one(model, rows)
                each = (time.perf_counter() - began) / len(places)
                for k, x in zip(places, found, strict=True):
                    if x is None and kind not in NULLABLE:
                        raise ValueError(f"the model for {kind} gave nothing for a row")
                    out[k], took[k] = x, each
            columns = [b.column(b.schema.get_field_index(f.name)) for f in kept]
            yield pa.record_batch([*columns, pa.array(out, arrow), pa.array(took, pa.float64())], names=schema.names)

    before = F.col("timing") if "timing" in df.columns else F.expr("cast(map() as map<string, double>)")
    spent = F.map_from_arrays(F.array(F.lit(kind)), F.array("_seconds"))
    return df.mapInArrow(run, schema).withColumn("timing", F.when(F.col("_seconds").isNotNull(), F.map_concat(before, spent)).otherwise(before)).drop("_seconds")


def timed_rows(df: DataFrame, audio_seconds: str = "duration") -> DataFrame:
    """(stage, seconds, items, audio_seconds) of each row and kind that took time, for ``reject.throughput``."""
    return df.select(F.explode("timing").alias("stage", "seconds"), F.lit(1).alias("items"), F.coalesce(F.col(audio_seconds), F.lit(0.0)).alias("audio_seconds"))


def _device_peaks() -> list[tuple[int, int, int]]:
    """(device, allocated, reserved): the most bytes that this process held on each GPU; none if that cannot be told."""
    try:
        import torch

        return [(k, int(torch.cuda.max_memory_allocated(k)), int(torch.cuda.max_memory_reserved(k))) for k in range(torch.cuda.device_count())]
    except Exception:  # noqa: BLE001  a report must not end a run
        return []


def device_memory(spark: SparkSession) -> DataFrame:
    """(device, allocated, reserved): the most bytes that one worker process held on a GPU, as far as the tasks of a small
    job meet the workers that ran the models. No rows without GPUs."""

    def run(batches):
        for _ in batches:
            pass
        rows = _device_peaks()
        yield pa.record_batch([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["device", "allocated", "reserved"])

    tasks = spark.sparkContext.defaultParallelism
    found = spark.range(0, tasks, 1, tasks).mapInArrow(run, "device long, allocated long, reserved long")
    return found.groupBy("device").agg(F.max("allocated").alias("allocated"), F.max("reserved").alias("reserved"))
