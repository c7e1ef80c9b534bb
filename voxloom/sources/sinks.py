"""Outputs of a cleaning run: one clean archive and one reject file a shard, and markers of finished shards.

Files are written by tasks under temporary names and renamed when the whole write commits, so a failed attempt leaves
nothing behind and a finished shard is whole. The folder must be shared by the executors.
"""

from __future__ import annotations

import io
import json
import math
import os
import tarfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..schema import ANNOTATIONS
from .archives import SOURCES

#: Digits after the point of a reject's value, by code; other codes show it as a whole number.
_DIGITS = {"too_short": 2, "too_long": 2, "wer": 3, "pause_gap": 2, "pause_head": 2, "pause_tail": 2}


def render_reason(code: str, value: float | None, thresholds: dict | None = None) -> str:
    """The reason as text, rounded as Python rounds."""
    if value is None:
        return code
    if code.startswith("audiobox_"):
        axis = code.removeprefix("audiobox_")
        return f"{code}:{value:.2f}{'>' if axis == 'PC' else '<'}{(thresholds or {}).get(axis)}"
    if math.isinf(value):
        return f"{code}:inf"
    return f"{code}:{value:.{_DIGITS[code]}f}" if code in _DIGITS else f"{code}:{int(value)}"


def _plain(value):
    if hasattr(value, "asDict"):
        return {k: _plain(v) for k, v in value.asDict().items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return {k: _plain(v) for k, v in value.items()} if isinstance(value, dict) else value


def metadata(row) -> dict:
    """A row's metadata as it is written: source fields (null ones too in the json_audio layout), annotations, text, language."""
    r, out = row.asDict(), {}
    out["duration"] = r.get("duration") if r.get("duration") is not None else r.get("source_duration")
    if r.get("source") == SOURCES["json_audio"]:
        out |= {"speaker": r.get("speaker"), "dnsmos": r.get("dnsmos")}
    elif out["duration"] is None:
        del out["duration"]
    out["source"] = r.get("source")
    for name in ANNOTATIONS:
        if (value := _plain(r.get(name))) is not None:
            if name == "tn":
                value = {k: v for k, v in value.items() if v is not None}
            out[name] = value
    return out | {"text": r.get("text"), "language": r.get("language")}


@dataclass
class _Done(WriterCommitMessage):
    files: list = field(default_factory=list)


class _ShardWriter(DataSourceWriter):
    """Rows come sorted by shard; each shard is one file."""

    def __init__(self, options: dict):
        self.folder, self.kind = options["path"], options.get("kind", "clean")
        self.thresholds = json.loads(options.get("thresholds", "{}"))

    def _final(self, shard: str) -> str:
        return os.path.join(self.folder, f"{shard}-clean.tar" if self.kind == "clean" else f"{shard}-drops.jsonl")

    def write(self, iterator):
        os.makedirs(self.folder, exist_ok=True)
        files, shard, out, temporary = [], None, None, None
        for row in iterator:
            if out is None or row["shard"] != shard:
                if out is not None:
                    out.close()
                shard, temporary = row["shard"], os.path.join(self.folder, f".{row['shard']}-{uuid.uuid4().hex}.tmp")
                out = tarfile.open(temporary, "w") if self.kind == "clean" else open(temporary, "w", encoding="utf-8")  # noqa: SIM115
                files.append((temporary, self._final(shard)))
            if row["key"] is None and row["ext"] is None:
                continue  # stands for a shard without rows
            if self.kind == "clean":
                meta = json.dumps(metadata(row), ensure_ascii=False).encode()
                for name, data in ((f"{row['key']}.{row['ext']}", bytes(row["audio"] or b"")), (f"{row['key']}.json", meta)):
                    info = tarfile.TarInfo(name)
                    info.size = len(data)
                    out.addfile(info, io.BytesIO(data))
                    out.members.clear()  # else the archive keeps every member that it has written
            else:
                reason = render_reason(row["reject_code"], row["reject_value"], self.thresholds)
                out.write(json.dumps({"key": row["key"], "stage": row["reject_stage"], "reason": reason, "meta": metadata(row)}, ensure_ascii=False) + "\n")
        if out is not None:
            out.close()
        return _Done(files)

    def commit(self, messages):
        for temporary, final in (f for m in messages if m for f in m.files):
            os.replace(temporary, final)

    def abort(self, messages):
        for temporary, _ in (f for m in messages if m for f in m.files):
            if os.path.exists(temporary):
                os.remove(temporary)


class ShardSink(DataSource):
    """format("voxloom_shards"): options path and kind (clean or drops)."""

    @classmethod
    def name(cls):
        return "voxloom_shards"

    def writer(self, schema, overwrite):
        return _ShardWriter(dict(self.options))


def _write(rows: DataFrame, shards: list[str], folder: str, **options) -> None:
    """Every shard gets a file, rows or not."""
    spark = rows.sparkSession
    spark.dataSource.register(ShardSink)
    empty = spark.createDataFrame([(s,) for s in shards], "shard string").withColumn("ord", F.lit(-1).cast("long"))
    every = rows.unionByName(empty, allowMissingColumns=True)
    dealt = every.repartition(max(1, len(shards)), "shard").sortWithinPartitions("shard", "ord")
    dealt.write.format("voxloom_shards").options(**options).mode("append").save(folder)


def write_run(rows: DataFrame, folder: str, shards: list[str], thresholds: dict | None = None) -> None:
    """Clean archives, reject files, then the markers. ``rows`` is computed twice unless it is persisted or written before."""
    from ..operators.reject import dropped, passed

    _write(passed(rows), shards, folder, kind="clean")
    _write(dropped(rows), shards, folder, kind="drops", thresholds=json.dumps(thresholds or {}))
    done = os.path.join(folder, ".done")
    os.makedirs(done, exist_ok=True)
    for shard in shards:
        open(os.path.join(done, f"{shard}.done"), "w").close()


def done_shards(folder: str) -> list[str]:
    done = os.path.join(folder, ".done")
    return sorted(f.removesuffix(".done") for f in os.listdir(done) if f.endswith(".done")) if os.path.isdir(done) else []


def shard_log(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(shard, n_in, n_out, kept_percent) of a run."""
    n = rows.groupBy("shard").agg(F.count("*").alias("n_in"), F.count_if(F.col("reject_code").isNull()).alias("n_out"))
    return n.withColumn("kept_percent", 100 * F.col("n_out") / F.greatest(F.col("n_in"), F.lit(1)))
