"""Synthetic samples over the driver's documents, for queries and benchmarks.

Annotations are integer arithmetic on doc_id, the same in any engine; they are made up and say nothing about the texts.
A document is a sample, or is cut into utterances of ``TOKENS`` tokens that together hold the whole text.
"""

from __future__ import annotations

import io
import json
import os
import re
import tarfile
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.audio import encode_wav
from ..operators.reject import with_rejects

TOKENS = 40


def ms(expression: str) -> Column:
    """Whole milliseconds as seconds."""
    return F.expr(f"cast({expression} as double) / 1000D")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select(F.col("source").alias("shard"), F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("key"), F.lit("wav").alias("ext"), "text", F.col("lang").alias("language"), "doc_id", "n_chars")
    return with_rejects(rows.withColumns({"duration": ms("doc_id * 7919 % 35000"), "audio_duration": ms("doc_id * 7919 % 35000")}))


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole texts as samples of at most ``TOKENS`` tokens each, one at least; doc_id and key number them.

    A table of fewer splits than there are cores is dealt out first; a larger one is not moved.
    """
    df = samples(spark, sf_dir)
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        df = df.repartition(4 * cores, "doc_id")
    words = df.withColumn("_w", F.coalesce(F.array_remove(F.split("text", "[ \n]+"), ""), F.expr("cast(array() as array<string>)")))
    firsts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size("_w") - 1) / TOKENS).cast("int")))
    rows = words.select("*", F.explode(F.transform(firsts, lambda k: F.struct(k.alias("k"), F.slice("_w", k * TOKENS + 1, TOKENS).alias("w")))).alias("_u"))
    named = {"key": F.concat("key", F.lit("-"), F.col("_u.k").cast("string")), "doc_id": F.col("doc_id") * 1000 + F.col("_u.k"), "text": F.array_join("_u.w", " ")}
    return rows.withColumns(named).drop("_w", "_u")


def with_quality(df: DataFrame) -> DataFrame:
    axis = lambda k, lo: ms(f"{lo} + doc_id * {k} % 6000")
    return df.withColumn("quality", F.create_map(F.lit("PQ"), axis(7, 3000), F.lit("CE"), axis(11, 2000), F.lit("CU"), axis(13, 2500), F.lit("PC"), axis(17, 1000)))


def with_segments(df: DataFrame) -> DataFrame:
    """One to three speakers' lines, before lines that are no segments: too long, not numbers, too short."""
    line = lambda k: F.format_string(f"%.2f %.2f speaker_{k}", F.lit(float(k)), F.expr(f"{k}D + cast(doc_id * {k * 7 + 3} % 300 as double) / 100D"))
    noise = F.array(*map(F.lit, ("0.0 5.0 speaker_8 extra", "1.2.3 9.0 speaker_1", "noise")))
    return df.withColumn("segments", F.concat(F.slice(F.array(line(0), line(1), line(2)), 1, F.expr("int(doc_id % 3) + 1")), noise))


def tokens(column: str = "text") -> Column:
    return F.array_remove(F.split(column, "[ \n]+"), "")


def with_transcript(df: DataFrame) -> DataFrame:
    """The text's tokens, without every m-th one and with the words before those changed."""
    words = tokens()
    m = F.expr("int(doc_id % 23) + 3")
    heard = F.filter(F.transform(words, lambda w, i: F.when((i + 1) % m == 0, F.lit(None)).when((i + 2) % m == 0, F.lit("zzz")).otherwise(w)), lambda w: w.isNotNull())
    return df.withColumns({"transcript": F.struct(F.array_join(heard, " ").alias("text"), F.col("language").alias("language")), "text": F.array_join(words, " ")})


def with_alignment(df: DataFrame) -> DataFrame:
    """The text's tokens, at 300 ms each with gaps that depend on the token's place."""
    words = tokens()
    start = lambda i: F.expr("doc_id * 31 % 1500").cast("long") + i.cast("long") * 400 + F.pmod(F.col("doc_id") * 17 + i * i * 91, F.lit(1300))
    # each unit ends before the next begins, but for a few overlaps
    items = F.transform(words, lambda w, i: F.struct(w.alias("text"), (start(i).cast("double") / 1000).alias("start"), ((start(i) + 120).cast("double") / 1000).alias("end")))
    last = F.expr("doc_id * 31 % 1500") + F.size(words) * 400 + F.pmod(F.col("doc_id") * 3, F.lit(2500))
    seconds = last.cast("double") / 1000
    return df.withColumns({"alignment": items, "text": F.array_join(words, " "), "audio_duration": seconds, "duration": seconds})


def frames(doc_id: str = "doc_id") -> str:
    """The length of a document's made-up recording at 16 kHz, as SQL."""
    return f"(1600 + {doc_id} % 1000)"


def with_audio(df: DataFrame) -> DataFrame:
    """A 16 kHz WAV of ``frames`` frames whose samples are the document's number, as ``encode_wav`` writes it; built-in
    expressions alone, so that no Python worker holds recordings."""
    head = encode_wav(np.zeros((0, 1), np.float32), 16_000).hex()
    levels = F.array(*(F.lit(encode_wav(np.full((1, 1), k / 100, np.float32), 16_000)[44:].hex()) for k in range(100)))
    n = F.expr(frames()).cast("int")
    little = lambda x: F.concat(*(F.lpad(F.hex(F.shiftright(x, 8 * k).bitwiseAND(255)), 2, "0") for k in range(4)))
    samples = F.repeat(F.get(levels, F.pmod("doc_id", F.lit(100)).cast("int")), n)
    return df.withColumn("audio", F.unhex(F.concat(F.lit(head[:8]), little(2 * n + 36), F.lit(head[16:80]), little(2 * n), samples)))


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the one that driver and executors share, as a path that they can open."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"file://{tempfile.mkdtemp(prefix='voxloom-')}"
    if not base.startswith(("file:", "/")):
        raise ValueError(f"archives are written by path, which {base} is not")
    path = os.path.join(re.sub("^file:/*", "/", base), f"{name}-{uuid.uuid4().hex}")
    os.makedirs(path)
    return path


def write_archives(df: DataFrame, folder: str, layout: str = "json_audio") -> None:
    """Source archives, one a shard: (shard, ord, key, text, language, audio) rows as pairs of the layout."""
    end, mode = (".tar", "w") if layout == "json_audio" else (".tar.gz", "w:gz")

    def write(rows):
        out, shard = None, None
        for r in rows:
            if r.shard != shard:
                if out is not None:
                    out.close()
                shard, out = r.shard, tarfile.open(os.path.join(folder, r.shard + end), mode)
            if layout == "json_audio":
                pair = ((f"{r.key}.json", json.dumps({"text": r.text, "language": r.language}).encode()), (f"{r.key}.wav", r.audio))
            else:
                pair = ((f"txts/{r.key}.txt", f"{r.key}\t{r.text or ''}\n0 1\n".encode()), (f"wavs/{r.key}.wav", r.audio))
            for name, data in pair:
                info = tarfile.TarInfo(name)
                info.size = len(data)
                out.addfile(info, io.BytesIO(data))
                out.members.clear()  # else the archive keeps every member that it has written
        if out is not None:
            out.close()

    df.select("shard", "ord", "key", "text", "language", "audio").repartition("shard").sortWithinPartitions("shard", "ord").foreachPartition(write)
