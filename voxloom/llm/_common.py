"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of text that a worker takes from an Arrow batch at once, and about as many that a cache of its may hold.
TEXT_BYTES, CACHE_BYTES = 4 << 20, 48 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``); one of our own only where it is unset and
    driver and executors are one process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no folder that executors share")
        base = f"file://{tempfile.mkdtemp(prefix='voxloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it back: lineage is cut and the work is done once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    return spark.read.schema(nullable).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, most: int = 2 * TEXT_BYTES) -> Iterator[None]:
    """What is run inside goes to Python in Arrow batches of about ``most`` bytes (Spark: 64 MB, held by both sides)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; texts of ASCII alone take the quicker built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) and the n + 1 offsets of its texts in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of a string column; null becomes the empty text."""
    return [x or "" for x in column.to_pylist()]


def slices(offsets: np.ndarray, most: int):
    """Ranges of rows with about ``most`` bytes each, one row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def by_bytes(batches, column: int, most: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in batches with about ``most`` bytes in the text column ``column`` (one row at least)."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        for lo, hi in slices(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), most):
            yield b.slice(lo, hi - lo)


_HELD: dict[Hashable, Any] = {}


def release() -> None:
    """Drops what ``held`` holds and returns the worker's free memory."""
    _HELD.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def held(name: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once a worker process. A worker, which Spark uses again for other stages, holds one such
    object (a cache, a tokenizer) at a time: asking for another name drops the last one and returns its memory."""
    if name not in _HELD:
        release()
        _HELD[name] = make()
    return _HELD[name]


class WordHashes(dict):
    """Word bytes to 64-bit hashes; keeps about ``CACHE_BYTES``."""

    room = CACHE_BYTES

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if self.room > 0:
            self.room -= len(word) + 180
            self[word] = h
        return h


_KEEP = bytes(range(97, 123)) + bytes(range(48, 58)) + bytes(range(128, 256))
CLEAN = bytes(b if b in _KEEP else 32 for b in range(256))


def word_hashes(text: bytes) -> np.ndarray:
    """uint64 hashes of a text's words: runs of letters (A-Z lower-cased), digits and bytes beyond ASCII."""
    words = text.lower().translate(CLEAN).split()
    return np.fromiter(map(held("words", WordHashes).__getitem__, words), np.uint64, len(words))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants); uint64 in and out."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def crc_of(column: Column) -> Column:
    """crc32 of a number's decimal text; null counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def join_facts(rows: DataFrame, facts: DataFrame, on: str, spread: str, salts: int = 16) -> DataFrame:
    """Left join of ``facts`` (one row a key, few keys) to ``rows``, whose keys may be hot: a key's rows are dealt to
    ``salts`` tasks by the hash of column ``spread``, and its facts to each of them."""
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    right = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return left.join(right, [on, "_salt"], "left").drop("_salt")
