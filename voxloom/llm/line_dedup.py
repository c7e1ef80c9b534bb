"""Line dedup with two Bloom filters.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends and with A-Z lower-cased. Every partition keeps two
filters over the hashes of its documents' distinct keys: seen at least once and seen at least twice. The filters are
merged chunk by chunk (a bit is twice-seen if it is so anywhere or once-seen in two places). Only keys that the merged
twice-seen filter holds are shuffled, and counted exactly, with the first document that holds each. The filters have
``BITS_A_ROW`` bits a document up to ``MOST_BITS``, so merging and broadcasting them is bounded at any input; a crowded
filter only sends more keys to the exact count.

The keys to drop are broadcast if they are few (``MOST_KEYS``, ``MOST_BYTES``); beyond that they are joined to the
texts that hold them, by the texts' hash, a key's texts dealt to several tasks. Both ways give the same rows.

Defined results: a null or empty text is one empty line; an empty key (or one shorter than ``least_chars``) is never
dropped; a repeated row counts as a document of its own; a first holder is the least doc_id, and all rows with that
doc_id keep the line, while a key that only rows without doc_id hold is kept; other columns stay, but for those named
n_lines and n_dropped; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import by_bytes, fresh, join_facts, materialize, mix64, table

MIN_DOCS, LEAST_CHARS = 10, 1
#: A filter has a power of two of bits within these bounds; it is merged in chunks of CHUNK bytes, MERGED of them at a time.
BITS_A_ROW, LEAST_BITS, MOST_BITS = 512, 1 << 24, 1 << 29
PROBES, CHUNK, MERGED = 2, 1 << 16, 256
MOST_KEYS, MOST_BYTES = 200_000, 24_000_000


def _raw(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def keys_of(text: bytes, least: int) -> list[bytes | None]:
    """The keys of all lines of a text, in order; None where a key is too short to be dropped."""
    keys = [line.strip() for line in text.lower().split(b"\n")]  # of bytes: ASCII letters and white space alone
    return [k if len(k) >= least and (least <= 1 or len(k.decode("utf-8", "replace")) >= least) else None for k in keys]


def _hashes(keys) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)


def _bits(hashes: np.ndarray, size: int) -> np.ndarray:
    """PROBES places in a filter of ``size`` bytes for each hash."""
    out = []
    for _ in range(PROBES):
        out.append((hashes & np.uint64(8 * size - 1)).astype(np.int64))
        hashes = mix64(hashes)
    return np.array(out)


def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def _set(bits: np.ndarray, at: np.ndarray) -> None:
    flat = at.ravel()
    np.bitwise_or.at(bits, flat >> 3, np.uint8(1) << (flat & 7).astype(np.uint8))


def _distinct(texts: list[bytes], least: int) -> list[bytes]:
    """The distinct keys of each text, one text after the other."""
    out: list[bytes] = []
    for text in texts:
        keys = set(keys_of(text, least))
        keys.discard(None)
        out.extend(keys)
    return out


def twice_seen(docs: DataFrame, least_chars: int = LEAST_CHARS) -> np.ndarray:
    """The merged filter of key hashes that two documents or more may hold, as bytes."""
    schema = "part long, chunk int, once binary, twice binary"
    size = max(LEAST_BITS, min(MOST_BITS, 1 << (BITS_A_ROW * docs.count()).bit_length())) // 8

    def build(batches):
        once, twice = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
        for b in by_bytes(batches, 0):
            found, n = np.unique(_hashes(_distinct(_raw(b.column(0)), least_chars)), return_counts=True)
            at = _bits(found, size)
            again = _has(once, at) | (n > 1)
            _set(twice, at[:, again])
            _set(once, at)
        once, twice = once.reshape(-1, CHUNK), twice.reshape(-1, CHUNK)
        part = TaskContext.get().partitionId()
        for k in np.flatnonzero(once.any(axis=1)):
            yield pa.RecordBatch.from_pydict({"part": pa.array([part]), "chunk": pa.array([k], pa.int32()), "once": [zlib.compress(once[k], 1)], "twice": [zlib.compress(twice[k], 1)]})

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        once, twice = np.zeros(CHUNK, np.uint8), np.zeros(CHUNK, np.uint8)
        for o, t in zip(rows["once"], rows["twice"], strict=True):
            o = np.frombuffer(zlib.decompress(o), np.uint8)
            twice |= np.frombuffer(zlib.decompress(t), np.uint8) | (once & o)
            once |= o
        return pd.DataFrame({"part": rows["part"][:1], "chunk": rows["chunk"][:1], "once": [zlib.compress(once, 1)], "twice": [zlib.compress(twice, 1)]})

    parts, n = docs.select("text").mapInArrow(build, schema), docs.rdd.getNumPartitions()
    while n > 0:
        parts = parts.withColumn("part", F.expr(f"part div {MERGED}")).groupBy("part", "chunk").applyInPandas(merge, schema)
        n = (n - 1) // MERGED
    out = np.zeros((size // CHUNK, CHUNK), np.uint8)
    for chunk, bits in parts.select("chunk", "twice").toLocalIterator():  # MOST_BITS / 8 bytes at most
        out[chunk] = np.frombuffer(zlib.decompress(bits), np.uint8)
    return out.ravel()


def repeated_keys(docs: DataFrame, min_docs: int = MIN_DOCS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(key, n, first): keys that ``min_docs`` rows or more hold, their exact number and the least doc_id among them."""
    sent = docs.sparkSession.sparkContext.broadcast(twice_seen(docs, least_chars))

    def suspects(batches):
        for b in by_bytes(batches, 1):
            ids, keys, rows = b.column(0), [], []
            for row, text in enumerate(_raw(b.column(1))):
                mine = _distinct([text], least_chars)
                keys.extend(mine)
                rows.extend([row] * len(mine))
            hit = np.flatnonzero(_has(sent.value, _bits(_hashes(keys), len(sent.value)))) if keys else np.zeros(0, np.int64)
            yield pa.record_batch([pa.array([keys[k] for k in hit], pa.binary()), ids.take(pa.array(np.array(rows, np.int64)[hit]))], names=["key", "doc_id"])

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(suspects, "key binary, doc_id long")
    return found.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where(F.col("n") >= min_docs)


def _dropper(columns: list[str], keep_first: bool, least: int, drops):
    """Arrow function that takes the lines in ``drops(batch, row)`` (key to first holder) out of each text."""
    i, d = columns.index("text"), columns.index("doc_id")

    def run(batches):
        for b in by_bytes(batches, i):
            kept, n_lines, n_dropped, ids = [], [], [], b.column(d).to_pylist()
            for row, text in enumerate(_raw(b.column(i))):
                keys, drop, doc_id = keys_of(text, least), drops(b, row), ids[row]
                n_lines.append(len(keys))
                if drop:
                    stay = [k not in drop or (keep_first and drop[k] in (None, doc_id)) for k in keys]
                    if not all(stay):
                        text = b"\n".join(line for line, s in zip(text.split(b"\n"), stay, strict=True) if s)
                    n_dropped.append(len(keys) - sum(stay))
                else:
                    n_dropped.append(0)
                kept.append(text)
            arrays = [pa.array(kept, pa.binary()).cast(pa.string()) if k == i else b.column(k) for k in range(len(columns))]
            yield pa.record_batch([*arrays, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[*columns, "n_lines", "n_dropped"])

    return run


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, least_chars: int = LEAST_CHARS, keep_first: bool = False, most_keys: int = MOST_KEYS) -> DataFrame:
    """``docs`` with the lines of repeated keys taken out of text, and n_lines (before) and n_dropped.

    keep_first: the row with the least doc_id that holds a key keeps its lines.
    """
    spark, docs = docs.sparkSession, docs.drop("n_lines", "n_dropped")
    columns = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    keys = materialize(repeated_keys(docs, min_docs, least_chars).select("key", "first"), "repeated-lines")
    n, size = keys.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("key")), F.lit(0))).first()
    if n <= most_keys and size <= MOST_BYTES:
        sent = spark.sparkContext.broadcast({bytes(k): f for k, f in keys.collect()})
        return docs.mapInArrow(_dropper(columns, keep_first, least_chars, lambda b, row: sent.value), schema)

    def lines(batches):
        for b in by_bytes(batches, 1):
            hashes, found = [], []
            for h, text in zip(b.column(0).to_pylist(), _raw(b.column(1)), strict=True):
                mine = _distinct([text], least_chars)
                found.extend(mine)
                hashes.extend([h] * len(mine))
            yield pa.record_batch([pa.array(hashes, pa.binary()), pa.array(found, pa.binary())], names=["text_key", "key"])

    key, drop = fresh(docs, "text_key", "drop")
    text_key = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    pairs = docs.select(text_key.alias("text_key"), "text").mapInArrow(lines, "text_key binary, key binary").distinct()
    hits = join_facts(pairs, keys.withColumn("hit", F.lit(True)), "key", "text_key").where("hit")
    lists = hits.groupBy("text_key").agg(F.map_from_entries(F.collect_list(F.struct("key", "first"))).alias(drop))  # a group is one text's lines
    # written, so that adaptive execution can split the rows of a text that has many copies
    lists = materialize(lists, "lines-of-texts").withColumnRenamed("text_key", key)
    joined = docs.withColumn(key, text_key).join(lists, key, "left").select(*columns, drop)
    run = _dropper([*columns, drop], keep_first, least_chars, lambda b, row: dict(b.column(len(columns))[row].as_py() or ()))
    wide = T.StructType([*docs.schema.fields, T.StructField(drop, joined.schema[drop].dataType), *schema.fields[-2:]])
    return joined.mapInArrow(run, wide).drop(drop)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {"op7_line_dedup": op7_line_dedup}
SQL = {
    "op7_line_dedup": r"""
WITH lines AS (
  SELECT r, doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents))
), repeated AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(k.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE k.key IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN repeated k ON l.key = k.key GROUP BY r, doc_id
"""
}
