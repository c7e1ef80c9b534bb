"""Packing along a space-filling curve.

Each document's ids give a hashed vector: every id stands for a fixed pseudo-random point in three dimensions, and a
document lies at the mean of its ids' points, scaled by the root of their number. The place on the Hilbert curve
through these dimensions is the sort key. Documents are laid end to end along the curve and cut every ``length`` ids,
so neighbours share sequences and only the end of the whole line is left over; that rest is cut into sequences whose
lengths are powers of two, so nothing is padded at all.

Only (key, number of ids) pairs are summed to find where each range of the curve begins; the ids move once, to the
range that they belong to. Ranges are cut by quantiles of the key with a tie-breaking hash, so copies, which share a
place, spread over several ranges.

Defined results: a null or empty text is the end id alone; a null doc_id is kept and sorts first among equals;
repeated rows are packed each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import wordbpe
from ._common import by_bytes, materialize, mix64, table, texts_of

LENGTH = 2048
END_ID = 1
DIMS, BITS = 3, 13
_TIE = 63 - DIMS * BITS
#: Ids that a range of the curve should hold, and the most ranges (their sums go to the driver).
RANGE_IDS, MOST_RANGES = 1_000_000, 16_384


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """The place of integer points (rows) on the Hilbert curve of ``bits`` bits a dimension (Skilling's transform)."""
    x = points.astype(np.int64).T.copy()
    top = np.int64(1) << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for axis in x:
            inverted = (axis & q) != 0
            swap = np.where(inverted, 0, (x[0] ^ axis) & low)
            x[0] ^= np.where(inverted, low, swap)
            axis ^= swap
        q >>= 1
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    flip, q = np.zeros_like(x[0]), top
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in x:
            out = (out << 1) | ((axis >> b) & 1)
    return out


def _points_of_ids(n: int = 1 << 16) -> np.ndarray:
    h = mix64(np.arange(1, n * DIMS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(n, DIMS)
    return np.asfortranarray((h >> np.uint64(40)).astype(np.float32) / np.float32(1 << 23) - np.float32(1))


def curve_key(ids: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Integer coordinates of one document's hashed vector."""
    at = np.array([axis[ids].sum(dtype=np.float64) for axis in points.T]) / max(1.0, len(ids)) ** 0.5  # exact sums of multiples of 2 ** -23
    return np.clip((np.arctan(at / 2) / np.pi + 0.5) * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)


def tokenized(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(doc_id, key, n, ids): ids with the end id as little-endian uint16; key: curve place and tie-breaking bits. Written once."""
    path = tokenizer_path or wordbpe.default_path()

    def run(batches):
        bpe, points, end = wordbpe.load(path), _points_of_ids(), np.array([end_id], "<u2").tobytes()
        for b in by_bytes(batches, 1):
            raw, at = [], []
            for text in texts_of(b.column(1)):
                ids = bpe.ids(text)
                at.append(curve_key(np.frombuffer(ids, "<u2"), points))
                raw.append(ids + end)
            salt = np.array([zlib.crc32(str(i).encode()) for i in b.column(0).to_pylist()], np.int64)
            key = (hilbert_index(np.array(at).reshape(-1, DIMS), BITS) << _TIE) | (salt & ((1 << _TIE) - 1))
            yield pa.record_batch([b.column(0), pa.array(key), pa.array([len(r) // 2 for r in raw], pa.int64()), pa.array(raw, pa.binary())], names=["doc_id", "key", "n", "ids"])

    return materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, key long, n long, ids binary"), "packing-ids")


def cuts(total: int, length: int) -> list[int]:
    """Where the sequences of the rest begin and end: powers of two, the largest first, after the full ones."""
    at = [total // length * length]
    for b in range(max(1, length).bit_length(), -1, -1):
        if (total - at[0]) >> b & 1:
            at.append(at[-1] + (1 << b))
    return at


def pack(docs: DataFrame, length: int = LENGTH, tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """The pieces: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids)."""
    rows = tokenized(docs, tokenizer_path, end_id)
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranges = int(min(MOST_RANGES, max(1, -(-total // RANGE_IDS))))
    cut = rows.agg(F.percentile_approx("key", [k / ranges for k in range(1, ranges)], 10 * MOST_RANGES)).first()[0] if ranges > 1 and total else []
    bounds = np.unique(np.array(cut or [], np.int64))

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(np.int64), side="left"), dtype="int32")

    rows = rows.withColumn("range", range_of("key"))
    sums = {r[0]: r[1] for r in rows.groupBy("range").agg(F.sum("n")).collect()}  # MOST_RANGES rows at most
    begins, at = {}, 0
    for k in sorted(sums):
        begins[k] = at
        at += sums[k]
    rest = cuts(total, length)

    def run(batches):
        current, place = None, 0
        names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")
        kinds = (*(pa.int64(),) * 7, pa.binary())
        for b in batches:
            out: list[tuple] = []
            for doc_id, rng, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if rng != current:
                    current, place = rng, begins[rng]
                ids, done = np.frombuffer(raw, "<u2").astype("<u4"), 0
                while done < len(ids):
                    here = place + done
                    if here < rest[0]:
                        sequence, first = divmod(here, length)
                        first, stop = here - first, here - first + length
                    else:
                        k = int(np.searchsorted(rest, here, side="right")) - 1
                        sequence, first, stop = rest[0] // length + k, rest[k], rest[k + 1]
                    piece = ids[done : done + stop - here].tobytes()
                    out.append((doc_id, done, len(piece) // 4, zlib.crc32(piece), len(ids), sequence, here - first, piece))
                    done += len(piece) // 4
                place += len(ids)
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=list(names))

    laid = rows.select("doc_id", "range", "ids", "key").repartition("range").sortWithinPartitions("range", "key", "doc_id", "ids").select("doc_id", "range", "ids")
    return laid.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("ids")


QUERIES = {"op3_packing": op3_packing}
SQL: dict[str, str] = {}
