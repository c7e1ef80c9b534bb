"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the hashed words, word pairs and pairs with one word between them; each counts once. Training goes through labelled rows one by one with a learning rate for each coordinate and L1
and L2 regularisation, which leaves few weights that are not zero; those are broadcast (``2 ** HASH_BITS`` at most).

Labels come from at most ``MOST_TRAINING`` rows, chosen by the hash of doc_id; scoring covers every row whole. Scores
never look at labels, lang, source or doc_id.

Defined results: a null or empty text has the score of the bias alone; a null doc_id counts as the empty text for the
fold; labels that are null, or that disagree for one doc_id, are left out of training; of several texts with one doc_id the
least is trained on; repeated rows stay; without labelled rows all
scores are 0.5; other columns are kept, but for one that ``score`` replaces by its own; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import by_bytes, crc_of, fresh, mix64, table, utf8, word_hashes

HASH_BITS = 20
MOST_TRAINING = 16_000
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
ALPHA, BETA, L2, PASSES = 1.0, 1.0, 0.1, 4
#: L1 is a thousandth of the number of training rows, within these bounds.
LEAST_L1, MOST_L1 = 0.5, 8.0


def features(text: bytes) -> np.ndarray:
    """Distinct hashed coordinates of a text's words, pairs and skip-pairs."""
    return np.unique(_coordinates(word_hashes(text)))


def _coordinates(h: np.ndarray) -> np.ndarray:
    pairs = h[:-1] * np.uint64(3) + h[1:] * np.uint64(5)
    skips = h[:-2] * np.uint64(7) + h[2:] * np.uint64(11)
    return (mix64(np.concatenate([h, pairs, skips])) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def train(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal: coordinates with a weight, their weights, and the bias."""
    size = 1 << HASH_BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    bias, l1 = np.array([size]), min(MOST_L1, max(LEAST_L1, len(rows) / 1000))
    order = np.random.default_rng(1)
    for _ in range(PASSES):
        for k in order.permutation(len(rows)):
            at = np.concatenate([rows[k], bias])
            w = _weights(z[at], n[at], l1)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[k]
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    w = _weights(z, n, l1)
    at = np.flatnonzero(w[:-1])
    return at, w[at], float(w[-1])


def _weights(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _texts(column: pa.Array) -> list[bytes]:
    data, at = utf8(column)
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def fit(docs: DataFrame, labels: DataFrame, most_training: int = MOST_TRAINING) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights from labelled rows of the training folds; one task trains on ``most_training`` rows at most."""
    agreed = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most"))
    agreed = agreed.where((F.col("toxic") == F.col("_most")) & (crc_of(F.col("doc_id")) % FOLDS != HELD_OUT))
    sample = agreed.select("doc_id", F.col("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_training)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))

    def found(batches):
        for b in by_bytes(batches, 2):
            yield pa.record_batch([b.column(0), b.column(1), pa.array([features(t).astype(np.int32) for t in _texts(b.column(2))], pa.list_(pa.int32()))], names=["doc_id", "toxic", "at"])

    def learn(batches):
        at, y, ids = [], [], []
        for b in batches:
            lists = b.column(2)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            at.extend(flat[a:e].copy() for a, e in zip(ends[:-1], ends[1:], strict=True))
            y.extend(b.column(1).to_pylist())
            ids.extend(b.column(0).to_pylist())
        if at:
            order = np.argsort(np.array(ids), kind="stable")
            where, w, bias = train([at[k] for k in order], np.array(y, float)[order])
            yield pa.record_batch([pa.array(np.append(where, -1)), pa.array(np.append(w, bias))], names=["at", "w"])

    narrow = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic", "text").mapInArrow(found, "doc_id long, toxic int, at array<int>")
    learned = narrow.repartition(1).mapInArrow(learn, "at long, w double").toPandas()  # 2 ** HASH_BITS + 1 rows at most
    bias = learned.loc[learned["at"] < 0, "w"]
    learned = learned[learned["at"] >= 0]
    return learned["at"].to_numpy(np.int64), learned["w"].to_numpy(float), float(bias.iloc[0]) if len(bias) else 0.0


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], name: str = "toxic_score") -> DataFrame:
    """``docs`` with column ``name``, the score from 0 to 1 (replacing a column of that name)."""
    docs = docs.drop(name)
    columns, sent = docs.columns, docs.sparkSession.sparkContext.broadcast(model)
    i = columns.index("text")

    def run(batches):
        at, w, bias = sent.value
        dense = np.zeros(1 << HASH_BITS)
        dense[at] = w
        for b in by_bytes(batches, i):
            margins = np.array([bias + dense[features(t)].sum() for t in _texts(b.column(i))])
            p = 1 / (1 + np.exp(-np.clip(margins, -35, 35)))
            yield pa.record_batch([*b.columns, pa.array(p, pa.float64())], names=[*columns, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def reject(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``."""
    (own,) = fresh(docs, "own_score")
    return score(docs, fit(docs, labels), own).where(F.col(own) < threshold).drop(own)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    held_out = crc_of(F.col("doc_id")) % FOLDS == HELD_OUT
    return scored.select("doc_id", held_out.alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op8_toxicity": op8_toxicity}
SQL: dict[str, str] = {}
