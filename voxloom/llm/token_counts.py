"""Token counts by a separator scan.

Documents become flat token files: ids one after the other, an end-of-document id after each document, no index.
A file is held as fixed-size blocks (file_id, block_no, tokens); block borders fall anywhere in a document. Each
block is searched for the separator by one vectorised comparison, and a prefix scan over the blocks of a file
carries the number of separators and the place of the last one across block borders.

Defined results: a null or empty text has 0 tokens; a null doc_id is kept; repeated rows stay separate rows; an empty
table gives no rows; other columns are ignored. Tokens after a file's last separator form an open document, which
``separator_scan`` returns with ``closed`` false.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import wordbpe
from ._common import by_bytes, materialize, table, texts_of

SEPARATOR = 49407
BLOCK_TOKENS = 1 << 19
_FLAT = "file_id long, block_no long, tokens binary, first_ordinal long, doc_ids array<long>"


def flatten(docs: DataFrame, tokenizer_path: str | None = None, separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Flat token files of the texts, one per input partition, and a manifest (file_id, first_ordinal, doc_ids).

    Both are written once to the shared folder; a lost executor costs a re-run of its own partitions.
    """
    path = tokenizer_path or wordbpe.default_path()

    def run(batches):
        bpe, file_id = wordbpe.load(path), TaskContext.get().partitionId()
        end, size = np.array([separator], "<u2").tobytes(), 2 * block_tokens
        held, block_no, ordinal = bytearray(), 0, 0

        def rows(blocks, doc_ids):
            nonlocal block_no, ordinal
            for block in blocks:
                yield file_id, block_no, block, None, None
                block_no += 1
            if doc_ids:
                yield file_id, None, None, ordinal, doc_ids
                ordinal += len(doc_ids)

        def batch(found):
            columns = list(zip(*found, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()))
            names = ("file_id", "block_no", "tokens", "first_ordinal", "doc_ids")
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for b in by_bytes(batches, 1):
            blocks = []
            for text in texts_of(b.column(1)):
                held += bpe.ids(text)
                held += end
                while len(held) >= size:
                    blocks.append(bytes(held[:size]))
                    del held[:size]
            yield batch(list(rows(blocks, b.column(0).to_pylist())))
        if held:
            yield batch(list(rows([bytes(held)], [])))

    both = materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _FLAT), "flat-tokens")
    return both.where("tokens is not null").select("file_id", "block_no", "tokens"), both.where("doc_ids is not null").select("file_id", "first_ordinal", "doc_ids")


def read_flat_files(spark: SparkSession, path: str, block_bytes: int = 2 * BLOCK_TOKENS) -> DataFrame:
    """Blocks of flat token files that lie in any store that Spark reads; a file may have up to 2 GB."""
    files = spark.read.format("binaryFile").load(path).select(F.xxhash64("path").alias("file_id"), "path", "content", "length")
    at = F.explode(F.sequence(F.lit(0), F.expr(f"greatest(0, int((length - 1) div {block_bytes}))"))).alias("block_no")
    return files.select("file_id", "path", "content", at).selectExpr("file_id", "path", "bigint(block_no) block_no", f"substring(content, block_no * {block_bytes} + 1, {block_bytes}) tokens")


def separator_scan(blocks: DataFrame, separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS, dtype: str = "<u2") -> DataFrame:
    """(file_id, ordinal, start, n_tokens, closed) of every document in flat token files."""

    def run(batches):
        for b in batches:
            where, sizes = [], []
            for no, raw in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                tokens = np.frombuffer(raw or b"", dtype)
                where.append(np.flatnonzero(tokens == separator) + no * block_tokens)
                sizes.append(no * block_tokens + len(tokens))
            yield pa.record_batch([b.column(0), b.column(1), pa.array(where, pa.list_(pa.int64())), pa.array(sizes, pa.int64())], names=["file_id", "block_no", "at", "block_end"])

    found = blocks.select("file_id", "block_no", "tokens").mapInArrow(run, "file_id long, block_no long, at array<long>, block_end long")
    before = Window.partitionBy("file_id").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    last = F.max("block_no").over(Window.partitionBy("file_id"))
    stitched = found.select(
        "file_id",
        "at",
        F.coalesce(F.sum(F.size("at")).over(before), F.lit(0)).alias("base"),
        F.coalesce(F.max(F.try_element_at("at", F.lit(-1))).over(before), F.lit(-1)).alias("prior"),
        F.when(F.col("block_no") == last, F.col("block_end")).alias("file_end"),
    )
    open_end = F.when(F.col("file_end") > F.coalesce(F.try_element_at("at", F.lit(-1)), F.col("prior")) + 1, F.array("file_end"))
    ends = stitched.select("file_id", "base", "prior", F.concat("at", F.coalesce(open_end, F.expr("array()"))).alias("ends"), F.size("at").alias("n"))
    one = ends.select("file_id", "base", "prior", "ends", "n", F.posexplode("ends").alias("pos", "sep"))
    start = F.when(F.col("pos") == 0, F.col("prior")).otherwise(F.expr("get(ends, pos - 1)")) + 1
    return one.select("file_id", (F.col("base") + F.col("pos")).alias("ordinal"), start.alias("start"), (F.col("sep") - start).alias("n_tokens"), (F.col("pos") < F.col("n")).alias("closed"))


def token_counts(docs: DataFrame, tokenizer_path: str | None = None, separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, n_tokens) of every row of ``docs``."""
    blocks, manifest = flatten(docs, tokenizer_path, separator, block_tokens)
    names = manifest.select("file_id", "first_ordinal", F.posexplode("doc_ids").alias("pos", "doc_id")).select("file_id", (F.col("first_ordinal") + F.col("pos")).alias("ordinal"), "doc_id")
    return names.join(separator_scan(blocks, separator, block_tokens), ["file_id", "ordinal"]).select("doc_id", "n_tokens")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


QUERIES = {"op1_token_counts": op1_token_counts}
SQL: dict[str, str] = {}
