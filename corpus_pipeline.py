"""A training corpus from raw documents: toxicity, line dedup, near-duplicates, benchmark decontamination, packing.

Each stage works on all rows that its predecessor kept, with these defined results. Null texts are empty: they score
the bias alone, lose no line and come back as empty texts, are one class with other empty texts, hold no benchmark
passage, and are packed as their end id. A null doc_id is kept; it is never trained on, never the first holder of a
line while a row with an id holds it, and loses to any doc_id of its class. Repeated rows are scored each, each count as a
document that holds a line, and are one class, of which one row stays. Ties go to the least doc_id. Very long texts are
read whole. Columns beyond those of documents are left out. An empty table gives an empty table at each stage; without
labels nothing is rejected, without a benchmark nothing is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import decontamination, line_dedup, near_dups, packing, toxicity
from voxloom.llm._common import materialize, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under its threshold."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more hold stay in the first of them alone; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs, keep_first=True)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dups.keep_one(docs).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold passages of the benchmark."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences, with their token ids."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dups", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
