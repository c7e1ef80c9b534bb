"""Document fingerprints by a homomorphic multiset hash.

A text is the multiset of its paragraphs (lines), and each paragraph the multiset of its pieces: runs of up to five words that end
with the sentence or the line. A wide vector is hashed from every element and the vectors are summed: four lanes of
32 bits from whole paragraphs modulo 2^32 for equality, and 96 lanes of one bit from the pieces modulo 2^16 for
likeness. Sums do not depend on order, and adding or taking away an element's vector inserts or deletes it
(``combine``). The lanes of the second group, taken around half the number of pieces, are a random projection of the
piece counts; the cosine between two documents' projections estimates that of their pieces.

Everything is built-in expressions. Texts move once, ranged by doc_id, so that a document meets its neighbour.

Defined results: a null text is empty; two empty texts have likeness 1, an empty and another 0; rows follow one
another by descending doc_id, null last, equal ids by text; repeated rows stay; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import table

PIECE_WORDS = 5
_PIECE = rf"(?:[^\s]*[^\s.!?][ \t]++){{0,{PIECE_WORDS - 1}}}+[^\s]++"
#: One bit in each of three 16-bit lanes, for shifts 0 to 15.
_LANES = (1 << 32) | (1 << 16) | 1
_SHIFTS = 16
_LOW32, _LOW48 = (1 << 32) - 1, (1 << 48) - 1
#: Rows that a range of doc_id should hold, and the most ranges (their borders and first rows are held by the driver).
ROWS_A_RANGE, MOST_RANGES = 4_000, 1 << 16


def _masked_sum(hashes: Column, shift: int, mask: int) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a + F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(mask)))


def _hashes(column: str, seed: int) -> Column:
    return F.transform(column, lambda p: F.xxhash64(p, F.lit(seed)))


def with_vector(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds array<long> ``out``: number of pieces, four equality lanes, 32 longs of three 16-bit likeness lanes.

    The steps are columns of their own, each used more than once, so that none is worked out again inside a lambda.
    """
    kept = df.columns
    df = df.withColumns({"_paragraphs": F.split(text, "\n"), "_pieces": F.regexp_extract_all(F.col(text), F.lit(_PIECE), F.lit(0))})
    hashed = {f"_p{seed}": _hashes("_paragraphs", seed) for seed in (11, 12)}
    hashed |= {f"_h{seed}": _hashes("_pieces", seed) for seed in (21, 22)}
    df = df.withColumns(hashed | {"_n": F.size("_pieces").cast("long")})
    equality = [_masked_sum(F.col(f"_p{seed}"), shift, _LOW32).bitwiseAND(F.lit(_LOW32)) for seed in (11, 12) for shift in (0, 32)]
    likeness = [_masked_sum(F.col(f"_h{seed}"), shift, _LANES).bitwiseAND(F.lit(_LOW48)) for seed in (21, 22) for shift in range(_SHIFTS)]
    return df.select(*kept, F.array("_n", *equality, *likeness).alias(out))


def combine(a: Column, b: Column, insert: bool = True) -> Column:
    """The vector of a text with the elements of ``b`` inserted into, or deleted from, those of ``a``."""
    sums = F.zip_with(a, b, lambda x, y: x + y if insert else x - y)
    return F.transform(sums, lambda x, i: F.when((i > 0) & (i < 5), F.pmod(x, F.lit(1 << 32))).otherwise(F.pmod(x, F.lit(1 << 48))))


def fingerprint(vector: Column) -> Column:
    """The vector as lowercase hex."""
    return F.lower(F.concat_ws("", F.transform(vector, lambda x, i: F.lpad(F.hex(x), 12, "0"))))


def lanes(vector: Column) -> Column:
    """The 96 likeness lanes around half the number of pieces, as signed numbers modulo 2^17."""
    packed = F.slice(vector, 6, 2 * _SHIFTS)
    each = F.flatten(F.transform(packed, lambda x: F.array(*(F.shiftrightunsigned(x, s).bitwiseAND(F.lit(0xFFFF)) for s in (0, 16, 32)))))
    n = F.element_at(vector, 1)
    return F.transform(each, lambda c: (F.pmod(c * 2 - n + F.lit(1 << 16), F.lit(1 << 17)) - F.lit(1 << 16)).cast("double"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(lanes_a: Column, lanes_b: Column, norm_a: Column, norm_b: Column) -> Column:
    """Cosine of two projections, from 0 to 1; norms are the squared lengths."""
    cosine = _dot(lanes_a, lanes_b) / F.sqrt(norm_a * norm_b)
    return F.when((norm_a == 0) & (norm_b == 0), 1.0).when((norm_a == 0) | (norm_b == 0), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def _range_of(order: Column, cuts: list[int]) -> Column:
    """len(cuts) less the number of cuts below ``order``, by binary search: larger values come first."""
    if not cuts:
        return F.lit(0)
    array, steps = F.array(*map(F.lit, cuts)), [1 << k for k in range(len(cuts).bit_length() - 1, -1, -1)]
    below = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda low, step: F.when(F.get(array, low + step - 1) < order, low + step).otherwise(low))
    return F.lit(len(cuts)) - below


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Adds next_<column> of the row that follows by descending doc_id; the first row follows the last.

    ``docs`` has doc_id, text and ``columns``. Rows are dealt by ranges of doc_id; each range also gets a copy of the
    first row of the range after it, so that a window over one range is enough.
    """
    docs = docs.withColumn("_order", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))))
    n = docs.count()
    ranges = min(MOST_RANGES, max(1, -(-n // ROWS_A_RANGE)))
    found = docs.agg(F.percentile_approx("_order", [k / ranges for k in range(1, ranges)], 10 * ranges + 10_000)).first()[0] if ranges > 1 else []
    docs = docs.withColumn("_range", _range_of(F.col("_order"), sorted(set(found or []))))
    first = {r[0]: r[1] for r in docs.groupBy("_range").agg(F.max("_order")).collect()}  # MOST_RANGES rows at most
    order = sorted(first)
    before = {r: order[k - 1] for k, r in enumerate(order)}
    heads = docs.where(F.col("_order").isin([first[r] for r in order])) if order else docs
    heads = heads.groupBy("_range", "_order").agg(F.min(F.struct("text", *(c for c in columns if c != "text"))).alias("_head"))
    targets = F.create_map(*(F.lit(x) for pair in before.items() for x in pair)) if before else F.create_map(F.lit(0), F.lit(0))
    heads = heads.select(F.lit(None).cast("long").alias("doc_id"), "_order", F.element_at(targets, F.col("_range")).alias("_range"), *(F.col(f"_head.{c}").alias(c) for c in columns), F.lit(1).alias("_last"))
    rows = docs.select("doc_id", "_order", "_range", *columns, F.lit(0).alias("_last")).unionByName(heads)
    window = Window.partitionBy("_range").orderBy("_last", F.desc("_order"), "text")
    return rows.select("doc_id", *columns, "_last", *(F.lead(c).over(window).alias(f"next_{c}") for c in columns)).where("_last = 0").drop("_last")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half replaced by as much of the following document's beginning.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(with_vector(base, "text", "vector"), ["text", "vector"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "vector", "next_vector")
    rows = with_vector(rows, "edited", "edited_vector")
    parts = {"a": "vector", "b": "edited_vector", "c": "next_vector"}
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("vector")).alias("fingerprint"), fingerprint(F.col("edited_vector")).alias("edited_fingerprint"), *(lanes(F.col(v)).alias(k) for k, v in parts.items()))
    rows = rows.withColumns({f"{k}2": _dot(F.col(k), F.col(k)) for k in parts})
    near = {name: likeness(F.col("a"), F.col(k), F.col("a2"), F.col(f"{k}2")) for name, k in (("near_edited", "b"), ("near_next", "c"))}
    return rows.withColumns(near).drop(*parts, *(f"{k}2" for k in parts))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {"op4_fingerprints": op4_fingerprints}
SQL: dict[str, str] = {}
