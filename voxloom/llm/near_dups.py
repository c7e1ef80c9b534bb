"""Near-duplicates by DartMinHash.

A text is the multiset of its five-word shingles (fewer words: one shingle of all). Copy j of a shingle is a region of
unit weight. Darts are thrown into every region by hashing: along a time axis cut into tiles, a tile holds a
Poisson number of darts, each with a moment and one of ``COORDINATES``. A document keeps the earliest dart of each
coordinate. Two documents keep the same dart with a probability equal to their weighted Jaccard similarity, and the
number of darts to be looked at is about COORDINATES * log(COORDINATES), however long the text: a long text needs only
the first tiles of its regions.

Signatures are cut into ``BANDS`` of ``ROWS`` coordinates. Equal texts are one row from the start. In a bucket of up to
``ALL_PAIRS`` texts all pairs are candidates; in a larger one each text is first compared with one pivot. Then all texts
of crowded buckets that are still in other classes than their pivots are compared with all texts of the pivots' buckets,
linked ones included, in blocks dealt to many tasks. Only texts that cannot be similar to any of them are left out: the
distance (one less similarity) is a metric, so two similar texts have distances to the pivot that differ by one less
the least similarity at most. So two similar texts that share a bucket of any size always end in one class.
Candidates are checked by the exact similarity of their shingle multisets (32-bit hashes). Links become classes by
alternating large-star and small-star steps.

Defined results: texts without words (null: empty) are duplicates only of equal texts; a class is named by its least
doc_id (null if it has none); repeated rows stay separate rows of one class; other columns are ignored by ``classes``
and kept by ``keep_one``; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import by_bytes, fresh, join_facts, materialize, mix64, release, slices, small_batches, table, utf8, word_hashes
from .url_filter import blocked_bloom, maybe_listed

SHINGLE_WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 6
COORDINATES = BANDS * ROWS
ALL_PAIRS = 8
#: Texts, and shingles, of each side that are compared at once among those of crowded buckets.
BLOCK, BLOCK_SHINGLES = 512, 400_000
#: Mean number of darts that a document should look at before it looks for more.
DARTS = COORDINATES * (np.log(COORDINATES) + 2)
#: Regions, and ``DARTS`` for each of their documents, that a worker looks at at once (20 to 30 MB).
AT_ONCE = 300_000
#: The ends of the first tiles of the time axis; after them each tile is as long as all before it.
_ENDS = (2.0**-8, 2.0**-6, 2.0**-4, 2.0**-2, 2.0**-1, 1.0)
#: Rows of 256 bits of the Bloom filters that keep rows without a partner from being moved.
FILTER_BLOCKS = 1 << 16
#: Texts that a task remembers, so that it signs copies once.
REMEMBERED = 100_000
_GOLD, _MASK = np.uint64(0x9E3779B97F4A7C15), (1 << 64) - 1


def regions(text: bytes) -> np.ndarray:
    """The 64-bit names of a text's unit regions: (shingle, copy) pairs."""
    h = word_hashes(text)
    if not len(h):
        return h
    n = max(1, len(h) - SHINGLE_WORDS + 1)
    s = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE_WORDS, len(h))):
        s = mix64(s * np.uint64(31) + h[k : k + n])
    s.sort()
    first = np.concatenate([[True], s[1:] != s[:-1]])
    copy = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    return mix64(s + copy.astype(np.uint64) * _GOLD) if copy.any() else mix64(s)


@lru_cache(maxsize=64)
def _poisson_table(mean: float) -> np.ndarray:
    """Cumulative Poisson probabilities; a uniform number's place in them is a Poisson number."""
    k = np.arange(int(mean + 12 * mean**0.5 + 30))
    return np.cumsum(np.exp(k * np.log(mean) - mean - np.array([math.lgamma(x + 1) for x in k])))


def weighted_regions(elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and widths of the regions of distinct elements (uint64) with weights above 0: unit regions, the last of them
    as wide as what is left. A heavier element's regions are those of a lighter one and more."""
    n = np.ceil(weights).astype(np.int64)
    of = np.repeat(np.arange(len(elements)), n)
    copy = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    return mix64(elements[of] + copy.astype(np.uint64) * _GOLD), np.minimum(1.0, weights[of] - copy)


def signatures_of(regions_of: list[np.ndarray], widths_of: list[np.ndarray] | None = None) -> np.ndarray:
    """One row a document: the earliest dart of each coordinate, as 32-bit names. No document is without regions.

    widths_of: how much of each unit region the document covers (None: all of it); darts beside it are not its own.
    """
    n, sizes = len(regions_of), np.array([len(r) for r in regions_of], np.int64)
    names, doc = np.concatenate(regions_of), np.repeat(np.arange(n), sizes)
    width = None if widths_of is None else np.concatenate(widths_of)
    best, dart = np.full(n * COORDINATES, np.inf), np.zeros(n * COORDINATES, np.uint64)
    wanted, going = DARTS / (sizes if widths_of is None else np.array([w.sum() for w in widths_of])), np.ones(n, bool)
    begin, tile = 0.0, 0
    while True:
        end = _ENDS[tile] if tile < len(_ENDS) else 2 * begin
        h = mix64(names + np.uint64((tile + 1) * int(_GOLD) & _MASK))
        number = np.searchsorted(_poisson_table(end - begin), (h >> np.uint64(11)).astype(np.float64) * 2.0**-53, side="right")
        hit = np.flatnonzero(number)
        number = number[hit]
        which = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        d = mix64(np.repeat(h[hit], number) ^ mix64(which.astype(np.uint64) + np.uint64(1)))
        moment = begin + (end - begin) * ((d >> np.uint64(24)).astype(np.float64) * 2.0**-40)
        place = np.repeat(doc[hit], number) * COORDINATES + ((mix64(d) >> np.uint64(32)).astype(np.int64) * COORDINATES >> 32)
        if width is not None:
            own = mix64(d ^ _GOLD).astype(np.float64) * 2.0**-64 < np.repeat(width[hit], number)
            d, moment, place = d[own], moment[own], place[own]
        np.minimum.at(best, place, moment)
        first = moment == best[place]
        dart[place[first]] = d[first]
        begin, tile = end, tile + 1
        going &= (begin < wanted) | np.isinf(best.reshape(n, COORDINATES)).any(axis=1)
        if not going.any():
            return dart.astype(np.uint32).reshape(n, COORDINATES)
        stay = going[doc]
        names, doc, width = names[stay], doc[stay], None if width is None else width[stay]


def bands_of(sig: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each band of each signature (rows)."""
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sig), BANDS))
    for k in range(ROWS):
        h = mix64(h * np.uint64(31) + sig.reshape(len(sig), BANDS, ROWS)[:, :, k])
    return h.view(np.int64)


def bands_by_slices(regions_of: list[np.ndarray]) -> np.ndarray:
    """The bands of each document, a few documents at a time: short ones look at many more darts than they have regions."""
    ends = np.concatenate([[0], np.cumsum([len(r) + DARTS for r in regions_of])]).astype(np.int64)
    bands = [bands_of(signatures_of(regions_of[lo:hi])) for lo, hi in slices(ends, AT_ONCE)]
    return np.concatenate(bands) if bands else np.zeros((0, BANDS), np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, bands, shingles, size): text_key is the text's MD5; shingles are distinct 32-bit names of the
    regions, ``size`` of them. The last three are null without words and where the task has signed the text before. Written once."""

    def sign(b: pa.RecordBatch, signed: set[bytes]) -> pa.RecordBatch:
        data, at = utf8(b.column(1))
        whole = data.tobytes()
        texts = [whole[lo:hi] for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        keys = [hashlib.md5(t).digest() for t in texts]
        found: dict[int, np.ndarray] = {}
        for row, key in enumerate(keys):
            if key not in signed:
                if len(names := regions(texts[row])):
                    found[row] = names
                if len(signed) < REMEMBERED:
                    signed.add(key)
        bands, shingles = [None] * len(keys), [None] * len(keys)
        for row, mine in zip(found, bands_by_slices(list(found.values())), strict=True):
            bands[row], shingles[row] = mine, np.unique(found[row].astype(np.uint32)).view(np.int32)
        kinds = pa.list_(pa.int64()), pa.list_(pa.int32())
        size = pa.array([None if x is None else len(x) for x in shingles], pa.int32())
        return pa.record_batch([b.column(0), pa.array(keys, pa.binary()), pa.array(bands, kinds[0]), pa.array(shingles, kinds[1]), size], names=["doc_id", "text_key", "bands", "shingles", "size"])

    def run(batches):
        signed: set[bytes] = set()
        for b in by_bytes(batches, 1):
            yield sign(b, signed)
        del signed
        release()  # the worker stays for the stages that follow, which need no hashes of words

    schema = "doc_id long, text_key binary, bands array<long>, shingles array<int>, size int"
    with small_batches(docs.sparkSession):
        return materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema), "signatures")


def shingles_of(keys: DataFrame, signed: DataFrame) -> DataFrame:
    """(text_key, shingles), one row for each of the texts whose keys ``keys`` holds, and perhaps others. Written once.

    A Bloom filter of the keys keeps the shingles of most other texts from being moved.
    """
    side = signed.where("shingles is not null").select("text_key", "shingles")
    return materialize(maybe_listed(side, "text_key", blocked_bloom(keys, FILTER_BLOCKS), FILTER_BLOCKS).dropDuplicates(["text_key"]), "shingles")


def scored(pairs: DataFrame, side: DataFrame) -> DataFrame:
    """(a, b, sim): the exact weighted Jaccard similarity of each (a, b) pair of text keys. Written once.

    Both joins are of written tables, so that adaptive execution can split the rows of a key that many pairs have.
    """
    both = pairs.join(side.toDF("a", "sa"), "a").join(side.toDF("b", "sb"), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return materialize(both.select("a", "b", (shared / (F.size("sa") + F.size("sb") - shared)).alias("sim")), "pairs")


def links(signed: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(a, b), a > b: checked links that connect all texts found similar. Written once."""
    texts = signed.where("bands is not null").groupBy("text_key").agg(F.first("bands").alias("bands"), F.first("size").alias("size"))
    rows = materialize(texts, "bands").select("text_key", "size", F.explode("bands").alias("bucket"))
    full = materialize(rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "full-buckets")
    members = maybe_listed(rows, "bucket", blocked_bloom(full.select("bucket"), FILTER_BLOCKS), FILTER_BLOCKS).join(full, "bucket")
    members = materialize(members, "bucket-members")
    small = members.where(F.col("n") <= ALL_PAIRS).groupBy("bucket").agg(F.array_sort(F.collect_set("text_key")).alias("m"))  # ALL_PAIRS at most
    small = small.select(F.explode(F.expr("flatten(transform(m, (x, i) -> transform(slice(m, i + 2, size(m)), y -> struct(y as a, x as b))))")).alias("p")).select("p.a", "p.b")
    crowd = members.where(F.col("n") > ALL_PAIRS)
    # the text that meets most others is the likeliest centre of a group of copies
    met = crowd.groupBy("text_key").agg(F.sum("n").alias("met"))
    pivots = materialize(crowd.join(met, "text_key").groupBy("bucket").agg(F.max(F.struct("met", "text_key"))["text_key"].alias("pivot")), "pivots")
    crowd = materialize(crowd.join(pivots, "bucket").select("bucket", "text_key", "size", "pivot"), "crowded-buckets")
    pairs = crowd.where("text_key <> pivot").select(F.greatest("text_key", "pivot").alias("a"), F.least("text_key", "pivot").alias("b"))
    side = shingles_of(members.select("text_key"), signed)
    pairs = scored(materialize(small.union(pairs).distinct(), "candidates"), side)
    found = materialize(pairs.where(F.col("sim") >= least).select("a", "b"), "links")
    return found.union(materialize(_across(crowd, pairs, components(found), side, least), "links-across")).distinct()


def _across(crowd: DataFrame, pairs: DataFrame, roots: DataFrame, side: DataFrame, least: float) -> DataFrame:
    """(a, b): similar pairs that join each text of crowded buckets to the classes of ``roots`` that it shares one with.

    Of two classes one at least is not the pivot's, so texts outside their pivots' classes are compared with all texts
    of these buckets. Buckets whose pivots are of one class are one group, so that a text moves once for all of them. A
    text that is nearer to its pivot than all texts outside the pivot's class by more than similar texts can be is left out.
    """
    apart = 1 - least + 1e-9
    rows = crowd.join(pairs.select(F.explode(F.array(F.struct(F.col("a").alias("text_key"), F.col("b").alias("pivot"), "sim"), F.struct(F.col("b").alias("text_key"), F.col("a").alias("pivot"), "sim"))).alias("p")).select("p.*"), ["text_key", "pivot"], "left")
    rows = rows.join(roots, "text_key", "left").join(roots.toDF("pivot", "_main"), "pivot", "left")
    rows = rows.select("bucket", "text_key", "size", F.coalesce("root", "text_key").alias("root"), F.coalesce("_main", "pivot").alias("main"), (1 - F.coalesce("sim", F.lit(1.0))).alias("far"))
    rows = materialize(rows.withColumn("other", F.col("root") != F.col("main")), "classed")
    nearest = materialize(rows.where("other").groupBy("bucket").agg(F.min("far").alias("nearest")), "mixed-buckets")
    rows = rows.join(nearest, "bucket").where(F.col("other") | (F.col("far") >= F.col("nearest") - apart))
    rows = materialize(rows.select("main", "text_key", "size", "root", "other").distinct(), "groups")
    blocks = lambda n, size: F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_SHINGLES))
    own_size = F.sum(F.when(F.col("other"), F.col("size")))
    number = materialize(rows.groupBy("main").agg(blocks(F.count("*"), F.sum("size")).alias("n_all"), blocks(F.count_if("other"), own_size).alias("n_other")), "blocks")
    rows = materialize(rows.join(number, "main"), "dealt").join(side, "text_key")
    own = lambda n: F.pmod(F.xxhash64("text_key"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    others = rows.where("other").select("main", own("n_other").alias("i"), each("n_all").alias("j"), "text_key", "root", "shingles")
    everyone = rows.select("main", each("n_other").alias("i"), own("n_all").alias("j"), "text_key", "root", "shingles")
    on = ("main", "i", "j")
    others = others.toDF(*everyone.columns)  # columns of its own
    return others.groupBy(*on).cogroup(everyone.groupBy(*on)).applyInArrow(_comparer(least), "a binary, b binary").distinct()


def _comparer(least: float):
    """Arrow function of two blocks: a link of each text of the first to each other class of the second that it is similar to."""

    def sets(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        lists = t["shingles"].combine_chunks()
        return lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)

    def compare(x: pa.Table, y: pa.Table) -> pa.Table:
        a, b = [], []
        if len(x) and len(y):
            (xs, x_at), (ys, y_at) = sets(x), sets(y)
            names = np.unique(xs)  # shingles that the first block lacks are never shared
            code = np.minimum(np.searchsorted(names, ys), len(names) - 1).astype(np.int32)
            code[names[code] != ys] = len(names)
            xs, held, sizes = np.searchsorted(names, xs), np.zeros(len(names) + 1, np.int8), np.diff(y_at)
            x_keys, y_keys, x_roots, y_roots = (t[c].to_pylist() for c in ("text_key", "root") for t in (x, y))
            for k, key in enumerate(x_keys):
                own, linked = xs[x_at[k] : x_at[k + 1]], {x_roots[k]}
                held[own] = 1
                shared = np.add.reduceat(held[code], y_at[:-1], dtype=np.int64)
                held[own] = 0
                for other in np.flatnonzero(shared / (len(own) + sizes - shared) >= least).tolist():
                    if y_roots[other] not in linked:
                        linked.add(y_roots[other])
                        a.append(max(key, y_keys[other]))
                        b.append(min(key, y_keys[other]))
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return compare


def components(edges: DataFrame) -> DataFrame:
    """(text_key, root) of every text in the (a, b) edges, by large-star and small-star steps; each round is written.

    A text's least neighbours are written before they are joined to its edges, so that adaptive execution can split the
    edges of a text that has many.
    """
    edges, before = edges.select("a", "b"), None
    while True:
        both = edges.toDF("u", "v").union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")), "least")
        large = materialize(both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        joined = large.join(least, "a")
        edges = joined.select("a", F.col("m").alias("b")).union(joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        edges = materialize(edges, "stars")
        now = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
        if now == before:
            return edges.toDF("text_key", "root")
        before = now


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Per row: doc_id, class_id (the class's least doc_id), class_rows, text_key, chosen (one doc_id and text a class)."""
    signed = signatures(docs)
    roots = components(links(signed, least))
    rows = join_facts(signed.select("doc_id", "text_key"), roots, "text_key", "doc_id").select("doc_id", "text_key", F.coalesce("root", "text_key").alias("_class"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    named = rows.groupBy("_class").agg(F.count("*").alias("class_rows"), F.min(order).alias("_first")).where("class_rows > 1")
    both = join_facts(rows, named, "_class", "doc_id")
    alone = F.col("class_rows").isNull()
    chosen = alone | (F.col("doc_id").eqNullSafe(F.col("_first.doc_id")) & (F.col("text_key") == F.col("_first.text_key")))
    class_id = F.when(alone, F.col("doc_id")).otherwise(F.col("_first.doc_id"))
    return both.select("doc_id", class_id.alias("class_id"), F.coalesce("class_rows", F.lit(1)).alias("class_rows"), "text_key", chosen.alias("chosen"))


def keep_one(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of every class: the one with the least doc_id."""
    columns = docs.columns
    key, own_id, own_key = fresh(docs, "key", "own_id", "own_key")
    chosen = materialize(classes(docs.select("doc_id", "text"), least).where("chosen").groupBy("doc_id", "text_key").agg(F.count("*").alias("rows")), "chosen")
    keyed = docs.withColumn(key, F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    names = chosen.select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key))
    kept = keyed.join(names, F.col("doc_id").cast("long").eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(own_key)), "left_semi")
    if not chosen.where("rows > 1").isEmpty():  # repeated rows
        kept = kept.dropDuplicates(["doc_id", key])
    return kept.select(*columns)


def op2_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_rows")


QUERIES = {"op2_near_dups": op2_near_dups}
SQL: dict[str, str] = {}
