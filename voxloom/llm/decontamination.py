"""Benchmark decontamination with a positional inverted index.

An index is a folder: the training documents' words (tokenised once), how often each term occurs in all of them, and
the postings of terms, which are the places where a term stands in a text. Postings of a term are stored when a
search first needs it and are there for every later search; ``add_documents`` stores more documents, with their postings
of all terms that the index has.

A search starts from the rarest terms: every window of 13 item words picks its two words that are rarest among the
documents. The posting lists of a window's two words are intersected after adjusting for their offsets: the second must
stand as far from the first as in the item. An alignment (text, item, shift) that survives is compared word by
word with the text, which gives exact phrases. Proximity matches relax the offsets to ``slop`` more words, in either order.

Terms and windows of the benchmark are broadcast in blocks of at most ``BLOCK_TERMS`` and ``BLOCK_ANCHORS`` rows,
whatever its size. A window is two places in an item; the items' words are held once. Postings are dealt by text and
term, so neither a frequent word nor a passage that many documents share gathers in one task. A text is known by its MD5.

Defined results: a null or wordless text has n_words 0 and is not contaminated; a null or wordless item has no windows;
rows of the benchmark that repeat count once an item_id; a null item_id is left out of the list of ids and of n_near; repeated
documents stay separate rows; other columns are ignored, and kept by ``keep_clean``; an empty table gives no rows, an
empty benchmark no hits.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import ascii_lower, fresh, join_facts, materialize, shared_dir, table
from .url_filter import blocked_bloom, maybe_listed

WINDOW, SLOP = 13, 4
#: A document is contaminated if at least this share of its words is hit.
SHARE = 20
BLOCK_ANCHORS, BLOCK_TERMS = 100_000, 500_000
FILTER_BLOCKS = 1 << 16
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The lower-cased words of a text; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BREAK), "")


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _blocks(df: DataFrame, most: int, *by: str) -> list[DataFrame]:
    """``df`` in parts of about ``most`` rows, dealt by the hash of ``by``."""
    parts = max(1, -(-df.count() // most))
    return [df] if parts == 1 else [df.where(F.pmod(F.xxhash64(*by), F.lit(parts)) == k) for k in range(parts)]


@dataclass(frozen=True)
class Index:
    """The folder of an index. Its tables grow by a folder ``batch=...`` at a time."""

    spark: SparkSession
    path: str

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}").drop("batch")

    def _add(self, name: str, df: DataFrame) -> DataFrame:
        """Writes the rows as a batch of their own and reads them back."""
        to = f"{self.path}/{name}/batch=b{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(to)
        return self.spark.read.parquet(to)

    @property
    def texts(self) -> DataFrame:
        """(doc_id, text_key, words) of every row."""
        return self._read("texts")

    @property
    def frequencies(self) -> DataFrame:
        """(term, n): occurrences in all documents."""
        return self._read("frequencies").groupBy("term").agg(F.sum("n").alias("n"))

    @property
    def terms(self) -> DataFrame:
        """(term) of the terms whose postings are stored."""
        return self._read("terms")

    def postings(self, terms: DataFrame) -> DataFrame:
        """(text_key, term, places) of ``terms``, places from 0; those that the index lacks are stored first.

        The names of terms are written after their postings: a search that fails in between leaves postings that are
        stored again, and equal postings are taken together by every search.
        """
        lacking = materialize(terms.select("term").distinct().join(self.terms, "term", "left_anti"), "lacking-terms")
        for part in _blocks(lacking, BLOCK_TERMS, "term"):
            if not part.isEmpty():
                self._post(self.texts, part)
                self._add("terms", part)
        return reduce(DataFrame.unionByName, (self._read("postings").join(F.broadcast(part), "term", "left_semi") for part in _blocks(terms.select("term").distinct(), BLOCK_TERMS, "term")))

    def _post(self, texts: DataFrame, terms: DataFrame) -> None:
        met = texts.select("text_key", F.posexplode("words").alias("pos", "term")).join(F.broadcast(terms), "term", "left_semi")
        self._add("postings", met.groupBy("text_key", "term").agg(F.array_sort(F.collect_set("pos")).alias("places")))  # a group is within one text


def build_index(docs: DataFrame, path: str | None = None) -> Index:
    """A new index of ``docs`` in the folder ``path`` (None: one of its own in the shared folder)."""
    spark = docs.sparkSession
    index = Index(spark, (path or f"{shared_dir(spark)}/index-{uuid.uuid4().hex}").rstrip("/"))
    none = spark.range(0)
    index._add("terms", none.select(F.lit("").alias("term")))
    index._add("postings", none.select(F.lit(b"").alias("text_key"), F.lit("").alias("term"), F.expr("cast(array() as array<int>)").alias("places")))
    add_documents(index, docs)
    return index


def open_index(spark: SparkSession, path: str) -> Index:
    return Index(spark, path.rstrip("/"))


def add_documents(index: Index, docs: DataFrame) -> None:
    """Stores ``docs`` in the index, with their postings of the terms that it has."""
    new = index._add("texts", docs.select("doc_id", text_key(F.col("text")).alias("text_key"), words(F.col("text")).alias("words")))
    index._add("frequencies", new.select(F.explode("words").alias("term")).groupBy("term").agg(F.count("*").alias("n")))
    for part in _blocks(index.terms.distinct(), BLOCK_TERMS, "term"):
        if not part.isEmpty():
            index._post(new, part)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item_no, item_id, item): distinct items with at least one word; item_no is a hash of the other two. Written once."""
    items = benchmark.select("item_id", words(F.col("text")).alias("item")).where(F.size("item") > 0).distinct()
    name = F.concat_ws(" ", F.col("item_id").isNull().cast("string"), F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.array_join("item", " "))
    return materialize(items.select(F.unhex(F.md5(name)).alias("item_no"), "item_id", "item"), "items")


def anchors(items: DataFrame, frequencies: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_no, p, q, term, second): per window its rarest place p and second rarest q (p itself in one-word windows). Written once."""
    one = items.select("item_no", F.posexplode("item").alias("pos", "term")).join(frequencies, "term", "left")
    rarity = one.groupBy("item_no").agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("n", F.lit(0)).alias("n"), "term"))).alias("r"))  # a group is one item
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("r") - window + 1))
    rarest = lambda s: F.slice(F.sort_array(F.transform(F.slice("r", s, window), lambda x: F.struct(x["n"].alias("n"), x["pos"].alias("pos"), x["term"].alias("term")))), 1, 2)
    pairs = F.array_distinct(F.transform(starts, rarest))
    picked = materialize(rarity, "rarity").select("item_no", F.explode(pairs).alias("w"))
    second = F.coalesce(F.get("w", F.lit(1)), F.get("w", F.lit(0)))
    picked = picked.select("item_no", F.get("w", F.lit(0)).alias("x"), second.alias("y"))
    return materialize(picked.selectExpr("item_no", "x.pos as p", "y.pos as q", "x.term as term", "y.term as second").distinct(), "anchors")


def matches(index: Index, anchor_rows: DataFrame, slop: int = SLOP) -> DataFrame:
    """(text_key, item_no, shifts): texts where a window's two rarest words stand within their distance in the item and
    ``slop`` words more; shifts are the places where the item would begin, from those that stand exactly as in the item. Written once."""
    found = []
    for part in _blocks(anchor_rows, BLOCK_ANCHORS, "item_no", "p", "q"):
        postings = materialize(index.postings(part.select(F.explode(F.array("term", "second")).alias("term"))), "postings")
        first = postings.join(F.broadcast(part), "term")
        other = postings.select("text_key", F.col("term").alias("second"), F.col("places").alias("others"))
        met = first.join(other, ["text_key", "second"])
        near = F.exists("places", lambda x: F.exists("others", lambda y: F.abs(x - y) <= F.abs(F.col("q") - F.col("p")) + slop))
        exact = F.filter("places", lambda x: F.array_contains("others", x + F.col("q") - F.col("p")))
        found.append(materialize(met.where(near).select("text_key", "item_no", F.transform(exact, lambda x: x - F.col("p")).alias("shifts")), "matches"))
    return reduce(DataFrame.unionByName, found)


def phrase_hits(texts: DataFrame, found: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(text_key, item_id, hits): places (from 1) inside whole windows, for each of the alignments in ``found`` that has any."""
    found = materialize(found.select("text_key", "item_no", F.explode("shifts").alias("shift")).distinct(), "alignments")
    listed = found.groupBy("text_key").agg(F.collect_set(F.struct("item_no", "shift")).alias("at"))  # a group is within one text
    held = maybe_listed(texts, "text_key", blocked_bloom(found.select("text_key"), FILTER_BLOCKS), FILTER_BLOCKS).dropDuplicates(["text_key"])
    each = held.join(listed, "text_key").select("text_key", "words", F.explode("at").alias("at")).select("text_key", "words", "at.item_no", "at.shift")
    each = each.join(items, "item_no")
    fits = F.expr(f"filter(sequence(greatest(0, -shift), greatest(0, -shift, size(item) - {window})), s -> shift + s >= 0 and s + {window} <= size(item) and shift + s + {window} <= size(words) and slice(words, shift + s + 1, {window}) = slice(item, s + 1, {window}))")
    short = F.expr("if(shift >= 0 and slice(words, shift + 1, size(item)) = item, array(0), array())")  # an item shorter than a window is one window
    each = each.select("text_key", "item_id", "shift", F.when(F.size("item") < window, short).otherwise(fits).alias("starts"), F.least(F.size("item"), F.lit(window)).alias("n"))
    hits = F.array_distinct(F.flatten(F.expr("transform(starts, s -> sequence(shift + s + 1, shift + s + n))")))
    return each.where(F.size("starts") > 0).select("text_key", "item_id", hits.alias("hits"))


def search(index: Index, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, slop: int = SLOP) -> DataFrame:
    """Per row of the index: doc_id, text_key, n_words, n_hit, n_items, items (sorted ids as strings) with exact phrases,
    n_near (item ids with a proximity match), contaminated.

    Rows that are equal in doc_id and text get equal results.
    """
    items = benchmark_items(benchmark)
    texts, found = index.texts, matches(index, anchors(items, index.frequencies, window), slop)
    string_id = F.col("item_id").cast("string")
    phrases = phrase_hits(texts, found, items, window).groupBy("text_key").agg(  # a group is within one text
        F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).cast("long").alias("n_hit"), F.array_sort(F.collect_set(string_id)).alias("items")
    )
    near = found.join(items.select("item_no", "item_id"), "item_no").groupBy("text_key").agg(F.size(F.collect_set(string_id)).cast("long").alias("n_near"))
    per_text = materialize(phrases.join(near, "text_key", "full"), "found-texts")
    rows = join_facts(texts.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words")), per_text, "text_key", "doc_id")
    n_hit, ids = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.expr("cast(array() as array<string>)"))
    bad = (n_hit > 0) & (share * n_hit >= F.col("n_words"))
    return rows.select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("items"), F.coalesce("n_near", F.lit(0)).alias("n_near"), bad.alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, slop: int = SLOP, path: str | None = None) -> DataFrame:
    """``search`` in a new index of ``docs``, kept in the folder ``path``."""
    return search(build_index(docs, path), benchmark, window, share, slop)


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    columns = docs.columns
    key, own_id, own_key = fresh(docs, "text_key", "own_id", "own_key")
    bad = decontaminate(docs.select("doc_id", "text"), benchmark, window, share).where("contaminated").select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key)).distinct()
    keyed = docs.withColumn(key, text_key(F.col("text")))
    return keyed.join(bad, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(own_key)), "left_anti").select(*columns)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", "n_near")


QUERIES = {"op5_decontamination": op5_decontamination}
_WORDS_SQL = r"list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
SQL = {
    "op5_decontamination": rf"""
WITH d AS (SELECT doc_id, coalesce({_WORDS_SQL}, []) AS w FROM documents),
i AS (SELECT DISTINCT item_id, {_WORDS_SQL} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, s, s + 12), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s FROM i WHERE len(w) > 0)
),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)
),
m AS (SELECT doc_id, s, dw.n, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id),
dp AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS p FROM d),
freq AS (SELECT t, count(*) AS n FROM dp GROUP BY t),
it AS (SELECT row_number() OVER () AS no, item_id, w FROM i WHERE len(w) > 0),
ip AS (SELECT no, unnest(w) AS t, generate_subscripts(w, 1) AS p FROM it),
r AS (SELECT no, p, t, coalesce(n, 0) AS n FROM ip LEFT JOIN freq USING (t)),
st AS (SELECT no, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s FROM it),
k AS (SELECT r.no, s, p, t, row_number() OVER (PARTITION BY r.no, s ORDER BY n, p) AS k FROM r JOIN st ON r.no = st.no AND p BETWEEN s AND s + 12),
a AS (SELECT DISTINCT x.no, x.t AS t1, coalesce(y.t, x.t) AS t2, abs(coalesce(y.p, x.p) - x.p) AS far
      FROM (SELECT * FROM k WHERE k = 1) x LEFT JOIN (SELECT * FROM k WHERE k = 2) y ON x.no = y.no AND x.s = y.s),
c AS (SELECT x.doc_id, count(DISTINCT item_id) AS n_near
      FROM a JOIN dp x ON x.t = t1 JOIN dp y ON y.t = t2 AND x.doc_id = y.doc_id AND abs(x.p - y.p) <= far + 4 JOIN it ON it.no = a.no GROUP BY x.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(d.w), false) AS contaminated,
       coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id) LEFT JOIN c USING (doc_id)
"""
}
