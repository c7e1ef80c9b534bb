"""URL filters: a blocked Bloom filter before an exact hash join.

Listed prefixes are canonical strings of host and path. A page's candidates are its host and parent domains, each with
the beginnings of its path that are as long as some listed path. A candidate picks one 256-bit block of the filter by
its hash and tests one bit in each of the block's four words; only candidates that pass reach the hash join with the
list itself, which removes the false positives. The longest listed prefix decides; a page that none fits is allowed.

The filter has ``blocks`` rows whatever the list's length, so broadcasting it is bounded; a list too long for it only
lets more candidates through to the join.

Defined results: a null url, or one without ``://``, has an empty host and path and no rule; repeated pages stay
separate rows; ties in length go to the rule that sorts last; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import UPPER, join_facts, table

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
BLOCKS = 1 << 12
_WORDS = 4


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    """(prefix, host, path, verdict) of listed prefixes."""
    rows = F.array(*(F.struct(F.lit(h + p).alias("prefix"), F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for v, h, p in rules))
    return spark.range(1).select(F.inline(rows))


def _bits(key: Column) -> list[Column]:
    second = F.xxhash64(key, F.lit(7))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(second, 6 * w).bitwiseAND(F.lit(63)).cast("int")) for w in range(_WORDS)]


def blocked_bloom(keys: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(block, w0..w3) over the single column of ``keys``: at most ``blocks`` rows."""
    key = F.col(keys.columns[0])
    marked = keys.select(F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"), *(b.alias(f"w{w}") for w, b in enumerate(_bits(key))))
    return marked.groupBy("block").agg(*(F.bit_or(f"w{w}").alias(f"w{w}") for w in range(_WORDS)))


def maybe_listed(candidates: DataFrame, column: str, bloom: DataFrame, blocks: int = BLOCKS, passing: bool = True) -> DataFrame:
    """The candidates that pass the filter, or those that do not."""
    key = F.col(column)
    hit = [F.col(f"b.w{w}").bitwiseAND(b) != 0 for w, b in enumerate(_bits(key))]
    on = F.pmod(F.xxhash64(key), F.lit(blocks)) == F.col("b.block")
    for h in hit:
        on = on & h
    return candidates.join(F.broadcast(bloom.alias("b")), on, "left_semi" if passing else "left_anti")


def filter_urls(pages: DataFrame, rules: DataFrame, path_lengths: list[int], default: str = "allow", blocks: int = BLOCKS) -> DataFrame:
    """(page_id, url, host, path, rule, verdict) of every page. path_lengths: the distinct lengths of the listed paths."""
    host, path = split_url(F.col("url"))
    base = pages.select("page_id", "url").select("page_id", "url", host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    starts = F.filter(F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in path_lengths)), lambda p: p.isNotNull())
    places = base.select("host", "path").where("host <> ''").distinct()
    pairs = places.select("host", "path", F.explode(F.flatten(F.transform(domains, lambda d: F.transform(starts, lambda p: F.struct(F.concat(d, p).alias("prefix"), d.alias("domain")))))).alias("c"))
    pairs = pairs.select("host", "path", "c.prefix", "c.domain")
    passed = maybe_listed(pairs, "prefix", blocked_bloom(rules.select("prefix"), blocks), blocks)
    listed = rules.select("prefix", F.col("host").alias("domain"), "verdict")
    best = passed.join(listed, ["prefix", "domain"]).groupBy("host", "path").agg(F.max(F.struct(F.length("prefix").alias("n"), "prefix", "verdict")).alias("best"))
    facts = best.select(F.concat("host", "path").alias("place"), "best")  # a path begins with / or is empty, a host has none
    rows = join_facts(base.withColumn("place", F.concat("host", "path")), facts, "place", "page_id")
    return rows.select("page_id", "url", "host", "path", F.col("best.prefix").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), rules_frame(spark), sorted({len(p) for _, _, p in RULES})).drop("url")


QUERIES = {"op10_url_filter": op10_url_filter}
SQL = {
    "op10_url_filter": r"""
WITH rest AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), rules(host_rule, path_rule, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
  SELECT DISTINCT p.host, p.path, host_rule || path_rule AS rule, verdict
  FROM (SELECT DISTINCT host, path FROM parts) p JOIN rules
    ON (p.host = host_rule OR ends_with(p.host, '.' || host_rule)) AND starts_with(p.path, path_rule)
), best AS (
  SELECT host, path, rule, verdict FROM fits QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, rule DESC) = 1
)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts p LEFT JOIN best b ON p.host = b.host AND p.path = b.path
"""
}
