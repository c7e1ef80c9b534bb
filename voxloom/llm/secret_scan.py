"""Secret scans with an incremental blob ledger.

Every version of every text is addressed by its content (SHA-256). A ledger is a folder with two tables: the history,
which says what blob each document held at each revision, and the scans, which hold the findings of each (blob, rule set
version) pair that was scanned. ``update`` records a revision of the documents and scans only the pairs that the ledger
lacks, each distinct blob once; ``findings`` joins findings back to all documents at a revision, ``history`` to all of
them at all revisions. A change of the rules is a new version, under which every blob is unseen.

Blobs are sorted out by their addresses alone, and Bloom filters of them are broadcast: texts whose blobs were all scanned
before stay where they are, blobs that one text alone holds are scanned in place, and only texts that may be copies, or
may have been scanned, move to where copies meet. The filters have at most ``MOST_BLOCKS`` rows; fuller filters only let more texts move.

A rule's matches are found leftmost first without overlap: the pieces between matches (split) and the matches themselves
(extract) give each match's place in code points.

Defined results: a null text is empty and has no findings; repeated rows and equal texts share one scan and each get
its findings; an update that failed half-way leaves scans that are used, and is repeated for the rest; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import join_facts, materialize, shared_dir, table
from .url_filter import blocked_bloom, maybe_listed


@dataclass(frozen=True)
class Rule:
    """least: the shortest length of the counted group (0: the match) that is a finding; shorter matches are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),  # a run of 20 or more; a shorter one holds no longer match
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
RULES = BASE + MORE
#: Bounds of the rows of 256 bits of a Bloom filter of blobs.
LEAST_BLOCKS, MOST_BLOCKS = 1 << 10, 1 << 18
_SPAN = "array<struct<start:int,kind_no:int,kind:string,stop:int>>"


def version_of(rules: tuple[Rule, ...]) -> str:
    """A name that changes with the rules."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def spans(text: Column, rule: Rule, number: int) -> Column:
    """array<struct<start, kind_no, kind, stop>> of a rule's findings, by start."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    length = lambda m: F.length(m if rule.group == 0 else F.regexp_extract(m, rule.pattern, rule.group))
    gaps = F.split(text, rule.pattern, -1)
    begin = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {_SPAN})").alias("out"))
    parts = F.transform(F.arrays_zip(found.alias("m"), F.slice(gaps, 1, F.size(found)).alias("gap")), lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["m"]).alias("m"), (length(x["m"]) >= rule.least).alias("ok")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        one = F.struct(start.alias("start"), F.lit(number).alias("kind_no"), F.lit(rule.kind).alias("kind"), (start + x["m"]).alias("stop"))
        return F.struct((start + x["m"]).alias("at"), F.when(x["ok"], F.concat(acc["out"], F.array(one))).otherwise(acc["out"]).alias("out"))

    return F.when(F.rlike(text, F.lit(rule.pattern)), F.aggregate(parts, begin, step)["out"]).otherwise(F.expr(f"cast(array() as {_SPAN})"))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) of (blob, text) rows."""
    each = blobs.select("blob", *(spans(F.col("text"), r, k).alias(f"s{k}") for k, r in enumerate(rules)))
    return each.select("blob", F.array_sort(F.concat(*(f"s{k}" for k in range(len(rules))))).alias("spans"))


def address(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _blocks(n: int) -> int:
    """Rows of a Bloom filter for ``n`` blobs, at least 16 bits each as long as ``MOST_BLOCKS`` allows."""
    return max(LEAST_BLOCKS, min(MOST_BLOCKS, 1 << (n // 16).bit_length()))


@dataclass(frozen=True)
class Ledger:
    """The folder of a ledger; its tables grow by a folder ``batch=...`` at a time."""

    spark: SparkSession
    path: str

    def _add(self, name: str, df: DataFrame) -> DataFrame:
        to = f"{self.path}/{name}/batch=b{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(to)
        return self.spark.read.parquet(to)

    @property
    def revisions(self) -> DataFrame:
        """(revision, doc_id, blob) of every row of every revision."""
        return self.spark.read.parquet(f"{self.path}/revisions").drop("batch")

    def scans(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob, spans) of the blobs scanned under these rules."""
        return self.spark.read.parquet(f"{self.path}/scans").where(F.col("version") == version_of(rules)).select("blob", "spans")

    def update(self, docs: DataFrame, revision: int = 0, rules: tuple[Rule, ...] = RULES) -> int:
        """Records ``docs`` as a revision and scans what the ledger lacks; the number of blobs that were scanned."""
        held = self._add("revisions", docs.select(F.lit(revision).cast("long").alias("revision"), "doc_id", address(F.col("text")).alias("blob")))
        number = held.groupBy("blob").agg(F.count("*").alias("rows")).join(self.scans(rules).select("blob", F.lit(True).alias("seen")), "blob", "left")
        number = materialize(number.select("blob", "rows", F.col("seen").isNotNull().alias("seen")), "blobs")
        n_unseen, n_other = number.agg(F.count_if(~F.col("seen")), F.count_if(F.col("seen") | (F.col("rows") > 1))).first()
        if not n_unseen:
            return 0
        unseen, other = number.where("not seen").select("blob"), number.where("seen or rows > 1").select("blob")
        texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).select(address(F.col("text")).alias("blob"), "text")
        if n_unseen < number.count():
            texts = maybe_listed(texts, "blob", blocked_bloom(unseen, _blocks(n_unseen)), _blocks(n_unseen))
        bloom, blocks = blocked_bloom(other, _blocks(n_other)), _blocks(n_other)
        alone = maybe_listed(texts, "blob", bloom, blocks, passing=False)  # unseen, and one row's
        moved = maybe_listed(texts, "blob", bloom, blocks).dropDuplicates(["blob"]).join(unseen, "blob", "left_semi")
        version = F.lit(version_of(rules)).alias("version")
        for blobs in (alone, moved):
            self._add("scans", scan_blobs(blobs, rules).select("blob", version, "spans"))
        return n_unseen

    def findings(self, revision: int = 0, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(doc_id, blob, spans) of every row of a revision."""
        return self.history(rules).where(F.col("revision") == revision).drop("revision")

    def history(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(revision, doc_id, blob, spans) of every row of every revision."""
        some = self.scans(rules).where(F.size("spans") > 0).groupBy("blob").agg(F.first("spans").alias("spans"))
        rows = join_facts(self.revisions, some, "blob", "doc_id")
        return rows.select("revision", "doc_id", "blob", F.coalesce("spans", F.expr(f"cast(array() as {_SPAN})")).alias("spans"))


def open_ledger(spark: SparkSession, path: str | None = None) -> Ledger:
    """The ledger in the folder ``path`` (None: a new one in the shared folder); a folder without one gets an empty ledger."""
    ledger = Ledger(spark, (path or f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}").rstrip("/"))
    none = spark.range(0).select(F.lit(b"").alias("blob"), F.lit("").alias("version"), F.expr(f"cast(array() as {_SPAN})").alias("spans"))
    none.write.mode("ignore").parquet(f"{ledger.path}/scans/batch=none")
    return ledger


def _listed(array: Column) -> Column:
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _number_of(kind_no: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind_no"] == kind_no))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = open_ledger(spark)
    ledger.update(table(spark, sf_dir, "documents"))
    found = ledger.findings()
    counts = [_number_of(k).cast("long").alias(f"n_{r.kind}") for k, r in enumerate(BASE)]
    base = F.filter("spans", lambda s: s["kind_no"] < len(BASE))
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


QUERIES = {"op6_secret_scan": op6_secret_scan}
SQL: dict[str, str] = {}
