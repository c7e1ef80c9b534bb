"""Publishing: greedy packs under a byte budget and their manifest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import let

GIB = 1 << 30
SHARDS_AT_ONCE = 256


def build_packs(shards: DataFrame, limit_bytes: float) -> DataFrame:
    """(name, size, pack): shards by name; a pack that is not empty closes when the next shard would take it over the limit.

    The fold needs all shards in order: it is one task with a row for each archive, not for each sample, and gathers the
    packs ``SHARDS_AT_ONCE`` shards at a time, so that the list is not copied for each of them.
    """
    none = F.expr("cast(array() as array<struct<name:string,size:bigint,pack:int>>)")
    acc = F.struct(F.lit(0).alias("pack"), F.lit(0).cast("long").alias("used"), F.lit(0).alias("n"), none.alias("out"))

    def step(a, x):
        fresh = (a["n"] > 0) & (a["used"] + x["size"] > limit_bytes)
        pack = F.when(fresh, a["pack"] + 1).otherwise(a["pack"])
        used = F.when(fresh, x["size"]).otherwise(a["used"] + x["size"])
        return F.struct(pack.alias("pack"), used.alias("used"), F.when(fresh, 1).otherwise(a["n"] + 1).alias("n"), F.concat(a["out"], F.array(F.struct(x["name"].alias("name"), x["size"].alias("size"), pack.alias("pack")))).alias("out"))

    def part(a, some):
        start = F.struct(a["pack"].alias("pack"), a["used"].alias("used"), a["n"].alias("n"), none.alias("out"))
        return let(F.aggregate(some, start, step), lambda x: F.struct(x["pack"].alias("pack"), x["used"].alias("used"), x["n"].alias("n"), F.concat(a["out"], x["out"]).alias("out")))

    rows = shards.select("name", F.col("size").cast("long").alias("size"))
    listed = rows.agg(F.array_sort(F.collect_list(F.struct("name", "size"))).alias("all"))
    firsts = F.when(F.size("all") > 0, F.sequence(F.lit(1), F.size("all"), F.lit(SHARDS_AT_ONCE))).otherwise(F.expr("cast(array() as array<int>)"))
    return listed.select(F.inline(F.aggregate(F.transform(firsts, lambda i: F.slice("all", i, SHARDS_AT_ONCE)), acc, part)["out"]))


def manifest(packs: DataFrame, samples: DataFrame) -> DataFrame:
    """(pack_id, files, size_gb, num_samples) of packs; ``samples`` has (name, n)."""
    joined = packs.join(samples, "name", "left")
    grouped = joined.groupBy("pack").agg(F.array_sort(F.collect_list("name")).alias("files"), F.round(F.sum("size") / GIB, 2).alias("size_gb"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("num_samples"))
    return grouped.select(F.format_string("pack_%05d", "pack").alias("pack_id"), "files", "size_gb", "num_samples")


def unchanged(manifest_rows: DataFrame, done: DataFrame) -> DataFrame:
    """Packs that an earlier upload holds with the same ordered list of files; ``done`` has (pack_id, files)."""
    return manifest_rows.join(done.withColumnRenamed("files", "_done"), "pack_id").where(F.col("files") == F.col("_done")).drop("_done")


def upload(manifest_rows: DataFrame, done: DataFrame, send: Callable[[str, list[str]], None], record: Callable[[str, list[str]], None]) -> list[str]:
    """Sends each pack that is not ``unchanged``, in order, and records it once it is sent; the packs that were sent.

    ``send`` and ``record`` are the client's, called on the driver one pack at a time.
    """
    same = unchanged(manifest_rows, done).select("pack_id")
    sent = []
    for row in manifest_rows.join(same, "pack_id", "left_anti").select("pack_id", "files").orderBy("pack_id").toLocalIterator():
        send(row.pack_id, row.files)
        record(row.pack_id, row.files)
        sent.append(row.pack_id)
    return sent
