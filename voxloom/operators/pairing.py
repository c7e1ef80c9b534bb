"""Joins and limits over archive members."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pair(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Members whose partner is there, where each key occurs once a side (the reader pairs repeated ones itself)."""
    return left.join(right, on)


def unpaired(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """(side, n): members of either side without a partner."""
    parts = [a.join(b.select(*on).distinct(), on, "left_anti").agg(F.count("*").alias("n")).select(F.lit(name).alias("side"), "n") for name, a, b in (("left", left, right), ("right", right, left))]
    return parts[0].unionByName(parts[1])


def shard_limit(rows: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` rows of each shard; none or 0 is no limit, and a negative one leaves one row."""
    if not limit:
        return rows
    order = Window.partitionBy("shard").orderBy("ord")
    return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= max(1, limit)).drop("_n")


def assign_workers(shards: DataFrame, workers: int) -> DataFrame:
    """(shard, worker): sorted shard names dealt in turn. One row a shard, so one ordered window is enough."""
    order = Window.orderBy("shard")
    return shards.select("shard").distinct().select("shard", F.pmod(F.row_number().over(order) - 1, F.lit(workers)).cast("long").alias("worker"))


def pending(shards: DataFrame, done: DataFrame) -> DataFrame:
    return shards.join(done.select("shard").distinct(), "shard", "left_anti")


def prefetch_keys(members: DataFrame, drops: DataFrame, cached: DataFrame) -> DataFrame:
    """Members of compressed archives that dropped rows need and no cache holds."""
    return members.where("compressed").join(drops.select("shard", "stem").distinct(), ["shard", "stem"], "left_semi").join(cached.select("shard", "stem").distinct(), ["shard", "stem"], "left_anti")
