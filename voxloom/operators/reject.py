"""First reject wins: marking, counting, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_rejects(df: DataFrame) -> DataFrame:
    """Adds empty reject columns where they are missing; a row whose audio could not be read is rejected at once."""
    have = set(df.columns)
    df = df.withColumns({c: F.lit(None).cast(t) for c, t in (("reject_stage", "string"), ("reject_code", "string"), ("reject_value", "double")) if c not in have})
    if "decode_error" in have:
        df = reject(df, "input", [(F.col("decode_error").isNotNull(), F.concat(F.lit("decode_error:"), "decode_error"), F.lit(None))])
    return df


def alive() -> Column:
    return F.col("reject_code").isNull()


def reject(df: DataFrame, stage: str, cases: list[tuple[Column, Column | str, Column]]) -> DataFrame:
    """Marks live rows with the first case (condition, code, value) that holds; a null condition does not."""
    hit = F.lit(None)
    for condition, code, value in reversed(cases):
        code = F.lit(code) if isinstance(code, str) else code
        hit = F.when(condition, F.struct(code.alias("code"), value.cast("double").alias("value"))).otherwise(hit)
    kept = df.columns
    df = df.withColumn("_hit", F.when(alive(), hit))
    return df.withColumns(
        {
            "reject_stage": F.coalesce("reject_stage", F.when(F.col("_hit").isNotNull(), stage)),
            "reject_value": F.when(alive(), F.col("_hit.value")).otherwise(F.col("reject_value")),
            "reject_code": F.coalesce("reject_code", F.col("_hit.code")),
        }
    ).select(*kept)


def passed(df: DataFrame) -> DataFrame:
    return df.where(alive()).drop("reject_stage", "reject_code", "reject_value")


def dropped(df: DataFrame) -> DataFrame:
    return df.where(~alive())


def counters(df: DataFrame) -> DataFrame:
    """(name, n): input, output, and drop:<stage> for each stage that rejects."""
    per_stage = df.groupBy("reject_stage").agg(F.count("*").alias("n"))  # as many rows as stages
    flags = F.array(F.lit("input"), F.when(F.col("reject_stage").isNull(), "output").otherwise(F.concat(F.lit("drop:"), "reject_stage")))
    every = df.sparkSession.range(1).select(F.explode(F.array(F.lit("input"), F.lit("output"))).alias("name"), F.lit(0).cast("long").alias("n"))
    return per_stage.select(F.explode(flags).alias("name"), "n").unionByName(every).groupBy("name").agg(F.sum("n").alias("n"))


def render_counters(rows: dict[str, int]) -> str:
    drops = " ".join(f"{k}={v}" for k, v in sorted(rows.items()) if k.startswith("drop:"))
    return f"input={rows.get('input', 0)} output={rows.get('output', 0)} {drops}".rstrip()


def throughput(timed: DataFrame) -> DataFrame:
    """Per stage from (stage, seconds, items, audio_seconds) rows: share of the time, items a second and times real time."""
    total = timed.agg(F.sum("seconds").alias("_all"))
    each = timed.groupBy("stage").agg(*(F.sum(c).alias(c) for c in ("seconds", "items", "audio_seconds")))
    rate = lambda c: F.when(F.col("seconds") > 0, F.col(c) / F.col("seconds"))
    return each.crossJoin(F.broadcast(total)).select("stage", "seconds", (F.col("seconds") / F.nullif("_all", F.lit(0.0))).alias("share"), rate("items").alias("items_per_sec"), rate("audio_seconds").alias("times_real_time")).orderBy(F.desc("seconds"), "stage")
