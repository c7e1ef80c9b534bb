"""The read side: summary, filters, sort orders, pages and details over passed and dropped samples.

``rows`` has shard, ord, key, passed (boolean), stage (of drops), text, orig_text, asr, audiobox, duration, alignment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE = 100
SORTS = ("wer", "quality", "duration", "key")


def summary(rows: DataFrame) -> DataFrame:
    """One row: passed, dropped, total, pass_rate (percent, one decimal; 0 without rows)."""
    n = rows.agg(F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("dropped"))
    total = F.col("passed") + F.col("dropped")
    return n.select("passed", "dropped", total.alias("total"), F.when(total > 0, F.round(100 * F.col("passed") / total, 1)).otherwise(F.lit(0.0)).alias("pass_rate"))


def by_stage(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("passed")).groupBy("stage").agg(F.count("*").alias("n"))


def select_rows(rows: DataFrame, passed: bool, stage: str | None = None, search: str | None = None) -> DataFrame:
    """One tab's rows; a stage narrows drops only; search is a substring of key, text and transcript in any case."""
    out = rows.where(F.col("passed") == passed)
    if stage and not passed:
        out = out.where(F.col("stage") == stage)
    if search:
        whole = F.lower(F.concat(F.coalesce("key", F.lit("")), F.lit(" "), F.coalesce("text", F.lit("")), F.lit(" "), F.coalesce("asr.text", F.lit(""))))
        out = out.where(F.contains(whole, F.lower(F.lit(search))))
    return out


def sort_order(mode: str, passed: bool) -> list[Column]:
    """Worst error rate first, least quality first, longest first (passed rows only), or by key; ties by shard and place."""
    first = {
        "wer": F.coalesce("asr.wer", F.lit(-1.0)).desc(),
        "quality": F.coalesce(F.try_element_at("audiobox", F.lit("PQ")), F.lit(99.0)).asc(),
        "duration": F.coalesce("duration", F.lit(0.0)).desc() if passed else F.lit(0).asc(),
        "key": F.col("key").asc(),
    }[mode]
    return [first, F.col("shard").asc(), F.col("ord").asc()]


def page(rows: DataFrame, order: list[Column], number: int, size: int = PAGE) -> DataFrame:
    """The page of that number (from 0), moved into the range there is."""
    pages = max(1, -(-rows.count() // size))
    return rows.orderBy(*order).offset(min(max(0, number), pages - 1) * size).limit(size)


def listing(rows: DataFrame) -> DataFrame:
    """Rows without the alignment itself, but with its length."""
    return rows.withColumn("n_aligned", F.size("alignment")).drop("alignment")


def detail(rows: DataFrame, shard: str, key: str) -> DataFrame:
    return rows.where((F.col("shard") == shard) & (F.col("key") == key))


def other_text(rows: DataFrame) -> Column:
    """The second text to show: the original if it differs, else the transcript if it differs."""
    return F.when(F.col("orig_text") != F.col("text"), F.col("orig_text")).when(F.col("asr.text") != F.coalesce("text", F.lit("")), F.col("asr.text"))


def score_distribution(rows: DataFrame, stage: str, score: Column, points: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Quantiles of a score over one stage's drops, for setting thresholds."""
    return rows.where(~F.col("passed") & (F.col("stage") == stage)).agg(F.percentile_approx(score, list(points)).alias("quantiles"), F.count(score).alias("n"))
