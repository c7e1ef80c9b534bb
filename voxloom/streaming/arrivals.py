"""Archives that arrive over time: a file stream whose checkpoint is the list of shards that are done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def process_arrivals(spark: SparkSession, folder: str, pattern: str, checkpoint: str, handle: Callable[[list[str]], None]) -> None:
    """Calls ``handle`` with the paths of archives that no earlier call has seen, then returns."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", pattern).load(folder).select("path")

    def batch(df: DataFrame, _: int) -> None:
        paths = [r.path.removeprefix("file:") for r in df.select(F.regexp_replace("path", "^file:/+", "/").alias("path")).orderBy("path").collect()]
        if paths:
            handle(paths)

    files.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(batch).start().awaitTermination()


def reject_rates(rejects: DataFrame, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Rejects by stage and time window of a stream with columns ts and stage."""
    return rejects.withWatermark("ts", late).groupBy(F.window("ts", window), "stage").agg(F.count("*").alias("n"))
