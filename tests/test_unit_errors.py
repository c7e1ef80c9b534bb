"""Units and distances are worked out once a row, and rates from them are those of ``compute_wer``."""

from pyspark.sql import functions as F

from voxloom.functions import text as tx
from voxloom.plans import registry

SF = "/root/testdata/sf0.001"


def test_one_distance_a_row(spark):
    plan = registry.transcript_filter(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("levenshtein(") == 2  # few distinct units, or many


def test_counts_and_rates(spark):
    rows = [("a b c", "a x c d"), ("", "a b"), ("a b", ""), (None, None), ("...", "a"), ("一二 x", "一三 x")]
    df = spark.createDataFrame(rows, "a string, b string")
    counts = tx.unit_errors(F.col("a"), F.col("b"), True)
    got = df.select(counts.alias("n"), tx.counted_rate(counts).alias("r"), tx.compute_wer(F.col("a"), F.col("b"), False, True).alias("want")).collect()
    assert [tuple(r.n) for r in got] == [(2, 3, 4), (2, 0, 2), (2, 2, 0), (0, 0, 0), (1, 0, 1), (1, 3, 3)]
    assert all(r.r == r.want for r in got)
