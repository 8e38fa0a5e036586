"""Statistics of durations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PERCENTILES = (50, 75, 90, 95, 99)


def duration_stats(df: DataFrame, duration: str = "duration_s") -> DataFrame:
    """One row: count, total_hours, min_s, max_s, mean_s and p50_s to p99_s, all to two places.

    A percentile p is the value at index floor(n * p), counted from 0 and at most the last. Equal
    values are counted first. Counts are cumulated inside buckets of one second, and the buckets'
    totals over each other, so no task sees all values.
    """
    counted = df.where(F.col(duration).isNotNull()).groupBy(F.col(duration).cast("double").alias("v")).agg(F.count("*").alias("c")).withColumn("b", F.floor("v"))
    buckets = counted.groupBy("b").agg(F.sum("c").alias("bc"))
    ends = buckets.select(F.col("b").alias("b0"), F.coalesce(F.sum("bc").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    upto = F.sum("c").over(Window.partitionBy("b").orderBy("v")) + F.col("before")
    placed = counted.join(ends, F.col("b") == F.col("b0")).withColumn("upto", upto)
    whole = counted.agg(F.sum("c").alias("n"), F.sum(F.col("v") * F.col("c")).alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi")).where("n > 0")

    def percentile(p: int):
        index = F.least(F.floor(F.col("n") * p / 100), F.col("n") - 1)
        here = (F.col("upto") > index) & (F.col("upto") - F.col("c") <= index)
        return F.round(F.max(F.when(here, F.col("v"))), 2).alias(f"p{p}_s")

    both = placed.crossJoin(F.broadcast(whole))  # one row
    return both.groupBy("n", "s", "lo", "hi").agg(*(percentile(p) for p in PERCENTILES)).select(
        F.col("n").alias("count"),
        F.round(F.col("s") / 3600, 2).alias("total_hours"),
        F.round("lo", 2).alias("min_s"),
        F.round("hi", 2).alias("max_s"),
        F.round(F.col("s") / F.col("n"), 2).alias("mean_s"),
        *(f"p{p}_s" for p in PERCENTILES),
    )
