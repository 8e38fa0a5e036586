"""Ordinals, global and in groups, that do not gather a table or a large group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of an order are COARSE ranges of COARSE ranges each, cut at places of about SAMPLE sampled values.
COARSE, SAMPLE = 32, 50_000


def even_buckets(df: DataFrame, column: str) -> Column:
    """Numbers that follow the order of a column, each for about as many rows; null comes first.

    Only the bounds come from a sample; every row gets a bucket. A value of very many rows fills
    a bucket of its own.
    """
    n = df.count()
    sample = df.select(column).where(F.col(column).isNotNull()).sample(min(1.0, SAMPLE / max(n, 1)), seed=1)
    values = sorted(r[0] for r in sample.collect())
    bounds = [values[len(values) * k // COARSE**2] for k in range(COARSE**2)] if values else []
    if not bounds:
        return F.lit(0)
    kind = df.schema[column].dataType
    literal = lambda xs: F.array(*(F.lit(x).cast(kind) for x in xs))
    coarse = literal(bounds[COARSE::COARSE])
    fine = F.array(*(literal(bounds[k : k + COARSE]) for k in range(0, COARSE**2, COARSE)))
    first = F.size(F.filter(coarse, lambda b: b <= F.col(column)))
    second = F.size(F.filter(F.element_at(fine, first + 1), lambda b: b <= F.col(column)))
    return F.when(F.col(column).isNull(), -1).otherwise(first * COARSE + second)


def rank(df: DataFrame, order: Column | list[Column], name: str = "rn", bucket: Column | None = None, within: list[str] | None = None) -> DataFrame:
    """`df` with the 1-based rank of every row by `order`, among all or `within` equal columns.

    Rows are ranked inside buckets that follow the order, and a bucket begins after the counts of
    those before it; only the counts, one for each bucket, meet in one task. `bucket` must follow the
    order and have few values of about equal size; for a text key of hexadecimal digits the first
    three are one, which is the default: 4096 buckets whatever the size of the table.
    """
    order = order if isinstance(order, list) else [order]
    within = within or []
    ranked = df.withColumn("_b", F.substring(order[0].cast("string"), 1, 3) if bucket is None else bucket)
    ranked = ranked.withColumn("_i", F.row_number().over(Window.partitionBy(*within, "_b").orderBy(*order)))
    counts = ranked.groupBy(*within, "_b").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*within).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    keys = [*within, "_b"]
    before = counts.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = ranked.join(before, same)  # small, but of unknown size where there are many groups: Spark decides
    return out.withColumn(name, (F.col("_before") + F.col("_i")).cast("long")).drop("_b", "_i", "_before", *(f"_k{i}" for i in range(len(keys))))


def shards(df: DataFrame, by: str | list[str], order: str, size: int = 500) -> DataFrame:
    """`df` with shard: the 0-based ordinal within `by` in the order of a column, divided by `size`."""
    by = [by] if isinstance(by, str) else by
    ranked = rank(df, F.col(order), "_rn", even_buckets(df, order), by)
    return ranked.withColumn("shard", F.floor((F.col("_rn") - 1) / size).cast("long")).drop("_rn")
