"""Splits that depend on the rows and the seed alone, not on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonehive.operators.ranks import rank

SPLITS = ("train", "validation", "test")


def draw(seed: int, ident: Column) -> Column:
    """A hexadecimal key that orders rows at random but the same way every time."""
    return F.md5(F.concat(F.lit(f"{seed}:"), ident.cast("string")))


def split_of(place: Column, n: Column, val: float, test: float) -> Column:
    """Places up to floor(n * val) are validation, as many as floor(n * test) test, all others train."""
    v, t = F.floor(n * F.lit(val)), F.floor(n * F.lit(test))
    return F.when(place <= v, "validation").when(place <= v + t, "test").otherwise("train")


def _keys_at(keys: DataFrame, places: list[int]) -> list[str]:
    """The hexadecimal keys (k) at these 1-based places of the order; before the first it is empty.

    Keys are counted by their first characters, which brings 4096 counts to the driver; keys of the
    group that a place falls in are counted by more characters until few are left to sort.
    """
    found = {0: ""}
    for place in sorted(set(places) - {0}):
        prefix, rest = "", place
        while True:
            inside = keys.where(F.col("k").startswith(prefix))
            size = len(prefix) + 3
            counts = sorted((r.b, r.n) for r in inside.groupBy(F.substring("k", 1, size).alias("b")).agg(F.count("*").alias("n")).collect())
            for prefix, n in counts:
                if rest <= n:
                    break
                rest -= n
            if n <= 1000 or size >= 32:
                few = sorted(r.k for r in keys.where(F.col("k").startswith(prefix)).select("k").collect()) if size < 32 else [prefix] * rest
                found[place] = few[rest - 1]
                break
    return [found[p] for p in places]


def random_split(df: DataFrame, ident: str, seed: int = 42, val: float = 0.05, test: float = 0.05) -> DataFrame:
    """`df` with split, by the rank of each row's key among all; rows of one id are in one split, those without one in train.

    Only the keys where a split ends are looked for; rows are then split where they are, whatever
    else they hold.
    """
    keys = df.where(F.col(ident).isNotNull()).select(draw(seed, F.col(ident)).alias("k"))
    n = keys.count()
    v, t = int(n * val), int(n * test)
    low, high = _keys_at(keys, [v, v + t])
    key = F.coalesce(draw(seed, F.col(ident)), F.lit("~"))
    return df.withColumn("split", F.when(key <= low, "validation").when(key <= high, "test").otherwise("train"))


def speaker_split(df: DataFrame, speaker: str, seed: int = 42, val: float = 0.05, test: float = 0.05) -> DataFrame:
    """`df` with split, drawn for speakers, so that none is in two splits."""
    drawn = random_split(df.select(speaker).distinct(), speaker, seed, val, test).withColumnRenamed(speaker, "_s")
    return df.join(drawn, F.col(speaker).eqNullSafe(F.col("_s"))).drop("_s")


def stratified_split(df: DataFrame, ident: str, duration: str, seed: int = 42, val: float = 0.05, test: float = 0.05, strata: int = 5) -> DataFrame:
    """`df` with stratum (1 to `strata` of equal size by duration) and split, drawn inside each."""
    # Position by duration, ties by id, in buckets of a second.
    total = df.groupBy().agg(F.count("*").alias("_n"))
    bucket = F.least(F.greatest(F.floor(F.coalesce(F.col(duration), F.lit(-1.0))).cast("long"), F.lit(-1)), F.lit(100_000))
    placed = rank(df, [F.col(duration), F.col(ident)], "_rn", bucket).crossJoin(F.broadcast(total))
    # ntile: the first n % strata groups have one row more
    small, more = F.floor(F.col("_n") / strata), F.col("_n") % strata
    edge = more * (small + 1)
    stratum = F.when(F.col("_rn") <= edge, F.floor((F.col("_rn") - 1) / (small + 1)) + 1).otherwise(more + F.floor((F.col("_rn") - 1 - edge) / F.greatest(small, F.lit(1))) + 1)
    tiled = placed.withColumn("stratum", stratum.cast("int")).drop("_rn", "_n")
    drawn = rank(tiled, draw(seed, F.col(ident)), "_rn", within=["stratum"])
    sizes = tiled.groupBy(F.col("stratum").alias("_s")).agg(F.count("*").alias("_n"))
    both = drawn.join(F.broadcast(sizes), F.col("stratum") == F.col("_s"))  # a row for each stratum
    return both.withColumn("split", split_of(F.col("_rn"), F.col("_n"), val, test)).drop("_rn", "_n", "_s")


def split_counts(df: DataFrame, zero_fill: bool = True) -> DataFrame:
    """split, n, ratio; with all three splits if `zero_fill`, else only those with rows."""
    counts = df.groupBy("split").agg(F.count("*").alias("n"))
    if zero_fill:
        names = df.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
        counts = names.join(counts, "split", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("ratio", F.when(total > 0, F.col("n") / total).otherwise(F.lit(0.0)))


def sample_examples(df: DataFrame, ident: str, n: int = 10, seed: int = 42) -> DataFrame:
    """n rows at random, the same ones every time; a top-k, so nothing is sorted as a whole."""
    return df.orderBy(draw(seed, F.col(ident)), F.col(ident)).limit(n)
