"""Building manifests: wide rows to clip rows, joins with audio listings and translations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonehive.functions.romanise import Options, convert
from tonehive.functions.text import strip, with_suffix


def column_or(df: DataFrame, name: str, default: str = "") -> Column:
    """The column, or the default where the table lacks it."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(default)


def fan_out(rows: DataFrame, datasets: dict[str, tuple[str, str]], index: str | Column = "index", suffix: str = ".mp3") -> DataFrame:
    """dataset, index, file, text: for every row and dataset (text column, audio column) one clip.

    Text and file are stripped of Unicode white space; a clip needs both. The index is the row's,
    so it has gaps and repeats across datasets. One scan feeds all datasets.
    """
    index = F.col(index) if isinstance(index, str) else index
    cells = [F.struct(F.lit(name).alias("dataset"), strip(column_or(rows, t)).alias("text"), strip(column_or(rows, a)).alias("file")) for name, (t, a) in datasets.items()]
    clips = rows.select(index.cast("long").alias("index"), F.inline(F.array(*cells)))
    return clips.where("text <> '' and file <> ''").select("dataset", "index", with_suffix(F.col("file"), suffix).alias("file"), "text")


def with_ordinal(df: DataFrame, name: str = "index") -> DataFrame:
    """`df` with a gapless ordinal from 0 in the order of the scan.

    A row's place in its partition is the low part of its running number; partitions begin after the
    counts of those before them, a number for each, which is what comes to the driver. `df` is
    computed twice and must come in the same partitions both times, as a scan does.
    """
    counts = {r.p: r.n for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()}
    begins, before = [], 0
    for p in range(max(counts, default=-1) + 1):
        begins.append(before)
        before += counts.get(p, 0)
    table = F.array(*map(F.lit, begins)) if begins else F.array(F.lit(0))
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return df.select((F.element_at(table, F.spark_partition_id() + 1) + within).cast("long").alias(name), "*")


def existing(clips: DataFrame, listing: DataFrame, on: str | list[str] = "file") -> DataFrame:
    """Clips whose file is listed."""
    return clips.join(listing, on, "left_semi")


def absent(clips: DataFrame, listing: DataFrame, on: str | list[str] = "file") -> DataFrame:
    """Clips whose file is not listed."""
    return clips.join(listing, on, "left_anti")


def same_count(a: DataFrame, b: DataFrame) -> int:
    """The common number of rows; raises if there is none."""
    n, m = a.count(), b.count()
    if n != m:
        raise ValueError(f"row counts differ: {n} and {m}")
    return n


def merge_replacing(left: DataFrame, right: DataFrame, key: str, old: str, new: str, order: list[str]) -> DataFrame:
    """`left` with column `old` taken from `right`'s column `new` by key, reduced to the columns in `order`.

    A key that `right` repeats repeats the row; null keys match null keys; a key that is missing gives null.
    """
    picked = right.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{new}`"))
    joined = left.drop(old).join(picked, F.col(f"`{key}`").eqNullSafe(F.col("_key")), "left").drop("_key")
    return joined.withColumnRenamed(new, old).select(*(f"`{c}`" for c in order))


def merge_translations(segments: DataFrame, translations: DataFrame, on: str | list[str], text: str = "text", translated: str = "translated") -> DataFrame:
    """Segments with the translated text where there is one."""
    return segments.join(translations, on, "left").withColumn(text, F.coalesce(translated, text)).drop(translated)


def add_romanised(df: DataFrame, source: str = "lomaji", target: str = "POJ", options: Options = Options()) -> DataFrame:
    """`df` with `target` added or overwritten by the conversion of `source`; empty where the table lacks it."""
    return df.withColumn(target, convert(column_or(df, source), options))
