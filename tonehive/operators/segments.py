"""Time segments: padding that does not bleed into neighbours, ranges, offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def padded(segments: DataFrame, media: str = "media", start: str = "start_ms", end: str = "end_ms", lead: int = 0, tail: int = 0, tie: str | None = None) -> DataFrame:
    """Segments with clip_start and clip_end: widened by lead and tail, but not into a neighbour nor below zero.

    The neighbour before is the one that ends last of all earlier ones. A segment that already
    overlaps its neighbour keeps its own bounds.
    """
    w = Window.partitionBy(media).orderBy(start, *([tie] if tie else []))
    before, after = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lead(start).over(w)
    begin = F.greatest(F.lit(0), F.col(start) - lead, F.least(F.coalesce(before, F.lit(0)), F.col(start)))
    stop = F.least(F.col(end) + tail, F.greatest(F.coalesce(after, F.col(end) + tail), F.col(end)))
    return segments.withColumn("clip_start", begin).withColumn("clip_end", stop)


def shifted(segments: DataFrame, offset_ms: Column, start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """Segments moved to the time of a cut that began at the offset."""
    return segments.withColumn(start, F.col(start) - offset_ms).withColumn(end, F.col(end) - offset_ms)


def overlapping(segments: DataFrame, ranges: DataFrame, media: str, bucket_ms: int) -> DataFrame:
    """Pairs of a segment (start_ms, end_ms) and a range (range_start, range_end) of the same medium that overlap.

    Both sides are entered in every bucket of time that they touch and joined on medium and bucket;
    a pair counts in the first bucket that both touch. So no pair is formed that is far apart.
    """
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / bucket_ms), F.floor(F.greatest(F.col(b) - 1, F.col(a)) / bucket_ms)))
    left = segments.where("end_ms > start_ms").withColumn("_b", span("start_ms", "end_ms"))
    right = ranges.where("range_end > range_start").withColumn("_b", span("range_start", "range_end"))
    first = F.greatest(F.floor(F.col("start_ms") / bucket_ms), F.floor(F.col("range_start") / bucket_ms))
    return left.join(right, [media, "_b"]).where("start_ms < range_end and end_ms > range_start").where(F.col("_b") == first).drop("_b")
