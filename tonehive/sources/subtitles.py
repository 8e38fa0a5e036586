"""SubRip subtitles: parsing, writing, headers, and JSON for translators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TIMES = r"(\d+):(\d\d):(\d\d)[,.](\d{1,3})\s*-->\s*(\d+):(\d\d):(\d\d)[,.](\d{1,3})"


def _ms(line: Column, first: int) -> Column:
    part = lambda k: F.regexp_extract(line, _TIMES, first + k).cast("long")
    fraction = F.rpad(F.regexp_extract(line, _TIMES, first + 3), 3, "0").cast("long")
    return part(0) * 3_600_000 + part(1) * 60_000 + part(2) * 1000 + fraction


def parse(files: DataFrame, content: str = "value", media: str = "media") -> DataFrame:
    """media, seg_idx, start_ms, end_ms, text of every block that has a time line; other blocks are skipped.

    seg_idx is the block's own number, or its place from 1 if it has none. Lines of a text are kept.
    """
    plain = F.regexp_replace(F.regexp_replace(F.col(content), "^﻿", ""), r"\r\n?", "\n")
    blocks = files.select(media, F.posexplode(F.split(F.regexp_replace(plain, r"\A\s+|\s+\z", ""), r"\n[ \t]*\n\s*")).alias("place", "block"))
    timed = blocks.where(F.col("block").rlike(_TIMES))
    number = F.nullif(F.regexp_extract("block", r"\A\s*(\d+)\s*\n", 1), F.lit("")).cast("int")
    text = F.regexp_replace(F.col("block"), rf"(?s)\A.*?{_TIMES}[^\n]*\n?", "")
    return timed.select(media, F.coalesce(number, F.col("place") + 1).alias("seg_idx"), _ms(F.col("block"), 1).alias("start_ms"), _ms(F.col("block"), 5).alias("end_ms"), F.trim(text).alias("text"))


def read_srt(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("media"), "value")
    return parse(files)


def _stamp(ms: Column) -> Column:
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3_600_000), F.floor(ms / 60_000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def to_srt(segments: DataFrame, media: str = "media") -> DataFrame:
    """media and the text of its subtitle file, blocks in order of time, numbered from 1. A file must fit a row."""
    rows = F.array_sort(F.collect_list(F.struct("start_ms", "end_ms", "text")))
    block = lambda x, i: F.concat((i + 1).cast("string"), F.lit("\n"), _stamp(x["start_ms"]), F.lit(" --> "), _stamp(x["end_ms"]), F.lit("\n"), F.coalesce(x["text"], F.lit("")), F.lit("\n"))
    return segments.groupBy(media).agg(rows.alias("r")).select(media, F.array_join(F.transform("r", block), "\n").alias("value"))


def to_json(segments: DataFrame, media: str = "media") -> DataFrame:
    """media and a JSON array of {seg_idx, text}, in order, for translating."""
    return segments.groupBy(media).agg(F.to_json(F.array_sort(F.collect_list(F.struct("seg_idx", "text")))).alias("json"))


def from_json(translations: DataFrame, media: str = "media", json: str = "json") -> DataFrame:
    """media, seg_idx and translated of such arrays; elements without a number are skipped."""
    rows = translations.select(media, F.inline(F.from_json(json, "array<struct<seg_idx:int,text:string>>")))
    return rows.where("seg_idx is not null").select(media, "seg_idx", F.col("text").alias("translated"))


def patched(header: Column, new: Column) -> Column:
    """A header map with entries added or overwritten."""
    kept = F.map_filter(header, lambda k, _: ~F.array_contains(F.map_keys(new), k))
    return F.map_concat(kept, new)
