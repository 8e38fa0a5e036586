"""Commands: python -m tonehive <command> ...; each reads and writes folders that Spark can reach."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tonehive.functions.audio import concatenated, normalise_audio, slice_audio, wav_header
from tonehive.operators.filters import Rules
from tonehive.operators.manifest import add_romanised, existing, fan_out, merge_replacing, merge_translations, same_count, with_ordinal
from tonehive.operators.segments import overlapping, padded, shifted
from tonehive.operators.stats import duration_stats
from tonehive.plans.package import Config, run
from tonehive.session import session
from tonehive.sources.files import audio, copy_missing, listing, read_csv, replace_csv, write_csv, write_one_csv, write_text
from tonehive.sources.subtitles import from_json, patched, read_srt, to_json, to_srt

SEGMENTS = "media string, seg_idx int, start_ms long, end_ms long, text string"


def _segments(spark: SparkSession, path: str):
    return read_srt(spark, path) if path.endswith(".srt") else read_csv(spark, path, SEGMENTS)


def add_roman(spark: SparkSession, a: argparse.Namespace) -> None:
    for path in a.paths:
        replace_csv(add_romanised(read_csv(spark, path), a.source, a.target), path)


def convert_subs(spark: SparkSession, a: argparse.Namespace) -> None:
    found = _segments(spark, a.input)
    if a.to == "csv":
        write_csv(found, a.output)
    else:
        to_srt(found).write.mode("overwrite").partitionBy("media").text(a.output)


def extract_json(spark: SparkSession, a: argparse.Namespace) -> None:
    to_json(_segments(spark, a.input)).select(F.col("json").alias("value"), "media").write.mode("overwrite").partitionBy("media").text(a.output)


def merge(spark: SparkSession, a: argparse.Namespace) -> None:
    arrays = spark.read.text(a.translations, wholetext=True).select(F.lit(a.media).alias("media"), F.col("value").alias("json"))
    write_csv(merge_translations(_segments(spark, a.input), from_json(arrays), ["media", "seg_idx"]), a.output)


def cut_clips(spark: SparkSession, a: argparse.Namespace) -> None:
    """Clips of every segment, padded but not into neighbours, as Parquet; with --joined one WAV a medium."""
    wide = padded(_segments(spark, a.segments), lead=a.lead, tail=a.tail, tie="seg_idx")
    media = audio(spark, a.audio).select(F.col("file").alias("media"), F.col("audio.bytes").alias("wav"))
    clips = wide.join(media, "media").withColumn("wav", slice_audio()("wav", "clip_start", "clip_end", F.lit(a.mute_pad)))
    (concatenated(clips, "media", "seg_idx", "wav") if a.joined else clips).write.mode("overwrite").parquet(a.output)


def prepare(spark: SparkSession, a: argparse.Namespace) -> None:
    """Manifests and clips from a wide table: --dataset name=text column,audio column,audio folder, as often as wanted.

    Clips whose audio is missing are left out; audio that is already there is not copied again.
    """
    rows = with_ordinal(read_csv(spark, a.table))
    for given in a.dataset:
        name, columns = given.split("=", 1)
        text, sound, folder = columns.split(",")
        clips = existing(fan_out(rows, {name: (text, sound)}, suffix=a.suffix).drop("dataset"), listing(spark, folder).select("file"))
        copy_missing(clips, folder, f"{a.output}/{name}/clips")
        write_one_csv(clips.select("index", "file", "text").orderBy("index"), f"{a.output}/{name}/clips/_manifest.csv")


def merge_column(spark: SparkSession, a: argparse.Namespace) -> None:
    """Replaces a column of a table by another table's, joined on a key; both must have as many rows."""
    left, right = read_csv(spark, a.table), read_csv(spark, a.other)
    same_count(left, right)
    replace_csv(merge_replacing(left, right, a.key, a.old, a.new, a.columns.split(",") if a.columns else left.columns), a.table)


def convert_media(spark: SparkSession, a: argparse.Namespace) -> None:
    """WAV files of a folder as mono at one rate and loudness, in Parquet (file, wav, seconds, SNR, error)."""
    done = audio(spark, a.input).withColumn("n", normalise_audio(a.rate, a.lufs, a.two_pass)("audio.bytes"))
    done.select("file", "n.*").write.mode("overwrite").parquet(a.output)


def inspect_media(spark: SparkSession, a: argparse.Namespace) -> None:
    """Prints rate, channels, bits and seconds of the WAV files of a folder."""
    audio(spark, a.input).select("file", wav_header()("audio.bytes").alias("h")).select("file", "h.*").orderBy("file").show(1_000_000, truncate=False)


def _in_range(segments, start_ms: int, end_ms: int):
    """Segments that overlap a range of time, in any medium, with the range's own start."""
    ranges = segments.select("media").distinct().select("media", F.lit(start_ms).cast("long").alias("range_start"), F.lit(end_ms).cast("long").alias("range_end"))
    return overlapping(segments, ranges, "media", 600_000)


def edit_sub(spark: SparkSession, a: argparse.Namespace) -> None:
    """Subtitles of a part of a medium, in the time of the part; what sticks out is cut off."""
    inside = _in_range(_segments(spark, a.input), a.start, a.end)
    inside = inside.withColumn("start_ms", F.greatest("start_ms", "range_start")).withColumn("end_ms", F.least("end_ms", "range_end"))
    write_csv(shifted(inside, F.col("range_start")).select(*(c.split()[0] for c in SEGMENTS.split(", "))), a.output)


def sync(spark: SparkSession, a: argparse.Namespace) -> None:
    """Media cut to the time that their subtitles span, with a margin, and the subtitles in the time of the cut.

    Writes <output>/media (media, offset_ms, wav) and <output>/segments.
    """
    found = _segments(spark, a.segments)
    spans = found.groupBy("media").agg(F.greatest(F.min("start_ms") - a.margin, F.lit(0)).alias("offset_ms"), (F.max("end_ms") + a.margin).alias("until_ms"))
    media = audio(spark, a.audio).select(F.col("file").alias("media"), F.col("audio.bytes").alias("wav"))
    cut = media.join(spans, "media").select("media", "offset_ms", slice_audio()("wav", "offset_ms", "until_ms", F.lit(0)).alias("wav"))
    cut.write.mode("overwrite").parquet(f"{a.output}/media")
    write_csv(shifted(found.join(spans, "media"), F.col("offset_ms")).select(*(c.split()[0] for c in SEGMENTS.split(", "))), f"{a.output}/segments")


def patch_meta(spark: SparkSession, a: argparse.Namespace) -> None:
    """Adds or overwrites entries of a subtitle header, a JSON object of texts: --set Key=Value, as often as wanted."""
    pairs = [x.split("=", 1) for x in a.set]
    new = F.create_map(*(F.lit(x) for pair in pairs for x in pair)) if pairs else F.expr("cast(map() as map<string,string>)")
    header = spark.read.text(a.header, wholetext=True).select(F.from_json("value", "map<string,string>").alias("h"))
    write_text(spark, header.select(F.to_json(patched(F.col("h"), new))).first()[0] + "\n", a.header)


def pack(spark: SparkSession, a: argparse.Namespace) -> None:
    clips = read_csv(spark, a.manifest).join(audio(spark, a.audio), "file")
    rules = Rules(a.min_dur, a.max_dur, a.min_snr, a.max_cer, a.min_wps, a.max_wps, not a.no_audio_filter, a.hypothesis_col is not None)
    config = Config(
        a.name, a.start_stage, a.end_stage, a.skip_normalization, a.text_col, a.sr, a.lufs, a.two_pass, a.workers, a.tts, a.lang, a.max_tts_chars, a.remove_punctuation,
        rules, a.val, a.test, a.seed, a.speaker_col, a.stratify_dur, a.shard_size, a.hypothesis_col,
    )
    print(json.dumps(run(clips, config, a.output), ensure_ascii=False, default=str))


def stats(spark: SparkSession, a: argparse.Namespace) -> None:
    duration_stats(spark.read.parquet(a.input)).show(truncate=False)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tonehive")
    commands = parser.add_subparsers(required=True)

    def command(title: str, f, *positional: str, **options):
        """An option's default tells its type; a type stands for itself without a default, a list for many."""
        p = commands.add_parser(title, help=f.__doc__)
        p.set_defaults(f=f)
        for x in positional:
            p.add_argument(x, **({"nargs": "+"} if x == "paths" else {}))
        for x, default in options.items():
            if default is False:
                flag = {"action": "store_true"}
            elif default is list:
                flag = {"action": "append", "default": []}
            else:
                flag = {"default": None, "type": default} if isinstance(default, type) else {"default": default, "type": type(default)}
            p.add_argument(f"--{x.replace('_', '-')}", **flag)

    command("add-roman", add_roman, "paths", source="lomaji", target="POJ")
    command("prepare", prepare, "table", "output", dataset=list, suffix=".mp3")
    command("merge-column", merge_column, "table", "other", "key", "old", "new", columns=str)
    command("convert-subs", convert_subs, "input", "output", to="csv")
    command("extract-json", extract_json, "input", "output")
    command("merge-translations", merge, "input", "translations", "media", "output")
    command("edit-sub", edit_sub, "input", "output", start=0, end=2**53)
    command("patch-meta", patch_meta, "header", set=list)
    command("sync", sync, "segments", "audio", "output", margin=0)
    command("slice", cut_clips, "segments", "audio", "output", lead=0, tail=0, mute_pad=0, joined=False)
    command("convert", convert_media, "input", "output", rate=16_000, lufs=-23.0, two_pass=False)
    command("inspect", inspect_media, "input")
    limits = {"min_dur": float, "max_dur": float, "min_snr": 20.0, "max_cer": 0.15, "min_wps": 0.0, "max_wps": 5.0, "no_audio_filter": False, "hypothesis_col": str}
    sound = {"skip_normalization": False, "sr": 16_000, "lufs": -23.0, "two_pass": False, "workers": int}
    words = {"text_col": "text", "tts": False, "lang": "nan", "max_tts_chars": 200, "remove_punctuation": False}
    parts = {"val": 0.05, "test": 0.05, "seed": 42, "speaker_col": str, "stratify_dur": False, "shard_size": 500}
    command("pack", pack, "manifest", "audio", "output", name="dataset", start_stage=1, end_stage=5, **sound, **words, **limits, **parts)
    command("stats", stats, "input")
    a = parser.parse_args(args)
    a.f(spark or session(), a)


if __name__ == "__main__":
    main()
