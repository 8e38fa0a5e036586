"""The packaging pipeline: normalise audio, clean text, filter, split, package.

Stages are functions from DataFrame to DataFrame in one lazy plan; audio, which is costly to make
and large to move, is normalised once and kept out of shuffles until the clips are final.
"""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tonehive.functions.audio import normalise_audio
from tonehive.functions.text import clean_asr, clean_tts, words_per_second
from tonehive.operators.filters import Rules, counts_of, drop_reason, observed_counts, within_length
from tonehive.operators.splits import random_split, speaker_split, split_counts, stratified_split
from tonehive.operators.stats import duration_stats
from tonehive.sources.files import write_shards, write_text

STAGES = ["normalized", "cleaned", "filtered", "split", "packaged"]
# Fixed values of the output format: titles of the stages in their reports, and the arguments that each report names.
TITLES = ["audio_normalizer", "text_cleaner", "quality_filter", "split_dataset", "packager"]
ARGUMENTS = [
    ["sr", "lufs", "two_pass", "workers"],
    ["tts", "lang", "max_tts_chars", "remove_punctuation"],
    ["text_col", "tts", "cer", "min_dur", "max_dur", "min_snr", "max_cer", "min_wps", "max_wps", "filter_audio"],
    ["train", "val", "test", "seed", "speaker_col", "stratify_dur"],
    ["tts", "speaker_col", "shard_size", "dataset_name", "lang"],
]


@dataclass(frozen=True)
class Config:
    dataset_name: str = "dataset"
    start_stage: int = 1
    end_stage: int = 5
    skip_normalization: bool = False
    text_col: str = "text"
    sr: int = 16_000
    lufs: float = -23.0
    two_pass: bool = False
    workers: int | None = None  # tasks that normalise audio; None leaves it to the scan
    tts: bool = False
    lang: str = "nan"
    max_tts_chars: int = 200
    remove_punctuation: bool = False
    rules: Rules = field(default_factory=Rules)
    val: float = 0.05
    test: float = 0.05
    seed: int = 42
    speaker_col: str | None = None
    stratify_dur: bool = False
    shard_size: int = 500
    hypothesis_col: str | None = None

    def arguments(self, stage: int) -> dict:
        """Those of a stage, by the names that its report gives them."""
        rules = asdict(self.rules)
        every = asdict(self) | rules | {"cer": rules["check_cer"], "train": round(1 - self.val - self.test, 10)}
        return {name: every[name] for name in ARGUMENTS[stage - 1]}


def normalized(clips: DataFrame, config: Config) -> DataFrame:
    """Adds wav, duration_s, snr_db and audio_error to clips that have audio.bytes."""
    dealt = clips.repartition(config.workers) if config.workers else clips
    done = dealt.withColumn("_n", normalise_audio(config.sr, config.lufs, config.two_pass)(F.col("audio.bytes")))
    return done.select(*clips.columns, F.col("_n.wav").alias("wav"), F.col("_n.duration_s").alias("duration_s"), F.col("_n.snr_db").alias("snr_db"), F.col("_n.error").alias("audio_error"))


def cleaned(clips: DataFrame, config: Config) -> DataFrame:
    """original_text is what was there, text the cleaned one; drop_reason "text" marks empty and too long ones."""
    raw = F.col(config.text_col)
    clean = clean_tts(raw) if config.tts else clean_asr(raw, config.remove_punctuation)
    out = clips.withColumn("original_text", raw).withColumn("text", clean)
    fits = (F.col("text") != "") & within_length(F.col("text"), config.max_tts_chars, config.tts)
    return out.withColumn("drop_reason", F.when(F.coalesce(fits, F.lit(False)), F.lit(None).cast("string")).otherwise("text"))


def filtered(clips: DataFrame, config: Config) -> DataFrame:
    """Adds wps and the first failing rule as drop_reason."""
    out = clips.withColumn("wps", words_per_second(F.col("text"), F.col("duration_s")))
    hypothesis = F.col(config.hypothesis_col) if config.hypothesis_col else None
    return out.withColumn("drop_reason", drop_reason(config.rules, F.col("duration_s"), F.col("wps"), F.col("snr_db"), F.col("text"), hypothesis))


def split(clips: DataFrame, config: Config, ident: str = "file") -> DataFrame:
    if config.speaker_col:
        return speaker_split(clips, config.speaker_col, config.seed, config.val, config.test)
    if config.stratify_dur:
        return stratified_split(clips, ident, "duration_s", config.seed, config.val, config.test)
    return random_split(clips, ident, config.seed, config.val, config.test)


def packaged(clips: DataFrame, config: Config) -> DataFrame:
    """The columns of a sample, in their order."""
    audio = F.struct(F.col("wav").alias("bytes"), F.col("file").alias("path")).alias("audio")
    more = [config.speaker_col] if config.speaker_col else []
    return clips.select(audio, "text", "duration_s", "snr_db", "wps", "original_text", "split", *more)


def run(clips: DataFrame, config: Config, out: str, subtitle_metadata: dict[str, str] | None = None) -> dict:
    """Runs the stages from clips (file, text, audio struct<bytes, path>) and writes to `out`.

    Each stage leaves a table under `out`/stages, so a run may begin at any stage. Returns the
    report: arguments, counts and time of each stage. It is also written beside the data as
    metadata_overall.json, each stage's part as metadata_<k>_<stage>.json, with dataset_info.json, a
    statistics page and a card.
    """
    spark = clips.sparkSession
    began = time.time()
    report: dict = {"pipeline_args": asdict(config), "subtitle_metadata": subtitle_metadata or {}, "stages": {}, "start_time": began}
    table = clips
    path = lambda k: f"{out}/stages/{k}_{STAGES[k - 1]}"
    if config.start_stage > 1:
        table = spark.read.parquet(path(config.start_stage - 1))
    stats: dict
    for k in range(config.start_stage, config.end_stage + 1):
        at, name = time.time(), STAGES[k - 1]
        if k == 1:
            table = table if config.skip_normalization else normalized(table, config)
            table = _kept(spark, table, path(k))
            failed = table.where("audio_error is not null").count() if "audio_error" in table.columns else 0
            stats = {"normalized": table.count() - failed, "errors": failed}
            table = table.where("audio_error is null").drop("audio_error") if "audio_error" in table.columns else table
        elif k in (2, 3):
            marked = (cleaned if k == 2 else filtered)(table, config)
            # Counted while it is written, so that texts are cleaned and rated once.
            seen = Observation()
            table = _kept(spark, observed_counts(marked, seen).where("drop_reason is null").drop("drop_reason"), path(k))
            kept, dropped, reasons = counts_of(seen)
            stats = {"kept": kept, "dropped": dropped} | ({"reasons": reasons, "audio_checks_skipped": not config.rules.filter_audio} if k == 3 else {})
        elif k == 4:
            table = _kept(spark, split(table, config), path(k))
            rows = {r.split: r for r in split_counts(table).collect()}
            short = {"train": "train", "validation": "val", "test": "test"}
            stats = {"total": sum(r.n for r in rows.values())} | {short[s]: r.n for s, r in rows.items()} | {f"{short[s]}_ratio": r.ratio for s, r in rows.items()}
            stats |= {"seed": config.seed, "method": "speaker" if config.speaker_col else "stratified" if config.stratify_dur else "random"}
        else:
            stats = package(table, config, out)
        part = {"stage": k, "name": TITLES[k - 1], "args": config.arguments(k), "stats": stats, "subtitle_metadata": report["subtitle_metadata"], "seconds": round(time.time() - at, 3)}
        report["stages"][f"{k}_{name}"] = part
        write_text(spark, _json(part), f"{out}/metadata_{k}_{name}.json")
    report |= {"success": True, "end_time": time.time(), "elapsed_s": time.time() - began}
    write_text(spark, _json(report), f"{out}/metadata_overall.json")
    return report


def _kept(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _json(value: dict) -> str:
    return json.dumps(value, ensure_ascii=False, indent=2, default=str) + "\n"


def dataset_info(df: DataFrame, config: Config) -> dict:
    """Name, mode, sizes of the splits that have rows, totals, rate and columns."""
    counts = {r.split: r.n for r in split_counts(df, zero_fill=False).collect()}
    hours = df.agg(F.round(F.coalesce(F.sum("duration_s"), F.lit(0.0)) / 3600, 2)).first()[0]
    return {"dataset_name": config.dataset_name, "mode": "TTS" if config.tts else "ASR", "splits": counts, "total_samples": sum(counts.values()), "total_hours": hours, "sample_rate": config.sr, "schema": df.columns}


def package(clips: DataFrame, config: Config, out: str) -> dict:
    """Writes the shards, dataset_info, the statistics page and the card; returns the info."""
    spark = clips.sparkSession
    samples = packaged(clips, config)
    write_shards(samples, f"{out}/data", config.shard_size)
    info = dataset_info(samples, config)
    write_text(spark, _json(info), f"{out}/dataset_info.json")
    write_text(spark, stats_page(clips, config), f"{out}/stats.md")
    write_text(spark, card(info, config), f"{out}/README.md")
    return info


def stats_page(clips: DataFrame, config: Config, examples: int = 10) -> str:
    """Markdown: a row of statistics and a few texts drawn at random."""
    from tonehive.operators.splits import sample_examples

    # Fixed values of the output format.
    head = ["Dataset", "Path", "Description", "Count", "Total Hours", "Min (s)", "Max (s)", "Mean (s)", "P50 (s)", "P75 (s)", "P90 (s)", "P95 (s)", "P99 (s)"]
    row = duration_stats(clips).first()
    cells = [config.dataset_name, "packaged", f"{config.dataset_name} Dataset", *(row if row else [0] + [""] * 9)]
    texts = [r.original_text for r in sample_examples(clips, "file", examples, config.seed).select("original_text").collect()]
    lines = ["# Dataset Statistics", "", "| " + " | ".join(head) + " |", "|" + "---|" * len(head), "| " + " | ".join(map(str, cells)) + " |", "", "# Random Text Examples", "", f"## {config.dataset_name} ({len(texts)} examples)", ""]
    return "\n".join(lines + [f"{i}. {t}" for i, t in enumerate(texts, 1)]) + "\n"


def card(info: dict, config: Config) -> str:
    """Markdown with a YAML head: splits, hours and columns."""
    about = {"audio": "WAV bytes in the Parquet files", "text": "cleaned transcript", "duration_s": "seconds", "snr_db": "estimated signal-to-noise ratio", "wps": "words per second", "original_text": "text before cleaning", "split": "train, validation or test"}
    task = "text-to-speech" if config.tts else "automatic-speech-recognition"
    lines = ["---", "language:", f"- {config.lang}", "license: other", "task_categories:", f"- {task}", "---", "", f"# {info['dataset_name']}", "", "| Split | Samples |", "|---|---|"]
    lines += [f"| {s} | {info['splits'].get(s, 0)} |" for s in ("train", "validation", "test")]
    lines += ["", f"Total audio: **{info['total_hours']:.1f} hours**", "", "## Columns", ""]
    return "\n".join(lines + [f"- `{c}`: {about.get(c, c)}" for c in info["schema"]]) + "\n"
