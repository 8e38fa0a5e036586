"""Quality rules that say why a row goes, and counts of what they did."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tonehive.functions.text import cer


@dataclass(frozen=True)
class Rules:
    """Limits; None is no limit. Audio rules apply only with `filter_audio`, the error rate only with `check_cer`."""

    min_dur: float | None = None
    max_dur: float | None = None
    min_snr: float | None = 20.0
    max_cer: float = 0.15
    min_wps: float | None = 0.0
    max_wps: float | None = 5.0
    filter_audio: bool = True
    check_cer: bool = False


def outside(value: Column, low: float | None, high: float | None) -> Column:
    """Whether a value is null or beyond a limit that is set."""
    if low is None and high is None:
        return F.lit(False)
    bad = value.isNull()
    if low is not None:
        bad = bad | (value < low)
    if high is not None:
        bad = bad | (value > high)
    return bad


def drop_reason(rules: Rules, duration: Column | None = None, wps: Column | None = None, snr: Column | None = None, reference: Column | None = None, hypothesis: Column | None = None) -> Column:
    """The first failing rule in the order duration, wps, snr, cer; null if the row stays.

    A measure that is not given is not checked.
    """
    checks: list[tuple[str, Column]] = []
    if rules.filter_audio and duration is not None:
        checks.append(("duration", outside(duration, rules.min_dur, rules.max_dur)))
    if wps is not None:
        checks.append(("wps", outside(wps, rules.min_wps, rules.max_wps)))
    if rules.filter_audio and snr is not None:
        checks.append(("snr", outside(snr, rules.min_snr, None)))
    if rules.check_cer and reference is not None and hypothesis is not None:
        checks.append(("cer", outside(cer(reference, hypothesis), None, rules.max_cer)))
    reason = F.lit(None).cast("string")
    for name, bad in reversed(checks):
        reason = F.when(bad, F.lit(name)).otherwise(reason)
    return reason


def within_length(text: Column, limit: int | None, tts: bool) -> Column:
    """Whether a text is short enough for synthesis; any is for recognition."""
    return F.char_length(text) <= limit if tts and limit is not None else F.lit(True)


def reason_counts(df: DataFrame, reason: str = "drop_reason") -> DataFrame:
    """reason, n for the rows that go."""
    return df.where(F.col(reason).isNotNull()).groupBy(F.col(reason).alias("reason")).agg(F.count("*").alias("n"))


def stage_counts(df: DataFrame, reason: str = "drop_reason") -> DataFrame:
    """One row: kept, dropped and a map from reason to number."""
    by = df.groupBy(reason).agg(F.count("*").alias("n"))
    gone = F.col(reason).isNotNull()
    return by.agg(
        F.coalesce(F.sum(F.when(~gone, F.col("n"))), F.lit(0)).alias("kept"),
        F.coalesce(F.sum(F.when(gone, F.col("n"))), F.lit(0)).alias("dropped"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(gone, F.struct(F.col(reason), F.col("n")))))).alias("reasons"),
    )


#: Every reason that a stage gives.
REASONS = ("text", "duration", "wps", "snr", "cer")


def observed_counts(df: DataFrame, seen: Observation, reason: str = "drop_reason") -> DataFrame:
    """`df`, whose rows are counted by reason (of REASONS) as the next action reads them; `counts_of` gives the counts."""
    gone = [F.count(F.when(F.col(reason) == name, 1)).alias(name) for name in REASONS]
    return df.observe(seen, F.count(F.when(F.col(reason).isNull(), 1)).alias("kept"), F.count(reason).alias("dropped"), *gone)


def counts_of(seen: Observation) -> tuple[int, int, dict[str, int]]:
    """Kept, dropped and number by reason, once the action is over."""
    n = seen.get
    return n["kept"], n["dropped"], {name: n[name] for name in sorted(REASONS) if n[name]}
