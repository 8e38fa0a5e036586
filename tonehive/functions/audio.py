"""Audio: WAV bytes in Arrow batches, and signal measures on float arrays as built-in expressions."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of ITU-R BS.1770-4: filter coefficients at 48 kHz, gates and block times.
SHELF = ([1.53512485958697, -2.69169618940638, 1.19839281085285], [1.0, -1.69065929318241, 0.73248077421585])
HIGH_PASS = ([1.0, -2.0, 1.0], [1.0, -1.99004745483398, 0.99007225036621])
ABSOLUTE_GATE, RELATIVE_GATE, OFFSET = -70.0, -10.0, -0.691
BLOCK_S, OVERLAP = 0.4, 0.75
FRAME_S = 0.025


def read_wav(data: bytes) -> tuple[int, np.ndarray]:
    """(rate, samples from -1 to 1 by channel) of PCM WAV bytes of 8, 16, 24 or 32 bits."""
    with wave.open(io.BytesIO(data)) as w:
        rate, channels, width, raw = w.getframerate(), w.getnchannels(), w.getsampwidth(), w.readframes(w.getnframes())
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(float) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) << 8 >> 8) / float(1 << 23)
    else:
        x = np.frombuffer(raw, f"<i{width}") / float(1 << (8 * width - 1))
    return rate, x.reshape(-1, channels)


def write_wav(rate: int, samples: np.ndarray) -> bytes:
    """16-bit mono PCM."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(samples, -1, 32767 / 32768) * 32768).round().astype("<i2").tobytes())
    return out.getvalue()


def resampled(x: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Band-limited resampling in the frequency domain."""
    n = round(len(x) * to / rate)
    if rate == to or not len(x) or not n:
        return x[:n]
    spectrum = np.fft.rfft(x)
    size = n // 2 + 1
    out = np.zeros(size, complex)
    k = min(size, len(spectrum))
    out[:k] = spectrum[:k]
    return np.fft.irfft(out, n) * (n / len(x))


def loudness(x: np.ndarray, rate: int) -> float:
    """Integrated loudness in LUFS of mono samples; -inf for silence or under one block."""
    x = resampled(x, rate, 48_000)
    size, hop = round(BLOCK_S * 48_000), round(BLOCK_S * 48_000 * (1 - OVERLAP))
    if len(x) < size:
        return float("-inf")
    # Both filters act as one frequency response, with room for their decay.
    n = 1 << (len(x) + 48_000).bit_length()
    z = np.exp(-2j * np.pi * np.fft.rfftfreq(n))
    response = np.ones(len(z), complex)
    for b, a in (SHELF, HIGH_PASS):
        response *= np.polyval(b[::-1], z) / np.polyval(a[::-1], z)
    y = np.fft.irfft(np.fft.rfft(x, n) * response, n)[: len(x)]
    power = np.concatenate([[0.0], np.cumsum(y * y)])
    starts = np.arange(0, len(x) - size + 1, hop)
    block = (power[starts + size] - power[starts]) / size
    level = OFFSET + 10 * np.log10(np.maximum(block, 1e-20))
    loud = block[level > ABSOLUTE_GATE]
    if not len(loud):
        return float("-inf")
    gate = OFFSET + 10 * np.log10(loud.mean()) + RELATIVE_GATE
    kept = block[(level > ABSOLUTE_GATE) & (level > gate)]
    return float(OFFSET + 10 * np.log10(kept.mean()))


def snr(x: np.ndarray, rate: int) -> float | None:
    """20 log10 of the 90th over the 10th percentile of frame RMS; null for silence or no frame."""
    size = max(1, round(FRAME_S * rate))
    frames = x[: len(x) // size * size].reshape(-1, size)
    if not len(frames):
        return None
    rms = np.sort(np.sqrt((frames * frames).mean(1)))
    low, high = (rms[min(int(len(rms) * p), len(rms) - 1)] for p in (0.1, 0.9))
    return float(20 * np.log10(high / low)) if low > 0 and high > 0 else None


def true_peak(x: np.ndarray, rate: int) -> float:
    """Greatest absolute value of the signal sampled four times as often: peaks lie between samples."""
    return float(np.abs(resampled(x, rate, 4 * rate)).max()) if len(x) else 0.0


def normalise(data: bytes, sample_rate: int, lufs: float, two_pass: bool = False) -> tuple[bytes, float, float | None]:
    """(WAV, seconds, SNR): mono, resampled, brought to the loudness unless that would clip.

    With `two_pass` the peak that must not clip is the true peak, kept at -1 dB, and the result is
    measured and corrected once more.
    """
    rate, x = read_wav(data)
    mono = resampled(x.mean(1), rate, sample_rate)
    for _ in range(2 if two_pass else 1):
        level = loudness(mono, sample_rate)
        if not np.isfinite(level):
            break
        gain = 10 ** ((lufs - level) / 20)
        peak, highest = (true_peak(mono, sample_rate), 10 ** (-1 / 20)) if two_pass else (np.abs(mono).max(), 0.999)
        mono = mono * min(gain, highest / peak if peak else gain)
    return write_wav(sample_rate, mono), len(mono) / sample_rate, snr(mono, sample_rate)


NORMALISED = "wav binary, duration_s double, snr_db double, error string"


def normalise_audio(sample_rate: int = 16_000, lufs: float = -23.0, two_pass: bool = False):
    """A column function from WAV bytes to struct<wav, duration_s, snr_db, error>; bad bytes give the error."""

    @F.pandas_udf(NORMALISED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for data in batch:
                try:
                    rows.append((*normalise(bytes(data), sample_rate, lufs, two_pass), None) if data is not None else (None, None, None, "no audio"))
                except (wave.Error, EOFError, ValueError) as e:
                    rows.append((None, None, None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["wav", "duration_s", "snr_db", "error"])

    return run


def slice_audio():
    """A column function (WAV bytes, start ms, end ms, mute pad ms) to the WAV of that range, in mono."""

    @F.pandas_udf("binary")
    def run(data: pd.Series, start: pd.Series, end: pd.Series, pad: pd.Series) -> pd.Series:
        def one(d, s, e, p):
            if d is None or pd.isna(s) or pd.isna(e):
                return None
            rate, x = read_wav(bytes(d))
            mono = x.mean(1)
            quiet = np.zeros(int(p) * rate // 1000)
            return write_wav(rate, np.concatenate([quiet, mono[max(0, int(s)) * rate // 1000 : max(0, int(e)) * rate // 1000], quiet]))

        return pd.Series([one(*row) for row in zip(data, start, end, pad, strict=True)])

    return run


def concatenated(clips: DataFrame, media: str, order: str, wav: str) -> DataFrame:
    """One WAV a medium: its clips one after the other, at the rate of the first. A medium must fit a task."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        parts = [read_wav(bytes(d)) for d in pdf[wav] if d is not None]
        rate = parts[0][0] if parts else 16_000
        joined = np.concatenate([resampled(x.mean(1), r, rate) for r, x in parts]) if parts else np.zeros(0)
        return pd.DataFrame({media: [pdf[media].iloc[0]], wav: [write_wav(rate, joined)], "clips": [len(parts)]})

    kind = clips.schema[media].dataType.simpleString()
    return clips.select(media, order, wav).groupBy(media).applyInPandas(run, f"`{media}` {kind}, `{wav}` binary, clips long")


HEADER = "struct<rate:long,channels:long,bits:long,seconds:double>"


def chunks(data: bytes) -> Iterator[tuple[bytes, int, int]]:
    """(name, begin, size) of the chunks of a RIFF file, in order."""
    at = 12
    while data[:4] == b"RIFF" and at + 8 <= len(data):
        size = int.from_bytes(data[at + 4 : at + 8], "little")
        yield data[at : at + 4], at + 8, size
        at += 8 + size + size % 2


def wav_header():
    """A column function from WAV bytes to struct<rate, channels, bits, seconds>; null if they are none.

    Chunks before the format or the samples are passed over.
    """

    @F.pandas_udf(HEADER)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for data in batch:
                data = bytes(data) if data is not None else b""
                found = {name: (begin, size) for name, begin, size in reversed(list(chunks(data)))}
                if b"fmt " not in found:
                    rows.append((None, None, None, None))
                    continue
                f = data[found[b"fmt "][0] :]
                channels, rate, frame, bits = (int.from_bytes(f[a:b], "little") for a, b in ((2, 4), (4, 8), (12, 14), (14, 16)))
                begin, size = found.get(b"data", (0, 0))
                rows.append((rate, channels, bits, min(size, len(data) - begin) / (frame * rate) if frame and rate else None))
            yield pd.DataFrame(rows, columns=["rate", "channels", "bits", "seconds"]).astype({"rate": "Int64", "channels": "Int64", "bits": "Int64", "seconds": "float64"})

    return run


def rms(samples: Column) -> Column:
    """Root mean square of an array of floats."""
    total = F.aggregate(samples, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.sqrt(F.try_divide(total, F.size(samples)))


def frame_snr(samples: Column, frame: int) -> Column:
    """Like `snr`, on an array column, as built-in expressions."""
    n = F.floor(F.size(samples) / frame).cast("int")
    frames = F.transform(F.sequence(F.lit(0), n - 1), lambda i: rms(F.slice(samples, i * frame + 1, F.lit(frame))))
    ordered = F.array_sort(frames)
    at = lambda p: F.element_at(ordered, F.least(F.floor(n * F.lit(p)) + 1, n).cast("int"))
    low, high = at(0.1), at(0.9)
    return F.when((n > 0) & (low > 0) & (high > 0), 20 * F.log10(high / low))
