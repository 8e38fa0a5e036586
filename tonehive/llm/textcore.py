"""Vectorised tokenising and hashing of Arrow string columns.

All functions work on the UTF-8 bytes of many texts at once. ASCII bytes never occur inside a
multi-byte character, so classes of ASCII characters can be tested byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BASE_INV = _U(pow(int(_BASE), -1, 1 << 64))
_BYTE, _BYTE_AGAIN = (np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1) for seed in (20240229, 19960301))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

#: Words are maximal runs of bytes outside these separators.
SPACE_SEPARATED = np.ones(256, bool)
SPACE_SEPARATED[[0x20, *range(0x09, 0x0E)]] = False
#: Words are ASCII letters and digits and every non-ASCII character.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True

_powers: tuple[np.ndarray, np.ndarray] | None = None


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is not None and len(_powers[0]) >= n:
        return _powers
    tables = []
    for base in (_BASE, _BASE_INV):
        t = np.full(n, base, dtype=np.uint64)
        t[0] = 1
        tables.append(np.multiply.accumulate(t))
    if n <= 2 * CHUNK_BYTES:
        _powers = (tables[0], tables[1])
    return tables[0], tables[1]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `limit` bytes together, or one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = max(i + 1, min(j, n))
        yield i, j
        i = j


class Words:
    """Words of a run of texts: text number, byte range and 64-bit hash of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray):
        self.texts = len(offsets) - 1
        self.at = offsets
        data = _LOWER[data]
        self.bytes = data
        inside = word_bytes[data]
        n = len(data)
        first = inside.copy()
        last = inside.copy()
        if n:
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            edges = offsets[1:-1]
            edges = edges[(edges > 0) & (edges < n)]
            first[edges] = inside[edges]
            last[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.text = np.searchsorted(offsets, self.start, "right") - 1
        self.hash = self._hashed(_BYTE)
        #: First word of each text, and one past the last.
        self.bounds = np.searchsorted(self.text, np.arange(self.texts + 1))

    def _hashed(self, table: np.ndarray) -> np.ndarray:
        n = len(self.bytes)
        power, inverse = _power_tables(max(n, 1))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(table[self.bytes] * power[:n], out=total[1:])
        h = (total[self.end] - total[self.start]) * inverse[self.start]
        return mix(h + (self.end - self.start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))

    def again(self) -> np.ndarray:
        """A second hash of each word, independent of the first."""
        return self._hashed(_BYTE_AGAIN)

    def spelled(self, at: int, size: int) -> bytes:
        """The words of a window, lower-cased, with one space between."""
        return b" ".join(self.bytes[a:b].tobytes() for a, b in zip(self.start[at : at + size], self.end[at : at + size], strict=True))

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of all windows of exactly `size` words within a text."""
        n = len(self.hash)
        if n < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.full(n - size + 1, _U(size))
        for k in range(size):
            h = h * _U(0xC2B2AE3D27D4EB4F) + self.hash[k : n - size + 1 + k]
        at = np.flatnonzero(self.text[: n - size + 1] == self.text[size - 1 :])
        return at, mix(h[at])

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of all windows of `size` words; a shorter text is one window if it has words."""
        n = len(self.hash)
        count = np.diff(self.bounds)
        parts_at, parts_hash = [], []
        if n >= size:
            h = np.zeros(n - size + 1, np.uint64)
            for k in range(size):
                h = h * _U(0xC2B2AE3D27D4EB4F) + self.hash[k : n - size + 1 + k]
            same = self.text[: n - size + 1] == self.text[size - 1 :]
            parts_at.append(np.flatnonzero(same))
            parts_hash.append(mix(h[same]))
        for length in range(1, size):
            short = self.bounds[:-1][count == length]
            if len(short):
                h = np.full(len(short), _U(length * 0x9E3779B1 + 7))
                for k in range(length):
                    h = h * _U(0xC2B2AE3D27D4EB4F) + self.hash[short + k]
                parts_at.append(short)
                parts_hash.append(mix(h))
        if not parts_at:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at, hashes = np.concatenate(parts_at), np.concatenate(parts_hash)
        order = np.argsort(at, kind="stable")
        return at[order], hashes[order]

    def sets(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct window hashes of each text, sorted, end to end; and where each text's begin."""
        at, hashes = self.windows(size)
        text = self.text[at]
        order = np.lexsort((hashes, text))
        text, hashes = text[order], hashes[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        text, hashes = text[new], hashes[new]
        return hashes, np.searchsorted(text, np.arange(self.texts + 1))


def each_words(column: pa.Array, word_bytes: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first text, one past the last, their words) over a column, in pieces of bounded size."""
    data, offsets = buffers(column)
    for i, j in pieces(offsets, limit):
        yield i, j, Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], word_bytes)


def sets_of(column: pa.Array, size: int) -> list[np.ndarray]:
    """The set of `size`-word shingle hashes of each text, as sorted arrays."""
    out: list[np.ndarray] = []
    for _, _, words in each_words(column, SPACE_SEPARATED):
        hashes, bounds = words.sets(size)
        out.extend(hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True))
    return out
