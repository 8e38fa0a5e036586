"""Substring deduplication by sliding spans of sentences.

A text is cut into units: sentences, those of more than `unit_words` words in pieces of that many.
A span is a run of consecutive units of at least `units` units and `least_words` words: the
shortest that begins at a unit, and the shortest that ends at one. Spans are hashed word by word
and joined globally; units covered by a span that occurs earlier elsewhere are removed. A repeated
passage of more than unit_words * (units - 1) words, cut at sentence ends, always holds a span,
and its own spans cover it from end to end. Spans are the same if two independent hashes of their
words are, 96 bits together: among 10 ** 11 spans the chance of one false match is under 10 ** -6.

With a `window` (op10 has one) texts are cut at sentence ends and, in place of the fixed stride, before
the word whose hash with the word before it is the least of some `window` neighbours. Whether a word
is such a place hangs on less than `window` words on either side, and one of every `window` words is.
So cuts line up whatever stands before a passage: of n repeated words at least n - 30 lie between
cuts that line up, of 51 words a run of 21, sentence ends or not, which is three units and more than
LEAST_WORDS; at most 2 * window - 1 words stay at an edge. Lines of fewer words than LEAST_WORDS that
many texts have are no spans and stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonehive.llm.store import cut
from tonehive.llm.textcore import SPACE_SEPARATED, Words, each_words, mix

UNITS = 3
UNIT_WORDS = 20
LEAST_WORDS = 20
WINDOW = 8

_BASE = np.uint64(0xA24BAED4963EE407)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?"]] = True


def _least_of(words: Words, window: int) -> np.ndarray:
    """Whether a word's hash, with the word before it, is the least of some `window` words of its text."""
    n = len(words.hash)
    before = np.concatenate([np.zeros(1, np.uint64), words.hash[:-1]])
    before[1:][words.text[1:] != words.text[:-1]] = 0
    h = mix(words.hash * _BASE + before)
    out = np.zeros(n, bool)
    if n >= window:
        inside = np.flatnonzero(words.text[: n - window + 1] == words.text[window - 1 :])
        out[inside + np.lib.stride_tricks.sliding_window_view(h, window)[inside].argmin(1)] = True
    return out


class Units:
    """Units of a run of texts: text number, first word and one past the last word of each."""

    def __init__(self, words: Words, unit_words: int, window: int | None = None):
        self.words = words
        n = len(words.hash)
        if not n:
            self.text = self.first = self.last = np.zeros(0, np.int64)
            self.bounds = np.zeros(words.texts + 1, np.int64)
            return
        lines = np.concatenate([[0], np.cumsum(words.bytes == 10)])
        ends = _ENDS[words.bytes[words.end - 1]]
        ends[:-1] |= (words.text[1:] != words.text[:-1]) | (lines[words.start[1:]] > lines[words.end[:-1]])
        ends[-1] = True
        starts = np.concatenate([[True], ends[:-1]])
        at = np.arange(n)
        within = at - np.maximum.accumulate(np.where(starts, at, 0))
        self.first = np.flatnonzero(within % unit_words == 0 if window is None else starts | _least_of(words, window))
        self.last = np.append(self.first[1:], n)
        self.text = words.text[self.first]
        self.bounds = np.searchsorted(self.text, np.arange(words.texts + 1))

    def spans(self, units: int, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first unit, last unit, hash, second hash) of every span."""
        n = len(self.first)
        if n < units:
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        edge = np.append(self.first, self.last[-1])
        i = np.arange(n)
        j = np.maximum(np.searchsorted(edge, edge[:-1] + least_words, "left") - 1, i + units - 1)
        ahead = j < n
        ahead[ahead] &= self.text[j[ahead]] == self.text[i[ahead]]
        k = np.minimum(np.searchsorted(edge, edge[1:] - least_words, "right") - 1, i - units + 1)
        back = k >= 0
        back[back] &= self.text[k[back]] == self.text[i[back]]
        pairs = np.unique(np.concatenate([i[ahead] * (n + 1) + j[ahead], k[back] * (n + 1) + i[back]]))
        a, b = pairs // (n + 1), pairs % (n + 1)
        m = len(self.words.hash)
        power, inverse = np.full(m, _BASE), np.full(m, _INVERSE)
        power[0] = inverse[0] = 1
        power, inverse = np.multiply.accumulate(power), np.multiply.accumulate(inverse)
        s, e = self.first[a], self.last[b]
        hashes = []
        for word in (self.words.hash, self.words.again()):
            total = np.zeros(m + 1, np.uint64)
            np.cumsum(word * power, out=total[1:])
            hashes.append(mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64)))
        return a, b, *hashes


#: Spans that a task compares with each other before it hands them on, at about 40 bytes each.
_HELD = 1 << 20
_SEEN = ["h", "g", "id", "rk", "at"]


class _Spans:
    """Spans as columns: hashes h and g, the row by id (or null) and rk, and in one number the first unit, how many more it has, and a flag."""

    def __init__(self, columns: list[np.ndarray], null: np.ndarray):
        self.columns, self.null = columns, null

    @staticmethod
    def of(batch: pa.RecordBatch) -> _Spans:
        ids = batch.column("id")
        return _Spans([batch.column(c).to_numpy() if c != "id" else ids.fill_null(0).to_numpy() for c in _SEEN], np.asarray(ids.is_null()))

    @staticmethod
    def joined(parts: list[_Spans]) -> _Spans:
        return _Spans([np.concatenate(x) for x in zip(*(p.columns for p in parts), strict=True)], np.concatenate([p.null for p in parts]))

    def take(self, rows: np.ndarray) -> _Spans:
        return _Spans([c[rows] for c in self.columns], self.null[rows])

    def batch(self, names: list[str]) -> pa.RecordBatch:
        columns = dict(zip(_SEEN, self.columns, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[c], mask=self.null) if c == "id" else pa.array(columns[c]) for c in names], names)

    def firsts(self) -> tuple[np.ndarray, np.ndarray]:
        """Of sorted spans: which begin a group of equal ones, and which are in the same place as the one that begins theirs."""
        h, g, ident, rk, at = self.columns
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
        return new, (ident == ident[first]) & (rk == rk[first]) & (at == at[first]) & (self.null == self.null[first])

    def combined(self) -> list[_Spans]:
        """The first of each group of equal spans; and the later ones, flagged and under a hash of their row."""
        order = np.argsort(self.columns[0], kind="stable")
        h = self.columns[0][order]
        twice = np.zeros(len(h), bool)
        twice[1:] = h[1:] == h[:-1]
        twice[:-1] |= twice[1:]
        some = self.take(order[twice])
        h, g, ident, rk, at = some.columns
        some = some.take(np.lexsort((at, rk, ident, some.null, g, h)))
        new, same = some.firsts()
        later = some.take(~same)
        later.columns[0] = mix(later.columns[2].view(np.uint64) + np.uint64(1)).view(np.int64)
        later.columns[1] = later.columns[3]
        later.columns[4] = later.columns[4] | 1
        return [self.take(order[~twice]), some.take(new), later]


def _occurrences(units: int, unit_words: int, least_words: int, window: int | None):
    """Every span; those that a task holds together are compared first, so that a span that very many texts have is few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[_Spans] = []
        size = 0
        for batch in batches:
            ids = batch.column("id")
            null, ids, rk = np.asarray(ids.is_null()), ids.fill_null(0).to_numpy(), batch.column("rk").to_numpy()
            for i, _, words in each_words(batch.column("text"), SPACE_SEPARATED):
                cut_up = Units(words, unit_words, window)
                a, b, h, g = cut_up.spans(units, least_words)
                if not len(a):
                    continue
                text = cut_up.text[a]
                at = (a - cut_up.bounds[text]) << 32 | (b - a) << 1
                held.append(_Spans([h.view(np.int64), (g >> np.uint64(32)).astype(np.uint32).view(np.int32), ids[text + i], rk[text + i], at], null[text + i]))
                size += len(a)
                if size >= _HELD:
                    yield from (x.batch(_SEEN) for x in _Spans.joined(held).combined())
                    held, size = [], 0
        if held:
            yield from (x.batch(_SEEN) for x in _Spans.joined(held).combined())

    return run


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that are not the first of their group; rows come sorted, each group in one run."""
    before: _Spans | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        spans = _Spans.of(batch)
        carried = 0 if before is None else 1
        if before is not None:
            spans = _Spans.joined([before, spans])
        new, same = spans.firsts()
        due = ~same | (spans.columns[4] % 2 == 1)
        due[:carried] = False
        yield spans.take(due).batch(["id", "rk", "at"])
        before = spans.take(np.flatnonzero(new)[-1:])


def _without(unit_words: int, window: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans")
            counts, removed, texts = [], [], []
            for i, j, words in each_words(batch.column("text"), SPACE_SEPARATED):
                cut_up = Units(words, unit_words, window)
                for t in range(i, j):
                    low, high = cut_up.bounds[t - i], cut_up.bounds[t - i + 1]
                    counts.append(int(high - low))
                    if not spans[t].is_valid:
                        removed.append(0)
                        texts.append(batch.column("text")[t].as_py())
                        continue
                    gone = np.zeros(high - low + 1, np.int32)
                    at = spans[t].values.to_numpy()
                    first = at >> 32
                    np.add.at(gone, first, 1)
                    np.add.at(gone, first + ((at & 0xFFFFFFFF) >> 1) + 1, -1)
                    gone = np.cumsum(gone)[:-1] > 0
                    removed.append(int(gone.sum()))
                    raw = (batch.column("text")[t].as_py() or "").encode()
                    base = words.at[t - i]
                    begin = words.start[cut_up.first[low:high]] - base
                    stop = np.append(begin[1:], len(raw))
                    kept = [raw[: begin[0]]] + [raw[x:y] for x, y, g in zip(begin, stop, gone, strict=True) if not g]
                    texts.append(b"".join(kept).decode().rstrip() if gone.all() or gone[-1] else b"".join(kept).decode())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], ["row", "text", "n_units", "n_removed"])

    return run


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", units: int = UNITS, unit_words: int = UNIT_WORDS, least_words: int = LEAST_WORDS, window: int | None = None) -> DataFrame:
    """doc_id, n_units, n_removed and the text without the units that an earlier span covers.

    The first occurrence of a span is the one of the least id (nulls last), then of the earlier
    place; it stays. Words are compared with A-Z lower-cased. Units that stay keep their bytes and
    the white space after them; at the end of a shortened text white space goes. A null text stays
    null, texts of fewer units than a span are unchanged, repeated rows with the same id and text
    are one document and come back alike. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # Rows are told apart by id and text; a text's hash only has to tell apart rows of one id.
    keyed = rows.withColumn("rk", F.hash("text"))
    seen = keyed.where("text is not null").mapInArrow(_occurrences(units, unit_words, least_words, window), "h long, g int, id long, rk int, at long")
    # Tasks have combined equal spans, so a group is at most a row or two for each _HELD spans there are.
    dealt = seen.repartition("h", "g").sortWithinPartitions("h", "g", F.col("id").asc_nulls_last(), "rk", "at")
    later = dealt.mapInArrow(_later, "id long, rk int, at long")
    gone = cut(later.groupBy(F.col("id").alias("_id"), F.col("rk").alias("_rk")).agg(F.collect_set("at").alias("spans")))
    both = keyed.join(gone, F.col("id").eqNullSafe(F.col("_id")) & (F.col("rk") == F.col("_rk")), "left").select(F.col("id").alias("row"), "text", "spans")
    out = both.mapInArrow(_without(unit_words, window), "row long, text string, n_units long, n_removed long")
    return out.select(F.col("row").alias("doc_id"), "n_units", "n_removed", "text")
