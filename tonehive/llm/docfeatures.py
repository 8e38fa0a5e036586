"""Numeric features of whole texts, and linear classifiers fitted on a bounded labelled sample."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonehive.llm.store import cut
from tonehive.llm.textcore import ALPHANUMERIC, SPACE_SEPARATED, Words, buffers, each_words, mix, pieces

#: Labelled rows that a classifier is fitted on, at most (in expectation).
SAMPLE_ROWS = 20_000
#: Marks kept of a class, at most, those with the most evidence (none is left out before that bound).
LEXICON_MARKS = 50_000
#: A mark is in at least this many texts of its class ...
LEXICON_TEXTS = 5
#: ... is at least this many times as frequent there as elsewhere ...
LEXICON_RATIO = 8.0
#: ... and so unevenly spread that among all candidates exp(-LEXICON_SURE) marks are expected by chance.
LEXICON_SURE = 4.0
#: Candidates are words, their first START bytes and the runs of GRAM bytes in them, each once, twice or up to TIMES times in a text.
START, GRAM, TIMES = 5, 6, 3
#: Log ratios beyond these, of all marks of a text and of its strongest, tell no more: a language with
#: few marks is not outweighed by one with many.
ENOUGH, STRONG = 8.0, 3.0
#: Marks are also summed by hash in so many numbers of their own, so that the fit can weigh rare ones by themselves.
BUCKETS = 128
NAMES = ["symbols", "upper", "digits", "pipes", "repeats", "distinct", "word_bytes", "log_words"]

_CLASSES = np.zeros((4, 256), bool)
_CLASSES[0, [ord(c) for c in "#$%&*@^~<>=+_{}[]\\/|!"]] = True
_CLASSES[1, ord("A") : ord("Z") + 1] = True
_CLASSES[2, ord("0") : ord("9") + 1] = True
_CLASSES[3, ord("|")] = True


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every word, word start and run of GRAM bytes of a word."""
    raw = np.concatenate([words.bytes, np.zeros(GRAM, np.uint8)]).astype(np.uint64)
    size = words.end - words.start
    packed = np.zeros(len(words.bytes), np.uint64)
    for k in range(GRAM):
        packed |= raw[k : k + len(packed)] << np.uint64(8 * k)
    start = packed[words.start] & (np.uint64(1) << (8 * np.minimum(size, START)).astype(np.uint64)) - np.uint64(1)
    count = np.maximum(size - GRAM + 1, 0)
    at = np.repeat(words.start - np.cumsum(count) + count, count) + np.arange(count.sum())
    hashes = np.concatenate([mix(words.hash), mix(start | np.uint64(1 << 62)), mix(packed[at] | np.uint64(1 << 63))])
    return np.concatenate([words.text, words.text, np.repeat(words.text, count)]), hashes


def _counted(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, times) of each distinct pair, in order."""
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(np.append(at, len(hashes)))


@dataclass(frozen=True)
class Lexicon:
    """Sorted hashes of marks, and for each of them, each class and 1 to TIMES occurrences the weight in a text."""

    hashes: np.ndarray
    weights: np.ndarray

    @staticmethod
    def of(marks: list[tuple[int, int, int, float]], classes: int) -> Lexicon:
        """From (hash as a signed number, class, times, weight)."""
        signed = np.array([m[0] for m in marks], np.int64)
        hashes, at = np.unique(signed.view(np.uint64), return_inverse=True)
        weights = np.zeros((len(hashes), classes, TIMES))
        for i, (_, c, times, weight) in zip(at, marks, strict=True):
            weights[i, c, times - 1] = weight
        return Lexicon(hashes, weights)

    def found(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A row for each text: for each class, the sum and the greatest of the weights of the marks in it; and sums by bucket."""
        out, top = np.zeros((2, words.texts, self.weights.shape[1]))
        by_hash = np.zeros((words.texts, BUCKETS))
        if len(self.hashes) and len(words.hash):
            text, hashes = _grams(words)
            k = np.zeros(1 << 20, bool)
            low = np.uint64((1 << 20) - 1)
            k[self.hashes & low] = True
            near = np.flatnonzero(k[hashes & low])
            text, hashes = text[near], hashes[near]
            k = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[k] == hashes
            text, k, times = _counted(text[hit], k[hit])
            for least in range(1, TIMES + 1):
                reached = times >= least
                weights = self.weights[k[reached], :, least - 1]
                np.add.at(out, text[reached], weights)
                np.maximum.at(top, text[reached], weights)
                np.add.at(by_hash, (text[reached], (self.hashes[k[reached]] % np.uint64(BUCKETS)).astype(np.int64)), weights.sum(1))
        return out, top, by_hash


def features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """A row of numbers for each text; of zeros for a null or wordless one."""
    data, offsets = buffers(column)
    out = np.zeros((len(offsets) - 1, len(NAMES) + 3 * lexicon.weights.shape[1] + BUCKETS))
    for i, j in pieces(offsets):
        raw, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        words = Words(raw, at, SPACE_SEPARATED)
        n = np.diff(words.bounds)
        sums = np.stack([np.diff(np.concatenate([[0], np.cumsum(c[raw])])[at]) for c in _CLASSES])
        letters = np.maximum(np.diff(at) - n, 1)
        count = np.maximum(n, 1)
        h, text = words.hash, words.text
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
        within = np.arange(len(h)) - words.bounds[:-1][text]
        group = mix(h + (text.astype(np.uint64) * np.uint64(1 << 20) + (within // 64).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(group)
        fresh = np.ones(len(h), bool)
        fresh[order[1:]] = group[order[1:]] != group[order[:-1]]
        by_text = lambda x: np.bincount(text, x, minlength=j - i)
        marks, strongest, by_hash = lexicon.found(Words(raw, at, ALPHANUMERIC))
        rows = np.stack(
            [
                sums[0] / letters,
                sums[1] / letters,
                sums[2] / letters,
                sums[3] / count,
                by_text(same) / count,
                np.where(n > 0, by_text(fresh) / count, 1.0),
                letters / count,
                np.log1p(n),
                *np.log1p(marks).T,
                *np.minimum(marks, ENOUGH).T,
                *np.minimum(strongest, STRONG).T,
                *by_hash.T,
            ],
            axis=1,
        )
        rows[n == 0] = 0.0
        out[i:j] = rows
    return out


@dataclass(frozen=True)
class Linear:
    """Softmax regression: class names, their shares in the sample, a lexicon and weights."""

    names: list
    prior: np.ndarray
    lexicon: Lexicon
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def judged(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(posteriors, words) of each text."""
        found = features(column, self.lexicon)
        x = np.clip((found - self.centre) / self.scale, -8, 8)
        z = np.concatenate([x, np.ones((len(x), 1))], axis=1) @ self.weights
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True), np.round(np.expm1(found[:, NAMES.index("log_words")]))

    def posteriors(self, column: pa.Array) -> np.ndarray:
        return self.judged(column)[0]


def bounded(labels: DataFrame, limit: int = SAMPLE_ROWS) -> DataFrame:
    """About `limit` rows of (doc_id, y), chosen by a hash of doc_id, or all if there are fewer.

    So the result may be broadcast: it has at most `limit` rows in expectation, of a few bytes.
    """
    known = labels.where("doc_id is not null and y is not null")
    n = known.count()
    if n <= limit:
        return known
    return known.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) < int((1 << 30) * limit / n))


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each class hold a candidate `times` times or more."""
    for batch in batches:
        labels = np.array(batch.column("y").to_pylist(), object)
        for i, j, words in each_words(batch.column("text"), ALPHANUMERIC):
            text, hashes, times = _counted(*_grams(words))
            for c in sorted(set(labels[i:j])):
                own = labels[i:j][text] == c
                for least in range(1, TIMES + 1):
                    value, k = np.unique(hashes[own & (times >= least)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([c] * len(value), pa.string()), pa.array(value.view(np.int64)), pa.array(np.full(len(value), least, np.int32)), pa.array(k.astype(np.int64))], ["y", "w", "times", "k"])


def _lexicon(sample: DataFrame, total: dict[str, int]) -> Lexicon:
    """Marks of every class of the sample (text, y).

    Support is a number of texts and not a share of the class, so that the marks of one of many
    languages in a class count as much as those of a language that most of the class is in.
    """
    names, n = sorted(total), float(sum(total.values()))
    sizes = sample.sparkSession.createDataFrame([(y, float(k)) for y, k in total.items()], "y string, size double")
    counted = cut(sample.mapInArrow(_gram_counts, "y string, w long, times int, k long").groupBy("y", "w", "times").agg(F.sum("k").alias("k")))
    everywhere = cut(counted.groupBy("w", "times").agg(F.sum("k").alias("all")).where(F.col("all") >= LEXICON_TEXTS))
    tested = everywhere.count() * len(names)
    frequent = counted.where(F.col("k") >= LEXICON_TEXTS).join(everywhere, ["w", "times"]).join(F.broadcast(sizes), "y")
    rate = lambda k, size: (k + 0.5) / (size + 1.0)
    share, chance = F.col("k") / F.col("all"), F.col("size") / n
    ratio: Column = rate(F.col("k"), F.col("size")) / rate(F.col("all") - F.col("k"), F.lit(n) - F.col("size"))
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - chance))).otherwise(0.0)
    # Chernoff's bound on the chance of so many of the class among the texts that hold the candidate.
    evidence = F.col("all") * (share * F.log(share / chance) + rest)
    marks = frequent.where((F.col("size") < n) & (share > chance)).withColumn("ratio", ratio).withColumn("evidence", evidence)
    marks = marks.where((F.col("ratio") >= LEXICON_RATIO) & (F.col("evidence") >= LEXICON_SURE + float(np.log(max(tested, 1)))))
    found = []
    for c, y in enumerate(names):
        best = marks.where(F.col("y") == y).orderBy(F.desc("evidence"), "w", "times").limit(LEXICON_MARKS)
        found += [(r.w, c, r.times, float(np.log(r.ratio))) for r in best.select("w", "times", "ratio").collect()]
    return Lexicon.of(found, len(names))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least shingle hash of each text: near copies mostly have the same."""
    for batch in batches:
        least = []
        data, offsets = buffers(batch.column("text"))
        for i, j in pieces(offsets):
            hashes, bounds = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], SPACE_SEPARATED).sets(5)
            least.extend(int(hashes[a].view(np.int64)) if b > a else 0 for a, b in zip(bounds[:-1], bounds[1:], strict=True))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.int64())], [*batch.schema.names, "sketch"])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, rounds: int = 400, ridge: float = 1e-3) -> Linear | None:
    """A classifier from docs (doc_id, text) and labels (doc_id, y); None if no text is labelled.

    About `sample_rows` labels are used at most, and of the texts one of each group with the same
    least shingle hash, so that many copies of a text do not pass for many texts. What comes to
    the driver is a row of numbers for each of them and at most LEXICON_MARKS marks of a class.
    """
    y = bounded(labels.select("doc_id", F.col("y").cast("string").alias("y")), sample_rows)
    rows = docs.where("text is not null").join(F.broadcast(y), "doc_id").select("text", "y")
    sample = rows.mapInArrow(_sketch, "text string, y string, sketch long").dropDuplicates(["y", "sketch"]).select("text", "y")
    sample = cut(sample)
    total = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).limit(1000).collect()}
    if not total:
        return None
    names = sorted(total)
    lexicon = _lexicon(sample, total)
    width = len(NAMES) + 3 * len(names) + BUCKETS

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column("text"), lexicon)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * width), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("y"), flat], ["y", "x"])

    got = sample.mapInArrow(numbers, "y string, x array<double>").toArrow()
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(-1, width)
    y = np.searchsorted(names, np.array(got["y"].to_pylist()))
    order = np.lexsort((*x.T, y))  # the same fit whatever the order of arrival
    x, y = x[order], y[order]
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.concatenate([np.clip((x - centre) / scale, -8, 8), np.ones((len(x), 1))], axis=1)
    target = np.eye(len(names))[y]
    w = np.zeros((z.shape[1], len(names)))
    momentum, step = w.copy(), 1.0 / (0.5 * np.linalg.eigvalsh(z.T @ z / len(z))[-1] + ridge)
    for r in range(rounds):
        p = momentum_logits = z @ momentum
        p = np.exp(p - momentum_logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        new = momentum - step * (z.T @ (p - target) / len(z) + ridge * momentum)
        momentum = new + r / (r + 3) * (new - w)
        w = new
    return Linear(names, target.mean(0), lexicon, centre, scale, w)
