"""Language identification by interpolated Kneser-Ney character models.

One four-gram model for each language over lower-cased letters and single spaces. Grams are kept
as 64-bit hashes in sorted arrays: the top order once for all languages, with a column of log
probabilities for each, so that a character costs one binary search; grams that no language has
seen fall back through the lower orders. The language with the least cross-entropy a character
wins; a cross-entropy far above what the language's own training texts show marks a rejection.

Grams are counted over all training texts, on the cluster, and all of them are in the models. Up to
TOTAL_GRAMS of them, of LANGUAGES languages at most, the models are sent to the tasks whole. Beyond,
they stay tables: the most frequent grams are sent with their log probabilities, and the grams of the
texts that are not among those are joined with the tables. Both give the same probabilities; what is
sent to the driver and to the tasks has at most TOTAL_GRAMS * LANGUAGES numbers, 200 MB.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonehive.llm.store import cut
from tonehive.llm.textcore import mix

ORDER = 4
#: Four-grams of all models together that are sent to the tasks; the others are looked up by joins.
TOTAL_GRAMS = 500_000
#: Languages whose models are sent whole; by default a table with more of them is refused.
LANGUAGES = 100
#: Distinct grams that a task counts before it hands them on.
_HELD = 1 << 20
#: Number of characters over which the lowest order spreads what it holds back.
ALPHABET = 4096
#: Cross-entropy is too high if it is so many deviations above the mean of all training texts of the language.
DEVIATIONS = 5.0
#: Characters that count as independent evidence in the score, at most.
EVIDENCE = 30
UNDETERMINED = "und"

_PIECE = 1 << 18
_letter_table: np.ndarray | None = None


def _letters_of_plane() -> np.ndarray:
    global _letter_table
    if _letter_table is None:
        _letter_table = np.fromiter((chr(i).isalpha() for i in range(1 << 16)), bool, 1 << 16)
        _letter_table[0xFFFF] = True  # stands for letters beyond the basic plane
    return _letter_table


def normalised(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts, each after three spaces, and where each text's own codes begin and end (n, 2)."""
    lowered = [(t or "").lower() for t in texts]
    length = np.fromiter(map(len, lowered), np.int64, len(lowered))
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    far = code > 0xFFFF
    if far.any():
        code = code.copy()
        values, which = np.unique(code[far], return_inverse=True)
        code[far] = np.where([chr(v).isalpha() for v in values], 0xFFFF, 0x20)[which]
    code = np.where(_letters_of_plane()[code], code, 0x20).astype(np.uint64)
    text = np.repeat(np.arange(len(lowered)), length)
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0x20) | (code[:-1] != 0x20) | (text[1:] != text[:-1])
    code, text = code[keep], text[keep]
    count = np.bincount(text, minlength=len(lowered))
    stop = np.cumsum(count + ORDER - 1)
    start = stop - count
    out = np.full(int(stop[-1]) if len(stop) else 0, 0x20, np.uint64)
    out[np.arange(len(code)) + (ORDER - 1) * (text + 1)] = code
    return out, np.stack([start, stop], axis=1)


def grams(code: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed four-gram ending at each character of a text, text number)."""
    own = spans[:, 1] - spans[:, 0]
    text = np.repeat(np.arange(len(spans)), own)
    at = np.arange(len(text)) + (ORDER - 1) * (text + 1)
    return code[at - 3] << np.uint64(48) | code[at - 2] << np.uint64(32) | code[at - 1] << np.uint64(16) | code[at], text


def _find(sorted_hashes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, found) of packed grams in a sorted array of hashes."""
    h = mix(keys)
    if not len(sorted_hashes):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_hashes, h), len(sorted_hashes) - 1)
    return at, sorted_hashes[at] == h


class _Order:
    """Discounted counts of one order of one language, by sorted hashes of grams and of contexts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        once, twice = int((counts == 1).sum()), int((counts == 2).sum())
        discount = once / (once + 2 * twice) if once and twice else 0.5
        h = mix(keys)
        order = np.argsort(h)
        self.hashes, self.mass = h[order], np.maximum(counts - discount, 0.0)[order]
        contexts, which = np.unique(keys >> np.uint64(16), return_inverse=True)
        total, kinds = np.bincount(which, counts), np.bincount(which)
        h = mix(contexts)
        order = np.argsort(h)
        self.contexts, self.total, self.held = h[order], total[order], discount * kinds[order] / total[order]


class KneserNey:
    """Interpolated Kneser-Ney model of one language, from counts of packed four-grams."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.orders: list[_Order] = []
        for n in range(ORDER, 0, -1):
            self.orders.append(_Order(keys, counts.astype(float)))
            if n > 1:  # lower orders count the kinds of characters that stand before a gram
                keys, counts = np.unique(keys & np.uint64((1 << (16 * (n - 1))) - 1), return_counts=True)

    def probability(self, keys: np.ndarray, level: int = 0) -> np.ndarray:
        if level == ORDER:
            return np.full(len(keys), 1.0 / ALPHABET)
        o, n = self.orders[level], ORDER - level
        lower = self.probability(keys & np.uint64((1 << (16 * (n - 1))) - 1), level + 1)
        at, known = _find(o.contexts, keys >> np.uint64(16))
        k, seen = _find(o.hashes, keys)
        own = np.where(seen, o.mass[k], 0.0) / o.total[at] + o.held[at] * lower
        return np.where(known, own, lower)


@dataclass
class Identifier:
    """All models."""

    names: list[str]
    models: list[KneserNey]
    hashes: np.ndarray
    table: np.ndarray

    @staticmethod
    def build(counted: list[tuple[str, np.ndarray, np.ndarray]]) -> Identifier:
        models = [KneserNey(keys, counts) for _, keys, counts in counted]
        union = np.unique(np.concatenate([keys for _, keys, _ in counted]))
        union = union[np.argsort(mix(union))]
        table = np.stack([np.log(m.probability(union)) for m in models], axis=1).astype(np.float32)
        return Identifier([c[0] for c in counted], models, mix(union), table)

    def nats(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nats by language, characters, has a letter) of each text."""
        code, spans = normalised(texts)
        keys, text = grams(code, spans)
        at, found = _find(self.hashes, keys)
        count = spans[:, 1] - spans[:, 0]
        total = np.zeros((len(texts), len(self.names)))
        missed, which = np.unique(keys[~found], return_inverse=True)
        for k, model in enumerate(self.models):
            value = np.zeros(len(keys))
            value[found] = self.table[at[found], k]
            if len(missed):
                value[~found] = np.log(model.probability(missed))[which]
            total[:, k] = np.bincount(text, value, minlength=len(texts))
        letter = np.bincount(text, (keys & np.uint64(0xFFFF)) != 0x20, minlength=len(texts)) > 0
        return -total, count, letter


def _in_pieces(column: pa.Array) -> Iterator[list[str | None]]:
    piece: list[str | None] = []
    size = 0
    for t in column.to_pylist():
        piece.append(t)
        size += len(t or "")
        if size >= _PIECE:
            yield piece
            piece, size = [], 0
    if piece:
        yield piece


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several (keys, counts), with their sums."""
    keys, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(which, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, g, n: how often each gram occurs in the texts of a task, in parts if there are many."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def counts() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            keys, times = _merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()).take(pa.array(np.zeros(len(keys), np.int64))), pa.array(keys.view(np.int64)), pa.array(times)], ["lang", "g", "n"])

    for batch in batches:
        for lang in sorted(set(batch.column("lang").to_pylist())):
            own = batch.filter(pc.equal(batch.column("lang"), lang))
            for texts in _in_pieces(own.column("text")):
                part = np.unique(grams(*normalised(texts))[0], return_counts=True)
                held[lang] = [_merged([*held.get(lang, []), part])]
        if sum(len(parts[0][0]) for parts in held.values()) > _HELD:
            yield from counts()
            held.clear()
    yield from counts()


def count_grams(texts: DataFrame) -> DataFrame:
    """lang, g, n: how often each gram occurs in all (text, lang), copies as often as they occur."""
    rows = texts.where("text is not null and lang is not null").select("text", "lang")
    return cut(rows.mapInArrow(_counted, "lang string, g long, n long").groupBy("lang", "g").agg(F.sum("n").alias("n")))


def train(counted: DataFrame, names: list[str]) -> Identifier | None:
    """Models of the languages in `names` from all of their grams; None without languages."""
    got = counted.orderBy("lang", "g").toArrow()
    lang, keys, counts = np.array(got["lang"].to_pylist(), dtype=object), got["g"].to_numpy().view(np.uint64), got["n"].to_numpy()
    models = []
    for name in sorted(names):
        own = lang == name
        order = np.argsort(keys[own])
        models.append((name, keys[own][order], counts[own][order]))
    return Identifier.build(models) if models else None


def _outcome(names: list[str], total: np.ndarray, count: np.ndarray, letter: np.ndarray, taught: list[str | None]) -> list[list]:
    """Prediction, score, cross-entropy and that of the taught language, from the nats of whole texts by language."""
    ce = total / np.maximum(count, 1)[:, None]
    best = ce.argmin(1)
    z = -ce * np.minimum(count, EVIDENCE)[:, None]
    p = np.exp(z - z.max(1, keepdims=True))
    p = p[np.arange(len(p)), best] / p.sum(1)
    low = ce[np.arange(len(ce)), best]
    at = {name: k for k, name in enumerate(names)}
    out: list[list] = [[], [], [], []]
    for i, lang in enumerate(taught):
        known = bool(letter[i])
        out[0].append(names[best[i]] if known else UNDETERMINED)
        out[1].append(round(float(p[i]), 6) if known else 0.0)
        out[2].append(round(float(low[i]), 6) if known else None)
        out[3].append(float(ce[i, at[lang]]) if known and lang in at else None)
    return out


def _predicted(batch: pa.RecordBatch, columns: list[list]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.float64(), pa.float64(), pa.float64())
    arrays = [batch.column(c) for c in ("doc_id", "held_out", "taught")] + [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "taught", "lang_pred", "score", "cross_entropy", "own"])


def _predictor(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Identifier | None = sent.value
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            taught = batch.column("taught").to_pylist()
            for texts in _in_pieces(batch.column("text")):
                if model is None:
                    parts = [[UNDETERMINED] * len(texts), [0.0] * len(texts), [None] * len(texts), [None] * len(texts)]
                else:
                    done = len(columns[0])
                    parts = _outcome(model.names, *model.nats(texts), taught[done : done + len(texts)])
                for column, part in zip(columns, parts, strict=True):
                    column += part
            yield _predicted(batch, columns)

    return run


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, max(rows.shape[1], 1)), pa.int32()), pa.array(rows.ravel(), pa.float64()))


def _matrix(column: pa.ListArray, width: int, missing: float = 0.0) -> np.ndarray:
    """Rows of a column of lists of `width` numbers; a null is a row of `missing`."""
    out = np.full((len(column), width), missing)
    given = np.asarray(column.is_valid())
    out[given] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return out


def _spread(column: pa.ListArray, field: str, width: int) -> np.ndarray:
    """Rows by language of a column of lists of (k, ...); languages that are not listed have 0."""
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
    listed = column.flatten()
    out[row, listed.field("k").to_numpy(zero_copy_only=False)] = listed.field(field).to_numpy(zero_copy_only=False)
    return out


def _slices(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    step = max(1, (1 << 20) // max(width, 1))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def _level(discount: np.ndarray):
    """g, p: probabilities by language of grams of one order, from their counts, their contexts and the next lower order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, len(discount)):
                n = _spread(batch.column("own"), "n", len(discount))
                total, kinds = (_spread(batch.column("context"), f, len(discount)) for f in ("total", "kinds"))
                lower = _matrix(batch.column("lower"), len(discount), 1.0 / ALPHABET)
                divisor = np.maximum(total, 1)
                p = np.where(total > 0, np.maximum(n - discount, 0) / divisor + discount * kinds / divisor * lower, lower)
                yield pa.RecordBatch.from_arrays([batch.column("g"), _lists(p)], ["g", "p"])

    return run


def _sums(width: int):
    """pk, rare: nats by language of the rare grams of each text; a task's rows come sorted by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.zeros(width)
        for whole in batches:
            for batch in _slices(whole, width):
                pk = batch.column("pk").to_numpy()
                first = np.flatnonzero(np.r_[True, pk[1:] != pk[:-1]])
                sums = np.add.reduceat(-np.log(_matrix(batch.column("p"), width)) * batch.column("n").to_numpy()[:, None], first, axis=0)
                if last == pk[0]:
                    sums[0] += held
                elif last is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), _lists(held[None])], ["pk", "rare"])
                last, held = int(pk[-1]), sums[-1].copy()
                if len(first) > 1:
                    yield pa.RecordBatch.from_arrays([pa.array(pk[first[:-1]]), _lists(sums[:-1])], ["pk", "rare"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), _lists(held[None])], ["pk", "rare"])

    return run


def _scanned(sent, width: int):
    """Nats by language of each text's frequent grams, and its other grams with how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, table = sent.value
        for batch in (part for whole in batches for part in _slices(whole, width)):
            sums, counts, letters, rare, times, sizes = [], [], [], [], [], []
            for texts in _in_pieces(batch.column("text")):
                code, spans = normalised(texts)
                keys, text = grams(code, spans)
                at = np.minimum(np.searchsorted(hot, keys), max(len(hot) - 1, 0))
                found = hot[at] == keys if len(hot) else np.zeros(len(keys), bool)
                sums.append(np.stack([np.bincount(text[found], table[at[found], k], len(texts)) for k in range(width)], axis=1))
                counts.append(spans[:, 1] - spans[:, 0])
                letters.append(np.bincount(text, (keys & np.uint64(0xFFFF)) != 0x20, len(texts)) > 0)
                key, own = keys[~found], text[~found]
                order = np.lexsort((key, own))
                key, own = key[order], own[order]
                first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (own[1:] != own[:-1])][: len(key)])
                rare.append(key[first])
                times.append(np.diff(np.r_[first, len(key)]))
                sizes.append(np.bincount(own[first], minlength=len(texts)))
            if not sums:
                continue
            ends = pa.array(np.r_[0, np.cumsum(np.concatenate(sizes))], pa.int32())
            listed = pa.StructArray.from_arrays([pa.array(np.concatenate(rare).view(np.int64)), pa.array(np.concatenate(times).astype(np.int64))], ["g", "n"])
            own_columns = [_lists(np.concatenate(sums)), pa.array(np.concatenate(counts).astype(np.int64)), pa.array(np.concatenate(letters)), pa.ListArray.from_arrays(ends, listed)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "held_out", "taught")] + own_columns, ["doc_id", "held_out", "taught", "hot", "chars", "letter", "others"])

    return run


def _judged(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, len(names)):
                total = _matrix(batch.column("hot"), len(names)) + _matrix(batch.column("rare"), len(names))
                columns = _outcome(names, total, batch.column("chars").to_numpy(), np.asarray(batch.column("letter")), batch.column("taught").to_pylist())
                yield _predicted(batch, columns)

    return run


def _lowest(n: int) -> Column:
    """The last `n` characters of a packed gram."""
    return F.col("g").bitwiseAND(F.lit((1 << 16 * n) - 1 if n < ORDER else -1))


class _Tables:
    """Models of any number of grams as tables: of each order its grams, its contexts and its discounts by language."""

    def __init__(self, counted: DataFrame, names: list[str]):
        spark = counted.sparkSession
        numbered = spark.createDataFrame(list(enumerate(names)), "k int, lang string")
        self.width = len(names)
        self.orders: dict[int, tuple[DataFrame, DataFrame, np.ndarray]] = {}
        now = cut(counted.join(F.broadcast(numbered), "lang").select("k", "g", "n"))
        self.counts = now
        for order in range(ORDER, 0, -1):
            discount = np.full(self.width, 0.5)
            for r in now.where("n <= 2").groupBy("k").agg(F.sum((F.col("n") == 1).cast("long")).alias("once"), F.sum((F.col("n") == 2).cast("long")).alias("twice")).collect():
                if r.once and r.twice:
                    discount[r.k] = r.once / (r.once + 2 * r.twice)
            own = now.groupBy("g").agg(F.collect_list(F.struct("k", "n")).alias("own"))
            totals = now.groupBy(F.shiftrightunsigned("g", 16).alias("c"), "k").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
            self.orders[order] = own, totals.groupBy("c").agg(F.collect_list(F.struct("k", "total", "kinds")).alias("context")), discount
            if order > 1:
                now = cut(now.groupBy("k", _lowest(order - 1).alias("g")).agg(F.count("*").alias("n")))

    def probabilities(self, keys: DataFrame) -> DataFrame:
        """g, p: probabilities by language of the distinct grams `g`."""
        lower = None
        for order in range(1, ORDER + 1):
            own, contexts, discount = self.orders[order]
            rows = keys.select(_lowest(order).alias("g")).distinct().withColumn("c", F.shiftrightunsigned("g", 16)).withColumn("l", _lowest(order - 1))
            rows = rows.join(own, "g", "left").join(contexts, "c", "left")
            rows = rows.withColumn("lower", F.lit(None).cast("array<double>")) if lower is None else rows.join(lower.select(F.col("g").alias("l"), F.col("p").alias("lower")), "l", "left")
            lower = cut(rows.select("g", "own", "context", "lower").mapInArrow(_level(discount), "g long, p array<double>"))
        return lower


def _by_tables(read: DataFrame, counted: DataFrame, names: list[str], most: int, schema: str, kind: str) -> DataFrame:
    """Predictions where the models are too large to be sent: at most `most` frequent grams are, the others are joined."""
    tables = _Tables(counted, names)
    often = tables.counts.groupBy("g").agg(F.sum("n").alias("n")).select("g", F.floor(F.log2("n") + 1e-9).cast("int").alias("b"))
    sizes = {r.b: r.k for r in often.groupBy("b").agg(F.count("*").alias("k")).collect()}  # at most 64 rows
    kept, least = 0, 64
    while least > 0 and kept + sizes.get(least - 1, 0) <= most:
        least -= 1
        kept += sizes.get(least, 0)
    got = tables.probabilities(often.where(F.col("b") >= least).select("g")).toArrow()
    keys = got["g"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    table = -np.log(_matrix(got["p"].combine_chunks(), len(names))[order])
    sent = read.sparkSession.sparkContext.broadcast((keys[order], table.astype(np.float32)))
    scan = read.mapInArrow(_scanned(sent, len(names)), f"doc_id {kind}, held_out boolean, taught string, hot array<double>, chars long, letter boolean, others array<struct<g:long,n:long>>")
    scanned = cut(scan.withColumn("pk", F.monotonically_increasing_id()))  # fixed by being written
    others = scanned.select("pk", F.inline("others"))
    rare = others.join(tables.probabilities(others.select("g")), "g").select("pk", "g", "n", "p")
    sums = rare.repartition("pk").sortWithinPartitions("pk", "g").select("pk", "n", "p").mapInArrow(_sums(len(names)), "pk long, rare array<double>")
    return cut(scanned.drop("others").join(sums, "pk", "left").mapInArrow(_judged(names), schema))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, total_grams: int = TOTAL_GRAMS, languages: int | None = LANGUAGES) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy and rejected for every row of documents.

    Models are learned from texts with a language whose crc32(doc_id) mod 4 is not 2; a null doc_id
    is neither held out nor learned from. All their grams count; if there are more than `total_grams`,
    the rarer ones are looked up by joins. A table with more than `languages` languages is refused;
    None takes any number of them. A prediction depends on the text alone. A text is rejected
    if its cross-entropy is DEVIATIONS deviations above the mean of all training texts of the
    language. A text that is null, empty or without a letter is `und` with score 0 and rejected; so
    is everything if nothing can be learned. Texts are read whole, in pieces of many texts or of one
    long one. Ties go to the language that sorts first; repeated rows are predicted alike. Other
    columns are not read. An empty table gives an empty result.
    """
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    teaches = ~F.col("held_out") & F.col("doc_id").isNotNull()
    counted = count_grams(rows.where(teaches))
    lettered = counted.where(F.col("g").bitwiseAND(F.lit(0xFFFF)) != 0x20).select("lang").distinct()
    names = sorted(r.lang for r in (lettered if languages is None else lettered.limit(languages + 1)).collect())
    if languages is not None and len(names) > languages:
        raise ValueError(f"more than {languages} languages to learn")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, taught string, lang_pred string, score double, cross_entropy double, own double"
    read = rows.select("doc_id", "held_out", F.when(teaches, F.col("lang")).alias("taught"), "text")
    if len(names) <= LANGUAGES and counted.count() <= total_grams:
        sent = docs.sparkSession.sparkContext.broadcast(train(counted, names))
        found = cut(read.mapInArrow(_predictor(sent), schema))
    else:
        found = _by_tables(read, counted, names, total_grams if len(names) <= LANGUAGES else total_grams * LANGUAGES // len(names), schema, kind)
    spread = found.where("own is not null").groupBy(F.col("taught").alias("_l")).agg((F.avg("own") + DEVIATIONS * F.greatest(F.coalesce(F.stddev_pop("own"), F.lit(0.0)), F.lit(0.05))).alias("_limit"))
    out = found.join(F.broadcast(spread), F.col("lang_pred") == F.col("_l"), "left")  # a row for each language
    rejected = F.col("cross_entropy").isNull() | F.coalesce(F.col("cross_entropy") > F.col("_limit"), F.lit(False))
    return out.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", rejected.alias("rejected"))
