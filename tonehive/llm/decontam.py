"""Benchmark decontamination by a hash set of normalised test n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonehive.llm.pii import gathered
from tonehive.llm.store import cut
from tonehive.llm.textcore import ALPHANUMERIC, Words, each_words

WINDOW = 13
#: Windows of the benchmark that are sent to every task, at about 150 bytes each; more go through a join.
BROADCAST_WINDOWS = 500_000

_OUT = "n_words long, n_hit long, items array<string>, hits array<struct<start:int,end:int>>"


class _Lookup:
    """Benchmark windows by hash, with what they spell and which items have them."""

    def __init__(self, rows: list[tuple[int, int, bytes, list[str]]]):
        self.sizes = sorted({r[1] for r in rows})
        self.spelled: dict[int, list[tuple[bytes, list[str]]]] = {}
        for h, _, text, items in rows:
            self.spelled.setdefault(h & 0xFFFFFFFFFFFFFFFF, []).append((text, items))
        self.hashes = np.array(sorted(self.spelled), np.uint64)
        self.marks = np.zeros(1 << 20, bool)
        self.marks[(self.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def find(self, words: Words) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, size, items) of every confirmed occurrence."""
        for size in self.sizes:
            at, h = words.runs(size)
            maybe = self.marks[(h & np.uint64((1 << 20) - 1)).astype(np.int64)]
            at, h = at[maybe], h[maybe]
            if not len(at):
                continue
            k = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            for i in np.flatnonzero(self.hashes[k] == h):
                text = words.spelled(int(at[i]), size)
                for spelled, items in self.spelled[int(h[i])]:
                    if spelled == text:
                        yield int(at[i]), size, items


class _Sent:
    """What is broadcast: windows as rows. A worker builds the lookup once and keeps it for its later tasks."""

    def __init__(self, rows: list[tuple[int, int, bytes, list[str]]]):
        self.rows = rows
        self.built: _Lookup | None = None

    def lookup(self) -> _Lookup:
        if self.built is None:
            self.built = _Lookup(self.rows)
        return self.built


def _item_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item").to_pylist()
            out: list[tuple] = []
            for i, _, words in each_words(batch.column("text"), ALPHANUMERIC):
                count = np.diff(words.bounds)
                sizes = np.minimum(count, window)
                for size in np.unique(sizes[sizes > 0]):
                    at, h = words.runs(int(size))
                    for k, x in zip(at, h.view(np.int64), strict=True):
                        if sizes[words.text[k]] == size:
                            out.append((int(x), int(size), words.spelled(int(k), int(size)), ids[i + words.text[k]]))
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            types = [pa.int64(), pa.int32(), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["h", "size", "spelled", "item"])

    return run


def _scan(column: pa.Array, lookup_of) -> tuple[list, list, list, list]:
    n_words, n_hit, all_items, all_hits = [], [], [], []
    for i, j, words in each_words(column, ALPHANUMERIC):
        covered = np.zeros(len(words.hash) + 1, np.int32)
        items: list[set[str]] = [set() for _ in range(j - i)]
        for at, size, found in lookup_of(i, j, words):
            covered[at] += 1
            covered[at + size] -= 1
            items[words.text[at]].update(found)
        hit = np.cumsum(covered)[:-1] > 0
        sums = np.concatenate([[0], np.cumsum(hit)])
        per_text = sums[words.bounds[1:]] - sums[words.bounds[:-1]]
        chars = None
        for t in range(j - i):
            a, b = words.bounds[t], words.bounds[t + 1]
            spans = []
            if per_text[t]:
                if chars is None:  # code points before each byte
                    chars = np.concatenate([[0], np.cumsum((words.bytes & 0xC0) != 0x80)])
                base = chars[words.at[t]]
                edge = np.diff(np.concatenate([[0], hit[a:b].astype(np.int8), [0]]))
                for x, y in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
                    spans.append({"start": int(chars[words.start[a + x]] - base), "end": int(chars[words.end[a + y - 1]] - base)})
            n_words.append(int(b - a))
            n_hit.append(int(per_text[t]))
            all_items.append(sorted(items[t]))
            all_hits.append(spans)
    return n_words, n_hit, all_items, all_hits


def _result(batch: pa.RecordBatch, found: tuple[list, list, list, list], keep: list[str]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    arrays = [pa.array(x, t) for x, t in zip(found, [pa.int64(), pa.int64(), pa.list_(pa.string()), span], strict=True)]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *arrays], [*keep, "n_words", "n_hit", "items", "hits"])


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """h, size, spelled, items: each distinct window of the benchmark with the ids of its items."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    each = items.mapInArrow(_item_windows(window), "h long, size int, spelled binary, item string")
    return each.groupBy("h", "size", "spelled").agg(F.collect_set("item").alias("items"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """id, text, n_words, n_hit, items and hits (code point spans) for every row of `docs`.

    Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters. A window is
    `window` consecutive words of an item, or all words of a shorter one; a document word is hit if
    an occurrence of a window covers it. Equal hashes are confirmed word by word. Null and empty
    texts have no words; items without words have no window; an item with a null id hits words but
    is not listed. Repeated rows all come back.

    At most `broadcast_windows` windows are broadcast. A larger benchmark is joined with the
    windows of the documents by hash, and each document then carries only its own matches.
    """
    windows = cut(benchmark_windows(benchmark, item_col, item_text_col, window))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    sc = docs.sparkSession.sparkContext
    if windows.count() <= broadcast_windows:
        table = [(r.h, r.size, bytes(r.spelled), r.items) for r in windows.collect()]
        sent = sc.broadcast(_Sent(table))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lookup = sent.value.lookup()
            for batch in batches:
                yield _result(batch, _scan(batch.column("text"), lambda i, j, words: lookup.find(words)), ["id", "text"])

        return rows.mapInArrow(run, f"id {kind}, text string, {_OUT}")

    keyed = rows.withColumn("tk", F.unhex(F.md5("text")))
    sizes = [r.size for r in windows.select("size").distinct().collect()]  # at most `window` numbers

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("tk")
            for i, _, words in each_words(batch.column("text"), ALPHANUMERIC):
                for size in sizes:
                    at, h = words.runs(size)
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(words.text[at] + i)), pa.array(h.view(np.int64))], ["tk", "h"])

    matched = keyed.where("tk is not null").select("tk", "text").mapInArrow(hashes, "tk binary, h long").distinct().join(windows, "h")
    own = matched.groupBy("tk").agg(F.collect_list(F.struct("h", "size", "spelled", "items")).alias("own"))

    def run_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("own")

            def find(i: int, j: int, words: Words, own=own):
                rows = {(r["h"], r["size"], r["spelled"]): (r["h"], r["size"], r["spelled"], r["items"]) for k in range(i, j) for r in own[k].as_py() or ()}
                return _Lookup(list(rows.values())).find(words) if rows else ()

            yield _result(batch, _scan(batch.column("text"), find), ["id", "text"])

    return keyed.join(own, "tk", "left").select("id", "text", "own").mapInArrow(run_own, f"id {kind}, text string, {_OUT}")


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every row of `docs`.

    items_sha256 is over the ids of the items that occur, sorted as strings, with commas between
    (over the empty string if there is none). A document is contaminated if at least one word in
    twenty is hit.
    """
    found = find_contamination(docs, benchmark, **options)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def without_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", length_col: str | None = None, **options) -> DataFrame:
    """`docs` without contaminated documents, and without the words that are hit in the others.

    Columns stay as they are but for the text, and `length_col`, if given, which is set to the
    changed text's length in code points.
    """
    names = docs.columns
    others = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in names if c != text_col))
    found = find_contamination(docs.select(others.alias("others"), F.col(text_col).alias("text")), benchmark, id_col="others", **options)
    found = found.where(~((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))
    piece = lambda start, stop: F.substr(F.col("text"), start + 1, stop - start)
    done = gathered(F.col("hits"), "string", lambda at, s: (s["end"], F.lit(True), piece(at, s["start"])))
    rest = F.concat(F.array_join(done["out"], ""), F.substr(F.col("text"), done["at"] + 1))
    new = F.when(F.size("hits") > 0, rest).otherwise(F.col("text"))
    fresh = found.select("id", new.alias("new"), (F.size("hits") > 0).alias("changed"))
    cols = []
    for c in names:
        old = F.col(f"id.`{c}`") if c != text_col else F.col("new")
        if c == length_col:
            old = F.when(F.col("changed"), F.char_length("new").cast(docs.schema[c].dataType)).otherwise(old)
        cols.append(old.alias(c))
    return fresh.select(*cols)
