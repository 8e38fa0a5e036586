"""Embedding near-duplicates by counting collisions of one-dimensional projections.

Vectors are projected on the composite directions (+-d_i +- d_j) / sqrt(2) of `m` fixed random
directions d. Every composite direction has a list of the vectors sorted by their projection; a
vector enters the lists where it stands out: those of all pairs of the `s` directions on which its
projection is greatest, by sign. A window of +-WINDOW is slid along each list, centred on one vector
after the other; a pair that meets in it collides there. Pairs are counted over all lists, as numbers
only, and those that collide `count` times or more are joined with their vectors and verified by
their cosine in double precision.

`calibrated` chooses s and count: pairs of exactly the wanted cosine are drawn and put through the
same lists, and s is the least with which RECALL of them collide at least COUNT times, count the
greatest that still keeps that recall. Pairs of a higher cosine collide more often. `m` grows with the
root of the number of vectors, so that lists stay as short, and pairs within windows grow with the
vectors and not with their square (from DIRECTIONS on lists grow instead).

A list of more than LONG vectors (a group of near copies) has no windows: its pairs would be too many
to write. Its vectors are compared with each other directly, block by block, and what leaves a block
is the number of links of each vector and a spanning forest. A vector goes with its copies to one
such list, the longest it is in; only pairs of different longest lists are looked for in the others.
Equal vectors are one class from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonehive.llm.blocks import by_group, in_block_pairs
from tonehive.llm.graph import connected_components
from tonehive.llm.store import cut

COSINE = 0.9
#: Half the width of a window: two deviations of the difference of two projections at COSINE.
WINDOW = 0.9
#: Share of the pairs at the wanted cosine that must be found, and the least count asked for.
RECALL, COUNT = 0.975, 3
#: Directions, at least and at most, and vectors in a list on average that they are taken for.
DIRECTIONS, AVERAGE = (64, 8192), 2
LONG = 128
BLOCK = 256
#: Different lengths of vectors that lists are calibrated for; with more, one collision is enough.
WIDTHS = 32


@lru_cache(8)
def _directions(d: int, m: int) -> np.ndarray:
    return np.random.default_rng(11).normal(size=(d, m))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the norm
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _lists_of(unit: np.ndarray, m: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    """(list, projection) of every vector in each of its s * (s - 1) / 2 lists."""
    p = unit @ _directions(unit.shape[1], m)
    s = min(s, m)
    top = np.sort(np.argpartition(-np.abs(p), s - 1, axis=1)[:, :s], axis=1)
    v = np.take_along_axis(p, top, 1)
    sided, a, b = top.astype(np.int64) * 2 + (v > 0), *np.array(list(combinations(range(s), 2))).T
    return sided[:, a] * (2 * m) + sided[:, b] + 4 * m * m * unit.shape[1], ((np.abs(v[:, a]) + np.abs(v[:, b])) / np.sqrt(2)).astype(np.float32)


@lru_cache(64)
def calibrated(d: int, m: int, cosine: float = COSINE, window: float = WINDOW, recall: float = RECALL, least: int = COUNT) -> tuple[int, int, float]:
    """(s, count, recall) for vectors of length d, by 2,000 drawn pairs of exactly this cosine."""
    rng = np.random.default_rng(5)
    x = _unit(rng.normal(size=(2000, d)))
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    y = x if d == 1 else cosine * x + np.sqrt(max(0.0, 1 - cosine * cosine)) * _unit(z)
    found = np.zeros(len(x))
    for s in range(4, 25):
        (la, va), (lb, vb) = _lists_of(x, m, s), _lists_of(y, m, s)
        found = np.array([sum(1 for k, v in zip(*one, strict=True) if abs(other.get(k, np.inf) - v) <= window) for one, other in ((w, dict(zip(q, r, strict=True))) for w, q, r in zip(zip(la, va, strict=True), lb, vb, strict=True))])
        if (found >= least).mean() >= recall:
            break
    count = least
    while (found >= count + 1).mean() >= recall:
        count += 1
    return s, count, float((found >= count).mean())


def _matrix(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat doubles of list rows and their offsets."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), lists.offsets.to_numpy() - lists.offsets[0].as_py()


def _lists(m: int, s: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = _matrix(batch.column("vec"))
            widths = np.diff(at)
            for d in np.unique(widths):
                every = np.flatnonzero(widths == d)
                for rows in np.array_split(every, max(1, len(every) // 1024)):
                    keys, shown = _lists_of(_unit(values[at[rows][:, None] + np.arange(d)]), m, s)
                    offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * keys.shape[1])
                    yield pa.RecordBatch.from_arrays([batch.column("ck").take(pa.array(rows)), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())), pa.ListArray.from_arrays(offsets, pa.array(shown.ravel()))], ["ck", "lists", "shown"])

    return run


def _slide(window: float):
    """(a, b), a < b, of every two vectors that lie within a window of a list; rows come sorted by list and projection."""

    def within(g: np.ndarray, v: np.ndarray, ck: np.ndarray) -> Iterator[pa.RecordBatch]:
        i, step = np.arange(len(g)), 0
        while len(i):
            step += 1
            i = i[i + step < len(g)]
            i = i[(g[i] == g[i + step]) & (v[i + step] - v[i] <= window)]
            if len(i):
                a, b = np.minimum(ck[i], ck[i + step]), np.maximum(ck[i], ck[i + step])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0, np.int64)]
        for batch in batches:
            held = [np.concatenate([x, batch.column(c).to_numpy()]) for x, c in zip(held, ("g", "v", "ck"), strict=True)]
            whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last list may go on
            if whole:
                yield from within(*(x[:whole] for x in held))
                held = [x[whole:] for x in held]
        yield from within(*held)

    return run


def _close(cosine: float):
    """Verified pairs: (a, null, links of a), (b, null, links of b) and the link (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, ax), (y, ay) = _matrix(batch.column("x")), _matrix(batch.column("y"))
            same = np.diff(ax) == np.diff(ay)
            keep = np.zeros(batch.num_rows, bool)
            for d in np.unique(np.diff(ax)[same]):
                rows = np.flatnonzero(same & (np.diff(ax) == d))
                u, w = (_unit(values[at[rows][:, None] + np.arange(d)]) for values, at in ((x, ax), (y, ay)))
                keep[rows] = np.einsum("ij,ij->i", u, w) >= cosine
            a, b, ta, tb = (batch.column(c).to_numpy()[keep] for c in ("a", "b", "ta", "tb"))
            none = pa.nulls(2 * len(a), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, b, a])), pa.concat_arrays([none, pa.array(b)]), pa.array(np.concatenate([tb, ta, np.zeros(len(a), np.int64)]))], ["a", "b", "n"])

    return run


def _in_block(cosine: float, across: bool):
    """Links within a block pair: numbers of links and a spanning forest.

    Within one longest list all pairs are due. `across` longest lists, rows on side 1 meet those on
    side 0, and a pair is due in the least long list that both are in.
    """

    def run(table: pa.Table) -> pa.Table | None:
        n = table.num_rows
        values, at = _matrix(table["vec"].combine_chunks())
        if len(set(np.diff(at))) > 1:
            raise ValueError("a list of vectors of different lengths")
        x = _unit(values.reshape(n, -1))
        ck, times = table["ck"].to_numpy(), table["times"].to_numpy()
        if across:
            side, home, rest = (table[c].to_numpy() for c in ("side", "home", "rest"))
            rows, cols = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
            due = home[rows, None] != home[None, cols]
            due &= (ck[rows, None] < ck[None, cols]) | ~(rest[None, cols] > 0)
        else:
            mine, p, q = table["_mine"].to_numpy(), table["_p"][0].as_py(), table["_q"][0].as_py()
            rows, cols = np.flatnonzero(mine == p), np.flatnonzero(mine == q)
            due = ck[rows, None] < ck[None, cols] if p == q else np.ones((len(rows), len(cols)), bool)
        near = np.argwhere(due & (x[rows] @ x[cols].T >= cosine - 1e-6))
        i, j = rows[near[:, 0]], cols[near[:, 1]]
        close = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
        i, j = i[close], j[close]
        if across and len(i):
            g, longs = table["_g"][0].as_py(), table["longs"].to_pylist()
            least = np.array([min(set(longs[a]).intersection(longs[b])) == g for a, b in zip(i, j, strict=True)], bool)
            i, j = i[least], j[least]
        if not len(i):
            return None
        links = np.zeros(n, np.int64)
        np.add.at(links, i, times[j])
        np.add.at(links, j, times[i])
        parent = list(range(n))

        def find(v: int) -> int:
            while parent[v] != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        ends: tuple[list[int], list[int]] = ([], [])
        for u, v in zip(i.tolist(), j.tolist(), strict=True):
            a, b = find(u), find(v)
            if a != b:
                parent[a] = b
                ends[0].append(int(ck[u]))
                ends[1].append(int(ck[v]))
        linked = np.flatnonzero(links)
        return pa.table({"a": pa.array(ck[linked].tolist() + ends[0], pa.int64()), "b": pa.array([None] * len(linked) + ends[1], pa.int64()), "n": pa.array(links[linked].tolist() + [0] * len(ends[0]), pa.int64())})

    return run


_FOUND = "a long, b long, n long"


def _in_long_lists(shown: DataFrame, classes: DataFrame, sizes: DataFrame, cosine: float, block: int) -> tuple[DataFrame, DataFrame]:
    """(what the long lists give, ck and longs: the long lists of every vector that is in one)."""
    entered = shown.select("ck", F.explode("lists").alias("g")).join(sizes, "g")
    # At most s * (s - 1) / 2 lists a vector; the longest is its home.
    homes = cut(entered.groupBy("ck").agg(F.collect_list("g").alias("longs"), F.max(F.struct("n", "g"))["g"].alias("home")))
    full = cut(homes.join(classes.select("ck", "times", "vec"), "ck"))
    size = cut(full.groupBy(F.col("home").alias("_g")).agg(F.count("*").alias("_n")))
    at_home = in_block_pairs(full.select(F.col("home").alias("_g"), "ck", "times", "vec"), "_g", "ck", size, block)
    found = by_group(at_home, ["_g", "_p", "_q"], _in_block(cosine, False), _FOUND)
    # Elsewhere, those whose home is not the list's most frequent one are compared with all.
    visits = full.select("ck", "home", F.explode("longs").alias("_g"))
    by_home = visits.groupBy("_g", "home").agg(F.count("*").alias("k"))
    most = cut(by_home.groupBy("_g").agg(F.max(F.struct("k", "home"))["home"].alias("main"), F.sum("k").alias("_n"), (F.sum("k") - F.max("k")).alias("_few")).where("_few > 0"))
    here = cut(visits.join(most, "_g"))
    if here.isEmpty():
        return found, homes.select("ck", "longs")
    here = here.withColumn("rest", (F.col("home") != F.col("main")).cast("int"))
    parts = lambda n: F.ceil(F.col(n) / F.lit(block)).cast("int")
    mine = lambda n: F.pmod(F.xxhash64("ck", F.lit(17)), parts(n)).cast("int")
    asking = here.where("rest = 1").select("_g", "ck", "rest", F.lit(1).alias("side"), mine("_few").alias("_p"), F.explode(F.sequence(F.lit(0), parts("_n") - 1)).alias("_q"))
    asked = here.select("_g", "ck", "rest", F.lit(0).alias("side"), F.explode(F.sequence(F.lit(0), parts("_few") - 1)).alias("_p"), mine("_n").alias("_q"))
    both = asking.unionByName(asked).join(full, "ck")
    return found.unionByName(by_group(both, ["_g", "_p", "_q"], _in_block(cosine, True), _FOUND)), homes.select("ck", "longs")


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, recall: float = RECALL, window: float = WINDOW, long: int = LONG, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of `vectors`.

    Two vectors are linked if their cosine is at least `cosine` (and the collision count finds
    them). Vectors that are null, empty or zero, or that hold a null, NaN or infinite component,
    and vectors of different length, are linked with nothing. Equal vectors are linked with each
    other. Repeated rows count each other as links. component_id is the least vec_id that links
    reach; a row with a null id takes part and gets its group's. Other columns are not read. An
    empty table gives an empty result.
    """
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("vec"))
    usable = F.coalesce((F.size("vec") > 0) & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vec", lambda v: v != 0), F.lit(False))
    # -0.0 and 0.0 are one value
    plain = F.transform("vec", lambda v: F.when(v == 0, F.lit(0.0).cast(kind[6:-1])).otherwise(v))
    tagged = rows.withColumn("vk", F.when(usable, F.unhex(F.md5(F.to_json(F.struct(plain.alias("v")))))))
    classes = tagged.where("vk is not null").groupBy("vk").agg(F.min("id").alias("first_id"), F.count("*").alias("times"), F.first("vec").alias("vec"))
    classes = cut(classes.withColumn("ck", F.monotonically_increasing_id()))  # fixed by being written

    widths = [r.d for r in classes.select(F.size("vec").alias("d")).distinct().limit(WIDTHS + 1).collect()]
    entries = 50 * classes.count()  # about 50 lists a vector, of 2 * m * m
    m = 64 * -(-min(max(int((entries / (2 * AVERAGE)) ** 0.5), DIRECTIONS[0]), DIRECTIONS[1]) // 64)
    chosen = [calibrated(d, m, cosine, window, recall) for d in (widths if len(widths) <= WIDTHS else [64])] or [(4, 1, 1.0)]
    s, count = max(c[0] for c in chosen), min(c[1] for c in chosen) if len(widths) <= WIDTHS else 1
    shown = cut(classes.select("ck", "vec").mapInArrow(_lists(m, s), "ck long, lists array<long>, shown array<float>"))
    sizes = cut(shown.select(F.explode("lists").alias("g")).groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") > long))
    entered = shown.select("ck", F.explode(F.arrays_zip("lists", "shown")).alias("e")).select(F.col("e.lists").alias("g"), F.col("e.shown").alias("v"), "ck")
    known = classes.select("ck", "times", "vec")
    any_long = not sizes.isEmpty()
    if any_long:
        dense, longs = _in_long_lists(shown, classes, sizes, cosine, block)
        entered = entered.join(sizes, "g", "left_anti")
        known = known.join(longs, "ck", "left")
    dealt = entered.repartition("g").sortWithinPartitions("g", "v", "ck")
    pairs = dealt.mapInArrow(_slide(window), "a long, b long").groupBy("a", "b").agg(F.count("*").alias("hits")).where(F.col("hits") >= count)
    ends = [known.select(*(F.col(c).alias(f"{c}{e}") for c in known.columns)) for e in "ab"]
    full = pairs.select("a", "b").join(ends[0], F.col("a") == F.col("cka")).join(ends[1], F.col("b") == F.col("ckb"))
    if any_long:  # pairs of a long list are counted there
        full = full.where(~F.coalesce(F.arrays_overlap("longsa", "longsb"), F.lit(False)))
    found = full.select("a", "b", F.col("veca").alias("x"), F.col("vecb").alias("y"), F.col("timesa").alias("ta"), F.col("timesb").alias("tb")).mapInArrow(_close(cosine), _FOUND)
    found = cut(found.unionByName(dense) if any_long else found)

    links = cut(found.groupBy("a").agg(F.sum("n").alias("links")).where("links > 0").withColumnRenamed("a", "ck"))
    component = connected_components(found.where("b is not null"), "a", "b").withColumnRenamed("node", "ck")
    joined = cut(classes.select("vk", "ck", "first_id", "times").join(component, "ck", "left").join(links, "ck", "left").withColumn("component", F.coalesce("component", "ck")))
    least = cut(joined.groupBy("component").agg(F.min("first_id").alias("least_id")))
    result = cut(joined.join(least, "component").select("vk", "least_id", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("links")))
    out = tagged.select("id", "vk").join(result, "vk", "left")
    component_id = F.when(F.col("links").isNull(), F.col("id")).otherwise(F.col("least_id"))
    return out.select(F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component_id.alias("component_id"), F.col("id").eqNullSafe(component_id).alias("kept"))
