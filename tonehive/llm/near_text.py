"""MinHash near-duplicate detection with tensored banding.

Instead of one independent group of minhashes per table, two small collections of sub-signatures
are computed, A and B, and the table keys are all pairs (A_i, B_j). 10 + 10 sub-signatures of three
minhashes give 100 tables of six rows: 60 minhash evaluations a document rather than 600. At a
similarity of 0.85 a pair shares at least one table with probability above 0.9998.

The stages:

1. Texts are grouped by digest, so that exact copies are one class from here on.
2. Sub-signatures that only one class has cannot collide; tables are keyed by the others alone.
3. In every table bucket all members are compared with one centre, the member whose
   sub-signatures are the most widely shared (the original that a group of copies stems from).
   That is linear in the bucket's size.
4. Candidates whose set sizes or sub-signatures rule the link out are dropped, the others
   verified on their full shingle sets.
5. Members that turned out not to be linked with their centre may still be linked with each
   other. They are compared block by block with the members of other components under that
   centre; only confirmed links leave a block.

Nothing is capped: a bucket of any size goes through 3 and 5. Work in 5 grows with the members
left over in a bucket, not with the linked ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonehive.llm.blocks import by_group, in_block_pairs
from tonehive.llm.graph import connected_components
from tonehive.llm.store import cut
from tonehive.llm.textcore import SPACE_SEPARATED, each_words, mix, sets_of

SHINGLE = 5
SIDE = 10  # sub-signatures in each of the two collections
ROWS = 3  # minhashes in a sub-signature
AGREE = 4  # of 2 * SIDE sub-signatures; a linked pair has 12.3 on average, under 4 once in 30,000
BLOCK = 128


def _signatures(side: int, rows: int):
    seeds = np.random.default_rng(7).integers(1, 1 << 63, (2 * side * rows, 2), dtype=np.uint64) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, subs = [], []
            for i, j, words in each_words(batch.column("text"), SPACE_SEPARATED):
                hashes, bounds = words.sets(SHINGLE)
                n = np.diff(bounds)
                some = n > 0
                sub = np.zeros((j - i, 2 * side), np.uint64)
                if len(hashes):
                    at = bounds[:-1][some]
                    for s in range(2 * side):
                        h = np.full(len(at), np.uint64(s + 1))
                        for r in range(rows):
                            x, m = seeds[s * rows + r]
                            h = mix(h ^ np.minimum.reduceat(mix_light(hashes ^ x, m), at))
                        sub[some, s] = h
                counts.append(n)
                subs.append(sub)
            if not batch.num_rows:
                continue
            n, sub = np.concatenate(counts), np.concatenate(subs)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * (2 * side)), pa.array(sub.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("tk"), batch.column("id"), pa.array(n.astype(np.int64)), lists], ["tk", "id", "n", "subs"])

    return run


def mix_light(x: np.ndarray, m: np.uint64) -> np.ndarray:
    """One multiply and shift; its inputs are already well mixed."""
    x = x * m
    return x ^ (x >> np.uint64(32))


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            sets = [s.tobytes() for s in sets_of(batch.column("text"), SHINGLE)]
            yield pa.RecordBatch.from_arrays([batch.column("tk"), pa.array(sets, pa.binary())], ["tk", "shingles"])


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    if not len(a) or not len(b):
        return False
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int(np.count_nonzero(b[at] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("sa"), batch.column("sb")
            keep = [linked(np.frombuffer(left[i].as_buffer(), np.uint64), np.frombuffer(right[i].as_buffer(), np.uint64), percent) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("tk").filter(pa.array(keep, pa.bool_())), batch.column("c").filter(pa.array(keep, pa.bool_()))], ["tk", "c"])

    return run


def _possible(table: pa.Table, percent: int, side: int, agree: int) -> np.ndarray:
    """Matrix over the rows of a block pair: may two rows be linked, without being so already?"""
    n = table["n"].to_numpy()
    label = np.array(table["label"].to_pylist(), dtype=object)
    _, label = np.unique(label, return_inverse=True)
    subs = table["subs"].combine_chunks().flatten().to_numpy().reshape(-1, 2 * side)
    mine, p, q = table["_mine"].to_numpy(), table["_p"][0].as_py(), table["_q"][0].as_py()
    rows, cols = np.flatnonzero(mine == p), np.flatnonzero(mine == q)
    small, large = np.minimum(n[rows, None], n[cols]), np.maximum(n[rows, None], n[cols])
    ok = (label[rows, None] != label[cols]) & (100 * small >= percent * large)
    same = np.zeros(ok.shape, np.uint8)
    for s in range(2 * side):
        same += subs[rows, None, s] == subs[None, cols, s]
    full = np.zeros((len(n), len(n)), bool)
    full[np.ix_(rows, cols)] = ok & (same >= agree)
    return full


def _with_partners(percent: int, side: int, agree: int):
    def run(table: pa.Table) -> pa.Table:
        possible = _possible(table, percent, side, agree)
        return table.select(["_g", "tk"]).filter(pa.array(possible.any(0) | possible.any(1)))

    return run


def _links_in_block(percent: int, side: int, agree: int):
    def run(table: pa.Table) -> pa.Table:
        possible = _possible(table, percent, side, agree)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
        keys, labels = table["tk"].to_pylist(), table["label"].to_pylist()
        parent: dict[bytes, bytes] = {}

        def find(x: bytes) -> bytes:
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        a, b = [], []
        for i, j in zip(*np.nonzero(possible), strict=True):
            u, v = find(labels[i]), find(labels[j])
            if u != v and linked(sets[i], sets[j], percent):
                parent[u] = v
                a.append(keys[i])
                b.append(keys[j])
        return pa.table({"tk": pa.array(a, pa.binary()), "c": pa.array(b, pa.binary())})

    return run


def _classes(rows: DataFrame, side: int, rows_each: int) -> DataFrame:
    """One row per text: tk, least id, set size and sub-signatures."""
    signed = rows.where("tk is not null").mapInArrow(_signatures(side, rows_each), "tk binary, id long, n long, subs array<long>")
    return cut(signed.groupBy("tk").agg(F.min("id").alias("first_id"), F.first("n").alias("n"), F.first("subs").alias("subs")).where("n > 0"))


def _candidates(classes: DataFrame, side: int) -> DataFrame:
    """(tk, c): every class with the centre of each table bucket that it is in."""
    subs = classes.select("tk", F.posexplode("subs").alias("pos", "s"))
    # Written first, here and below: so a join has two shuffled sides, and a frequent key can be split.
    shared = cut(subs.groupBy("s").agg(F.count("*").alias("times")).where("times > 1"))
    own = subs.join(shared, "s").groupBy("tk").agg(F.collect_list(F.struct("pos", "s")).alias("own"), F.sum("times").alias("pop"))
    part = lambda low: F.transform(F.filter("own", lambda x: (x["pos"] >= low) & (x["pos"] < low + side)), lambda x: x["s"])
    own = own.select("tk", "pop", part(0).alias("a"), part(side).alias("b"))
    keys = F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.xxhash64(x, y))))
    keyed = cut(own.select("tk", "pop", F.explode(keys).alias("key")))
    centre = cut(keyed.groupBy("key").agg(F.max(F.struct("pop", "tk")).alias("m"), F.count("*").alias("k")).where("k > 1").select("key", F.col("m.tk").alias("c")))
    return cut(keyed.join(centre, "key").where("tk <> c").select("tk", "c").distinct())


def _sets_needed(rows: DataFrame, classes: DataFrame, needed: DataFrame) -> DataFrame:
    """Shingle sets of the classes in `needed`, from one row of each: copies differ in id, so they spread."""
    one = classes.join(needed, "tk", "left_semi").select("tk", F.col("first_id").alias("id"))
    r, o = rows.alias("r"), one.alias("o")
    texts = r.join(o, (F.col("r.tk") == F.col("o.tk")) & F.col("r.id").eqNullSafe(F.col("o.id"))).select("r.tk", "r.text")
    return cut(texts.mapInArrow(_shingle_sets, "tk binary, shingles binary").dropDuplicates(["tk"]))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, side: int = SIDE, rows_each: int = ROWS, agree: int = AGREE, block: int = BLOCK) -> DataFrame:
    """tk, first_id, n, component (a tk) and least_id of every distinct text that has words.

    tk is the MD5 digest of the text, first_id the least id that has this text, n the number of its
    distinct five-word shingles, least_id the least id in its component.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.unhex(F.md5(F.col(text_col))).alias("tk"))
    classes = _classes(rows, side, rows_each)
    pairs = _candidates(classes, side)

    brief = classes.select("tk", "n", "subs")
    other = brief.select(F.col("tk").alias("c"), F.col("n").alias("nc"), F.col("subs").alias("subs_c"))
    sized = F.least("n", "nc") * 100 >= F.greatest("n", "nc") * percent
    agreeing = F.size(F.array_intersect("subs", "subs_c")) >= agree
    likely = cut(pairs.join(brief, "tk").join(other, "c").where(sized & agreeing).select("tk", "c"))
    sets = _sets_needed(rows, classes, likely.select("tk").unionByName(likely.select(F.col("c").alias("tk"))).distinct())
    with_sets = likely.join(sets.withColumnRenamed("shingles", "sa"), "tk").join(sets.select(F.col("tk").alias("c"), F.col("shingles").alias("sb")), "c")
    links = cut(with_sets.select("tk", "c", "sa", "sb").mapInArrow(_verified(percent), "tk binary, c binary"))
    found = connected_components(links, "tk", "c")

    # What a centre left over: members of its buckets that no link joins to it yet.
    open_ones = cut(pairs.join(links, ["tk", "c"], "left_anti").select(F.col("c").alias("_g")).distinct())
    label = found.select(F.col("node").alias("tk"), F.col("component").alias("label"))
    members = pairs.select(F.col("c").alias("_g"), "tk").join(open_ones, "_g", "left_semi").join(brief, "tk").join(label, "tk", "left").withColumn("label", F.coalesce("label", "tk"))
    size = cut(members.groupBy("_g").agg(F.count("*").alias("_n"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("_g", "_n"))
    blocks = in_block_pairs(members, "_g", "tk", size, block)
    partners = cut(by_group(blocks, ["_g", "_p", "_q"], _with_partners(percent, side, agree), "_g binary, tk binary").distinct())
    if not partners.isEmpty():
        sets = _sets_needed(rows, classes, partners.select("tk").distinct())
        members = partners.join(brief, "tk").join(label, "tk", "left").withColumn("label", F.coalesce("label", "tk")).join(sets, "tk")
        size = cut(partners.groupBy("_g").agg(F.count("*").alias("_n")))
        blocks = in_block_pairs(members, "_g", "tk", size, block)
        more = cut(by_group(blocks, ["_g", "_p", "_q"], _links_in_block(percent, side, agree), "tk binary, c binary").distinct())
        if not more.isEmpty():
            known = found.select(F.col("node").alias("tk"), F.col("component").alias("c"))
            found = connected_components(known.unionByName(more), "tk", "c")

    joined = classes.select("tk", "first_id", "n").join(found.select(F.col("node").alias("tk"), "component"), "tk", "left").withColumn("component", F.coalesce("component", "tk"))
    least = cut(joined.groupBy("component").agg(F.min("first_id").alias("least_id")))
    return cut(joined.join(least, "component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of `docs`.

    Words are runs of characters other than space and U+0009 to U+000D, A-Z lower-cased. Two
    documents are linked if 100 * intersection >= percent * union of their sets of five-word
    shingles; a text of fewer words is one shingle. component_id is the least doc_id that links
    reach; kept tells whether it is the row's own.

    Null, empty and wordless texts have n_shingles 0, are linked with nothing and kept. Repeated
    rows all come back. A row with a null id takes part (its text links others), gets the
    component_id of its group and is kept only if no id is known in the group. Further columns of
    `docs`, whatever their names, are not read. An empty table gives an empty result.
    """
    classes = near_duplicate_classes(docs, id_col, text_col, **options)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.md5(F.col(text_col))).alias("tk"))
    out = rows.join(classes, "tk", "left")
    component = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("least_id"))
    return out.select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` with one row of each group of near copies, the one with the least id.

    Rows without words all stay. Of repeated rows that share that id and text one stays.
    """
    classes = near_duplicate_classes(docs, id_col, text_col, **options)
    chosen = classes.where(F.col("first_id").eqNullSafe(F.col("least_id"))).groupBy("component").agg(F.min("tk").alias("_ctk"), F.first("least_id").alias("_cid"))
    tag = F.struct(F.unhex(F.md5(F.col(text_col))).alias("tk"), F.col(id_col).cast("long").alias("id"))
    names = docs.columns
    tagged = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), tag.alias("t"))
    here = (F.col("t.tk") == F.col("_ctk")) & F.col("t.id").eqNullSafe(F.col("_cid"))
    times = tagged.select("t").join(chosen, here).groupBy("_ctk", "_cid").agg(F.count("*").alias("_times"))
    kept = tagged.join(times, here)
    single = kept.where("_times = 1").select("row.*")
    one = kept.where("_times > 1").select("row", "_ctk").dropDuplicates(["_ctk"]).select("row.*")
    wordless = tagged.join(classes.select("tk"), F.col("t.tk") == F.col("tk"), "left_anti").select("row.*")
    return single.unionByName(one).unionByName(wordless)
