"""Comparing the members of a group block by block, so that no task holds a whole group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_block_pairs(members: DataFrame, group: str, member: str, size: DataFrame, block: int) -> DataFrame:
    """`members` with columns _g, _p and _q added: each row goes to every pair of blocks its block is in.

    `size` has (group, _n), the number of members of each group. A group of n members has
    ceil(n / block) blocks; every two members meet in exactly one (_g, _p, _q), which holds about
    2 * block rows at most.
    """
    parts = F.ceil(F.col("_n") / F.lit(block)).cast("int")
    mine = F.pmod(F.xxhash64(member, F.lit(17)), F.col("_parts")).cast("int")
    return (
        members.join(size, group)
        .withColumn("_parts", parts)
        .withColumn("_mine", mine)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .withColumn("_p", F.least("_mine", "_other"))
        .withColumn("_q", F.greatest("_mine", "_other"))
        .drop("_n", "_parts", "_other")
    )


def by_group(df: DataFrame, keys: list[str], function: Callable[[pa.Table], pa.Table | None], schema: str, partitions: int | None = None) -> DataFrame:
    """`function` applied to the rows of each group, which must be of bounded size.

    Like a grouped map, but the groups of a partition come through one Arrow stream, which is far
    cheaper where most groups are small.
    """
    cols = [*keys]
    dealt = df.repartition(partitions, *cols) if partitions else df.repartition(*cols)
    dealt = dealt.sortWithinPartitions(*cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        out: list[pa.Table] = []
        waiting = 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            start = 0
            for i in range(1, n + 1):
                if i < n and values[i] == values[start]:
                    continue
                if held and values[start] != last:
                    got = function(pa.Table.from_batches(held))
                    held = []
                    if got is not None and got.num_rows:
                        out.append(got)
                        waiting += got.num_rows
                held.append(batch.slice(start, i - start))
                last = values[start]
                start = i
            if waiting > 4096:
                for t in out:
                    yield from t.to_batches()
                out, waiting = [], 0
        if held:
            got = function(pa.Table.from_batches(held))
            if got is not None and got.num_rows:
                out.append(got)
        for t in out:
            yield from t.to_batches()

    return dealt.mapInArrow(run, schema)
