"""Merkle fixity audit of WARC files.

Records are hashed; runs of records in the same range of offsets of a file form the first inner
level; every `fan` neighbouring nodes form a node of the next one, up to one root for a file, and
file roots form the upper levels in the same way. Two replicas with equal roots are equal. Where
roots differ, only the children of differing nodes are compared, level by level, down to records.

Every node has a bounded number of children, so no aggregation gathers more than that in one
place, and levels shrink by a factor of `fan`.

A record that changed its length moves all that follow it in its file, so those ranges differ too. Their
records are compared by key and digest, not by offset: what only moved is no finding.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tonehive.llm.store import cut

RANGE_BYTES = 1 << 16
FAN = 16
RECORDS_A_FILE = 1024

_EOL = "\r\n"


def warc_record(url: Column, body: Column, ident: Column) -> Column:
    """The bytes of a WARC/1.0 resource record: header block, payload and end."""
    content = F.coalesce(F.encode(body, "UTF-8"), F.lit(b""))
    head = F.concat(
        F.lit(f"WARC/1.0{_EOL}WARC-Type: resource{_EOL}WARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit(f"{_EOL}WARC-Record-ID: <urn:page:"),
        F.coalesce(ident.cast("string"), F.lit("none")),
        F.lit(f">{_EOL}Content-Type: text/html{_EOL}Content-Length: "),
        F.octet_length(content).cast("string"),
        F.lit(_EOL + _EOL),
    )
    return F.concat(F.encode(head, "UTF-8"), content, F.lit((_EOL + _EOL).encode()))


_HEAD = re.compile(rb"WARC/1\.\d\r\n((?:[^\r\n]+\r\n)+)\r\n")
_CHUNK = 1 << 16


def _members(data: bytes) -> Iterator[tuple[int, bytes, str | None]]:
    """(offset, bytes, error) of the gzip members of a file, or of the whole file if it is none."""
    if data[:2] != b"\x1f\x8b":
        yield 0, data, None
        return
    view, at = memoryview(data), 0
    while at < len(data):
        inflate, parts, here = zlib.decompressobj(31), [], at
        try:
            while not inflate.eof and here < len(data):
                chunk = view[here : here + _CHUNK]
                parts.append(inflate.decompress(chunk))
                here += len(chunk)
        except zlib.error as e:
            yield at, b"".join(parts), f"gzip: {e}"
            return  # where the next member begins is not known
        yield at, b"".join(parts), None if inflate.eof else "gzip: ends early"
        at = here - len(inflate.unused_data)


def records(data: bytes) -> Iterator[tuple[int, str | None, str | None, bytes | None, str | None]]:
    """(at, url, record_id, content, error) of the records of a WARC file, gzipped by record or not.

    `at` is the offset in the file, of a gzip member that of the member. What is no record is one row
    with an error and without content, and reading goes on at the next beginning of a record.
    """
    for begin, plain, error in _members(data):
        at, whole = 0, plain is data
        while at < len(plain):
            m = _HEAD.match(plain, at)
            place = begin + at if whole else begin
            fields = {} if m is None else {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in m[1].split(b"\r\n"))}
            size = fields.get(b"content-length", b"")
            if m is None or not size.isdigit():
                yield place, None, None, None, "no header" if m is None else "no Content-Length"
                following = plain.find(b"WARC/1.", at + 1)
                at = following if following >= 0 else len(plain)
                continue
            end = m.end() + int(size)
            name = lambda field, fields=fields: fields.get(field, b"").decode("utf-8", "replace")
            bad = "content ends early" if end > len(plain) else None if plain[end : end + 4] == b"\r\n\r\n" else "no end of record"
            yield place, name(b"warc-target-uri"), name(b"warc-record-id"), plain[m.end() : end], bad
            following = end + 4 if bad is None else plain.find(b"WARC/1.", m.end())
            at = following if following >= 0 else len(plain)
        if error is not None:
            yield begin, None, None, None, error


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """file, at, url, record_id, content and error of the records of WARC files, gzipped by record or not.

    Records are found by their Content-Length, so a payload may hold anything. Malformed parts are
    rows with an error. A file is one row of a binary scan and must be under 2 GB.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["file", "at", "url", "record_id", "content", "error"])

        for batch in batches:
            for i in range(batch.num_rows):
                name, out, size = batch.column("path")[i].as_py(), [], 0
                for r in records(batch.column("content")[i].as_py()):
                    out.append((name, *r))
                    size += len(r[3] or b"") + 100
                    if size > 1 << 24:
                        yield batch_of(out)
                        out, size = [], 0
                yield batch_of(out)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, at long, url string, record_id string, content binary, error string")


def audit_files(spark: SparkSession, primary: str, replica: str) -> DataFrame:
    """name, at, record_id, expected, found and status of every record in which two folders of WARC files differ.

    Files are matched by name, records by their id; `at` is the primary's offset, of an extra record
    the replica's. A malformed part is a record without an id, with its error in place of a digest.
    """
    sides = []
    for path in (primary, replica):
        content = F.coalesce(F.sha2("content", 256), F.lit(""))
        digest = F.when(F.col("error").isNull(), content).otherwise(F.concat_ws(":", "error", content))
        sides.append(cut(read_warc(spark, path).select(F.element_at(F.split("file", "/"), -1).alias("name"), "at", F.coalesce("record_id", F.lit("")).alias("key"), digest.alias("digest"))))
    names = sides[0].select("name").union(sides[1].select("name")).distinct()
    # One number a file, so one task can order them.
    numbered = cut(names.withColumn("file", (F.row_number().over(Window.orderBy("name")) - 1).cast("long")))
    rows = [side.join(numbered, "name").groupBy("file", "at", "key", "digest").agg(F.count("*").alias("times")) for side in sides]
    findings, _ = audit(*rows)
    return findings.join(numbered, "file").select("name", "at", F.col("key").alias("record_id"), "expected", "found", "status")


def write_warc(pages: DataFrame, path: str, files: int) -> None:
    """Writes pages (page_id, url, html) as `files` uncompressed WARC files.

    Spark's text writer ends every row with the given line end, here the one that ends a record.
    """
    record = F.decode(warc_record(F.col("url"), F.col("html"), F.col("page_id")), "UTF-8")
    pages.select(F.regexp_replace(record, r"\r\n\r\n\z", "").alias("value")).repartition(files).write.option("lineSep", _EOL + _EOL).text(path)


def laid_out(records: DataFrame, records_a_file: int = RECORDS_A_FILE, replica_size: str | None = None) -> DataFrame:
    """`records` (key, size, digest and what else they have) dealt to files: with file, at and times.

    Records are dealt by a hash of key and digest; equal ones are one entry with a count, and stand
    one after the other. A file holds about `records_a_file` entries, so the running sum of sizes
    is over a bounded window whatever keys are frequent. `replica_size` names the sizes of the same
    records in a replica, null for those it lacks; replica_at is then their offset there.
    """
    entries = cut(records.groupBy(*records.columns).agg(F.count("*").alias("times")))
    files = max(1, -(-entries.count() // records_a_file))
    placed = entries.withColumn("file", F.pmod(F.xxhash64("key", "digest"), F.lit(files)))
    before = Window.partitionBy("file").orderBy("key", "digest").rowsBetween(Window.unboundedPreceding, -1)
    offset = lambda size: F.coalesce(F.sum(F.coalesce(F.col(size), F.lit(0)) * F.col("times")).over(before), F.lit(0))
    placed = placed.withColumn("at", offset("size"))
    return placed if replica_size is None else placed.withColumn("replica_at", offset(replica_size))


def _node(children: DataFrame, keys: list[str]) -> DataFrame:
    """Digest of each group of children, in order."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "digest"))), lambda x: x["digest"])
    return children.groupBy(*keys).agg(F.sha2(F.array_join(ordered, "\n"), 256).alias("digest"))


def _levels(leaves: DataFrame, file_height: int, top_height: int, range_bytes: int, fan: int) -> list[DataFrame]:
    """From the ranges up to the root; each has file, pos and digest. Above the files, file is -1."""
    levels = [_node(leaves.select("file", F.floor(F.col("at") / range_bytes).alias("up"), F.col("at").alias("pos"), F.concat_ws(":", "digest", F.col("times").cast("string")).alias("digest")), ["file", "up"]).withColumnRenamed("up", "pos")]
    for _ in range(file_height):
        levels.append(_node(levels[-1].withColumn("up", F.floor(F.col("pos") / fan)), ["file", "up"]).withColumnRenamed("up", "pos"))
    level = levels[-1].select(F.lit(-1).cast("long").alias("file"), F.col("file").alias("pos"), "digest")
    levels[-1] = level
    for _ in range(top_height):
        levels.append(_node(levels[-1].withColumn("up", F.floor(F.col("pos") / fan)), ["file", "up"]).withColumnRenamed("up", "pos"))
    return levels


def _height(n: int, fan: int) -> int:
    """Levels over n nodes until one is left."""
    h = 0
    while n > 1:
        n, h = -(-n // fan), h + 1
    return h


def audit(primary: DataFrame, replica: DataFrame, range_bytes: int = RANGE_BYTES, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(findings, visits) of two replicas with file, at, key, digest and times of each record.

    findings: file, at (in the primary, or of an extra record in the replica), key, times, expected
    (null for a record that only the replica has), found (null for one that it lacks) and status
    altered, missing or extra. Records of one key that differ are paired in order. visits: level (0 are the ranges), compared
    and differing nodes, from the root down to the level above the records.
    """
    a, b = (cut(x.select("file", "at", "key", "digest", "times")) for x in (primary, replica))
    both = a.select("file", "at").unionByName(b.select("file", "at")).agg(F.max("at").alias("at"), F.max("file").alias("file")).first()
    spark = primary.sparkSession
    if both.at is None:
        return spark.createDataFrame([], "file long, at long, key string, times long, expected string, found string, status string"), spark.createDataFrame([], "level int, compared long, differing long")
    file_height, top_height = _height(both.at // range_bytes + 1, fan), _height(both.file + 1, fan)
    mine = [cut(x) for x in _levels(a, file_height, top_height, range_bytes, fan)]
    theirs = [cut(x) for x in _levels(b, file_height, top_height, range_bytes, fan)]
    visits, differing = [], None
    for level in range(len(mine) - 1, -1, -1):
        x, y = mine[level].alias("x"), theirs[level].alias("y")
        pairs = x.join(y, (F.col("x.file") == F.col("y.file")) & (F.col("x.pos") == F.col("y.pos")), "full").select(F.coalesce("x.file", "y.file").alias("file"), F.coalesce("x.pos", "y.pos").alias("pos"), F.col("x.digest").alias("dx"), F.col("y.digest").alias("dy"))
        if differing is not None:
            if level == file_height - 1:  # from file roots to the nodes below each
                pairs = pairs.join(differing.select(F.col("pos").alias("file")), "file", "left_semi")
            else:
                pairs = pairs.withColumn("k", F.floor(F.col("pos") / fan)).join(differing.select("file", F.col("pos").alias("k")), ["file", "k"], "left_semi").drop("k")
        pairs = cut(pairs.withColumn("differs", ~F.col("dx").eqNullSafe(F.col("dy"))))
        seen = pairs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("differs").cast("long")), F.lit(0)).alias("d")).first()
        visits.append((level, seen.n, seen.d))
        differing = pairs.where("differs").select("file", "pos")
    # Records of the ranges that differ.
    if file_height == 0:
        open_ranges = differing.select(F.col("pos").alias("file"), F.lit(0).cast("long").alias("k"))
    else:
        open_ranges = differing.select("file", F.col("pos").alias("k"))
    k = F.floor(F.col("at") / range_bytes)
    left, right = (cut(x.withColumn("k", k).join(open_ranges, ["file", "k"], "left_semi").drop("k")) for x in (a, b))
    same = lambda columns: [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in columns]
    whole = same(["file", "key", "digest", "times"])
    nth = F.row_number().over(Window.partitionBy("file", "key").orderBy("at"))  # a key is mostly one record
    mine = left.alias("x").join(right.alias("y"), whole, "left_anti").withColumn("nth", nth)
    theirs = right.alias("x").join(left.alias("y"), whole, "left_anti").withColumn("nth", nth)
    found = mine.alias("x").join(theirs.alias("y"), same(["file", "key", "nth"]), "full")
    status = F.when(F.col("y.digest").isNull(), "missing").when(F.col("x.digest").isNull(), "extra").otherwise("altered")
    findings = found.select(*(F.coalesce(f"x.{c}", f"y.{c}").alias(c) for c in ("file", "at", "key", "times")), F.col("x.digest").alias("expected"), F.col("y.digest").alias("found"), status.alias("status"))
    return findings, spark.createDataFrame(visits, "level int, compared long, differing long")


def damaged(page_id: Column, html: Column) -> Column:
    """What a worn replica holds: some pages altered, some cut in half; by a rule on page_id."""
    rest = F.pmod(page_id, F.lit(97))
    return F.when(rest == 3, F.concat(F.lit("x"), F.substr(html, F.lit(2)))).when(rest == 50, F.substr(html, F.lit(1), F.floor(F.char_length(html) / 2).cast("int"))).otherwise(html)


def fixity_report(pages: DataFrame, range_bytes: int = RANGE_BYTES, fan: int = FAN, records_a_file: int = RECORDS_A_FILE) -> DataFrame:
    """page_id, status, expected and found digest of every record in which two replicas differ.

    The primary holds the pages as WARC records, the replica the same with `damaged` pages and
    without those of page_id % 97 = 77, each at its own offsets. Both are hashed in one scan; only
    digests and sizes move. Pages are read whole, however long; other columns are not read.
    A null url or html is written as empty, a null page_id is never damaged. Of repeated rows each
    copy is a record; they are reported once with their number in `times`.
    """
    record = warc_record(F.col("url"), F.col("html"), F.col("page_id"))
    worn = warc_record(F.col("url"), damaged(F.col("page_id"), F.col("html")), F.col("page_id"))
    lost = F.coalesce(F.pmod("page_id", F.lit(97)) == 77, F.lit(False))
    size = lambda x: F.octet_length(x).cast("long")
    both = pages.select(F.col("page_id").cast("long").alias("key"), size(record).alias("size"), F.sha2(record, 256).alias("digest"), F.when(~lost, F.sha2(worn, 256)).alias("replica"), F.when(~lost, size(worn)).alias("replica_size"))
    placed = cut(laid_out(both, records_a_file, "replica_size"))
    theirs = placed.where("replica is not null").select("file", F.col("replica_at").alias("at"), "key", F.col("replica").alias("digest"), "times")
    findings, _ = audit(placed, theirs, range_bytes, fan)
    return findings.select(F.col("key").alias("page_id"), "status", "expected", "found", "times")
