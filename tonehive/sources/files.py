"""Files: CSV with quoted line ends, replacing what is being read, audio listings, sharded Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str | list[str], schema: str | None = None, null_value: str | None = None) -> DataFrame:
    """UTF-8 CSV with a header; cells may hold line ends and doubled quotes. Without a schema all are strings.

    An empty or missing cell is an empty string unless `null_value` is given; surplus cells are dropped.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").option("emptyValue", "")
    reader = reader.option("nullValue", null_value) if null_value is not None else reader
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.na.fill("") if null_value is None else df


def write_csv(df: DataFrame, path: str, by: str | None = None) -> None:
    """CSV with a header, in a folder for each value of `by` if given; one pass over `df`.

    Cells are written as they are, white space around them too. An empty cell that is alone on its line is quoted, since
    readers pass over empty lines.
    """
    cells = [c for c in df.schema if c.name != by]
    alone = len(cells) == 1 and cells[0].dataType.simpleString() == "string"
    df = df.na.fill("") if alone else df
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", '""' if alone else "")
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    (writer.partitionBy(by) if by else writer).csv(path)


def replace_csv(df: DataFrame, path: str) -> None:
    """Writes `df`, which may read from `path`, beside it and renames that to `path`: a file where it was one, else a folder.

    A run that fails leaves the old data; the renames are the file system's own.
    """
    spark = df.sparkSession
    staged, old = f"{path.rstrip('/')}.{uuid.uuid4().hex}.new", f"{path.rstrip('/')}.{uuid.uuid4().hex}.old"
    p, found = _file_system(spark, path)
    (write_one_csv if found.exists(p) and found.getFileStatus(p).isFile() else write_csv)(df, staged)
    jvm = spark.sparkContext._jvm
    path_of = jvm.org.apache.hadoop.fs.Path
    fs = path_of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = fs.exists(path_of(path))
    if had and not fs.rename(path_of(path), path_of(old)):
        raise OSError(f"cannot move {path}")
    if not fs.rename(path_of(staged), path_of(path)):
        if had:
            fs.rename(path_of(old), path_of(path))
        raise OSError(f"cannot replace {path}")
    if had:
        fs.delete(path_of(old), True)


def _file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file_system(spark, path)
    return fs.exists(p)


def _scan(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Binary files below a folder, with file: the path relative to the folder, characters as they are on disk."""
    p, fs = _file_system(spark, folder)
    root = p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri().getPath().rstrip("/") + "/"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    # The path less its scheme and authority begins with the folder's own path.
    whole = F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return found.withColumn("file", F.substr(whole, F.lit(len(root) + 1)))


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """file (relative to `folder`), path, size: names alone, contents are not read."""
    return _scan(spark, folder, pattern).select("file", "path", F.col("length").alias("size"))


def audio(spark: SparkSession, folder: str, pattern: str = "*.wav") -> DataFrame:
    """file and audio (struct of bytes and path) of every audio file."""
    return _scan(spark, folder, pattern).select("file", F.struct(F.col("content").alias("bytes"), "path").alias("audio"))


def copy_missing(wanted: DataFrame, source: str, target: str) -> tuple[int, DataFrame]:
    """Copies files named in `wanted` (file) from one folder to another unless they are there.

    Returns how many were copied, and the names that the source lacks. Folders are on any file system
    that Spark reads. Which files are due is found by joins of the listings; the copies are streams
    of the file systems' own, one after the other.
    """
    spark = wanted.sparkSession
    names = wanted.select("file").distinct()
    there = listing(spark, source).select("file")
    due = names.join(there, "file", "left_semi")
    if exists(spark, target):
        due = due.join(listing(spark, target).select("file"), "file", "left_anti")
    util = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    copied = 0
    for row in due.toLocalIterator():  # a partition of names at a time
        a, from_fs = _file_system(spark, f"{source.rstrip('/')}/{row.file}")
        b, to_fs = _file_system(spark, f"{target.rstrip('/')}/{row.file}")
        to_fs.mkdirs(b.getParent())
        if not util.copy(from_fs, a, to_fs, b, False, conf):
            raise OSError(f"cannot copy {row.file}")
        copied += 1
    return copied, names.join(there, "file", "left_anti")


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """One small text as one file, on any file system that Spark writes."""
    p, fs = _file_system(spark, path)
    if fs.exists(p) and fs.getFileStatus(p).isDirectory():
        fs.delete(p, True)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_one_csv(df: DataFrame, path: str) -> None:
    """CSV with a header as one file, for tables that one task can write; larger ones go to `write_csv`."""
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}.new"
    write_csv(df.coalesce(1), staged)
    p, fs = _file_system(spark, staged)
    part = [f.getPath() for f in fs.listStatus(p) if f.getPath().getName().startswith("part-")]
    goal, _ = _file_system(spark, path)
    if fs.exists(goal):
        fs.delete(goal, True)
    if part:
        fs.rename(part[0], goal)
    fs.delete(p, True)


def write_shards(df: DataFrame, path: str, size: int = 500, by: str = "split") -> None:
    """Parquet in a folder for each split, no file of more than `size` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", size).partitionBy(by).parquet(path)
