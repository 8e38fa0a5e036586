"""Tables in the folder that the cluster shares, in place of what would be computed again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scopes: list[list[str]] = []
#: Bytes that a batch for Python has at most once a table has been written: buffers double as they grow, in
#: every running task, beside the heap.
BATCH_BYTES = 8 << 20


def limit_batches(spark: SparkSession) -> None:
    """Lowers the session's limit, for the job at hand and for those that read its table."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset, a local one in local mode only (tests).

    On a cluster a local folder would be another one on each machine, so there it must be set.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tonehive-checkpoint-"))
    return sc.getCheckpointDir()


def _on_file_system(spark: SparkSession, path: str, method: str, *args: object) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    getattr(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), method)(p, *args)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Has a table deleted with the application."""
    _on_file_system(spark, path, "deleteOnExit")


def new_folder(spark: SparkSession) -> str:
    """An empty folder in the shared one, deleted with the `scratch` around the call or with the application."""
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    _on_file_system(spark, path, "mkdirs")
    if _scopes:
        _scopes[-1].append(path)
    delete_at_end(spark, path)
    return path


def written(df: DataFrame) -> DataFrame:
    """`df` written once as Parquet in the shared folder and read back.

    The result no longer depends on shuffle files or cached blocks of any executor, so a lost
    executor costs only the tasks that run at the moment. The table goes when the `scratch` around
    the call ends, or else with the application.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    limit_batches(spark)
    df.write.parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    delete_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that are written inside; what is computed from them must have been written by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _on_file_system(spark, path, "delete", True)
