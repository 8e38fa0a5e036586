"""Clip manifests from a landing folder, as a stream that takes each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

MANIFEST = "index long, file string, text string"


def manifests(spark: SparkSession, folder: str, schema: str = MANIFEST, files_a_batch: int = 1000) -> DataFrame:
    """Rows of CSV manifests as they arrive, with the file that each came from and its time."""
    stream = spark.readStream.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("maxFilesPerTrigger", files_a_batch).csv(folder)
    return stream.select("*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_modification_time").alias("arrived"))


def arrivals(clips: DataFrame, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Clips by window of arrival; a window is final once the watermark has passed it."""
    return clips.withWatermark("arrived", late).groupBy(F.window("arrived", window)).agg(F.count("*").alias("clips"), F.sum(F.char_length("text")).alias("chars"))


def land(clips: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends all that has arrived as Parquet, exactly once, and ends."""
    return clips.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
