"""Structured Streaming: folders read as they fill, with the stream's own checkpoint in place of a ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.chunks import token_windows


def text_stream(spark: SparkSession, path: str, files_per_trigger: int = 1_000) -> DataFrame:
    """(source_path, content, modified_at) of text files as they come."""
    raw = spark.readStream.format("text").option("wholetext", "true").option("maxFilesPerTrigger", files_per_trigger).load(path)
    return raw.select(
        F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("content"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    )


def chunk_stream(documents: DataFrame, size: int = 800, overlap: int = 100) -> DataFrame:
    return token_windows(documents, "content", size, overlap)


def first_seen_stream(df: DataFrame, key: str, time: str, late: str = "1 day") -> DataFrame:
    """Each key once within the watermark; the state is bounded by it."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def counts_stream(df: DataFrame, time: str, group: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    g = df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(
        F.window(time, window).alias("w"), group,
    ).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("start"), group, "n")


def write(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append to Parquet, each file's rows exactly once."""
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if once else w).start()
