"""What has been done, so that a stopped run goes on where it was: an append-only table of (key, status, pages, at)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "key string, status string, pages int, at timestamp"


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        """The latest entry of each key; a ledger that isn't there is empty."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        if not p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], SCHEMA)
        entries = self.spark.read.schema(SCHEMA).parquet(self.path)
        return entries.groupBy("key").agg(F.max(F.struct("at", "status", "pages")).alias("e")).select("key", "e.status", "e.pages", "e.at")

    def add(self, done: DataFrame, key: str, status: str = "processed", pages: str | None = None) -> None:
        rows = done.select(
            F.col(key).cast("string").alias("key"), F.lit(status).alias("status"),
            (F.col(pages) if pages else F.lit(None)).cast("int").alias("pages"), F.current_timestamp().alias("at"),
        )
        rows.dropDuplicates(["key"]).write.mode("append").parquet(self.path)

    def remaining(self, todo: DataFrame, key: str, again: tuple[str, ...] = ("failed",)) -> DataFrame:
        """What isn't done, and what has a status to try again."""
        done = self.read().where(~F.col("status").isin(*again)).select(F.col("key").alias("_k"))
        return todo.join(done, F.col(key).cast("string") == F.col("_k"), "left_anti")

    def next_page(self, documents: DataFrame, key: str, num_pages: str) -> DataFrame:
        """Adds ``next_page``: the page to go on with, or null if all are done."""
        seen = self.read().select(F.col("key").alias("_k"), F.col("pages").alias("_p"))
        done = F.coalesce("_p", F.lit(0))
        return documents.join(
            seen, F.col(key).cast("string") == F.col("_k"), "left",
        ).withColumn("next_page", F.when(done < F.col(num_pages), done + 1)).drop("_k", "_p")

    def clear(self) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
