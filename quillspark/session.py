"""Session settings that the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build(app: str = "quillspark", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config(map={**SETTINGS, **extra})
    return (builder.master(master) if master else builder).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
