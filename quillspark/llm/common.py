"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` below the shared folder of ``spark.checkpoint.dir`` and read it back.

    Reading a written table cuts the lineage, and any executor can read it after another is lost.
    Without the setting (small tests), a folder in the local temporary directory is set.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            root = jdir.get()
        else:
            import tempfile

            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            root = "file://" + tempfile.mkdtemp(prefix="quillspark-")
            spark.sparkContext.setCheckpointDir(root)
    path = f"{root.rstrip('/')}/quillspark/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.parquet(path)


#: Tables of this process that aren't deleted yet.
_WRITTEN: list[str] = []


def released(path_df: DataFrame) -> None:
    """Delete a table written by :func:`materialise`, once nothing reads it any more."""
    _delete(path_df.sparkSession, {p.rsplit("/", 1)[0] for p in path_df.inputFiles() if "/quillspark/" in p})


def release_all(spark: SparkSession) -> int:
    """Delete the tables that operators have left for their results to be read from; to be called when all results are written."""
    return _delete(spark, {*_WRITTEN})


def _delete(spark: SparkSession, paths: set[str]) -> int:
    conf, n = spark.sparkContext._jsc.hadoopConfiguration(), 0
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        n += bool(path.getFileSystem(conf).delete(path, True))
        _WRITTEN[:] = [w for w in _WRITTEN if w.rsplit("/", 1)[1] != p.rsplit("/", 1)[1]]
    return n


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of few rows: of long texts a whole Arrow batch as Python strings, with what is made of it, takes much memory."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def usable_text(col: str = "text"):
    return F.col(col).isNotNull() & (F.length(F.trim(F.col(col))) > 0)
