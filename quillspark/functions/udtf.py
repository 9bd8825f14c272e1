"""Table functions for SQL."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


@udtf(returnType="chunk_index int, content string")
class FixedChunks:
    """``SELECT * FROM t, LATERAL fixed_chunks(t.text, 500)``: pieces of so many characters; none for null or empty texts."""

    def eval(self, text: str, size: int) -> Iterator[tuple[int, str]]:
        if text and size and size > 0:
            for k, i in enumerate(range(0, len(text), size)):
                yield k, text[i : i + size]


def register(spark: SparkSession) -> None:
    spark.udtf.register("fixed_chunks", FixedChunks)
