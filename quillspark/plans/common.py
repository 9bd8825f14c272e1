"""Tables as the queries see them: each key once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table


def base(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return table(spark, sf, name).select(*columns) if columns else table(spark, sf, name)


#: Columns of whole texts, which no shuffle should carry.
WIDE = {"text", "content", "body", "summary", "transcript"}
#: Repeated keys sent to all executors; more are grouped by a shuffle.
BROADCAST_KEYS = 1_000_000


def once(spark: SparkSession, sf: str, name: str, key: str, *columns: str) -> DataFrame:
    """A repeated key has the same content but may have lost a side field: the greatest value is kept, which
    leaves out nulls and is combined before the shuffle.

    Where whole texts are asked for, only keys are shuffled, to find the repeated ones (one job); rows with a key of their own stay
    where they are read, and only repeated rows are grouped.
    """
    rows = table(spark, sf, name).where(F.col(key).isNotNull())
    named = {c: c.replace("metadata.", "") for c in columns}
    whole = lambda df: df.groupBy(key).agg(*(F.max(c).alias(n) for c, n in named.items()))
    if not WIDE & {*columns}:
        return whole(rows)
    repeated = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)
    if repeated.limit(BROADCAST_KEYS + 1).count() > BROADCAST_KEYS:
        return whole(rows)
    single = rows.join(F.broadcast(repeated), key, "left_anti").select(key, *(F.col(c).alias(n) for c, n in named.items()))
    return single.unionByName(whole(rows.join(F.broadcast(repeated), key, "left_semi")))


def once_sql(name: str, key: str, *columns: str) -> str:
    return f"(SELECT {key}, {
        ', '.join(f'max({c}) AS {c.replace("metadata.", "")}' for c in columns)
    } FROM {name} WHERE {key} IS NOT NULL GROUP BY {key})"
