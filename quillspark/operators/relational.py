"""Joins, reports and keys over document tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of a side that may be sent to all executors; a larger side is joined by a shuffle.
BROADCAST_ROWS = 500_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """With a hint to broadcast if it has at most ``most`` rows, which is counted without reading further than that."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, name: str, out: str) -> DataFrame:
    """Adds ``out``: the dimension's name of the key, or the key where it has none. The dimension has each key once."""
    d = dim.select(F.col(dim_key).alias("_k"), F.col(name).alias("_n"))
    return df.join(d, F.col(key) == F.col("_k"), "left").withColumn(out, F.coalesce("_n", F.col(key).cast("string"))).drop("_k", "_n")


def remaining(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not done; keys done that are null count for nothing."""
    return todo.join(done.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def referenced(df: DataFrame, refs: DataFrame, key: str) -> DataFrame:
    return df.join(refs.select(key), key, "left_semi")


def first_match(df: DataFrame, sources: DataFrame, key: str, rank: str, value: str) -> DataFrame:
    """Adds the value of the match with the lowest rank; the smallest value decides between equal ranks."""
    best = sources.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(rank, value)).alias("_b")).select(
        key, F.col(f"_b.{value}").alias(value), F.col(f"_b.{rank}").alias(rank),
    )
    return df.join(best, key, "left")


def first_seen(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key: combined before the shuffle, so that a hot key doesn't gather in one task."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_b"))
    return best.select(*keys, *(F.col(f"_b.{c}").alias(c) for c in [*order, *rest]))


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group with their ``rank``; Spark limits each partition's groups before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= n)


def outcome_report(df: DataFrame, group: str, done: Column) -> DataFrame:
    """Numbers and shares of done and failed per group and in all (``level`` 1)."""
    counted = df.withColumn("_done", done.cast("bigint")).rollup(group).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_done").alias("n_done"), F.grouping(group).cast("int").alias("level"),
    )
    return counted.select(
        group, "level", "n", F.coalesce("n_done", F.lit(0)).alias("n_done"), (F.col("n") - F.coalesce("n_done", F.lit(0))).alias("n_failed"),
        F.round(100 * F.coalesce("n_done", F.lit(0)) / F.col("n"), 2).alias("percent"),
    )


def surrogate_keys(df: DataFrame, path: list[str], order: str, base: int = 50_000) -> DataFrame:
    """(level, path..., parent_id, id): ids of all prefixes of the paths in the order of their first rows, depth first within each
    first-level group.

    The paths are distinct values of a hierarchy; only these are numbered, after an aggregation.
    """
    levels = []
    for i in range(1, len(path) + 1):
        keys = path[:i]
        seen = df.groupBy(*keys).agg(F.min(order).alias("_first"))
        levels.append(seen.select(*keys, *(F.lit(None).cast("string").alias(c) for c in path[i:]), F.lit(i).alias("level"), "_first"))
    nodes = levels[0]
    for x in levels[1:]:
        nodes = nodes.unionByName(x)
    group = nodes.withColumn("_group", F.min("_first").over(Window.partitionBy(path[0])))
    # distinct nodes of a hierarchy, not rows of data
    numbered = group.withColumn("id", F.row_number().over(Window.orderBy("_group", path[0], "level", "_first", *path[1:])) + base - 1)
    parent = numbered.select(F.col("level").alias("_pl"), *(F.col(c).alias(f"_p_{c}") for c in path), F.col("id").alias("parent_id"))
    on = F.col("_pl") == F.col("level") - 1
    for i, c in enumerate(path):
        on = on & ((F.col(f"_p_{c}").eqNullSafe(F.col(c)) & (F.col("level") > i + 1)) | ((F.col("level") <= i + 1) & F.col(f"_p_{c}").isNull()))
    return numbered.join(parent, on, "left").select("level", *path, "parent_id", "id")


def tag_frequency(tags: DataFrame, col: str) -> DataFrame:
    """Numbers of rows with each tag; a tag counts once in a row."""
    one = tags.select(F.explode(F.array_distinct(F.transform(col, lambda t: F.trim(t)))).alias("tag")).where("tag <> ''")
    return one.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def distinct_ignoring_case(tags: Column, most: int = 20) -> Column:
    """Tags in order, of those that differ in case only the first; at most ``most``."""
    clean = F.filter(F.transform(tags, lambda t: F.trim(t)), lambda t: t != "")
    low = F.transform(clean, lambda t: F.lower(t))
    firsts = F.filter(F.transform(clean, lambda t, i: F.when(F.array_position(low, F.lower(t)) == i + 1, t)), lambda t: t.isNotNull())
    return F.slice(firsts, 1, most)


def similar_strings(df: DataFrame, col: str, ratio: float = 0.85) -> DataFrame:
    """(a, b, ratio), a < b: distinct values alike by 1 - edit distance / longer length, found without comparing all pairs.

    A value alike to a longer one by at most k edits has, cut into k + 1 pieces, one that is in the longer value as it
    is, at most k characters off its place. Pieces meet such substrings in an equi-join on length, piece and text.
    Nulls and empty values are left out; values are distinct first, so that copies cost nothing.
    """
    v = df.select(F.col(col).alias("v")).where(F.col(col).isNotNull() & (F.length(col) > 0)).distinct().withColumn("n", F.length("v"))
    edits = lambda n: F.floor(F.lit(1 - ratio) * F.floor(n / F.lit(ratio) + 1e-9) + 1e-9).cast("int")
    start = lambda i, n, k: F.floor(i * n / (k + 1)).cast("int")
    short = v.withColumn("k", edits(F.col("n"))).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k"))))
    short = short.select(
        F.col("v").alias("x"), "n", "i",
        F.substring(
            "v", start(F.col("i"), F.col("n"), F.col("k")) + 1,
            start(F.col("i") + 1, F.col("n"), F.col("k")) - start(F.col("i"), F.col("n"), F.col("k")),
        ).alias("piece"),
    )
    long = v.select(
        F.col("v").alias("y"), F.col("n").alias("m"), F.explode(F.sequence(F.ceil(F.col("n") * ratio - 1e-9).cast("int"), F.col("n"))).alias("n"),
    ).withColumn("k", edits(F.col("n"))).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k"))))
    long = long.withColumn("at", start(F.col("i"), F.col("n"), F.col("k"))).withColumn(
        "size", start(F.col("i") + 1, F.col("n"), F.col("k")) - F.col("at"),
    )
    long = long.withColumn(
        "p", F.explode(F.sequence(F.col("at") - F.col("k"), F.col("at") + F.col("k"))),
    ).where("p >= 0 and p + size <= m").select("y", "n", "i", F.substring("y", F.col("p") + 1, F.col("size")).alias("piece")).distinct()
    pairs = short.join(long, ["n", "i", "piece"]).where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    alike = 1 - F.levenshtein("a", "b") / F.greatest(F.length("a"), F.length("b"))
    return pairs.withColumn("ratio", F.round(alike, 4)).where(alike >= ratio - 1e-9)
