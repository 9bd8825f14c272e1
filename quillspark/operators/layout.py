"""Reading order of blocks on pages with columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BINS = 10


def histogram(df: DataFrame, page: str, x: str) -> DataFrame:
    """(page, bin, n) of ten equal bins between a page's least and greatest value, the last closed; bins without values too.
    Null values are left out; where all are equal, they are in bin 5 as the middle of a range of 1."""
    ends = df.where(F.col(x).isNotNull()).groupBy(page).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    spread = F.col("_hi") - F.col("_lo")
    placed = df.where(F.col(x).isNotNull()).join(ends, page).withColumn(
        "bin",
        F.when(spread == 0, BINS // 2).otherwise(
            F.least(F.floor((F.col(x) - F.col("_lo")) / F.nullif(spread, F.lit(0.0)) * BINS), F.lit(BINS - 1))
        ).cast("int"),
    )
    counted = placed.groupBy(page, "bin").agg(F.count(F.lit(1)).alias("n"))
    dense = ends.select(page, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(BINS - 1))).alias("bin"))
    return dense.join(counted, [page, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def peaks(df: DataFrame, page: str, x: str, threshold: float = 0.3, pad_edges: bool = False) -> DataFrame:
    """(page, bin, centre, n): bins above both neighbours that hold more than ``threshold`` of the page's values. The first and the
    last bin are none unless ``pad_edges``."""
    w = Window.partitionBy(page).orderBy("bin")
    edge = F.lit(-1) if pad_edges else F.lit(None)
    h = histogram(df, page, x).withColumn("_a", F.lag("n").over(w)).withColumn("_z", F.lead("n").over(w)).withColumn(
        "_all", F.sum("n").over(Window.partitionBy(page)),
    )
    high = (F.col("n") > F.coalesce("_a", edge)) & (F.col("n") > F.coalesce("_z", edge)) & (F.col("n") > threshold * F.col("_all"))
    width = F.when(F.col("_hi") == F.col("_lo"), 1.0).otherwise(F.col("_hi") - F.col("_lo"))
    return h.where(high).select(page, "bin", (F.col("_lo") + (F.col("bin") + 0.5) * width / BINS).alias("centre"), "n")


def columns_of_blocks(df: DataFrame, page: str, key: str, x: str, centres: DataFrame) -> DataFrame:
    """Adds ``column_no``: the place, from the left, of the nearest centre; the left one if two are as near. A page without centres, or a
    block without a position, is in column 0. A page has at most ten centres, which become an array."""
    arr = centres.groupBy(page).agg(F.array_sort(F.collect_list("centre")).alias("_c"))
    off = F.transform(F.col("_c"), lambda c: F.abs(c - F.col(x)))
    nearest = F.array_position(off, F.array_min(off)) - 1
    return df.join(arr, page, "left").withColumn("column_no", F.coalesce(nearest, F.lit(0)).cast("int")).drop("_c")


def reading_order(df: DataFrame, page: str, key: str, y: str, column: str) -> DataFrame:
    """Adds ``band`` (0 head, 1 body, 2 foot) and ``place``: head above the first tenth of the range, foot below the last; the body goes by column."""
    w = Window.partitionBy(page)
    lo, hi = F.min(y).over(w), F.max(y).over(w)
    n_columns = F.max(column).over(w)
    band = F.when(n_columns == 0, 1).when(F.col(y) < lo + 0.1 * (hi - lo), 0).when(F.col(y) > hi - 0.1 * (hi - lo), 2).otherwise(1)
    banded = df.withColumn("band", band.cast("int"))
    order = Window.partitionBy(page).orderBy("band", F.when(F.col("band") == 1, F.col(column)).otherwise(0), F.col(y).asc_nulls_last(), key)
    return banded.withColumn("place", F.row_number().over(order))


def columns_per_page(df: DataFrame, page: str, x: str, threshold: float = 0.3) -> DataFrame:
    """(page, n_columns) of each page with blocks: its peaks, or one column if it has none."""
    found = peaks(df, page, x, threshold).groupBy(page).agg(F.count(F.lit(1)).alias("n_columns"))
    return df.select(page).distinct().join(found, page, "left").select(page, F.coalesce("n_columns", F.lit(1)).alias("n_columns"))


def tables(df: DataFrame, key: str, found: str) -> DataFrame:
    """(key, table_index, page_number, rows) of the tables that a layout program found, an array of (page_number, data); a table
    without data has no rows, a null table no page either; documents without tables give nothing."""
    each = df.select(key, F.posexplode(found).alias("table_index", "_t"))
    return each.select(
        key, "table_index", F.col("_t.page_number").alias("page_number"), F.coalesce(F.col("_t.data"), F.array().cast("array<array<string>>")).alias("rows"),
    )
