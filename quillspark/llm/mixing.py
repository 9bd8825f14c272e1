"""Problem 7: mixing sources to target weights.

Method: Pfair scheduling. With shares w of the total, block j (from 0) of a source is released in slot
floor(j / w) and due by slot ceil((j + 1) / w); in each slot the released block with the earliest deadline
goes next, so that after any slot a source is less than one block from its share.

The size of the mixture is the largest at which every source that has records can give its share while
it repeats none of them more than ``max_repeats`` times, or ``total_tokens`` if that is less. Sources of
the target without records are left out and the other shares scaled; the report has them with share 0.

The schedule has at most ``MAX_SLOTS`` slots, whatever the data: blocks grow with the mixture. It holds the
sources' numbers only, a few for each row of the target; records meet it in a join.

Defined results: null and empty texts have no tokens and are not used; a null, blank or unknown source
has no target and is not used; weights that are null or not above 0 count as 0; ``max_repeats`` below 1
or null counts as 1; a repeated id counts once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK_TOKENS = 8_192
MAX_SLOTS = 1_000_000
#: Buckets of a source in the two steps of its running sum.
BUCKETS = 4_096


def standard_source(col: str) -> Column:
    return F.nullif(F.regexp_replace(F.trim(F.lower(F.col(col))), r"[\s_-]+", "_"), F.lit(""))


def schedule(weights: list[float], blocks: list[int]) -> Iterator[tuple[int, int, int]]:
    """(slot, index of the source, block of the source), earliest deadline first among the released.

    ``blocks``: how many blocks each source has; a source without blocks left frees its slots.
    """
    total = sum(Fraction(w) for w in weights)
    share = [Fraction(w) / total for w in weights] if total else []
    waiting = [(0, i, 0) for i, n in enumerate(blocks) if n > 0 and share[i] > 0]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    slot = 0
    while waiting or ready:
        while waiting and (waiting[0][0] <= slot or not ready):
            _, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-((-(j + 1) * share[i].denominator) // share[i].numerator), i, j))
        _, i, j = heapq.heappop(ready)
        yield slot, i, j
        if j + 1 < blocks[i]:
            heapq.heappush(waiting, ((j + 1) * share[i].denominator // share[i].numerator, i, j + 1))
        slot += 1


def _targets(target: DataFrame) -> DataFrame:
    clean = target.select(
        standard_source("source").alias("source"), F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("weight"),
        F.greatest(F.coalesce(F.col("max_repeats").cast("int"), F.lit(1)), F.lit(1)).alias("max_repeats"),
    )
    return clean.where("source is not null").groupBy("source").agg(F.sum("weight").alias("weight"), F.max("max_repeats").alias("max_repeats"))


def _plan(spark: SparkSession, sums: DataFrame, target: DataFrame, total_tokens: int | None, block_tokens: int) -> tuple[list[dict], int]:
    """A row for each source of the target (a few dozen, as the target is written by hand) and the block size."""
    rows = [r.asDict() for r in _targets(target).join(sums, "source", "left").na.fill(0, ["tokens"]).orderBy("source").collect()]
    used = [r for r in rows if r["weight"] > 0 and r["tokens"] > 0]
    whole = sum(r["weight"] for r in used)
    most = min((r["tokens"] * r["max_repeats"] * whole / r["weight"] for r in used), default=0)
    size = min(most, total_tokens) if total_tokens is not None else most
    block = max(block_tokens, -(-int(size) // (MAX_SLOTS // 2)))
    for r in rows:
        r["quota"] = int(size * r["weight"] / whole) if r in used else 0
        r["blocks"] = -(-r["quota"] // block)
    return rows, block


def mix(counted: DataFrame, target: DataFrame, total_tokens: int | None = None, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """The mixture and the plan it follows.

    ``counted``: doc_id, source, n_tokens, best read from a written table, as it is read twice. Gives
    (slot, source, block_no, doc_id, repeat_no, n_tokens): the order of the mixture is by slot, source, repeat
    and id. Each source's records are put in the order of a hash; their running sum is made in two
    steps, over buckets and within each, so that no task sorts a whole source.
    """
    spark = counted.sparkSession
    src = counted.select(standard_source("source").alias("source"), "doc_id", "n_tokens").where("source is not null and n_tokens > 0").withColumn("hash", F.xxhash64("doc_id")).withColumn(
        "bucket", F.pmod(F.shiftrightunsigned("hash", 8), F.lit(BUCKETS)).cast("int"),
    )
    by_bucket = src.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("tokens"))
    known = by_bucket.join(F.broadcast(_targets(target).select("source")), "source")
    rows, block = _plan(spark, known.groupBy("source").agg(F.sum("tokens").alias("tokens")), target, total_tokens, block_tokens)
    plan = spark.createDataFrame(
        [(r["source"], float(r["weight"]), int(r["max_repeats"]), int(r["tokens"]), int(r["quota"])) for r in rows],
        "source string, weight double, max_repeats int, tokens bigint, quota bigint",
    )
    # at most BUCKETS rows for each source of the target
    before = known.withColumn(
        "before", F.sum("tokens").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
    ).select("source", "bucket", F.coalesce("before", F.lit(0)).alias("before"))
    within = Window.partitionBy("source", "bucket").orderBy("hash", "doc_id")
    placed = (
        src.join(F.broadcast(plan.where("quota > 0").select("source", F.col("tokens").alias("length"), "quota")), "source")
        .join(F.broadcast(before), ["source", "bucket"])
        .withColumn("start", F.col("before") + F.sum("n_tokens").over(within) - F.col("n_tokens"))
        .where("start < quota")
        .withColumn("repeat_no", F.explode(F.sequence(F.lit(0), F.floor((F.col("quota") - F.col("start") - 1) / F.col("length")).cast("int"))))
        .withColumn("block_no", F.floor((F.col("start") + F.col("repeat_no") * F.col("length")) / F.lit(block)))
    )
    used = [r for r in rows if r["blocks"]]
    names, weights, blocks = [r["source"] for r in used], [r["weight"] for r in used], [r["blocks"] for r in used]

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            out: list[tuple[int, int, int]] = []
            for x in schedule(weights, blocks):
                out.append(x)
                if len(out) == 50_000:
                    yield _slot_batch(out, names)
                    out = []
            if out:
                yield _slot_batch(out, names)

    order = spark.range(1, numPartitions=1).mapInArrow(slots, "slot bigint, source string, block_no bigint")
    # a block of one source holds few records, so the join has no hot key
    mixed = placed.join(order, ["source", "block_no"]).select("slot", "source", "block_no", "doc_id", "repeat_no", "n_tokens")
    return mixed, plan


def _slot_batch(rows: list[tuple[int, int, int]], names: list[str]) -> pa.RecordBatch:
    slot, source, block = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(slot, pa.int64()), pa.array([names[i] for i in source], pa.string()), pa.array(block, pa.int64())],
        names=["slot", "source", "block_no"],
    )


def shares(mixed: DataFrame, plan: DataFrame) -> DataFrame:
    """Target and reached share of each source of the target; ``unused_tokens`` are those of its records that are in the mixture not once, as
    the source that runs out first bounds the whole."""
    got = mixed.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_used"), F.countDistinct("doc_id").alias("n_records"), (F.max("repeat_no") + 1).alias("most_used"),
        F.sum("n_tokens").alias("used_tokens"), F.sum(F.when(F.col("repeat_no") == 0, F.col("n_tokens"))).alias("_once"),
    )
    every = Window.partitionBy()  # over the rows of the target
    return plan.join(got, "source", "left").select(
        "source", F.try_divide("weight", F.sum("weight").over(every)).alias("target_share"), F.coalesce(
            F.try_divide(F.coalesce("used_tokens", F.lit(0)), F.sum(F.coalesce("used_tokens", F.lit(0))).over(every)), F.lit(0.0),
        ).alias("actual_share"),
        F.coalesce("used_tokens", F.lit(0)).alias("used_tokens"), F.coalesce("n_used", F.lit(0)).alias("n_used"), F.coalesce("n_records", F.lit(0)).alias("n_records"), F.coalesce("most_used", F.lit(0)).alias("most_used"), "max_repeats",
        (F.col("tokens") - F.coalesce("_once", F.lit(0))).alias("unused_tokens"),
    )
