"""Problem 6: filling containers of fixed capacity.

Method: harmonic packing. Lengths are in class k when k of them, and not k + 1, are sure to fit (capacity / (k + 1)
< length <= capacity / k); from ``CLASSES`` on all are in the last class. A bin of class k takes k items in the order
of their keys, whatever other classes hold, so that each class of each shard is filled by whatever worker
has it (:func:`harmonic`). Shards are dealt by a hash of the key.

The plain method leaves the room empty that k items of a class don't need. A second step, :func:`topped_up`, fills it:
shard by shard, class by class, a bin gets the largest items of later classes that fit, taken out of the last of
their own bins; what is left of broken bins is put together again, k at a time. ``fill_report`` tells the room used
before and after that step.

A text above the capacity is cut into pieces of the whole capacity and a rest, which is packed like
any item; nothing else is cut.

Defined results: null and empty texts have no tokens and get no container; a repeated id counts once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Items of a shard; a shard wastes at most part of one bin for each class.
SHARD_ITEMS = 50_000
CLASSES = 32
#: Kinds of container; they are written by hand and are constants of the plan.
MAX_KINDS = 1_000


def harmonic(pieces: DataFrame) -> DataFrame:
    """``class`` and ``class_bin`` (from 0 in each shard) of pieces: container_name, capacity, shard, doc_id, piece_no, n. Every bin of class k but
    the last of a shard has k items."""
    own = Window.partitionBy("container_name", "capacity", "shard", "class").orderBy("doc_id", "piece_no")
    return pieces.withColumn("class", F.least(F.floor(F.col("capacity") / F.col("n")), F.lit(CLASSES)).cast("int")).withColumn(
        "class_bin", F.floor((F.row_number().over(own) - 1) / F.col("class")).cast("bigint"),
    )


def topped_up(lengths: list[int], kinds: list[int], bins: list[int], capacity: int) -> list[int]:
    """The bin (from 0) of each item, from the classes and bins within classes that :func:`harmonic` gave."""
    order = sorted(range(len(lengths)), key=lambda i: (kinds[i], bins[i]))
    at: dict[int, list[int]] = {}
    for i in order:
        at.setdefault(lengths[i], []).append(i)
    largest = list(range(capacity + 1))  # largest[n]: n or less, on the way to the largest length not used up
    out = [-1] * len(lengths)

    def left(n: int) -> bool:
        stack = at.get(n)
        while stack and out[stack[-1]] >= 0:
            stack.pop()
        return bool(stack)

    def find(n: int) -> int:
        root = n
        while root and not left(root):
            root = largest[root] if largest[root] != root else root - 1
        while n > root:
            n, largest[n] = (largest[n] if largest[n] != n else n - 1), root
        return root

    used = 0

    def fill(members: list[int]) -> None:
        nonlocal used
        room = capacity
        for i in members:
            out[i] = used
            room -= lengths[i]
        while room and (m := find(room)):
            out[at[m].pop()] = used
            room -= m
        used += 1

    k = 0
    while k < len(order):
        own = kinds[order[k]]
        loose: list[int] = []  # of broken bins
        while k < len(order) and kinds[order[k]] == own:
            z = k
            while z < len(order) and kinds[order[z]] == own and bins[order[z]] == bins[order[k]]:
                z += 1
            members = [i for i in order[k:z] if out[i] < 0]
            if len(members) == own:
                fill(members)
            else:
                loose += members
            k = z
        while loose := [i for i in loose if out[i] < 0]:
            fill(loose[:own])
    return out


def _top_up_group(key, items):
    column = lambda n: items.column(n).to_numpy()
    order = np.lexsort((column("piece_no"), column("doc_id")))
    found = topped_up(*(column(n)[order].tolist() for n in ("n", "class", "class_bin")), key[1].as_py())
    items = items.take(pa.array(order))
    own = ("container_name", "shard", "doc_id", "piece_no", "token_start", "n", "class", "class_bin")
    return pa.table({n: items.column(n) for n in own} | {"bin": pa.array(found, pa.int64())})


def fill_containers(counted: DataFrame, spec: DataFrame, n_items: int) -> DataFrame:
    """Which container each text, or piece of a text above the capacity, goes to, and its ``harmonic_id``: the bin before topping up.

    ``counted``: doc_id, n_tokens. ``spec``: container_name, capacity_tokens, a few rows (more than ``MAX_KINDS`` are an
    error). ``n_items``: about how many texts there are, for the number of shards.
    """
    shards = max(1, -(-n_items // SHARD_ITEMS))
    spec = spec.where("capacity_tokens > 0 and container_name is not null").dropDuplicates(["container_name"]).select(
        "container_name", F.col("capacity_tokens").cast("bigint").alias("capacity"),
    )
    wanted = spec.limit(MAX_KINDS + 1).collect()
    if len(wanted) > MAX_KINDS:
        raise ValueError(f"more than {MAX_KINDS} kinds of container")
    kinds = [F.struct(F.lit(r.container_name).alias("container_name"), F.lit(r.capacity).cast("bigint").alias("capacity")) for r in wanted]
    kind = F.array(*kinds) if kinds else F.from_json(F.lit("[]"), "array<struct<container_name:string,capacity:bigint>>")
    rows = counted.where("n_tokens > 0").withColumn("_kind", F.explode(kind)).select("doc_id", "n_tokens", "_kind.container_name", "_kind.capacity")
    n_full = F.floor((F.col("n_tokens") - 1) / F.col("capacity")).cast("int")
    pieces = rows.withColumn("piece_no", F.explode(F.sequence(F.lit(0), n_full))).select(
        "container_name", "capacity", "doc_id", "piece_no", (F.col("piece_no") * F.col("capacity")).alias("token_start"),
        F.least(
            "capacity", F.col("n_tokens") - F.col("piece_no") * F.col("capacity"),
        ).alias("n"), F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"),
    )
    packed = harmonic(pieces).groupBy("container_name", "capacity", "shard").applyInArrow(
        _top_up_group,
        "container_name string, shard int, doc_id bigint, piece_no int, token_start bigint, n bigint, class int, class_bin bigint, bin bigint",
    )
    return packed.select(
        "container_name", F.concat_ws("-", "shard", "bin").alias("container_id"), "doc_id", "piece_no", "token_start", F.col("n").alias("n_tokens"),
        F.concat_ws("-", "shard", "class", "class_bin").alias("harmonic_id"),
    )


def fill_report(packed: DataFrame, spec: DataFrame) -> DataFrame:
    """Containers, tokens and the share of room used, per container kind, after topping up and before it."""
    each = packed.groupBy("container_name").agg(
        F.countDistinct("container_id").alias("n_containers"), F.countDistinct("harmonic_id").alias("n_harmonic"), F.sum("n_tokens").alias("n_tokens"),
    )
    room = lambda n: F.col("n_tokens") / (F.col(n) * F.col("capacity_tokens"))
    return each.join(F.broadcast(spec.dropDuplicates(["container_name"])), "container_name").select(
        "container_name", F.col("capacity_tokens").cast("bigint").alias("capacity_tokens"), "n_containers", "n_tokens",
        room("n_containers").alias("share_filled"), "n_harmonic", room("n_harmonic").alias("share_filled_before"),
    )
