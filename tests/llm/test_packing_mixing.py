import os
import random

import pytest
from pyspark.sql import functions as F

from quillspark.llm import mixing as M
from quillspark.llm import packing as P
from quillspark.llm import queries as Q
from quillspark.llm import tokens

needs_tokenizer = pytest.mark.skipif(not os.path.exists(tokens.TOKENIZER_PATH), reason="no tokenizer files here")


def classes_of(lengths, capacity):
    kinds, seen, bins = [min(capacity // n, P.CLASSES) for n in lengths], {}, []
    for k in kinds:
        bins.append(seen.get(k, 0) // k)
        seen[k] = seen.get(k, 0) + 1
    return kinds, bins


def largest_fit(lengths, capacity):
    """Always the largest item that fits; the bins as sets of lengths."""
    left, out = sorted(lengths), []
    while left:
        room, own = capacity, []
        while fits := [n for n in left if n <= room]:
            left.remove(fits[-1])
            own.append(fits[-1])
            room -= fits[-1]
        out.append(tuple(sorted(own)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(20))
def test_bins_hold_all_items_within_capacity(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 100, 512])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 600))]
    kinds, own = classes_of(lengths, capacity)
    bins = P.topped_up(lengths, kinds, own, capacity)
    load = {}
    for n, b in zip(lengths, bins):
        load.setdefault(b, []).append(n)
    assert len(bins) == len(lengths) and all(sum(x) <= capacity for x in load.values()) and sorted(load) == list(range(len(load)))
    assert len(load) <= len(set(zip(kinds, own)))
    if lengths and capacity == 100:
        assert len(load) <= 1.2 * sum(lengths) / capacity + 3
    if len(lengths) > 50 and capacity >= 100:
        assert sorted(tuple(sorted(x)) for x in load.values()) != largest_fit(lengths, capacity)


def test_classes_have_a_fixed_count_whatever_others_hold(spark):
    rng = random.Random(5)
    rows = [("box", 100, i % 3, i, 0, rng.randint(1, 100)) for i in range(900)]
    d = spark.createDataFrame(rows, "container_name string, capacity bigint, shard int, doc_id bigint, piece_no int, n bigint")
    got = P.harmonic(d).collect()
    bins = {}
    for r in got:
        assert r["class"] == min(100 // r.n, P.CLASSES)
        bins.setdefault((r.shard, r["class"]), {}).setdefault(r.class_bin, []).append(r.n)
    for (_, k), own in bins.items():
        assert sorted(own) == list(range(len(own))) and all(len(own[b]) == k and sum(own[b]) <= 100 for b in list(own)[:-1] if b != max(own)) and len(own[max(own)]) <= k
    alone = {(r.shard, r.doc_id): r.class_bin for r in P.harmonic(d.where("n between 26 and 33")).collect()}
    assert alone == {(r.shard, r.doc_id): r.class_bin for r in got if r["class"] == 3} and len(alone) > 20


def test_containers(spark):
    spec = spark.createDataFrame([("small", 10), ("large", 100), ("none", 0)], "container_name string, capacity_tokens int")
    d = spark.createDataFrame([(1, 25), (2, 10), (3, 1), (4, 0), (5, 9), (5, 9)], "doc_id bigint, n_tokens bigint").distinct()
    got = P.fill_containers(d, spec, 5).collect()
    per = {}
    for r in got:
        per.setdefault((r.container_name, r.container_id), 0)
        per[r.container_name, r.container_id] += r.n_tokens
    assert all(v <= {"small": 10, "large": 100}[k[0]] for k, v in per.items())
    assert [(r.piece_no, r.token_start, r.n_tokens) for r in sorted(got, key=lambda r: r.piece_no) if r.container_name == "small" and r.doc_id == 1] == [(0, 0, 10), (1, 10, 10), (2, 20, 5)]
    assert all(r.piece_no == 0 for r in got if r.doc_id != 1 or r.container_name == "large") and all(r.doc_id != 4 for r in got)
    assert P.fill_containers(d.limit(0), spec, 0).count() == 0
    report = {r.container_name: r for r in P.fill_report(P.fill_containers(d, spec, 5), spec).collect()}
    assert report["small"].n_tokens == 45 and report["small"].share_filled >= report["small"].share_filled_before > 0


@needs_tokenizer
def test_containers_of_the_tables(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    counted = tokens.with_token_counts(docs, ["doc_id"]).where("n_tokens > 0")
    got = Q.p6_containers(spark, data)
    whole = got.groupBy("container_name", "doc_id").agg(F.sum("n_tokens").alias("n")).join(counted, "doc_id")
    assert whole.where("n <> n_tokens").count() == 0 and whole.count() == 4 * counted.count()
    over = got.groupBy("container_name", "container_id").agg(F.sum("n_tokens").alias("n")).join(
        spark.read.parquet(f"{data}/container_spec.parquet"), "container_name",
    ).where("n > capacity_tokens")
    assert over.count() == 0
    fill = Q.p6_fill(spark, data)
    assert fill.where("share_filled > 0.9").count() >= 3 and fill.where("share_filled < share_filled_before").count() == 0


def test_schedule_stays_within_a_block():
    weights, blocks = [5.0, 3.0, 1.5, 0.5], [500, 300, 150, 50]
    seen, order = [0] * 4, list(M.schedule(weights, blocks))
    assert [s for s, _, _ in order] == list(range(1000)) and len({(i, j) for _, i, j in order}) == 1000
    for slot, i, j in order:
        assert j == seen[i]
        seen[i] += 1
        assert all(abs(seen[k] - weights[k] / 10 * (slot + 1)) < 1 for k in range(4))
    assert list(M.schedule([], [])) == [] and [x[1] for x in M.schedule([1.0, 0.0], [2, 0])] == [0, 0]


def test_mixture(spark):
    rows = [(i, ["Big", " big", "BIG"][i % 3], 100) for i in range(2000)] + [(5000 + i, "Small-One", 50) for i in range(40)] + [
        (9000, None, 5), (9001, "big", 0), (9002, "other", 7),
    ]
    d = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint").withColumn("slot", F.lit(1))
    target = spark.createDataFrame(
        [("big", 3.0, 1), ("small_one", 1.0, 4), ("absent", 1.0, 9), ("nothing", None, None)], "source string, weight double, max_repeats int",
    )
    mixed, plan = M.mix(d, target, block_tokens=400)
    got = {r.source: r for r in M.shares(mixed, plan).collect()}
    assert abs(got["small_one"].actual_share - 0.25) < 0.03 and got["absent"].actual_share == 0 and got["small_one"].most_used == 4
    assert got["small_one"].unused_tokens == 0 and got["big"].unused_tokens == 200_000 - got["big"].used_tokens and got["absent"].unused_tokens == 0
    # in the order of the mixture each source's tokens stay within a block, and a record that runs over its end, of its share
    seen, total = {"big": 0, "small_one": 0}, 0
    for r in mixed.orderBy("slot", "source", "repeat_no", "doc_id").collect():
        seen[r.source] += r.n_tokens
        total += r.n_tokens
        assert all(abs(seen[k] - w * total) <= 2 * 400 + 100 for k, w in (("big", 0.75), ("small_one", 0.25)))
    used = mixed.groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("repeat_no").alias("m"))
    assert used.where("n > 4 or n <> m").count() == 0 and used.where("doc_id >= 9000").count() == 0
    assert used.where("doc_id between 5000 and 8999 and n = 4").count() == 40
    small, _ = M.mix(d, target, total_tokens=4000, block_tokens=400)
    assert 3000 <= small.agg(F.sum("n_tokens")).first()[0] <= 4600


def test_mixture_of_nothing(spark):
    target = spark.createDataFrame([("big", 1.0, 1)], "source string, weight double, max_repeats int")
    mixed, plan = M.mix(spark.createDataFrame([], "doc_id bigint, source string, n_tokens bigint"), target)
    assert mixed.count() == 0 and M.shares(mixed, plan).first().used_tokens == 0


@needs_tokenizer
def test_shares_of_the_tables(spark, data):
    got = Q.p7_shares(spark, data).collect()
    assert abs(sum(r.actual_share or 0 for r in got) - 1) < 1e-9 and all(r.most_used <= r.max_repeats for r in got)
    assert Q.p7_mixture(spark, data).count() == sum(r.n_used for r in got)
