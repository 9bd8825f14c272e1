"""Problem 1: near-duplicate texts.

Method: Bayesian candidate pruning. Texts become sets of word sequences ("shingles"). Pairs that agree in
all rows of some band of MinHash values are candidates; for each, further MinHash values are compared in
steps, and the pair is dropped as soon as the posterior probability that its similarity reaches the
threshold falls below a tolerance; what is left is verified on the shingles exactly.

Equal texts are one from the start: of each a single row is hashed into bands, so that the work doesn't grow
with the number of copies or of repeated rows. Bands are joined by Spark's join, whose skew handling splits a
hot bucket between tasks.

Defined results: null texts and texts of fewer than ``min_words`` words (or without a shingle) are alike
to nothing; a repeated id counts once; similarity is symmetric and pairs come smaller id first.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, released

_WORD = re.compile(r"[^\W_]+")
#: Ids sent to all executors to choose the candidates' texts; above it they are joined by a shuffle.
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class Settings:
    """``words``: words in a shingle. ``miss``: chance that a pair just at the threshold is no candidate.
    ``tolerance``: posterior probability below which a candidate is dropped. ``step``: MinHash values compared at a time."""

    words: int = 5
    threshold: float = 0.8
    min_words: int = 1
    rows: int = 4
    miss: float = 0.001
    hashes: int = 128
    step: int = 16
    tolerance: float = 1e-4

    @property
    def bands(self) -> int:
        return max(1, math.ceil(math.log(self.miss) / math.log(1 - self.threshold**self.rows)))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=8)
def _multipliers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**32, (2, n), dtype=np.uint64).astype(np.uint32) | np.array([[1], [0]], np.uint32)


class Shingler:
    """Shingle hashes of many texts at once; words are hashed once while they are remembered."""

    def __init__(self, settings: Settings):
        self.s, self.memo = settings, {}

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which texts count; the 64-bit hashes of all their shingles, with repeats; where each text's begin."""
        import xxhash

        memo, flat, sizes = self.memo, [], []
        if len(memo) > 500_000:
            memo.clear()
        least = max(self.s.min_words, self.s.words)
        for t in texts:
            found = _WORD.findall(t.lower())
            if len(found) < least:
                sizes.append(0)
                continue
            sizes.append(len(found))
            for w in found:
                h = memo.get(w)
                if h is None:
                    h = memo[w] = xxhash.xxh3_64_intdigest(w)
                flat.append(h)
        n = np.array(sizes, np.int64)
        keep = n > 0
        n = n[keep]
        h = np.array(flat, np.uint64)
        if not len(h):
            return keep, h, np.zeros(0, np.int64)
        k = self.s.words
        mixed = h[: len(h) - k + 1].copy()
        for j in range(1, k):
            mixed = _mix(mixed) + h[j : len(h) - k + 1 + j]
        mixed = _mix(mixed)
        first = np.cumsum(n) - n
        count = n - k + 1
        at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return keep, mixed[at], np.cumsum(count) - count


def min_hashes(shingles: np.ndarray, begin: np.ndarray, n: int, seed: int) -> np.ndarray:
    """n MinHash values (rows) of each text (columns)."""
    a, b = _multipliers(n, seed)
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    out = np.empty((n, len(begin)), np.uint32)
    for i in range(n):
        y = (x + b[i]) * a[i]
        y ^= y >> np.uint32(15)
        out[i] = np.minimum.reduceat(y * np.uint32(0x9E3779B1), begin)
    return out


def _band_keys(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(settings)
        for b in batches:
            keep, x, begin = shingle(b.column("t").to_pylist())
            ids = b.column("id").filter(pa.array(keep))
            if not len(begin):
                continue
            sig = min_hashes(x, begin, settings.bands * settings.rows, 1).astype(np.uint64)
            keys = np.empty((len(begin), settings.bands), np.uint64)
            for k in range(settings.bands):
                h = np.full(len(begin), k + 1, np.uint64)
                for r in range(settings.rows):
                    h = _mix(h) + sig[k * settings.rows + r]
                keys[:, k] = _mix(h)
            flat = pa.array(keys.reshape(-1).view(np.int64))
            offsets = pa.array(np.arange(len(begin) + 1, dtype=np.int32) * settings.bands)
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, flat)], names=["id", "keys"])

    return run


def _features(settings: Settings):
    """For candidates only: further MinHash values, and the sorted distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(settings)
        for b in batches:
            keep, x, begin = shingle(b.column("t").to_pylist())
            if not len(begin):
                continue
            sig = (min_hashes(x, begin, settings.hashes, 2) >> np.uint32(16)).astype(np.uint16).T
            ends = [*begin[1:].tolist(), len(x)]
            sets = [np.unique(x[i:j]).tobytes() for i, j in zip(begin.tolist(), ends)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("id").filter(pa.array(keep)), pa.array([s.tobytes() for s in np.ascontiguousarray(sig)], pa.binary()),
                    pa.array(sets, pa.binary()),
                ],
                names=["id", "sig", "shingles"],
            )

    return run


@lru_cache(maxsize=8)
def fewest_matches(threshold: float, hashes: int, step: int, tolerance: float) -> tuple[int, ...]:
    """After each step, the fewest matching values with which a pair stays: with fewer, the posterior
    probability (from a uniform prior of the similarity) of reaching the threshold is below the tolerance."""
    grid = np.linspace(0, 1, 2001)[1:-1]
    out = []
    for n in range(step, hashes + 1, step):
        for m in range(n + 1):
            like = m * np.log(grid) + (n - m) * np.log1p(-grid)
            p = np.exp(like - like.max())
            if p[grid >= threshold].sum() / p.sum() >= tolerance:
                break
        out.append(m)
    return tuple(out)


def _prune(settings: Settings):
    need = fewest_matches(settings.threshold, settings.hashes, settings.step, settings.tolerance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            a, z = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(b.num_rows, settings.hashes) for c in ("sig_a", "sig_b"))
            left, matches = np.arange(b.num_rows), np.zeros(b.num_rows, np.int64)
            for k, least in enumerate(need):
                part = slice(k * settings.step, (k + 1) * settings.step)
                matches[left] += (a[left, part] == z[left, part]).sum(axis=1)
                left = left[matches[left] >= least]
            rows = pa.array(left)
            yield pa.RecordBatch.from_arrays([b.column("a").take(rows), b.column("b").take(rows)], names=["a", "b"])

    return run


def _verify(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for x, y in zip(b.column("set_a").to_pylist(), b.column("set_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                found.append(both / (len(x) + len(y) - both))
            like = np.array(found, np.float64)
            keep = pa.array(like >= settings.threshold - 1e-12)
            yield pa.RecordBatch.from_arrays(
                [b.column("a").filter(keep), b.column("b").filter(keep), pa.array(like).filter(keep)], names=["a", "b", "similarity"],
            )

    return run


def distinct_texts(texts: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, t) of texts that occur in one row; (id, t) of texts that occur in several, once each under the smallest of their ids;
    and (rep, id), the smallest id and each id of the latter. The last two are written to the shared folder.

    Texts are told apart by 128 bits of a hash, of which alone a shuffle is made; the ids of repeated texts are sent to all
    executors up to ``BROADCAST_IDS``, and joined by a shuffle beyond. Of an id with different texts one counts.
    """
    src = texts.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t")).where("id is not null and t is not null")
    keyed = src.select(F.unhex(F.md5("t")).alias("key"), "id")
    many = keyed.groupBy("key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "rep")
    members = materialise(keyed.join(many, "key").groupBy("id").agg(F.min("rep").alias("rep")))
    sent = F.broadcast if members.count() <= BROADCAST_IDS else lambda df: df
    single = src.join(sent(members.select("id")), "id", "left_anti")
    again = materialise(src.join(sent(members.where("id = rep").select("id")), "id", "left_semi").dropDuplicates(["id"]))
    return single, again, members


def text_links(texts: DataFrame, settings: Settings) -> DataFrame:
    """(a, b, similarity), a < b: different texts that are alike, of (id, t) with one row for each text. Written to the shared folder."""
    bands = texts.mapInArrow(_band_keys(settings), "id bigint, keys array<bigint>").select("id", F.explode("keys").alias("key"))
    pairs = bands.alias("l").join(
        bands.alias("r"), (F.col("l.key") == F.col("r.key")) & (F.col("l.id") < F.col("r.id")),
    ).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))
    candidates = materialise(pairs.distinct())
    ids = materialise(candidates.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    chosen = texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")
    features = materialise(chosen.mapInArrow(_features(settings), "id bigint, sig binary, shingles binary"))
    with_sig = candidates
    for side in ("a", "b"):
        with_sig = with_sig.join(features.select(F.col("id").alias(side), F.col("sig").alias(f"sig_{side}")), side)
    left = with_sig.mapInArrow(_prune(settings), "a bigint, b bigint")
    for side in ("a", "b"):
        left = left.join(features.select(F.col("id").alias(side), F.col("shingles").alias(f"set_{side}")), side)
    links = materialise(left.mapInArrow(_verify(settings), "a bigint, b bigint, similarity double"))
    for done in (candidates, ids, features):
        released(done)
    return links


def countable(texts: DataFrame, settings: Settings) -> DataFrame:
    """The ids of texts with enough words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = max(settings.min_words, settings.words)
        for b in batches:
            keep = pa.array([len(_WORD.findall(t.lower())) >= least for t in b.column("t").to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("id").filter(keep)], names=["id"])

    return texts.select("id", "t").mapInArrow(run, "id bigint")


def found_pairs(texts: DataFrame, id_col: str, text_col: str, settings: Settings) -> DataFrame:
    """(id_a, id_b), smaller first: all pairs of ids whose texts are alike, equal texts included.

    Pairs are found between different texts, and only in the result unfolded to the ids that have these texts.
    """
    single, again, members = distinct_texts(texts, id_col, text_col)
    links = text_links(single.unionByName(again), settings)
    copies = members.where("id <> rep").join(countable(again, settings).withColumnRenamed("id", "rep"), "rep", "left_semi")
    everyone = copies.unionByName(copies.select("rep", F.col("rep").alias("id")).distinct())
    across = links
    for side in ("a", "b"):
        across = across.join(everyone.select(F.col("rep").alias(side), F.col("id").alias(f"id_{side}")), side, "left").withColumn(
            side, F.coalesce(f"id_{side}", side),
        ).drop(f"id_{side}")
    within = everyone.alias("l").join(
        copies.alias("r"), (F.col("l.rep") == F.col("r.rep")) & (F.col("l.id") < F.col("r.id")),
    ).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))
    both = across.select("a", "b").unionByName(within)
    return both.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))


def groups(texts: DataFrame, id_col: str, text_col: str, settings: Settings) -> DataFrame:
    """(id, group_id, n_links): one row per id with a text. Groups are the connected texts, named by their
    smallest id; ``n_links`` is the number of different texts that are alike to the id's own."""
    single, again, members = distinct_texts(texts, id_col, text_col)
    links = text_links(single.unionByName(again), settings)
    degree = links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("n_links"))
    of = single.select("id", F.col("id").alias("class")).unionByName(members.select("id", F.col("rep").alias("class")))
    return of.join(components(links), "class", "left").join(degree, "class", "left").select(
        "id", F.coalesce("root", "class").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def components(links: DataFrame) -> DataFrame:
    """(class, root) of connected classes, by alternating large-star and small-star steps.

    Each step is a join and an aggregation over edges, cut off by a written table; it ends when no edge
    changes, after a number of steps about the logarithm of the longest chain.
    """
    edges = materialise(links.select("a", "b"))
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: each node and its smaller neighbours go to the smallest of these
        down = large.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))
        root = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(root, "a").select(F.col("b").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(
            root.select(F.col("a").alias("u"), F.col("m").alias("v"))
        ).distinct()
        old, edges = edges, materialise(small.select(F.col("v").alias("a"), F.col("u").alias("b")))
        released(old)
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("b").alias("class"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("class"), F.col("a").alias("root"))
    ).distinct()
