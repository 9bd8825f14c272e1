"""Problem 4: the k most similar vectors of every vector, or of every query vector, by cosine.

Method: balanced posting lists. Centroids are fitted on a bounded sample with a penalty on crowded
lists; a vector is put into the list of its nearest centroid and, near the border, into those of further
centroids whose distance is within a ratio of the nearest; centroids are found by a best-first search in a
graph of near centroids that each worker holds in memory; a query visits the lists within a wider ratio.
Within a list similarities are exact.

Every vector is indexed. Equal vectors are indexed once and unfolded at the end, however many there are.
A list that the sample shows to be crowded is divided into blocks by a hash of the id, and queries go
to all its blocks, so that no task holds a whole crowded list.

There is a list for each ``LIST_SIZE`` vectors, so that work grows with their number. Up to ``ONE_LEVEL`` centroids are fitted
on the driver; more in two levels, coarse ones on the driver and those within each coarse cell by the workers. From
``MAX_LISTS`` lists (210 million vectors) on lists grow.

Bounds of what is kept on the driver or sent to all: ``SAMPLE`` vectors, ``MAX_LISTS`` centroids with
``DEGREE`` links each (93 MB for 64 numbers).

Defined results: a vector is usable if it has the given number of finite values, not all zero; others give
no rows; ties go to the smaller id; a repeated id counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, sliced

LIST_SIZE = 800
ONE_LEVEL, MAX_LISTS = 4_096, 262_144
SAMPLE = 131_072
#: Vectors of the sample for each list, and those from which a worker fits centroids at a time.
PER_LIST, FIT_AT_ONCE = 40, 16_384
BLOCK = 4_000
#: Ids sent to all executors, of vectors that equal one indexed; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
DEGREE = 24
ENTRIES = 128
#: Lists of a vector: at most so many, whose distance is at most so many times that of the nearest centroid.
COPIES, COPY_RATIO = 4, 1.2
PROBES, PROBE_RATIO = 6, 1.3
#: The same where queries are a part of the vectors: more lists of each query cost less than more copies of each vector.
PART_COPIES, PART_PROBES, PART_RATIO = 2, 40, 1.6
BEAM = 48


def usable(values: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are usable, and these as float32 vectors of length 1."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(values), dim), False).to_numpy(zero_copy_only=False)
    if not fits.any():
        return fits, np.empty((0, dim), np.float32)
    flat = pc.list_flatten(values.filter(pa.array(fits))).cast(pa.float64()).fill_null(float("nan"))
    x = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)
    ok = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    x = x[ok]
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    keep = fits.copy()
    keep[fits] = ok
    return keep, x.astype(np.float32)


def _packed(x: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(x.shape[1] * 4), len(x), [None, pa.py_buffer(np.ascontiguousarray(x, np.float32))],
    ).cast(pa.binary())


def _unpacked(col: pa.Array, dim: int) -> np.ndarray:
    col = pa.concat_arrays(col.chunks) if isinstance(col, pa.ChunkedArray) else col
    offset = np.frombuffer(col.buffers()[1], np.int32)[col.offset] if len(col) else 0
    return np.frombuffer(
        col.buffers()[2], np.uint8, len(col) * dim * 4, int(offset),
    ).view(np.float32).reshape(-1, dim) if len(col) else np.empty((0, dim), np.float32)


def unit_vectors(items: DataFrame, id_col: str, vector_col: str, dim: int) -> DataFrame:
    """id and vec (bytes of float32, length 1) of the usable vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, x = usable(b.column("v"), dim)
            yield pa.RecordBatch.from_arrays([b.column("id").filter(pa.array(keep)), _packed(x)], names=["id", "vec"])

    src = items.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<float>").alias("v"),
    ).where("id is not null and v is not null")
    return src.mapInArrow(run, "id bigint, vec binary")


def fit_centroids(x: np.ndarray, n: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of about equally filled lists, and each list's share of the sample."""
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), n, replace=False)].copy()
    count = np.full(n, len(x) / n)
    for r in range(rounds + 1):
        crowd = 0.02 * np.log((count + 1) / (len(x) / n + 1)) if r < rounds else 0
        near = np.concatenate([np.argmax(x[i : i + 8192] @ c.T - crowd, axis=1) for i in range(0, len(x), 8192)])
        count = np.bincount(near, minlength=n).astype(float)
        if r == rounds:
            break
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        empty = count == 0
        if empty.any():  # an empty list gets a vector of the fullest one
            total[empty] = x[rng.choice(np.flatnonzero(near == np.argmax(count)), empty.sum())]
        c = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-12)
    return c, count / len(x)


def fit_within(
    vectors_of: Callable[[str], DataFrame], n_rows: int, lists: int, coarse: np.ndarray, share: np.ndarray, dim: int,
) -> tuple[np.ndarray, np.ndarray]:
    """About so many centroids, and each list's share: a worker fits those of one coarse cell, or of a part of a crowded one, on its part of the
    sample. Equal vectors of the sample count once, so that many copies don't draw all centroids."""
    wanted = PER_LIST * lists
    parts = np.maximum(1, np.ceil(share * wanted / FIT_AT_ONCE)).astype(np.int64)
    shared = vectors_of("true").sparkSession.sparkContext.broadcast((coarse, parts))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, n_parts = shared.value
        for b in sliced(batches, 4096):
            x = _unpacked(b.column("vec"), dim)
            near = np.argmax(x @ c.T, axis=1) if len(x) else np.empty(0, np.int64)
            mixed = x.view(np.uint32)[:, :2].astype(np.uint64) @ np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F][: min(2, dim)], np.uint64)
            part = (mixed >> np.uint64(33)).astype(np.int64) % n_parts[near]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.int64()), pa.array(part, pa.int64()), b.column("vec")], names=["coarse", "part", "vec"])

    def fit(t):
        x = np.unique(_unpacked(t.column("vec"), dim), axis=0)
        c, own = fit_centroids(x, max(1, round(len(x) / PER_LIST)))
        return pa.table({"vec": _packed(c), "n": pa.array(own * len(x), pa.float64())})

    drawn = vectors_of("true" if n_rows <= wanted else f"pmod(xxhash64(id), {n_rows}) < {wanted}").select("vec")
    found = drawn.mapInArrow(cells, "coarse bigint, part bigint, vec binary").groupBy("coarse", "part").applyInArrow(fit, "vec binary, n double").toArrow()
    n = found.column("n").to_numpy()
    return _unpacked(found.column("vec"), dim).copy(), n / n.sum()


class CentroidGraph:
    """Links of each centroid to near ones; best-first search for many vectors at once."""

    def __init__(self, c: np.ndarray):
        n = len(c)
        self.c = np.ascontiguousarray(c, np.float32)
        degree = min(DEGREE, n - 1)
        self.links = np.empty((n, degree + 1), np.int32)
        for own, others in self._near_groups():
            s = self.c[own] @ self.c[others].T
            s[own[:, None] == others[None, :]] = -9
            self.links[own, :degree] = others[np.argpartition(-s, degree - 1, axis=1)[:, :degree]] if degree else 0
        self.links[:, degree] = (np.arange(n) * 7919 + 1) % n  # a far link keeps the graph in one piece
        entries, best = [0], self.c @ self.c[0]
        while len(entries) < min(max(ENTRIES, int(2 * n**0.5)), n):  # each the farthest from those before
            entries.append(int(np.argmin(best)))
            best = np.maximum(best, self.c @ self.c[entries[-1]])
        self.entries = np.array(entries, np.int32)

    def _near_groups(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Centroids, and those among which their near ones are sought: all, or if they are many those about the nearest of some pivots."""
        n = len(self.c)
        if n <= ONE_LEVEL:
            for i in range(0, n, 1024):
                yield np.arange(i, min(i + 1024, n)), np.arange(n)
            return
        pivots = self.c[np.random.default_rng(5).choice(n, int(n**0.5), replace=False)]
        of = np.concatenate([np.argmax(self.c[i : i + 8192] @ pivots.T, axis=1) for i in range(0, n, 8192)])
        order = np.argsort(of, kind="stable")
        begin = np.searchsorted(of[order], np.arange(len(pivots) + 1))
        members = [order[a:z] for a, z in zip(begin, begin[1:])]
        near = np.argsort(-(pivots @ pivots.T), axis=1)
        for g, own in enumerate(members):
            others, k = [], 0
            while k < len(pivots) and (k < 8 or sum(map(len, others)) <= 4 * DEGREE):
                others.append(members[near[g, k]])
                k += 1
            for i in range(0, len(own), 1024):
                yield own[i : i + 1024], np.concatenate(others)

    def search(self, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest centroids found, best first, with their cosines; fewer are filled with -1."""
        q, n, beam = len(x), len(self.c), max(BEAM, k)
        seen = np.zeros((q, n + 1), bool)
        row = np.arange(q)[:, None]
        ids = np.broadcast_to(self.entries, (q, len(self.entries))).copy()
        seen[:, self.entries] = True
        sims = x @ self.c[self.entries].T
        done = np.zeros(ids.shape, bool)
        while True:
            order = np.argsort(-sims, axis=1)[:, :beam]
            ids, sims, done = ids[row, order], sims[row, order], done[row, order]
            todo = ~done & (ids >= 0)
            live = np.flatnonzero(todo.any(axis=1))
            if not len(live):
                break
            pick = np.argsort(~todo[live], axis=1, kind="stable")[:, :3]  # the best that aren't expanded
            lr = live[:, None]
            ok = todo[lr, pick]
            done[lr, pick] |= ok
            new = np.where(ok[:, :, None], self.links[ids[lr, pick]], n).reshape(len(live), -1)
            new = np.sort(new, axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = n
            new[seen[lr, new]] = n
            seen[lr, new] = True
            seen[:, n] = False
            fresh = new < n
            s = np.full(new.shape, -9, np.float32)
            a, b = np.nonzero(fresh)
            s[a, b] = np.einsum("ij,ij->i", x[live[a]], self.c[new[a, b]])
            pad = np.full((q, new.shape[1]), -1, np.int32)
            pad[live] = np.where(fresh, new, -1)
            more = np.full(pad.shape, -9, np.float32)
            more[live] = s
            ids, sims, done = np.hstack([ids, pad]), np.hstack([sims, more]), np.hstack([done, pad < 0])
        return ids[:, :k], sims[:, :k]


def _within(sims: np.ndarray, ids: np.ndarray, most: int, ratio: float) -> np.ndarray:
    dist = np.sqrt(np.maximum(0, 2 - 2 * sims))
    keep = (ids >= 0) & (dist <= ratio * dist[:, :1] + 1e-6)
    keep[:, most:] = False
    return keep


def nearest(
    vectors_of: Callable[[str], DataFrame], n_rows: int, k: int, dim: int, min_similarity: float = -2.0, queries: str | None = None,
) -> DataFrame:
    """(id, other_id, similarity, rank) of the k most similar others of each query.

    ``vectors_of``: gives id and vec, as of :func:`unit_vectors`, of the rows that meet an SQL condition on ``id``. ``n_rows``: about how
    many there are. ``queries``: an SQL condition on ``id`` that says which are queries; all, if not given.
    """
    vectors = vectors_of("true")
    spark = vectors.sparkSession
    lists = int(min(MAX_LISTS, max(1, -(-n_rows // LIST_SIZE))))
    copies_of, probes, probe_ratio = (PART_COPIES, PART_PROBES, PART_RATIO) if queries else (COPIES, PROBES, PROBE_RATIO)
    wanted = min(SAMPLE, PER_LIST * lists)
    drawn = vectors if n_rows <= wanted else vectors_of(f"pmod(xxhash64(id), {n_rows}) < {wanted}")
    sample = _unpacked(drawn.select("vec").limit(2 * SAMPLE).toArrow().column("vec"), dim)
    if not len(sample):
        return spark.createDataFrame([], "id bigint, other_id bigint, similarity float, rank int")
    sample = np.unique(sample, axis=0) if len(sample) < 1000 else sample
    c, share = fit_centroids(sample, min(lists, len(sample)) if lists <= ONE_LEVEL else max(1, min(int(lists**0.5), len(sample) // 4)))
    if lists > ONE_LEVEL:
        c, share = fit_within(vectors_of, n_rows, lists, c, share, dim)
    blocks = np.maximum(1, np.ceil(share * n_rows * copies_of / BLOCK / 2)).astype(np.int32)
    graph = spark.sparkContext.broadcast((CentroidGraph(c), blocks))

    # equal vectors: one of each group is indexed; only hashes of vectors are shuffled to find them
    is_query = F.expr(queries) if queries else F.lit(True)
    members = vectors.select(F.md5("vec").alias("key"), "id").distinct()
    copies = members.groupBy("key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.max(is_query).alias("any_query")).where("n > 1")
    of_copies = materialise(members.join(copies.select("key", "rep", "any_query"), "key").select("rep", "id", "any_query"))
    left_out = of_copies.where("id <> rep").select("id")
    reps = vectors.join(F.broadcast(left_out) if left_out.count() <= BROADCAST_IDS else left_out, "id", "left_anti")
    asked = is_query
    if queries:  # a vector is asked for if any of its copies is a query
        also = of_copies.where("any_query").select(F.col("rep").alias("id")).distinct().withColumn("_also", F.lit(True))
        reps = reps.join(F.broadcast(also) if also.count() <= BROADCAST_IDS else also, "id", "left")
        asked = is_query | F.coalesce("_also", F.lit(False))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, n_blocks = graph.value
        step = max(64, min(2048, 2**24 // len(n_blocks)))
        for b in batches:
            for i in range(0, b.num_rows, step):
                part = b.slice(i, step)
                x = _unpacked(part.column("vec"), dim)
                ids, sims = g.search(x, probes)
                probe, keep = _within(sims, ids, probes, probe_ratio), _within(sims, ids, copies_of, COPY_RATIO)
                probe &= part.column("asked").to_numpy(zero_copy_only=False)[:, None]
                key = part.column("id").to_numpy()
                r, j = np.nonzero(probe | keep)
                cell, role = ids[r, j], probe[r, j] + 2 * keep[r, j]
                own = (key[r] * np.int64(-7046029254386353131) >> np.int64(33)) % n_blocks[cell]
                many = np.where(role & 1, n_blocks[cell], 1)
                at = np.repeat(np.arange(len(r)), many)
                block = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
                block = np.where(role[at] & 1, block, own[at])
                kind = np.where(block == own[at], role[at], 1).astype(np.int8)
                rows = pa.array(r[at])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cell[at], pa.int32()), pa.array(block, pa.int32()), part.column("id").take(rows), pa.array(kind),
                        part.column("vec").take(rows),
                    ],
                    names=["cell", "block", "id", "role", "vec"],
                )

    def compare(t):
        x, key, role = _unpacked(t.column("vec"), dim), t.column("id").to_numpy(), t.column("role").to_numpy()
        member = np.flatnonzero(role & 2)
        asks = np.flatnonzero(role & 1)
        asks = asks[np.unique(key[asks], return_index=True)[1]]
        qs, xs, ss = [], [], []
        m, mk = x[member], key[member]
        mk, by_id = np.unique(mk, return_index=True)  # a repeated row counts once
        m = m[by_id]
        top = min(k + 1, len(mk))
        for i in range(0, len(asks) if top else 0, 1024):
            a = asks[i : i + 1024]
            s = x[a] @ m.T
            s[key[a][:, None] == mk[None, :]] = -9
            best = np.argpartition(-s, top - 1, axis=1)[:, :top] if top < s.shape[1] else np.broadcast_to(np.arange(top), (len(a), top))
            val = np.take_along_axis(s, best, 1)
            r, j = np.nonzero(val >= max(min_similarity, -2.0))
            qs.append(key[a[r]])
            xs.append(mk[best[r, j]])
            ss.append(val[r, j])
        cat = lambda v, t_: np.concatenate(v) if v else np.empty(0, t_)
        return pa.table(
            {
                "id": pa.array(cat(qs, np.int64), pa.int64()), "other": pa.array(cat(xs, np.int64), pa.int64()),
                "similarity": pa.array(cat(ss, np.float32), pa.float32()),
            }
        )

    placed = reps.select("id", "vec", asked.alias("asked")).mapInArrow(place, "cell int, block int, id bigint, role tinyint, vec binary")
    pairs = placed.groupBy("cell", "block").applyInArrow(compare, "id bigint, other bigint, similarity float")

    # of each group of equal vectors only the k + 1 smallest ids can be among anyone's k nearest
    salted = of_copies.select(
        "rep", "id", F.row_number().over(Window.partitionBy("rep", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")).alias("n"),
    ).where(F.col("n") <= k + 1)
    firsts = salted.groupBy("rep").agg(F.slice(F.array_sort(F.collect_list("id")), 1, k + 1).alias("ids"))
    unfolded = pairs.join(firsts.withColumnRenamed("rep", "other"), "other", "left").select(
        "id", "similarity", F.explode(F.coalesce("ids", F.array("other"))).alias("other"),
    )
    own = of_copies.where("any_query").select(F.col("rep").alias("id")).distinct().join(firsts, F.col("rep") == F.col("id")).select(
        "id", F.lit(1.0).cast("float").alias("similarity"), F.explode("ids").alias("other"),
    )
    best = unfolded.unionByName(own).repartition("id").groupBy("id", "other").agg(F.max("similarity").alias("similarity"))
    # at most (k + 1) x (k + 1) x probes x blocks rows for a query
    ranked = best.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "other"))).where(F.col("n") <= k + 1)
    tops = ranked.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "other", "similarity"))).alias("top"))
    everyone = tops.join(
        of_copies.select(F.col("rep").alias("id"), F.col("id").alias("copy")), "id", "left",
    ).select(F.coalesce("copy", "id").alias("id"), "top")
    if queries:
        everyone = everyone.where(F.expr(queries))
    kept = everyone.select("id", F.posexplode(F.slice(F.filter("top", lambda t: t["other"] != F.col("id")), 1, k)).alias("rank", "t"))
    return kept.select("id", F.col("t.other").alias("other_id"), F.col("t.similarity").alias("similarity"), (F.col("rank") + 1).alias("rank"))


def text_vectors(texts: DataFrame, id_col: str, text_col: str, dim: int = 64) -> DataFrame:
    """id and vec of texts with at least one word: the sum of a random vector of signs for each distinct word, weighted by its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        import xxhash

        word, place, table = re.compile(r"[^\W_]+"), {}, np.empty((0, dim), np.float32)
        for b in sliced(batches, 1024):
            ids, at, sizes = [], [], []
            if len(place) > 200_000:
                place, table = {}, np.empty((0, dim), np.float32)
            new = []
            for i, t in zip(b.column("id").to_pylist(), b.column("t").to_pylist()):
                words = dict.fromkeys(word.findall(t.lower()))
                if words:
                    ids.append(i)
                    sizes.append(len(words))
                    for w in words:
                        if w not in place:
                            place[w] = len(place)
                            new.append(w)
                        at.append(place[w])
            if new:
                bits = np.frombuffer(b"".join(xxhash.xxh3_128_digest(w.encode()) * (dim // 128 + 1) for w in new), np.uint8).reshape(len(new), -1)
                signs = np.unpackbits(bits, axis=1)[:, :dim].astype(np.float32) * 2 - 1
                table = np.vstack([table, signs * np.array([len(w) for w in new], np.float32)[:, None]])
            x = np.add.reduceat(table[at], np.cumsum(sizes) - sizes, axis=0) if ids else np.empty((0, dim), np.float32)
            size = np.linalg.norm(x, axis=1, keepdims=True)
            keep = size[:, 0] > 0
            yield pa.RecordBatch.from_arrays([pa.array(np.array(ids, np.int64)[keep]), _packed(x[keep] / size[keep])], names=["id", "vec"])

    return texts.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t"),
    ).where("id is not null and t is not null").mapInArrow(run, "id bigint, vec binary")
