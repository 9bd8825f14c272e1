import numpy as np
from pyspark.sql import functions as F

from quillspark.llm import neighbours as N
from quillspark.llm import queries as Q


def brute(rows, k, least=-2.0):
    ids = sorted(i for i, v in rows.items())
    x = np.array([rows[i] for i in ids], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    np.fill_diagonal(s, -9)
    top = np.argsort(-s, axis=1, kind="stable")[:, :k]
    return {(ids[i], ids[j]): s[i, j] for i in range(len(ids)) for j in top[i] if s[i, j] >= least}


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, v array<double>").withColumn("vec", F.lit("clash")).withColumn("cell", F.lit(0))


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    rows = {i: (centres[i % 40] + 0.3 * rng.normal(size=16)).tolist() for i in range(4000)}
    v = N.unit_vectors(frame(spark, list(rows.items())), "id", "v", 16)
    got = {(r.id, r.other_id) for r in N.nearest(lambda w: v.where(w), 4000, 5, 16).collect()}
    assert len(got & set(brute(rows, 5))) >= 0.9 * 5 * 4000
    asked = {(r.id, r.other_id) for r in N.nearest(lambda w: v.where(w), 4000, 5, 16, queries="id % 50 = 0").collect()}
    assert {a for a, _ in asked} == {i for i in rows if i % 50 == 0} and len(asked & got) >= 0.95 * len(asked)


def test_copies_unusable_vectors_and_ties(spark):
    e = np.eye(4).tolist()
    rows = [(i, e[0]) for i in range(1, 9)] + [
        (20, [1.0, 0.1, 0.0, 0.0]), (30, e[2]), (31, None), (32, [0.0] * 4), (33, [1.0]), (34, [float("nan"), 1.0, 1.0, 1.0]),
        (35, [None, 1.0, 1.0, 1.0]), (36, [float("inf"), 1.0, 1.0, 1.0]), (1, e[0]),
    ]
    got = N.nearest(lambda w: N.unit_vectors(frame(spark, rows).where(w), "id", "v", 4), len(rows), 3, 4).collect()
    near = {}
    for r in sorted(got, key=lambda r: (r.id, r["rank"])):
        near.setdefault(r.id, []).append(r.other_id)
    assert near[1] == [2, 3, 4] and near[2] == [1, 3, 4] and near[8] == [1, 2, 3] and near[20] == [1, 2, 3]
    assert set(near) == {*range(1, 9), 20, 30}


def test_no_vectors(spark):
    assert N.nearest(lambda w: N.unit_vectors(spark.createDataFrame([], "id bigint, v array<float>"), "id", "v", 4), 0, 3, 4).count() == 0


def test_crowded_lists_are_divided(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = {i: rng.normal(size=8).tolist() for i in range(600)}
    monkeypatch.setattr(N, "BLOCK", 50)
    got = {(r.id, r.other_id) for r in N.nearest(lambda w: N.unit_vectors(frame(spark, list(rows.items())).where(w), "id", "v", 8), 600, 4, 8).collect()}
    assert got == set(brute(rows, 4))


def test_graph_finds_near_centroids():
    x = np.random.default_rng(3).normal(size=(3000, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = N.CentroidGraph(x[:600])
    ids, _ = g.search(x[600:1000], 5)
    best = np.argsort(-(x[600:1000] @ x[:600].T), axis=1)[:, :5]
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(ids.tolist(), best.tolist())]) > 0.9


def test_graph_of_many_centroids(monkeypatch):
    x = np.random.default_rng(3).normal(size=(5000, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    monkeypatch.setattr(N, "ONE_LEVEL", 500)
    g = N.CentroidGraph(x[:3000])
    assert ((g.links >= 0) & (g.links < 3000)).all()
    ids, _ = g.search(x[3000:4000], 5)
    best = np.argsort(-(x[3000:4000] @ x[:3000].T), axis=1)[:, :5]
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(ids.tolist(), best.tolist())]) > 0.9


def test_centroids_in_two_levels(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(60, 16))
    rows = {i: (centres[i % 60] + 0.3 * rng.normal(size=16)).tolist() for i in range(6000)} | {i: centres[0].tolist() for i in range(6000, 9000)}
    for name, value in (("LIST_SIZE", 60), ("ONE_LEVEL", 20), ("FIT_AT_ONCE", 300)):
        monkeypatch.setattr(N, name, value)
    v = N.unit_vectors(frame(spark, list(rows.items())), "id", "v", 16)
    near = N.nearest(lambda w: v.where(w), 9000, 5, 16).collect()
    got = {(r.id, r.other_id) for r in near}
    want = brute({i: x for i, x in rows.items() if i < 6000}, 5)
    alone = [(a, b) for a, b in want if a % 60]  # not about the centre that a third of the rows are copies of
    assert len({p for p in alone if p in got}) >= 0.9 * len(alone)
    assert {r.id for r in near} == set(rows) and {r.other_id for r in near if r.id == 8999} == {6000, 6001, 6002, 6003, 6004}


def test_recall_of_vectors_of_texts(spark, data, monkeypatch):
    """The queries of p4_texts and p4_items against brute force, with lists small enough that a part of them is searched."""
    monkeypatch.setattr(N, "LIST_SIZE", 12)
    texts = spark.read.parquet(f"{data}/knowledge_main.parquet").withColumnRenamed("chunk_id", "id")
    rows = {r.id: np.frombuffer(r.vec, np.float32) for r in N.text_vectors(texts, "id", "text").collect()}
    found = Q.p4_texts(spark, data).collect()
    asked = sorted({r.id for r in found})
    assert asked == sorted(i for i in rows if i % 50 == 0)
    ids = np.array(sorted(rows))
    x = np.array([rows[i] for i in ids])
    hits = 0
    for i in asked:
        s = x @ rows[i]
        s[ids == i] = -9
        hits += sum(r.similarity >= np.sort(s)[-5] - 1e-5 for r in found if r.id == i)
    assert hits >= 0.95 * 5 * len(asked)


def test_query_on_whole_table(spark, data):
    rows = {}
    for r in spark.read.parquet(f"{data}/knowledge_item.parquet").select("item_id", "embedding").collect():
        v = r.embedding
        if v and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            rows[r.item_id] = v
    want = {(min(p), max(p)) for p in brute(rows, 5, 0.85)}
    assert {tuple(r) for r in Q.p4_found(spark, data).collect()} == want


def test_vectors_of_texts(spark):
    d = spark.createDataFrame([(1, "one two three"), (2, "One, two; three!"), (3, ""), (4, None), (5, "x " * 20000)], "id bigint, t string")
    v = {r.id: bytes(r.vec) for r in N.text_vectors(d, "id", "t").collect()}
    assert set(v) == {1, 2, 5} and v[1] == v[2] and len(v[5]) == 256
