import random
import re

from pyspark.sql import functions as F

from quillspark.llm import near_duplicates as D
from quillspark.llm import queries as Q

S = D.Settings(words=3, threshold=0.6, min_words=20)


def brute(texts, s):
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\W_]+", t.lower()) if t else []
        if len(w) >= max(s.min_words, s.words):
            sets[i] = {tuple(w[k : k + s.words]) for k in range(len(w) - s.words + 1)}
    ids = sorted(sets)
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= s.threshold}


def made(n=120, seed=3):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    out = []
    for i in range(n):
        t = [rng.choice(words) for _ in range(rng.randint(15, 80))]
        out.append((10 * i, " ".join(t)))
        if i % 3 == 0:
            for c in range(rng.randint(1, 3)):
                u = list(t)
                for _ in range(rng.randint(0, 4)):
                    u[rng.randrange(len(u))] = rng.choice(words)
                out.append((10 * i + c + 1, " ".join(u).upper() if c == 2 else " ".join(u)))
    return out + [(9001, None), (9002, ""), (9003, "too short"), (9004, out[0][1]), (9004, out[0][1]), (9005, "ñandú " * 30), (9006, "ñandú " * 30)]


def test_pairs_are_those_of_brute_force(spark):
    rows = made()
    df = spark.createDataFrame(rows, "id bigint, t string").withColumn("a", F.lit(1)).withColumn("key", F.lit("x"))
    got = {tuple(r) for r in D.found_pairs(df, "id", "t", S).collect()}
    want = brute(dict(rows).items(), S)
    assert got <= want and len(want - got) <= 0.01 * len(want) and len(want) > 50


def test_groups_are_connected_and_count_links(spark):
    a = [f"a{k}" for k in range(60)]
    b, c = list(a), list(a)
    b[0] = "x"
    c[0], c[59] = "x", "y"
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c)), (4, " ".join(a)), (5, "alone here"), (6, None)]
    got = {r.id: (r.group_id, r.n_links) for r in D.groups(spark.createDataFrame(rows, "id bigint, t string"), "id", "t", D.Settings()).collect()}
    assert got[1][0] == got[2][0] == got[3][0] == got[4][0] == 1 and got[5] == (5, 0) and 6 not in got
    assert got[1][1] == got[4][1] >= 1


def test_copies_add_no_work(spark, monkeypatch):
    """However often two texts are repeated, under other ids or the same, the tables written between hold as many rows."""
    a = [f"a{k}" for k in range(60)]
    b = ["x", *a[1:]]
    seen = []

    def spied(df):
        out = written(df)
        seen.append((out.columns, out.count()))
        return out

    written = D.materialise
    monkeypatch.setattr(D, "materialise", spied)
    for n in (1, 60):
        seen.clear()
        rows = [(k + i * 1000, " ".join(t)) for i, t in enumerate((a, b)) for k in range(n) for _ in range(2 if n > 1 else 1)]
        df = spark.createDataFrame(rows, "id bigint, t string")
        single, again, members = D.distinct_texts(df, "id", "t")
        texts = single.unionByName(again)
        assert members.count() == (0 if n == 1 else 2 * n)
        assert texts.mapInArrow(D._band_keys(S), "id bigint, keys array<bigint>").count() == 2
        seen.clear()
        assert [tuple(r)[:2] for r in D.text_links(texts, S).collect()] == [(0, 1000)]
        assert [x for _, x in seen] == [1, 2, 2, 1]
        assert D.found_pairs(df, "id", "t", S).count() == (2 * n) * (2 * n - 1) // 2


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101)], "a bigint, b bigint")
    got = {r["class"]: r.root for r in D.components(chain).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == 100 and got[100] == 100


def test_empty_table(spark):
    assert D.found_pairs(spark.createDataFrame([], "id bigint, t string"), "id", "t", S).count() == 0
    assert D.groups(spark.createDataFrame([], "id bigint, t string"), "id", "t", D.Settings()).count() == 0


def test_tables_between_steps_can_be_deleted(spark):
    from quillspark.llm import common

    common.release_all(spark)
    a, b = common.materialise(spark.range(3)), common.materialise(spark.range(4))
    common.released(a)
    assert len(common._WRITTEN) == 1 and b.count() == 4
    assert common.release_all(spark) == 1 and common.release_all(spark) == 0


def test_pruning_keeps_what_reaches_the_threshold():
    need = D.fewest_matches(0.6, 128, 16, 1e-4)
    assert list(need) == sorted(need) and need[0] < 0.6 * 16 and 0.3 * 128 < need[-1] < 0.6 * 128


def test_query_on_whole_table(spark, data):
    rows = {r.chunk_id: r.text for r in spark.read.parquet(f"{data}/knowledge_main.parquet").select("chunk_id", "text").collect()}
    got = {tuple(r) for r in Q.p1_found(spark, data).collect()}
    want = brute(rows.items(), S)
    assert got <= want and len(want - got) <= 1


def test_queries_with_sql(spark, data):
    from ..oracle import connect, rows

    duck = connect(data)
    for name, sql in Q.ORACLES.items():
        assert rows(Q.QUERIES[name](spark, data).toPandas()) == rows(duck.sql(sql).df()), name
