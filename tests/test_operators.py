"""Nulls, empty texts, ties, empty tables and clashing names."""

import pytest
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.functions import udtf
from quillspark.operators import chunks as C
from quillspark.operators import layout as G
from quillspark.operators import lines as L
from quillspark.operators import nested as N
from quillspark.operators import relational as R
from quillspark.operators import retrieval as V
from quillspark.operators import standards as S


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "f",
    [
        T.slug, T.anchor, T.squeezed, T.collapsed_blank_lines, T.clean_scan_marks, T.without_markdown_links, T.without_tags, T.sheet_name, T.uuid5,
        T.subtitle_text, T.salvaged_json,
    ],
)
def test_null_stays_null(spark, f):
    assert one(spark, f(F.lit(None).cast("string"))) is None


def test_titles(spark):
    assert one(spark, T.title_of_text(F.lit("\n\n  A day \nmore"))) == "A day"
    assert one(spark, T.title_of_text(F.lit(""))) == "Untitled Document"
    assert one(spark, T.title_cascade(F.lit(" "), F.lit("/a/my_file-name.txt"), F.lit("x"))) == "My File Name"
    assert one(spark, T.title_cascade(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("one\nTHE HEAD\n"))) == "THE HEAD"
    assert len(one(spark, T.title_of_text(F.lit("x" * 200)))) == 80


def test_uuid5_is_the_standard_one(spark):
    import uuid

    assert one(spark, T.uuid5(F.lit("https://example.org/ä"))) == str(uuid.uuid5(uuid.NAMESPACE_URL, "https://example.org/ä"))


def test_token_windows(spark):
    d = spark.createDataFrame([(1, " ".join(map(str, range(25)))), (2, "a b"), (3, ""), (4, None), (5, "  \n ")], "id int, text string")
    got = C.token_windows(d, "text", 10, 4).orderBy("id", "chunk_index").collect()
    assert [(r.id, r.chunk_index, r.n_tokens) for r in got] == [(1, 0, 10), (1, 1, 10), (1, 2, 10), (1, 3, 7), (2, 0, 2)]
    assert got[1].content.split()[0] == "6"
    with pytest.raises(ValueError):
        C.token_windows(d, "text", 10, 10)


def test_token_windows_cover_long_texts(spark):
    d = spark.createDataFrame([(1, "w " * 50_000)], "id int, text string")
    n = C.token_windows(d, "text", 800, 100).agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t")).first()
    assert n.n == 1 + -(-(50_000 - 800) // 700) and n.t == 50_000 + 100 * (n.n - 1)


def test_fixed_chunks_give_the_text_back(spark):
    text = "é" * 1234
    d = spark.createDataFrame([(1, text)], "id int, text string")
    assert "".join(r.content for r in C.fixed_chars(d, "text").orderBy("chunk_index").collect()) == text
    udtf.register(spark)
    d.createOrReplaceTempView("texts_of_test")
    assert [len(r.content) for r in spark.sql("SELECT c.* FROM texts_of_test t, LATERAL fixed_chunks(t.text, 500) c ORDER BY chunk_index").collect()] == [500, 500, 234]


def test_merged_lines(spark):
    text = "First part of the\nsecond.\n\nA hyphen-\nated word\n=== Page 2 ===\nNext: no\n- item\nlast of\nThe end"
    got = L.merge_broken_lines(L.exploded(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t"), "id").orderBy("paragraph").collect()
    assert [r.text for r in got] == ["First part of the second.", "", "A hyphen ated word", "=== Page 2 ===", "Next: no - item last of The end"]
    glued = L.merge_broken_lines(
        L.exploded(spark.createDataFrame([(1, "a hyphen-\nated word")], "id int, t string"), "id", "t"), "id", glue_hyphen=True,
    ).first()
    assert glued.text == "a hyphenated word"


def test_headings_and_sections(spark):
    text = "INTRODUCTION\nbody of it\n\n1. First thing\nmore\n\nShort one\n\n  indented\nEND."
    lines = L.detect_headings(L.exploded(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t"), "id")
    assert [r.heading for r in lines.where("heading is not null").orderBy("line_no").collect()] == [
        "## INTRODUCTION", "## 1. First thing", "## Short one",
    ]
    md = "before\n# One\n## Two\nbody\n## Two\n\n"
    got = L.extract_sections(L.exploded(spark.createDataFrame([(1, md)], "id int, t string"), "id", "t"), "id").orderBy("section_no").collect()
    assert [(r.level, r.heading, r.content) for r in got] == [(None, None, "before"), (2, "Two", "body"), (2, "Two", "\n")]


def test_empty_tables(spark):
    d = spark.createDataFrame([], "id int, t string")
    lines = L.exploded(d, "id", "t")
    for out in (
        L.merge_broken_lines(lines, "id"), L.detect_headings(lines, "id"), L.extract_sections(lines, "id"), C.token_windows(d, "t"),
        C.fixed_chars(d, "t"), C.sentences(d, "t"), V.bm25(d, "id", "t", "a word", 5),
    ):
        assert out.count() == 0


def test_lookup_keeps_rows_and_defaults_to_the_key(spark):
    d = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, code string")
    dim = spark.createDataFrame([("a", "Alpha")], "k string, name string")
    assert {(r.id, r.label) for r in R.lookup(d, dim, "code", "k", "name", "label").collect()} == {(1, "Alpha"), (2, "z"), (3, None)}


def test_first_seen_with_ties(spark):
    d = spark.createDataFrame([("x", 2, "b"), ("x", 1, "a"), ("x", 1, "a"), (None, 5, "n")], "k string, at int, v string")
    assert {tuple(r) for r in R.first_seen(d, ["k"], ["at"]).collect()} == {("x", 1, "a"), (None, 5, "n")}


def test_surrogate_keys_go_depth_first(spark):
    d = spark.createDataFrame([("b", "x", 1), ("a", "y", 2), ("b", "w", 3)], "p string, q string, at int")
    got = {(r.p, r.q): (r.id, r.parent_id) for r in R.surrogate_keys(d, ["p", "q"], "at", 100).collect()}
    assert got == {("b", None): (100, None), ("b", "x"): (101, 100), ("b", "w"): (102, 100), ("a", None): (103, None), ("a", "y"): (104, 103)}


def test_tags_that_differ_in_case(spark):
    assert one(spark, R.distinct_ignoring_case(F.array(F.lit("A"), F.lit("b"), F.lit(" a"), F.lit(""), F.lit("B")))) == ["A", "b"]


def test_nearest_ignores_unusable_vectors(spark):
    d = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0]), (5, [2.0, 0.0]), (6, [0.0, 3.0])], "id int, v array<double>")
    assert [r.id for r in V.nearest(d, "v", [1.0, 0.0], "id", 5).collect()] == [1, 5, 6]
    assert [r.id for r in V.nearest(d, "v", [1.0, 0.0], "id", 5, F.col("id") > 1).collect()] == [5, 6]


def test_best_per_document(spark):
    d = spark.createDataFrame([(1, "a", 0.2), (2, "a", 0.1), (3, None, 0.0), (4, "b", 0.1)], "id int, doc string, distance double")
    assert [(r.doc, r.id, r.total_chunks) for r in V.best_per_document(d, "doc", "id", 5).collect()] == [("a", 2, 2), ("b", 4, 1)]


def test_layout_of_one_position(spark):
    d = spark.createDataFrame([(1, 1, 5.0, 1.0), (1, 2, 5.0, None), (2, 3, None, 1.0)], "page int, id int, x double, y double")
    assert G.histogram(d, "page", "x").where("n > 0").collect()[0].bin == 5
    cols = G.columns_of_blocks(d, "page", "id", "x", G.peaks(d, "page", "x"))
    assert {r.id: r.column_no for r in cols.collect()} == {1: 0, 2: 0, 3: 0}
    assert {r.id: r.place for r in G.reading_order(cols, "page", "id", "y", "column_no").collect()} == {1: 1, 2: 2, 3: 1}


def test_flattened_names_that_clash(spark):
    d = spark.sql("SELECT named_struct('b', 1, 'c', named_struct('d', 2)) AS a, 3 AS `a.b`")
    assert N.flattened(d).columns == ["a.b", "a.c.d", "a.b_2"]
    assert N.flattened(d, 1).columns == ["a.b", "a.c", "a.b_2"]


def test_sheets(spark):
    d = spark.createDataFrame(
        [(1, '{"a":[{"k":1},{"k":2}],"b":{"k":3}}'), (2, '{"a":1}'), (3, "[{\"x\":1}]"), (4, "5"), (5, "nonsense{"), (6, None)], "id int, j string",
    )
    got = {(r.id, r.sheet, r.row_no): dict(r.cells) for r in N.sheets(d, "id", "j").collect() if r.id < 5}
    assert got == {
        (1, "a", 0): {"k": "1"}, (1, "a", 1): {"k": "2"}, (1, "b", 0): {"k": "3"}, (2, "Data", 0): {"a": "1"}, (3, "Data", 0): {"x": "1"},
        (4, "Data", 0): {"value": "5"},
    }


@pytest.mark.parametrize("ratio", [0.6, 0.75, 0.85, 1.0])
def test_similar_strings_against_all_pairs(spark, ratio):
    import random

    rng = random.Random(5)
    values = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 14))) for _ in range(120)} | {"ab" * 20, "ab" * 19 + "cc"}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    want = {(a, b) for a in values for b in values if a < b and 1 - distance(a, b) / max(len(a), len(b)) >= ratio - 1e-9}
    d = spark.createDataFrame([(v,) for v in sorted(values)] * 2 + [(None,), ("",)], "v string")
    assert {(r.a, r.b) for r in R.similar_strings(d, "v", ratio).collect()} == want


def test_similar_strings_of_any_length(spark):
    long = "".join(chr(97 + i * i % 26) for i in range(300))
    d = spark.createDataFrame([(long,), (long[:-3] + "zzz",), ("x" * 250,)], "v string")
    assert [(r.a, r.b) for r in R.similar_strings(d, "v", 0.95).collect()] == [tuple(sorted((long, long[:-3] + "zzz")))]


def test_top_phrases(spark):
    d = spark.createDataFrame([("1", "Oak trees grow. Oak trees and the"), ("2", None), ("3", ""), ("4", "one the"), ("5", "x y")], "key string, text string")
    got = [(r.key, r.keyword, r.n, r["rank"]) for r in C.top_phrases(d, "key", "text", k=3).orderBy("key", "rank").collect()]
    assert got == [("1", "oak", 2, 1), ("1", "oak trees", 2, 2), ("1", "trees", 2, 3), ("5", "x", 1, 1), ("5", "x y", 1, 2), ("5", "y", 1, 3)]


def test_hybrid_tags(spark):
    d = spark.createDataFrame(
        [("1", "Oak trees. Oak music", ["Oak", " Trees ", None, ""]), ("2", None, ["a"]), ("3", "", None), ("4", "the MUSIC of the", None)],
        "_k string, _t string, tags array<string>",
    )
    got = {r["_k"]: r.tags for r in C.hybrid_tags(d, "_k", "_t", "tags", ("music", "art")).collect()}
    assert got["2"] == ["a"] and got["3"] == [] and got["1"][:2] == ["Oak", "Trees"] and "oak" not in got["1"] and "trees oak music" in got["1"]
    assert got["4"] == ["music", "the music"] and C.hybrid_tags(d.limit(0), "_k", "_t", "tags", ("x",)).count() == 0


def test_long_policy_lines(spark):
    lines = L.exploded(spark.createDataFrame([(1, "# S\n- [x] " + "a" * 3000)], "id int, text string"), "id", "text")
    assert len(S.policy_tree(lines, "id").first().policies[0].text) == 3000


def test_course_and_math_records_of_odd_lines(spark):
    texts = ["", "BIG IDEA 1", "EU 1.A", "BIG IDEA 1\n(EVO)", "Learning Objective 1\n\nx", "EU 1.A\nEU 1.B\nEU 1.C\nEU 1.D: d", None]
    lines = L.exploded(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "id", "text")
    got = {(r.id, r.line_no): (r.kind, r.code, r.text) for r in S.course_records(lines, "id").collect()}
    assert got == {(5, 0): ("understanding", "1.A", "EU 1.B"), (5, 2): ("understanding", "1.C", "EU 1.D: d")}
    assert S.math_coded_records(lines, "id").count() == 0 and S.science_records(lines, "id").count() == 0


def test_once_keeps_whole_texts_where_they_are(spark, tmp_path):
    from quillspark.plans.common import once

    rows = [(1, "a", None), (1, "a", "f"), (2, "b", "g"), (None, "c", "h"), (3, None, None), (3, None, "i")]
    spark.createDataFrame(rows, "k int, text string, side string").write.parquet(f"{tmp_path}/t.parquet")
    for columns in (("text", "side"), ("side",)):
        got = sorted((r.k, *(r[c] for c in columns)) for r in once(spark, str(tmp_path), "t", "k", *columns).collect())
        assert got == [(k, *(x[c] for c in columns)) for k, x in ((1, {"text": "a", "side": "f"}), (2, {"text": "b", "side": "g"}), (3, {"text": None, "side": "i"}))]
    plan = once(spark, str(tmp_path), "t", "k", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "Union" in plan


def test_buckets_give_the_same_states_and_totals(spark):
    import random

    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), i, rng.choice([None, None, i]), rng.choice([1, 2, None])) for i in range(200)]
    d = spark.createDataFrame(rows, "k string, at int, v int, n int")
    plain = L.fill_forward(d, ["k"], ["at"], state=F.col("v"))
    cut = L.fill_forward(d, ["k"], ["at"], F.floor(F.col("at") / 7), state=F.col("v"))
    assert cut.columns == plain.columns and sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))
    total = {}
    want = {}
    for k, at, _, n in rows:
        total[k] = total.get(k, 0) + (n or 0)
        want[at] = total[k]
    assert {r.at: r.t for r in L.running_totals(d, ["k"], ["at"], F.floor(F.col("at") / 7), t=F.col("n")).collect()} == want
