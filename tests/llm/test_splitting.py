import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import queries as Q
from quillspark.llm import splitting as P


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .\n\r\té!?", max_size=400), st.integers(8, 60), st.integers(0, 7))
def test_round_trip_and_limits(text, most, overlap):
    pieces = P.split_text(text, most, overlap)
    assert "".join(text[own:z] for _, own, z in pieces) == text
    for k, (a, own, z) in enumerate(pieces):
        assert z - a <= most and z > own
        assert own - a == (min(overlap, own) if k else 0)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .\n\t!", max_size=200), st.integers(1, 40))
def test_level_is_the_coarsest_at_which_all_segments_fit(text, limit):
    import re

    cuts = (r"\n[ \t\r]*\n", r"\n[ \t\r]*\n|(?<=[.!?])[ \t\r\n]+", r"[ \t\r\n]+")
    fits = lambda cut: all(len(x.strip(" \t\r\n")) <= limit for x in re.split(cut, text))
    want = next((name for name, cut in zip(P.LEVELS, cuts) if fits(cut)), "none")
    assert P.boundary_level(text, limit) == want


def test_levels():
    limit = 20
    assert P.boundary_level("a" * 15 + "\n\n" + "b" * 15, limit) == "paragraph"
    assert P.boundary_level("a" * 15 + "\r\n \r\n" + "b" * 15, limit) == "paragraph"
    assert P.boundary_level("a" * 15 + ". " + "b" * 15, limit) == "sentence"
    assert P.boundary_level("a" * 15 + "\r\n" + "b" * 15, limit) == "word"
    assert P.boundary_level("a" * 15 + ".b" + "b" * 15, limit) == "none"
    assert P.boundary_level("   " * 10 + "a" * 20 + "   " * 10 + "\n\nb", limit) == "paragraph"


def test_weak_boundaries_are_merged_first():
    text = "One two. Three four.\n\nFive six. Seven."
    assert [text[own:z] for _, own, z in P.split_text(text, 24, 0)] == ["One two. Three four.\n\n", "Five six. Seven."]


def test_longest_text_and_bad_overlap():
    assert len(P.split_text("word " * 200_000, 6000, 300)) >= 1_000_000 // 6000
    with pytest.raises(ValueError):
        P.split_text("x" * 50, 10, 10)


def test_pieces(spark):
    spec = spark.createDataFrame([("f", 10, 2)], "field_name string, max_chars int, overlap_chars int")
    rows = [(1, "short", 0), (2, "aa bb cc dd ee ff", 0), (2, "aa bb cc dd ee ff", 1), (3, None, 0), (4, "", 0), (5, "é" * 10, 0), (6, "é" * 11, 0)]
    d = spark.createDataFrame(rows, "k bigint, t string, max_chars int")
    got = P.split_pieces(P.oversized(d, "k", "t", "f", spec)).orderBy("record_key", "chunk_index").collect()
    assert {r.record_key for r in got} == {"2", "6"} and all(len(r.piece) <= 10 for r in got)
    for key in ("2", "6"):
        own = [r for r in got if r.record_key == key]
        assert "".join(r.piece[r.overlap :] for r in own) == (rows[1][1] if key == "2" else "é" * 11) and [r.chunk_index for r in own] == list(range(len(own)))
    empty = P.oversized(d.limit(0), "k", "t", "f", spec)
    assert P.split_pieces(empty).count() == 0 and P.levels(empty).count() == 0
    assert sorted(tuple(r) for r in P.levels(P.oversized(d, "k", "t", "f", spec)).collect()) == [("f", "2", "word"), ("f", "6", "none")]


def test_query_on_whole_tables(spark, data):
    import re

    spec = {r.field_name: r.max_chars for r in spark.read.parquet(f"{data}/split_spec.parquet").collect()}
    cuts = (r"\n[ \t\r]*\n", r"\n[ \t\r]*\n|(?<=[.!?])[ \t\r\n]+", r"[ \t\r\n]+")
    want = set()
    for table, key, col, field in (
        ("source_document", "id", "content", "source_document.content"), ("knowledge_main", "chunk_id", "text", "knowledge_main.text"),
    ):
        for r in spark.read.parquet(f"{data}/{table}.parquet").select(key, col).collect():
            if r[col] and len(r[col]) > spec[field]:
                level = next((n for n, c in zip(P.LEVELS, cuts) if all(len(x.strip(" \t\r\n")) <= spec[field] for x in re.split(c, r[col]))), "none")
                want.add((field, str(r[key]), level))
    assert {tuple(r) for r in Q.p5_found(spark, data).collect()} == want and want
