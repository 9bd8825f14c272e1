import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.llm import quality as Q8
from quillspark.llm import queries as Q

PROSE = "The council met in the hall and it heard what the teachers had to say about the new plan. There was no vote on it, but the chair will write to all of them.\n"


TABLE = Q8.Table()


def merged(text, cuts, from_left=True):
    at = [0, *sorted(min(c, len(text)) for c in cuts), len(text)]
    parts = [Q8.Partial(text[a:z], TABLE) for a, z in zip(at, at[1:])]
    while len(parts) > 1:
        parts = [parts[0].merged(parts[1], TABLE), *parts[2:]] if from_left else [*parts[:-2], parts[-2].merged(parts[-1], TABLE)]
    return parts[0].finished(TABLE)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab the1|\n.,;:é '’<>/n-\t", max_size=120), st.lists(st.integers(0, 120), max_size=5))
def test_chunks_merge_to_the_whole(text, cuts):
    whole = Q8.statistics(text)
    assert merged(text, cuts) == whole and merged(text, cuts, False) == whole


MIXED = "Don't put the n/a in l'école,  a  b\tc, it's <b class='x y'>bold</b>; so....\n  - one: thing\nName: Ann\n\n| a | b |\n1,2,,3\n" + "x" * 70 + " (I.) ÂÃ© the end"


def test_every_cut_gives_every_field_of_the_whole():
    whole = Q8.statistics(MIXED)
    for cut in range(len(MIXED) + 1):
        assert merged(MIXED, [cut]) == whole, cut
        assert merged(MIXED, [cut // 2, cut, cut + 7], cut % 2 == 0) == whole, cut


@pytest.mark.parametrize("kind,text", [
    ("prose", PROSE * 3), ("prose", PROSE.lower()), (
        "prose", "El consejo revisó el plan de la escuela y la maestra explicó las normas del aula para que todos participaran.\n" * 2,
    ), ("prose", PROSE * 4 + "\n- one thing\n- another\n"),
    ("prose", PROSE * 4 + "a | b | c\n1 | 2 | 3\n"), ("prose", PROSE.replace(" ", "\n", 30).replace("\n", " \n")), (
        "list", "\n".join(f"{i}. steady garden" for i in range(12)),
    ), ("list", "- red apples\n- green pears\n- blue plums\n" * 3),
    ("list", "Anna Roe\nBen Lund, Coach\nCara Finn\nDan Holt\n" * 2), (
        "table", "name,a,b,c\n" + "\n".join(f"Item,{i},{i * 2},x" for i in range(9)),
    ), ("table", "| a | b |\n| - | - |\n" + "| x1 | 2 |\n" * 9), ("table", "Name: Ann\nAge: 4\n\nName: Bo\nAge: 5\n" * 3),
    ("junk", "}{)(*&^%$#@!~`=+-_ " * 20), (
        "junk", "xkcd qwrt zxcv bnmp lkjh gfds ptrw mnbv " * 5,
    ), ("junk", "click garden here " * 30), ("junk", "<div class='a'><span></span></div>" * 10), ("junk", "8237462 9823746 1928374 5647382 " * 6),
])
def test_kinds(kind, text):
    assert Q8.statistics(text)["text_kind"] == kind


ROWS = "".join(f"Conference on steady gardens {i},{i * 2},{i + 7},x\n" for i in range(9))
FIELDS = "".join(f"Number steady gardens visited: {i}\nTeachers present first mornings: {i * 2}\n\n" for i in range(9))


@pytest.mark.parametrize("text", [ROWS, FIELDS])
def test_rows_and_fields_beyond_the_head_of_a_line(text):
    whole = Q8.statistics(text)
    assert whole["text_kind"] == "table" and whole["table_share"] > 0.9
    for cut in range(120):
        assert merged(text, [cut]) == whole


@pytest.mark.parametrize("kind,text", [
    ("prose", "Ученики читали книги в школе. Потом они писали письма своим друзьям и гуляли в саду.\n" * 2), ("prose", "Photosynthesis converts sunlight. Plants store glucose. Roots absorb water."),
    ("prose", "Réunion demain matin. Merci beaucoup."), ("prose", "学生们在图书馆里读书，然后写信给朋友。老师讲解了新的计划。"), ("prose", "Оι μαθητές διάβασαν βιβλία στο σχολείο. Μετά έγραψαν γράμματα."),
    ("prose", "Ученики читали книги в школе и\nпотом писали письма своим\nдрузьям. Учитель объяснил новый\nплан и все с ним согласились."), ("prose", "Uczniowie czytali książki. Potem napisali listy do przyjaciół z klasy."),
    ("list", "1) Measure another equation of the landscape.\n2) Question every landscape for geography.\n3) Clarify this policy and the meeting.\n"),
    ("list", "CV-9.D.4 Review our feedback and our playground.\nLI-7.F.9 Share our telescope and each schedule.\nLI-10.G.3b Introduce each committee for media arts."),
    ("list", "flexible glossary; inclusive passage; annual survey; regional handbook; broad glossary; honest meeting"), ("table", "Name;Survey;Calendar\nAnn;;98\nBo;n/a;97\nCy;4;"),
    ("junk", "~ [+<$|=@$#+>-/@&-}-}}@@)]/<|-]\n*|#$_|~[)(\n@#$~&$~;%<|>$@>/^<#\n"), ("prose", PROSE * 4 + "1) One.\n2) Two.\n3) Three.\n"),
])
def test_kinds_of_other_scripts_and_of_enumerations(kind, text):
    assert Q8.statistics(text)["text_kind"] == kind


def test_statistics(spark):
    long = PROSE * 2000
    run = "ab1'c" * 5000 + " end\n" + MIXED
    rows = [(1, None), (2, ""), (3, "  \n"), (4, PROSE), (4, PROSE), (5, long), (6, long), (5, long), (7, run), (8, "Ж" * 999 + " é\n" * 999)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("no", F.lit(1)).withColumn("part", F.lit("x"))
    got = {r.doc_id: r.asDict() for r in Q8.text_statistics(d, chunk_chars=1000).collect()}
    assert Q8.text_statistics(d, chunk_chars=1000).count() == len(got) == 7 and got[3]["text_kind"] is None and got[4]["text_kind"] == "prose"
    for i, t in rows:
        assert t is None or got[i] == {"doc_id": i} | Q8.statistics(t), i
    assert Q8.text_statistics(d.limit(0)).count() == 0


def test_query_has_no_prose(spark, data):
    labels = {r.doc_id: r.label.strip().lower() for r in spark.read.parquet(f"{data}/quality_label.parquet").collect()}
    found = {r.doc_id: r.text_kind for r in Q.p8_found(spark, data).collect()}
    assert set(found.values()) <= {"list", "table", "junk"}
    agree = sum(found.get(i, "prose") == label.rstrip("s") for i, label in labels.items())
    assert agree >= 0.8 * len(labels)
