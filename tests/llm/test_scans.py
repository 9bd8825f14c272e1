import pytest

from quillspark.llm import queries as Q
from quillspark.llm import scans as S

WORDS = "the teachers met in long hall and planned another standards-based lesson for school-wide reading the conference was calm because families came long-term clear every library described our garden of".split()
PAGE = """=== Page 1 ===
Harbor Reading Guide   12
The tcachers met in the long hall and plan-
ned another standards-
based lesson for reading.

CLEAR READING 4
Every librar­
13
HARBOR READNG GUIDE
y described our garden be(ause families came.
=== Page 2 ===
"""


@pytest.fixture(scope="module")
def decoder():
    return S.Decoder(S.Lexicon({w: 500 for w in WORDS} | {"planned": 500, "teachers": 500}))


HEADS = S.Heads("Harbor Reading Guide", "/in/harbor_board/harbor_reading_guide_0012.pdf")


def test_defects_of_a_page(decoder):
    kinds, found = S.analyse(PAGE, HEADS, decoder)
    assert found == [
        (2, "running_head"), (3, "hyphen_break"), (3, "misread"), (8, "hyphen_break"), (9, "page_number"), (10, "running_head"), (11, "misread"),
    ]
    assert kinds[6] == "heading" and kinds[0] == "marker"


def test_paragraphs_of_a_page(decoder):
    assert S.paragraphs(PAGE, HEADS, decoder) == [
        "The teachers met in the long hall and planned another standards-based lesson for reading.", "CLEAR READING 4",
        "Every library described our garden because families came.",
    ]


@pytest.mark.parametrize("line", ["12", " - 12 -", "[45]", "p. 9", "Page 3 of 12", "P a g e  1 4 1", "xiv", "l06", "I27", "ll2"])
def test_page_numbers(line):
    assert S.page_number(line)


@pytest.mark.parametrize("line", ["", "on 12", "22.", "The", "in 1998 the hall", "is", "garden"])
def test_no_page_numbers(line):
    assert not S.page_number(line)


@pytest.mark.parametrize(
    "seen,true",
    [
        ("becanse", None), ("beoause", "because"), ("fhe", "the"), ("c0nference", "conference"), ("rnet", "met"), ("famihes", "families"),
        ("cvery", "every"), ("de$cribed", "described"), ("gardeii", None),
    ],
)
def test_confused_characters(decoder, seen, true):
    found = decoder.read(seen)
    assert true is None or found and found[0] == true
    assert S.wrong(seen, decoder) == (found is not None)


def test_words_that_are_right(decoder):
    for w in ("The", "Quinvelt", "standards-based", "SC-5.E.2a,", "12", "(1999)", "families'", "", "long-term", "—"):
        assert not S.wrong(w, decoder), w


def test_split_and_merged_words(decoder):
    assert S.decode(["thelibrary was", "ca lm and c1ear"], decoder) == "the library was calm and clear"


@pytest.mark.parametrize(
    "lines,text",
    [
        (["met in every gar den of", "the lib ra ry"], "met in every garden of the library"), (["met inthelong hall"], "met in the long hall"),
        (["the c0nfer ence was"], "the conference was"), (["a confer-", "en ce was calm"], "a conference was calm"),
        (["the lib ra-", "ry of"], "the library of"), (["HIS LI BRA RY"], "HIS LIBRARY"), (["Under CV-", "9.A.8c, the"], "Under CV-9.A.8c, the"),
        (["met with rarelibrary"], "met with rare library"), (["for Gar Den"], "for Gar Den"),
    ],
)
def test_decoding_over_characters(lines, text):
    d = S.Decoder(S.Lexicon({w: 500 for w in WORDS} | {"rare": 3, "with": 500, "a": 500, "under": 500, "his": 500}))
    assert S.decode(lines, d) == text


def test_defects_come_from_decoding(decoder):
    page = "The families met in every gar den of\nthe long hall. Every lib ra-\nry was calm and\nplannedthelibrary. Under CV-\n9.A.8c, the"
    assert S.analyse(page, HEADS, decoder)[1] == [(1, "misread"), (2, "hyphen_break"), (2, "misread"), (4, "misread")]


def test_odd_texts(decoder):
    for t in ("", "\n\n", "===", "-", "- \n-", "\x00", "word " * 100_000):
        S.analyse(t, HEADS, decoder)
        S.paragraphs(t, S.Heads(None, None), decoder)


def test_tables(spark):
    meta = "metadata struct<title:string>"
    docs = [
        ("d1", PAGE, ("Harbor Reading Guide",), "/in/harbor_board/harbor_reading_guide_0012.pdf", True),
        ("d1", PAGE, (None,), "/in/harbor_board/harbor_reading_guide_0012.pdf", True), ("d2", " ".join(WORDS) * 9, (None,), None, False),
        ("d3", None, None, None, True), (None, "x", None, None, None),
    ]
    d = spark.createDataFrame(docs, f"id string, content string, {meta}, source_path string, is_scanned boolean")
    k = spark.createDataFrame(
        [(1, PAGE, "d1"), (1, PAGE, None), (2, PAGE, "d2"), (3, PAGE, None), (4, None, "d1"), (5, "", "d1"), (6, "The garden.", "gone")],
        "chunk_id bigint, text string, document_id string",
    )
    words = S.Lexicon({w: 500 for w in WORDS} | {"planned": 500})
    found = S.defects(S.scanned_texts(d, k), words)
    assert {r.record_key for r in found.collect()} == {"d1", "1"} and found.count() == 14
    assert S.repaired(S.scanned_texts(d, k), words).groupBy("record_key").count().where("count = 3").count() == 2
    assert S.defects(S.scanned_texts(d.limit(0), k.limit(0)), words).count() == 0
    assert S.corpus_lexicon(d).words["garden"] == 9 and S.corpus_lexicon(d.limit(0)).words == {}


def test_known_words_are_a_share_of_the_corpus(spark):
    """The same words are known when the corpus is repeated."""
    small = spark.createDataFrame([("the", 900_000), ("garden", 1000), ("often", 30), ("seldom", 4), ("once", 1)], "word string, n bigint")
    a, b = S.lexicon(small), S.lexicon(small.selectExpr("word", "n * 1000 as n"))
    assert set(a.words) == {"the", "garden", "often", "seldom"} and (a.least, a.common) == (2, 20)
    assert set(b.words) == {*a.words, "once"} and (b.least, b.common) == (902, 9912)
    assert [w for w, n in a.words.items() if n >= a.common] == [w for w, n in b.words.items() if n >= b.common] == ["garden", "often", "the"]


@pytest.mark.parametrize("line,text", [
    ("the tea cbers and", "the teachers and"), ("the con tin uous paragraph", "the continuous paragraph"), ("the tcachersand school", "the teachers and school"),
    ("schoo1students were", "school students were"), ("thelessonswere planned", "the lessons were planned"),
])
def test_splits_merges_and_confusions_together(line, text):
    d = S.Decoder(S.Lexicon({w: 500 for w in [*WORDS, *"teachers continuous paragraph school students were lessons planned".split()]}))
    assert S.decode([line], d) == text
    assert S.analyse("The " + line[4:] if line.startswith("the ") else line, HEADS, d)[1] == [(1, "misread")]


def test_query_on_whole_tables(spark, data):
    found = Q.p2_found(spark, data)
    assert set(found.columns) == {"field_name", "record_key", "line_no", "defect"} and {r.defect for r in found.select("defect").distinct().collect()} <= {
        "hyphen_break", "misread", "running_head", "page_number",
    }
    assert found.count() == found.distinct().count() > 0
