import pytest

from quillspark.llm import queries as Q
from quillspark.llm import transcripts as R

PEOPLE = [(1, "Ada Marlow", "Coach"), (2, "Bo Hestrin", "Librarian")]


def turns(text, people=PEOPLE):
    out = []
    for _, n, said in R.parse(text, people):
        if out and out[-1][0] == n:
            out[-1] = (n, out[-1][1] + " " + said)
        else:
            out.append((n, said))
    return out


@pytest.mark.parametrize("text", [
    "[0:05] Ada Marlow: Good day.\n[0:09] BO HESTRIN: Hello.\n", "0:05 | Coach | Good day.\n0:09 | B. Hestrin | Hello.", "(0:05) Ada M. - Good day.\n(0:09) Dr. Hestrin - Hello.", ">> Ada Marlow (Coach): Good\nday.\n>> Bo: Hello.",
    "Ada Marlow (0:05):\nGood day.\nbo hestrin (0:09):\nHello.", "A.M.  00:00:05\nGood day.\n\nBo Hestrn  00:00:09\nHello.", "WEBVTT\n\n1\n00:00:05.000 --> 00:00:07.000\n<v Speaker 1>Good\n\n2\n00:00:07.000 --> 00:00:09.000\nday.\n\n3\n00:00:09.000 --> 00:00:10.000\nSPK_02: Hello.\n",
    "[0:09] Bo Hestrin: Hello.\n[0:05] Ada Marlow: Good day.\n", "[0:05] Ada Marlow: uh, Good [laughter] day.\n[0:07] Bo Hestrin: mm-hmm (door closes)\n[0:08] Marlow: *coughs*\n[0:09] Librarian: Hello.",
])
def test_layouts(text):
    assert turns(text) == [(1, "Good day."), (2, "Hello.")]


def test_words_that_look_like_labels():
    text = "[0:05] Ada Marlow: We come to Question 2: who\ndecides? Note: this\nwas new at 10:30 and the ratio 3:1 held\n[0:09] Unknown speaker: No.\n[0:10] Caller: Yes (all of them)."
    assert turns(text) == [
        (1, "We come to Question 2: who decides? Note: this was new at 10:30 and the ratio 3:1 held"), (0, "No. Yes (all of them)."),
    ]


@pytest.mark.parametrize(
    "said,kept",
    [
        ("What kind of book is it?", "What kind of book is it?"), ("It is kind of new.", "It is new."), ("As you know, we met.", "As you know, we met."),
        ("We met, you know.", "We met,."), ("Do you know the plan?", "Do you know the plan?"), ("You know.", "You know."),
        ("Leemos este libro y la novela.", "Leemos este libro y la novela."), ("Leemos este... la novela.", "Leemos la novela."),
        ("Wenn er kommt und das Buch nicht da ist, um zu lesen.", "Wenn er kommt und das Buch nicht da ist, um zu lesen."),
        ("We er met um here.", "We met here."), ("It looks like, say, a plan.", "It looks like, say, a plan."), ("Um, uh.", None),
    ],
)
def test_fillers_by_context(said, kept):
    assert turns(f"[0:01] Ada Marlow: {said}") == ([(1, kept)] if kept else [])


@pytest.mark.parametrize("label,number", [
    ("Ada Marlow", 1), ("ADA MARLW", 1), ("Ada Marrlowe", 1), ("Adq Mzrlow", 1), ("Dr. Hestrn", 2), ("Mr Hestrin", 2), ("Hestrin", 2), ("Librarian", 2), ("Speaker 2", 2),
    ("spk_07", 0), ("Unknown woman", 0), ("Caller", 0), ("Cara Delgado", None), ("Note", None), ("Bo", 2), ("B.H.", 2), ("Coach (left)", 1), ("", None), ("Library", None),
])
def test_labels_are_hits_of_the_automaton(label, number):
    assert R.Roster(PEOPLE).number(label) == number


def test_one_speaker_is_not_everyone():
    assert R.Roster(PEOPLE[:1]).number("Somebody Else") is None


@pytest.mark.parametrize("text,kept", [
    ("a [door] b", "a b"), ("a [x [y] z] b", "a [x z] b"), ("a ((noise here)) b", "a b"), ("a (door closes) b", "a b"), ("a (all of them) b", "a (all of them) b"), ("a *sighs* b * c", "a b * c"),
    ("a ♪ la la ♪ b ♪", "a b"), ("a < b and c > d", "a d"), ("a [ b", "a [ b"), ("a ] b [", "a ] b ["), ("a {x} b", "a b"), ("a [" + "x" * 81 + "] b", "a [" + "x" * 81 + "] b"),
])
def test_notes_are_pairs_of_marks(text, kept):
    assert R.clean(text, R.Roster(PEOPLE))[0] == kept


def test_odd_texts():
    assert turns("") == [] and turns("\n \n") == [] and turns("[music]") == [] and turns("Just words.") == [(0, "Just words.")]
    assert turns("[0:01] Ada Marlow: Hi.\n[0:02] no label here\n", []) == [(0, "Hi. no label here")]
    assert len(turns("[0:01] Ada Marlow: " + "long words. " * 50_000)) == 1


def test_turns_from_chunks_and_transcript(spark):
    items = spark.createDataFrame(
        [(1, "u1", "[0:01] Ada Marlow: Hi.\n[0:02] Bo: Ho."), (1, "u1", None), (2, "u2", None), (3, None, None), (4, "u4", "  ")],
        "audio_id bigint, uuid string, transcript string",
    )
    chunk = "chunk_id bigint, text string, time_start double, chunk_index int, of_audio_item struct<uuid string>"
    chunks = spark.createDataFrame(
        [
            (12, "[0:02] Bo: Ho.", 2.0, 0, ("u2",)), (11, "[0:01] Ada Marlow: Hi.", 1.0, 0, ("u2",)), (11, "[0:01] Ada Marlow: Hi.", 1.0, 0, ("u2",)),
            (13, None, 3.0, 0, ("u2",)), (14, "x", 1.0, 1, None),
        ],
        chunk,
    )
    roster = spark.createDataFrame([(i, *p) for i in (1, 2) for p in PEOPLE], "audio_id bigint, speaker_no int, full_name string, role_name string")
    got = sorted((r.audio_id, r.turn_no, r.speaker_no, r.text) for r in R.turns(items, chunks, roster).collect())
    assert got == [(1, 1, 1, "Hi."), (1, 2, 2, "Ho."), (2, 1, 1, "Hi."), (2, 2, 2, "Ho.")]
    assert R.turns(items.limit(0), chunks.limit(0), roster.limit(0)).count() == 0


def test_recordings_with_both_give_the_same(spark, data):
    items, chunks, roster = (spark.read.parquet(f"{data}/{n}.parquet") for n in ("audio_item", "audio_chunk", "audio_roster"))
    both = [r[0] for r in items.where("transcript is not null").join(chunks, items.uuid == chunks.of_audio_item.uuid).select("audio_id").distinct().collect()]
    a = {tuple(r) for r in Q.p3_found(spark, data).collect() if r.audio_id in both}
    from pyspark.sql import functions as F

    b = {tuple(r) for r in R.turns(items.withColumn("transcript", F.lit(None).cast("string")), chunks, roster).select("audio_id", "turn_no", "speaker_no").collect() if r.audio_id in both}
    assert a == b
