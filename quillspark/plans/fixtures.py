"""Queries over small texts of our own, for parsers whose forms the test tables don't have."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import layout as G
from ..operators import lines as L
from ..operators import standards as S

CODES = (
    "MU:Cr1.1.PKa", "VA:Re7.2.III", "DA:Pr4.1.8b", "2.NBT.A.1", "CCSS.MATH.CONTENT.6.RP.A.3b", "HSA-CED.A.2", "HSA-CED.A.2a", "K.CC.B.4", "2.NBT.1", "K.CC.4",
    "3.NF.2a", "HS.A-CED.2", "HS.A-REI.3", "HS.G.4", "CCSS.Math.Content.5.OA.2", "not a code", "",
)
SUBTITLES = (
    "WEBVTT\n\n1\n00:00:01.000 --> 00:00:03.000\nGood morning.\n\n2\n00:00:03.000 --> 00:00:05.000\nWe begin.",
    "<?xml version=\"1.0\"?>\n42\nOnly this\n", "",
)
QUESTIONS = ("How do rivers change? Why does it matter?", "What? Who decides the rule?", "No question here", "Ok?")
SCIENCE = """MS.Forces and Interactions
MS-PS2-1.Apply a law of motion to a
problem of two bodies.
2013 © Achieve, Inc.
[Clarification Statement: Bodies may be cars
or carts.]
[Assessment Boundary: One dimension only.]

3-LS4-2. Use evidence to explain
how traits help.
2 of 40
Disciplinary Core Ideas of the grade
6-PS1-1. Develop a model of matter.
HS.Space Systems
=== Page 3 ===
12-ESS1-5. Weigh evidence
of plates.

K.Weather
K-ETS1-1. Ask questions.
[Clarification Statement: Of local weather.]"""
INQUIRY = """Framework of inquiry
D1.2.K-2. Identify facts about a question.
D2.His.3.6-8. Use questions to weigh
events of the past.
=== Page 4 ===
and their causes.

Some other text
D4.7.9-12. Assess options."""
COURSE = """BIG IDEA 1: EVOLUTION (EVO)
The process of evolution drives
the diversity of life.

Enduring Understanding EVO-1: Traits of a population change.
LO 1.A: Describe the change.
a line of text
EVO-1.1: Natural selection acts on traits.
EVO-1.1.1: Explain how selection acts.
Big Idea 2 (ENE): Energetics of systems
EU ENE-2
Cells have membranes.
Learning Objective ENE-2.A
LO ENE-2.B
text of its own
Learning Objective ENE-2.C: Explain a system.
BIG IDEA 3
Information storage (IST)
EU 3.A
"""
MATH_CODED = """Grade 2 overview of mathematics
Operations and Algebraic Thinking 2.OA
Represent and solve problems of adding
2.OA.1 Use adding within 100 to

solve word problems.
=== Page 2 ===
in many contexts
2.OA.2a. Fluently add within 20.
2.NBT
Work with equal groups of objects
HS.A-REI.3 Solve linear equations."""
POLICY = """Front matter
# School day
## Hours
- [x] Doors open at eight
- [ ] Late entry by the side door
## Meals
- [x] Lunch at noon
# Library
- [ ] Quiet in the hall"""

ARTS = """Anchor Standard 1: Make plans
Enduring Understanding: Ideas come from looking.
Essential Question: Where do ideas come from? How do they grow?
VA:Cr1.1.Ka Draw a thing you saw.
=== Page 2 ===
VA:Cr1.1.1a Draw a place.
Enduring Understanding
Work is shared.
Anchor Standard 2: Share work
MU:Pr4.1.2a Sing for others."""
MATHS = """GRADE 2
2.OA
Represent and solve problems of adding
1. Use adding within 100 to
solve word problems.
a. With two steps.
2. Add within 20.

Work with equal groups of objects
3. Tell if a number is even.
3.MD
4. Measure time."""


def _texts(spark: SparkSession, *texts: str) -> DataFrame:
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def _lines(spark: SparkSession, text: str) -> DataFrame:
    return L.exploded(_texts(spark, text), "id", "text")


def code_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _texts(spark, *CODES).select(
        "id", S.parse_code(F.col("text")).alias("c"),
    ).select("id", "c.*").withColumn("grade_name", S.grade_name(F.col("grade")))


def subtitle_clean(spark: SparkSession, sf: str) -> DataFrame:
    return _texts(spark, *SUBTITLES).select("id", T.subtitle_text(F.col("text")).alias("text"))


def question_split(spark: SparkSession, sf: str) -> DataFrame:
    return _texts(spark, *QUESTIONS).select("id", F.posexplode(T.questions(F.col("text"))).alias("place", "question"))


def record_multiline(spark: SparkSession, sf: str) -> DataFrame:
    return S.science_records(_lines(spark, SCIENCE), "id").drop("id").withColumn("record_no", F.col("record_no").cast("int"))


def record_math_coded(spark: SparkSession, sf: str) -> DataFrame:
    return S.math_coded_records(_lines(spark, MATH_CODED), "id").drop("id").withColumn("record_no", F.col("record_no").cast("int"))


def record_inquiry(spark: SparkSession, sf: str) -> DataFrame:
    return S.inquiry_records(_lines(spark, INQUIRY), "id").select(
        F.col("record_no").cast("int").alias("record_no"), "dimension", "discipline", "number", "grade_band", "text",
    )


def anchor_states(spark: SparkSession, sf: str) -> DataFrame:
    return S.anchored_standards(_lines(spark, ARTS), "id").drop("id")


def relationship_edges(spark: SparkSession, sf: str) -> DataFrame:
    return S.edges(S.anchored_standards(_lines(spark, ARTS), "id"), "id").groupBy("anchor", "type").agg(F.count(F.lit(1)).alias("n"))


def record_math(spark: SparkSession, sf: str) -> DataFrame:
    return S.math_records(_lines(spark, MATHS), "id").select(
        F.col("record_no").cast("int").alias("record_no"), "code", "grade", "domain", "cluster", "text",
    )


def multi_pattern_extract(spark: SparkSession, sf: str) -> DataFrame:
    return S.course_records(_lines(spark, COURSE), "id").drop("id")


def course_edges(spark: SparkSession, sf: str) -> DataFrame:
    return S.course_edges(S.course_records(_lines(spark, COURSE), "id"), "id").drop("id")


def nested_json_build(spark: SparkSession, sf: str) -> DataFrame:
    return S.policy_tree(_lines(spark, POLICY), "id").select("section", "subsection", "place", F.to_json("policies").alias("policies"))


def table_format(spark: SparkSession, sf: str) -> DataFrame:
    rows = [(0, [["Name", "Score"], [" Ada ", "9"], ["", None], ["Bo", "7"]]), (1, [["only", "one"]]), (2, [["", ""]]), (3, [])]
    return spark.createDataFrame(rows, "id int, rows array<array<string>>").select("id", T.table_text(F.col("rows")).alias("text"))


def slide_format(spark: SparkSession, sf: str) -> DataFrame:
    rows = [(0, [("Opening", "Welcome"), (None, "No title"), ("", "Blank title")]), (1, [])]
    title = lambda s, i: F.coalesce(F.nullif(F.trim(s["title"]), F.lit("")), F.concat(F.lit("Slide "), (i + 1).cast("string")))
    d = spark.createDataFrame(rows, "id int, slides array<struct<title string, content string>>")
    return d.select(
        "id", F.array_join(F.transform("slides", lambda s, i: F.concat(F.lit("# "), title(s, i), F.lit("\n\n"), s["content"])), "\n\n").alias("text"),
    )


def layout_tables(spark: SparkSession, sf: str) -> DataFrame:
    rows = [(0, [(2, [["Name", "Score"], ["Ada", None]]), (None, None)]), (1, []), (2, None)]
    d = spark.createDataFrame(rows, "id int, found array<struct<page_number int, data array<array<string>>>>")
    return G.tables(d, "id", "found").select("id", "table_index", "page_number", F.to_json("rows").alias("rows"))


SPEECH = (
    '{"results": {"language": "en", "channels": [{"alternatives": [{"transcript": "Good day.", "words": [{"word": "good"}]}, {"transcript": "x"}]}]}}',
    '{"results": {"language": "en", "channels": [{"alternatives": []}]}}', '{"results": {"channels": [{"alternatives": [{"confidence": 1}]}]}}', "{}", "timed out", "",
)


def speech_content(spark: SparkSession, sf: str) -> DataFrame:
    return _texts(spark, *SPEECH).select("id", T.speech_response(F.col("text")).alias("s")).select("id", "s.*")


def _values(rows) -> str:
    lit = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


_A, _M, _H = S.ARTS_CODE, S.MATH_K8_CODE, S.MATH_HS_CODE
_X = lambda p, i: f"nullif(regexp_extract(t, '{p}', {i}), '')"
_IS = lambda p: f"regexp_matches(t, '{p}')"
_CASE = lambda a, b, c: f"CASE WHEN {_IS(_A)} THEN {a} WHEN {_IS(_M)} THEN {b} WHEN {_IS(_H)} THEN {c} END"

_LINES = lambda text: f"(SELECT (i - 1)::INT AS n, trim(l[i]) AS c FROM (SELECT string_split({_values([(text,)])[1:-1]}, chr(10)) AS l), range(1, len(l) + 1) r(i))"
_G = lambda p, i, c="c": f"nullif(regexp_extract({c}, '{p}', {i}), '')"
_HAS = lambda p, c="c": f"regexp_matches({c}, '{p}')"
_NOTE = lambda mark: f"(SELECT trim(replace(replace(string_agg(y.c, ' ' ORDER BY y.n), '{mark}', ''), ']', '')) FROM l y WHERE y.n >= x.n AND y.n < coalesce((SELECT min(z.n) FROM l z WHERE z.n > x.n AND (z.c = '' OR z.c LIKE '[%')), 1000000))"
_LATEST = lambda mark: f"coalesce((SELECT max_by({_NOTE(mark)}, x.n) FROM l x WHERE x.n BETWEEN e AND e + 9 AND x.c LIKE '{mark}%'), '')"
_SCIENCE_SQL = f"""WITH l AS {_LINES(SCIENCE)}, b AS (SELECT n, c, {_HAS(S.SCIENCE_RECORD)} AS b, NOT {_HAS(S.SCIENCE_RECORD)} AND {_HAS(S.SCIENCE_STOP)} AS s, {_HAS(S.SCIENCE_SKIP)} AS k FROM l),
    r AS (SELECT n AS f, row_number() OVER (ORDER BY n) AS record_no, c, (SELECT min(n) FROM b y WHERE y.n > x.n AND (y.b OR y.s)) AS e FROM b x WHERE b),
    o AS (SELECT n, c FROM b x WHERE NOT b AND NOT EXISTS (SELECT 1 FROM r WHERE x.n > f AND (e IS NULL OR x.n < e)) AND NOT starts_with(c, '===')),
    t AS (SELECT *, (SELECT string_agg(c, ' ' ORDER BY n) FROM b y WHERE y.n = f OR y.n > f AND (e IS NULL OR y.n < e) AND NOT k) AS t FROM r)
    SELECT record_no::INT AS record_no, {_G(S.SCIENCE_RECORD, 1)} || '-' || {_G(S.SCIENCE_RECORD, 2)} || {_G(S.SCIENCE_RECORD, 3)} || '-' || {_G(S.SCIENCE_RECORD, 4)} AS code, {_G(S.SCIENCE_RECORD, 1)} AS grade, {_G(S.SCIENCE_RECORD, 2)} AS category,
    {_G(S.SCIENCE_RECORD, 2)} || {_G(S.SCIENCE_RECORD, 3)} AS dci, {_G(S.SCIENCE_RECORD, 4)} AS number, coalesce((SELECT max_by(trim({_G(S.SCIENCE_TOPIC, 2, "o.c")}), o.n) FROM o WHERE o.n < f AND {_HAS(S.SCIENCE_TOPIC, "o.c")}), {_G(S.SCIENCE_RECORD, 2)} || ' Standards') AS topic,
    {_G(S.SCIENCE_RECORD, 5, "t")} AS text, {_LATEST(S.CLARIFICATION)} AS clarification, {_LATEST(S.BOUNDARY)} AS boundary FROM t"""
_MATH_SQL = f"""WITH l AS {_LINES(MATH_CODED)}, b AS (SELECT n, c, {_HAS(S.MATH_CODED_LINE)} AS b, {_HAS(S.MATH_ANY_CODE)} AS a FROM l), r AS (SELECT n AS f, row_number() OVER (ORDER BY n) AS record_no, c, (SELECT min(n) FROM b y WHERE y.n > x.n AND y.a) AS e FROM b x WHERE b),
    o AS (SELECT n, c FROM b x WHERE NOT b AND c <> '' AND NOT EXISTS (SELECT 1 FROM r WHERE x.n > f AND (e IS NULL OR x.n < e))), d AS (SELECT min(n) AS d FROM o WHERE {_HAS(S.MATH_DOMAIN_NAME)})
    SELECT record_no::INT AS record_no, {_G(S.MATH_CODED_LINE, 1)} || '.' || concat_ws('-', {_G(S.MATH_CODED_LINE, 2)}, {_G(S.MATH_CODED_LINE, 3)}) || '.' || {_G(S.MATH_CODED_LINE, 4)} AS code, {_G(S.MATH_CODED_LINE, 1)} AS grade, {_G(S.MATH_CODED_LINE, 2)} AS domain,
    coalesce({_G(S.MATH_CODED_LINE, 3)}, '') AS subdomain, {_G(S.MATH_CODED_LINE, 4)} AS number, trim(concat_ws(' ', {_G(S.MATH_CODED_LINE, 5)}, (SELECT string_agg(c, ' ' ORDER BY n) FROM b y WHERE y.n > f AND (e IS NULL OR y.n < e) AND c <> '' AND NOT starts_with(c, '===')))) AS text,
    (SELECT max_by(o.c, o.n) FROM o, d WHERE o.n < f AND o.n >= d AND length(o.c) > 20 AND NOT {_HAS(S.MATH_NO_CLUSTER, "o.c")}) AS cluster FROM r"""
_FIRST = lambda ps, i: "coalesce(" + ", ".join(_G(p, i) for p in ps) + ")"
_COURSE_SQL = f"""WITH RECURSIVE l AS (SELECT *, coalesce(lead(c) OVER (ORDER BY n), '') AS nx, {_HAS(S.BIG_IDEA_CAPITALS)} AS one, {_HAS(S.BIG_IDEA_CODED)} AS two, {_FIRST(S.UNDERSTANDING, 1)} AS eu, {_FIRST(S.UNDERSTANDING, 2)} AS eut, {_FIRST(S.OBJECTIVE, 1)} AS lo, {_FIRST(S.OBJECTIVE, 2)} AS lot FROM {_LINES(COURSE)}),
    m AS (SELECT *, {_HAS(S.BIG_IDEA_ALONE)} AND {_HAS(S.BIG_IDEA_TITLE, "nx")} AS three FROM l),
    q AS (SELECT *, CASE WHEN one THEN (SELECT count(*) FROM m y WHERE y.n > m.n AND y.n <= m.n + 4 AND NOT EXISTS (SELECT 1 FROM m z WHERE z.n > m.n AND z.n <= y.n AND (z.c = '' OR {_HAS(S.IDEA_STOP, "z.c")}))) WHEN three OR eu IS NOT NULL AND eut IS NULL OR lo IS NOT NULL AND lot IS NULL THEN 1 ELSE 0 END AS eats FROM m),
    walk AS (SELECT 0 AS n UNION ALL SELECT walk.n + 1 + q.eats FROM walk JOIN q ON q.n = walk.n),
    f AS (SELECT q.n AS line_no, CASE WHEN one OR two OR three THEN 'big_idea' WHEN lo IS NOT NULL AND coalesce(lot, nx) <> '' THEN 'objective' WHEN eu IS NOT NULL AND lo IS NULL AND coalesce(eut, nx) <> '' THEN 'understanding' END AS kind,
        CASE WHEN one THEN coalesce({_G(S.BIG_IDEA_CAPITALS, 3)}, 'BI' || {_G(S.BIG_IDEA_CAPITALS, 1)}) WHEN two THEN {_G(S.BIG_IDEA_CODED, 2)} WHEN three THEN coalesce({_G(S.BIG_IDEA_TITLE, 2, "nx")}, 'BI' || {_G(S.BIG_IDEA_ALONE, 1)}) ELSE coalesce(lo, eu) END AS code,
        CASE WHEN one THEN trim(coalesce({_G(S.BIG_IDEA_CAPITALS, 2)}, '')) WHEN two THEN trim({_G(S.BIG_IDEA_CODED, 3)}) WHEN three THEN trim({_G(S.BIG_IDEA_TITLE, 1, "nx")}) WHEN lo IS NOT NULL THEN coalesce(lot, nx) ELSE coalesce(eut, nx) END AS t,
        CASE WHEN one THEN coalesce((SELECT string_agg(c, ' ' ORDER BY n) FROM m y WHERE y.n > q.n AND y.n <= q.n + q.eats), '') ELSE '' END AS description FROM q JOIN walk ON walk.n = q.n),
    held AS (SELECT *, last_value(CASE WHEN kind = 'big_idea' THEN code END IGNORE NULLS) OVER w AS big_idea, last_value(CASE WHEN kind = 'understanding' THEN code END IGNORE NULLS) OVER w AS understanding FROM f WINDOW w AS (ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

# Of some parsers that go from line to line the expected rows are written out.
ORACLES = {
    "code_parse": f"""SELECT c.*, coalesce(g.name, c.grade) AS grade_name FROM (SELECT id, {_CASE("'arts'", "'math'", "'math_hs'")} AS family, {_CASE(f"{_X(_A, 1)} || ':' || {_X(_A, 2)}", _X(_M, 2), f"concat_ws('-', {_X(_H, 1)}, {_X(_H, 2)})")} AS subject,
        {_CASE(_X(_A, 5), _X(_M, 1), "'HS'")} AS grade, {_CASE(f"{_X(_A, 3)} || '.' || {_X(_A, 4)}", _X(_M, 3), _X(_H, 3))} AS number, {_CASE(_X(_A, 6), _X(_M, 4), _X(_H, 4))} AS part FROM (VALUES {_values(enumerate(CODES))}) v(id, t)) c
        LEFT JOIN (VALUES {_values(S.GRADE_NAMES.items())}) g(grade, name) ON c.grade = g.grade""",
    "subtitle_clean": f"SELECT id, coalesce(array_to_string(list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x)), lambda x: NOT contains(x, '-->') AND NOT regexp_matches(x, '^\\d+$') AND NOT starts_with(x, 'WEBVTT') AND NOT starts_with(x, '<?xml')), ' '), '') AS text FROM (VALUES {_values(enumerate(SUBTITLES))}) v(id, t)",
    "question_split": f"WITH q AS (SELECT id, list_filter(list_transform(list_transform(string_split(t, '? '), lambda x: trim(x)), lambda x: CASE WHEN ends_with(x, '?') THEN x ELSE x || '?' END), lambda x: length(x) > 5) AS q FROM (VALUES {_values(enumerate(QUESTIONS))}) v(id, t)) SELECT id, (unnest(generate_series(0, len(q) - 1)))::INT AS place, unnest(q) AS question FROM q",
    "record_multiline": _SCIENCE_SQL,
    "record_math_coded": _MATH_SQL,
    "record_inquiry": "SELECT * FROM (VALUES " + _values(
        [
            (1, "1", None, "2", "K-2", "Identify facts about a question."),
            (2, "2", "His", "3", "6-8", "Use questions to weigh events of the past. and their causes."),
            (3, "4", None, "7", "9-12", "Assess options."),
        ]
    ) + ") v(record_no, dimension, discipline, number, grade_band, text)",
    "anchor_states": "SELECT * FROM (VALUES " + _values(
        [
            (3, "VA:Cr1.1.Ka", "Draw a thing you saw.", "1", "Ideas come from looking.", "How do they grow?"),
            (5, "VA:Cr1.1.1a", "Draw a place.", "1", "Ideas come from looking.", "How do they grow?"),
            (9, "MU:Pr4.1.2a", "Sing for others.", "2", "Work is shared.", "How do they grow?"),
        ]
    ) + ") v(line_no, code, text, anchor, understanding, question)",
    "relationship_edges": "SELECT * FROM (VALUES " + _values(
        [("1", "eu", 1), ("1", "eq", 1), ("2", "eu", 1), ("2", "eq", 1)]
    ) + ") v(anchor, type, n)",
    "record_math": "SELECT * FROM (VALUES " + _values(
        [
            (1, "2.OA.1", "2", "OA", "Represent and solve problems of adding", "Use adding within 100 to solve word problems."),
            (2, "2.OA.1a", "2", "OA", "Represent and solve problems of adding", "With two steps."),
            (3, "2.OA.2", "2", "OA", "Represent and solve problems of adding", "Add within 20."),
            (4, "2.OA.3", "2", "OA", "Work with equal groups of objects", "Tell if a number is even."),
            (5, "3.MD.4", "3", "MD", None, "Measure time."),
        ]
    ) + ") v(record_no, code, grade, domain, cluster, text)",
    "multi_pattern_extract": f"{_COURSE_SQL} SELECT line_no, kind, code, t AS text, description, big_idea, understanding FROM held WHERE kind IS NOT NULL",
    "course_edges": f"{_COURSE_SQL} SELECT DISTINCT big_idea, code AS understanding FROM held WHERE kind = 'understanding' AND big_idea IS NOT NULL",
    "nested_json_build": "SELECT * FROM (VALUES " + _values(
        [
            (
                "School day", "Hours", 3,
                '[{"text":"Doors open at eight","status":"adopted"},{"text":"Late entry by the side door","status":"pending"}]',
            ),
            ("School day", "Meals", 6, '[{"text":"Lunch at noon","status":"adopted"}]'),
            ("Library", "", 8, '[{"text":"Quiet in the hall","status":"pending"}]'),
        ]
    ) + ") v(section, subsection, place, policies)",
    "layout_tables": "SELECT * FROM (VALUES " + _values([(0, 0, 2, '[["Name","Score"],["Ada",null]]'), (0, 1, None, "[]")]) + ") v(id, table_index, page_number, rows)",
    "speech_content": f"""SELECT id, CASE WHEN ok THEN coalesce(j ->> '$.results.channels[0].alternatives[0].transcript', '') END AS content, CASE WHEN (j -> '$.results.channels[0].alternatives[0]') IS NOT NULL THEN j ->> '$.results.language' END AS language,
        (j -> '$.results.channels[0].alternatives[0].words')::VARCHAR AS words, CASE WHEN NOT ok THEN 'no answer in JSON' END AS error FROM (SELECT id, json_valid(t) AS ok, CASE WHEN json_valid(t) THEN t::JSON END AS j FROM (VALUES {_values(enumerate(SPEECH))}) v(id, t))""",
    "table_format": "SELECT * FROM (VALUES " + _values(
        [(0, "Name | Score\n------------\nAda | 9\nBo | 7"), (1, "only | one\n----------"), (2, None), (3, None)]
    ) + ") v(id, text)",
    "slide_format": "SELECT * FROM (VALUES " + _values(
        [(0, "# Opening\n\nWelcome\n\n# Slide 2\n\nNo title\n\n# Slide 3\n\nBlank title"), (1, "")]
    ) + ") v(id, text)",
}
QUERIES = {k: globals()[k] for k in ORACLES}
