"""Extraction of records with codes from lines of standards documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import lines as L

# Forms of codes.
ARTS_CODE = r"^([A-Z]{2}):(Cr|Pr|Re|Cn)(\d+)\.(\d+)\.(PK|K|[1-8]|I{1,3})([a-z])?$"
MATH_K8_CODE = r"^(?i:CCSS\.MATH\.CONTENT\.)?([K\d])\.([A-Z]+)\.(?:[A-Z]\.)?(\d+)([a-z])?"
MATH_HS_CODE = r"^(?i:CCSS\.MATH\.CONTENT\.)?HS\.?([A-Z]+)(?:-([A-Z]+))?\.(?:[A-Z]\.)?(\d+)([a-z])?"
SCIENCE_RECORD = r"^([K\d]+|MS|HS)-(PS|LS|ESS|ETS)(\d+)-(\d+)\.\s*(.+)$"
SCIENCE_TOPIC = r"^([K\d]+|MS|HS)\.(.+)$"
SCIENCE_STOP = r"^$|^\[Clarification|^\[Assessment|^\*?The performance|Science and Engineering Practices|Disciplinary Core Ideas|Crosscutting Concepts"
SCIENCE_SKIP = r"©|Achieve, Inc\.|^\d+ of \d+$"
CLARIFICATION, BOUNDARY = "[Clarification Statement:", "[Assessment Boundary:"
MATH_CODED_LINE = r"^([K\d]+|HS)\.([A-Z]+)(?:-([A-Z]+))?\.(\d+[a-z]?)\.?\s*(.+)"
MATH_ANY_CODE = r"^([K\d]+|HS)\."
MATH_DOMAIN_NAME = r"([A-Z][a-z\s&—-]+)\s+([K\d]+|HS)\.([A-Z]+)"
MATH_NO_CLUSTER = r"^[K\d]+\.|(?i:page|===|mathematics|overview)"
INQUIRY_RECORD = r"^D([1-4])\.(?:([A-Z][A-Za-z]{2})\.)?(\d+)\.(K-2|3-5|6-8|9-12)\.?\s+(.*)$"
GRADE_NAMES = {
    "PK": "Pre-Kindergarten", "K": "Kindergarten", "1": "Grade 1", "2": "Grade 2", "3": "Grade 3", "4": "Grade 4", "5": "Grade 5", "6": "Grade 6",
    "7": "Grade 7", "8": "Grade 8", "I": "Proficient", "II": "Accomplished", "III": "Advanced", "MS": "Middle School", "HS": "High School",
}
BIG_IDEA_CAPITALS = r"^BIG IDEA (\d+)[:\s]+([A-Z\s]+)(?:\s*\(([A-Z]+)\))?"
BIG_IDEA_CODED = r"^Big Idea (\d+)\s*\(([A-Z]+)\)[:\s]+(.+)"
BIG_IDEA_ALONE, BIG_IDEA_TITLE = r"^BIG IDEA (\d+)$", r"^([^(]+)(?:\s*\(([A-Z]+)\))?"
IDEA_STOP = r"^(BIG IDEA|Enduring Understanding|Learning Objective)"
UNDERSTANDING = (r"^Enduring Understanding\s*([0-9A-Z.\-]+)[:\s]*(.+)?", r"^EU\s*([0-9A-Z.\-]+)[:\s]*(.+)?", r"^([A-Z]{3}-\d+\.\d+)[:\s]+(.+)")
OBJECTIVE = (r"^Learning Objective\s*([0-9A-Z.\-]+)[:\s]*(.+)?", r"^LO\s*([0-9A-Z.\-]+)[:\s]*(.+)?", r"^([A-Z]{3}-\d+\.\d+\.\d+)[:\s]*(.+)")
# End of the fixed values.


def group(c: Column, pattern: str, i: int) -> Column:
    """A group of a pattern, null if the text doesn't match or the group is empty."""
    return F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))


def grade_name(c: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in GRADE_NAMES.items() for x in kv)), c), c)


def parse_code(c: Column) -> Column:
    """(family, subject, grade, number, part) of a code; all null if it has no known form."""
    arts, k8, hs = c.rlike(ARTS_CODE), c.rlike(MATH_K8_CODE), c.rlike(MATH_HS_CODE)
    pick = lambda a, b, d: F.when(arts, a).when(k8, b).when(hs, d)
    return F.struct(
        pick(F.lit("arts"), F.lit("math"), F.lit("math_hs")).alias("family"),
        pick(
            F.concat(group(c, ARTS_CODE, 1), F.lit(":"), group(c, ARTS_CODE, 2)), group(c, MATH_K8_CODE, 2),
            F.concat_ws("-", group(c, MATH_HS_CODE, 1), group(c, MATH_HS_CODE, 2)),
        ).alias("subject"),
        pick(group(c, ARTS_CODE, 5), group(c, MATH_K8_CODE, 1), F.lit("HS")).alias("grade"),
        pick(F.concat_ws(".", group(c, ARTS_CODE, 3), group(c, ARTS_CODE, 4)), group(c, MATH_K8_CODE, 3), group(c, MATH_HS_CODE, 3)).alias("number"),
        pick(group(c, ARTS_CODE, 6), group(c, MATH_K8_CODE, 4), group(c, MATH_HS_CODE, 4)).alias("part"),
    )


def first_of(c: Column, patterns: tuple[str, ...], i: int) -> Column:
    """The group of the first pattern that matches."""
    return F.coalesce(*(group(c, p, i) for p in patterns))


def science_records(lines: DataFrame, key: str) -> DataFrame:
    """(key, record_no, code, grade, category, dci, number, topic, text, clarification, boundary).

    A record's text goes on to a line that stops it or begins another. Its topic is that of the latest topic line outside of records, or
    its category's. Clarification and boundary are the last that begin within ten lines from the stop, each as far as a blank
    line or another bracket. Of the lines of a record none begins a topic.
    """
    w = L.by(key)
    c = F.trim("line")
    begins, stops = c.rlike(SCIENCE_RECORD), c.rlike(SCIENCE_STOP)
    found = L.records(lines, key, begins, ~begins & stops, ~begins & c.rlike(SCIENCE_SKIP))
    state = lines.select(key, "line_no", c.alias("_c"), begins.alias("_b"), (~begins & stops).alias("_s"))
    # a note goes on until a blank line or a bracket
    state = state.withColumn("_part", F.sum(((F.col("_c") == "") | F.startswith("_c", F.lit("["))).cast("int")).over(w))
    own = Window.partitionBy(key, "_part").orderBy("line_no").rowsBetween(0, Window.unboundedFollowing)
    whole = F.concat_ws(" ", F.collect_list("_c").over(own))
    note = lambda mark: F.when(
        F.startswith("_c", F.lit(mark)), F.trim(F.replace(F.replace(whole, F.lit(mark), F.lit("")), F.lit("]"), F.lit(""))),
    )
    ahead = w.rowsBetween(0, 9)
    state = state.withColumn("_cl", note(CLARIFICATION)).withColumn("_bo", note(BOUNDARY)).withColumn("_in", F.when(F.col("_b"), 1).when(F.col("_s"), 0))
    state = state.withColumn("record_no", F.sum(F.col("_b").cast("int")).over(w)).withColumn(
        "_inside", F.coalesce(F.last("_in", ignorenulls=True).over(w), F.lit(0)) == 1,
    )
    state = state.withColumn("_cl", F.last("_cl", ignorenulls=True).over(ahead)).withColumn("_bo", F.last("_bo", ignorenulls=True).over(ahead))
    state = state.withColumn(
        "_topic", F.last(F.when(~F.col("_inside") & ~F.startswith("_c", F.lit("===")), F.trim(group(F.col("_c"), SCIENCE_TOPIC, 2))), ignorenulls=True).over(w),
    )
    # the line that ends a record: its first stop, or the next record's first line
    ends = F.min(F.struct("line_no", "_cl", "_bo"))
    after = state.where(F.col("_s") | F.col("_b")).withColumn(
        "record_no", F.when(F.col("_b"), F.col("record_no") - 1).otherwise(F.col("record_no")),
    ).where("record_no > 0").groupBy(key, "record_no").agg(ends.alias("e"))
    topics = state.where("_b").select(key, "record_no", "_topic")
    t = F.col("text")
    part = lambda i: group(t, SCIENCE_RECORD, i)
    return found.join(topics, [key, "record_no"]).join(after, [key, "record_no"], "left").select(
        key, "record_no", F.concat(part(1), F.lit("-"), part(2), part(3), F.lit("-"), part(4)).alias("code"), part(1).alias("grade"), part(2).alias("category"),
        F.concat(part(2), part(3)).alias("dci"), part(4).alias("number"), F.coalesce("_topic", F.concat(part(2), F.lit(" Standards"))).alias("topic"),
        part(5).alias("text"), F.coalesce("e._cl", F.lit("")).alias("clarification"), F.coalesce("e._bo", F.lit("")).alias("boundary"),
    )


def inquiry_records(lines: DataFrame, key: str) -> DataFrame:
    """(key, record_no, dimension, discipline, number, grade_band, text)."""
    line = F.trim("line")
    begins = line.rlike(INQUIRY_RECORD)
    found = L.records(lines, key, begins, ~begins & (line == ""), line.rlike(r"^=== .* ===$") | F.contains(line, F.lit("Framework")))
    t = F.col("text")
    return found.select(
        key, "record_no",
        *(group(t, INQUIRY_RECORD, i).alias(n) for i, n in enumerate(("dimension", "discipline", "number", "grade_band", "text"), 1)),
    )


def course_records(lines: DataFrame, key: str) -> DataFrame:
    """(key, line_no, kind, code, text, description, big_idea, understanding): big ideas, understandings and objectives of a course.

    A big idea in capitals is described by the lines below it, at most four, up to a blank line or another item in full words; these
    lines are nothing else. A number or code without a title or text has it on the next line, which is nothing else then. Ideas
    and understandings hold until the next; an item has those that hold at it. A code of three numbers is an objective only.
    """
    w = L.by(key)
    c, after = F.col("_c"), F.col("_next")
    t = lines.select(key, "line_no", F.trim("line").alias("_c")).withColumn("_next", F.coalesce(F.lead("_c").over(w), F.lit("")))
    capitals = c.rlike(BIG_IDEA_CAPITALS)
    mark = F.when((c == "") | c.rlike(IDEA_STOP), F.struct("line_no", capitals.alias("idea")))
    t = t.withColumn("_from", F.last(mark, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    t = t.withColumn(
        "_told", mark.isNull() & F.coalesce(F.col("_from.idea"), F.lit(False)) & (F.col("line_no") - F.col("_from.line_no") <= 4),
    )
    told = F.collect_list(F.when(F.col("_told"), F.struct(F.col("_from.line_no").alias("at"), "_c"))).over(w.rowsBetween(1, 4))
    t = t.withColumn("_about", F.array_join(F.transform(F.filter(told, lambda x: x["at"] == F.col("line_no")), lambda x: x["_c"]), " "))
    eu, lo = first_of(c, UNDERSTANDING, 1), first_of(c, OBJECTIVE, 1)
    eu_text, lo_text = first_of(c, UNDERSTANDING, 2), first_of(c, OBJECTIVE, 2)
    alone = c.rlike(BIG_IDEA_ALONE) & after.rlike(BIG_IDEA_TITLE)
    # of lines in a row that need the next one, the first takes the second, the third the fourth
    t = t.withColumn("_needs", ~F.col("_told") & (alone | eu.isNotNull() & eu_text.isNull() | lo.isNotNull() & lo_text.isNull()))
    t = t.withColumn("_run", F.sum((~F.col("_needs")).cast("int")).over(w))
    t = t.withColumn("_takes", F.col("_needs") & (F.sum(F.col("_needs").cast("int")).over(Window.partitionBy(key, "_run").orderBy("line_no")) % 2 == 1))
    t = t.withColumn("_taken", F.coalesce(F.lag("_takes").over(w), F.lit(False)))
    g = lambda p, i: group(c, p, i)
    idea = F.when(
        capitals, F.struct(F.lit("big_idea").alias("kind"), F.coalesce(g(BIG_IDEA_CAPITALS, 3), F.concat(F.lit("BI"), g(BIG_IDEA_CAPITALS, 1))).alias("code"), F.trim(F.coalesce(g(BIG_IDEA_CAPITALS, 2), F.lit(""))).alias("text")),
    ).when(
        c.rlike(BIG_IDEA_CODED), F.struct(F.lit("big_idea").alias("kind"), g(BIG_IDEA_CODED, 2).alias("code"), F.trim(g(BIG_IDEA_CODED, 3)).alias("text")),
    ).when(
        alone, F.struct(F.lit("big_idea").alias("kind"), F.coalesce(group(after, BIG_IDEA_TITLE, 2), F.concat(F.lit("BI"), g(BIG_IDEA_ALONE, 1))).alias("code"), F.trim(group(after, BIG_IDEA_TITLE, 1)).alias("text")),
    )
    item = lambda kind, code, text: F.when(code.isNotNull(), F.struct(F.lit(kind).alias("kind"), code.alias("code"), F.coalesce(text, after).alias("text")))
    found = t.withColumn("_f", F.when(~F.col("_told") & ~F.col("_taken"), F.coalesce(idea, item("objective", lo, lo_text), item("understanding", eu, eu_text))))
    found = found.withColumn("_f", F.when(F.col("_f.text") != "", F.col("_f")).when(F.col("_f.kind") == "big_idea", F.col("_f")))
    held = L.fill_forward(
        found, [key], ["line_no"], big_idea=F.when(F.col("_f.kind") == "big_idea", F.col("_f.code")),
        understanding=F.when(F.col("_f.kind") == "understanding", F.col("_f.code")),
    )
    return held.where("_f is not null").select(
        key, "line_no", "_f.kind", "_f.code", "_f.text", F.when(capitals, F.col("_about")).otherwise("").alias("description"), "big_idea", "understanding",
    )


def course_edges(records: DataFrame, key: str) -> DataFrame:
    """(key, big_idea, understanding): which understandings stand under which big idea, each once."""
    return records.where("kind = 'understanding' and big_idea is not null").select(key, "big_idea", F.col("code").alias("understanding")).distinct()


def policy_tree(lines: DataFrame, key: str) -> DataFrame:
    """(key, section, subsection, policies): items ``- [x] text`` (adopted) and ``- [ ] text`` (pending) below headings of levels 1 and 2."""
    section = F.when(F.col("line").rlike(r"^# "), F.trim(F.expr("substring(line, 3)")))
    sub = F.when(F.col("line").rlike(r"^## "), F.trim(F.expr("substring(line, 4)"))).when(F.col("line").rlike(r"^# "), F.lit(""))
    held = L.fill_forward(lines, [key], ["line_no"], section=section, subsection=sub)
    item = held.where(F.col("line").rlike(r"^- \[[ x]\] ") & F.col("section").isNotNull())
    one = F.struct(
        "line_no", F.trim(F.expr("substring(line, 7)")).alias("text"),
        F.when(F.substring("line", 4, 1) == "x", "adopted").otherwise("pending").alias("status"),
    )
    return item.groupBy(key, "section", "subsection").agg(
        F.min("line_no").alias("place"),
        F.transform(F.array_sort(F.collect_list(one)), lambda x: F.struct(x["text"].alias("text"), x["status"].alias("status"))).alias("policies"),
    )


# Forms of lines in lists of arts and mathematics standards.
ANCHOR_LINE = r"^Anchor Standard (\d+):\s*(.+)$"
UNDERSTANDING_LINE = r"^Enduring Understanding:?\s*(.*)$"
QUESTION_LINE = r"^Essential Questions?(?:\(s\))?:?\s*(.*)$"
ARTS_LINE = r"^((?:VA|MU|TH|DA|MA):[A-Za-z0-9.]+)\s+(.+)$"
MATH_DOMAIN_LINE = r"^(K|\d+|HS)\.([A-Z]+)$"
MATH_STANDARD_LINE = r"^(\d+)\.\s*(.*)$"
MATH_PART_LINE = r"^([a-z])\.\s*(.*)$"
# End of the fixed values.


def anchored_standards(lines: DataFrame, key: str) -> DataFrame:
    """(key, line_no, code, text, anchor, understanding, question): standards with the anchor, understanding and question that hold at them.

    The text of an understanding or question may stand on the next line; of several questions on a line the last holds. An
    understanding and a question go on to hold after a new anchor.
    """
    from ..functions.text import questions

    c = F.trim("line")
    after = F.trim(F.coalesce(F.lead("line").over(Window.partitionBy(key).orderBy("line_no")), F.lit("")))
    told = lines.withColumn(
        "_eu", F.when(c.rlike(UNDERSTANDING_LINE), F.coalesce(group(c, UNDERSTANDING_LINE, 1), F.nullif(after, F.lit("")))),
    ).withColumn("_eq", F.when(c.rlike(QUESTION_LINE), F.coalesce(group(c, QUESTION_LINE, 1), F.nullif(after, F.lit("")))))
    last = F.element_at(questions(F.col("_eq")), -1)
    held = L.fill_forward(
        told, [key], ["line_no"], anchor=group(c, ANCHOR_LINE, 1), understanding=F.col("_eu"),
        question=F.when(F.size(questions(F.col("_eq"))) > 0, last),
    )
    return held.where(c.rlike(ARTS_LINE)).select(
        key, "line_no", group(c, ARTS_LINE, 1).alias("code"), group(c, ARTS_LINE, 2).alias("text"), "anchor", "understanding", "question",
    )


def edges(standards: DataFrame, key: str) -> DataFrame:
    """(anchor, other_id, type): which understandings and questions belong to which anchor, each once; ids are made of the texts."""
    from ..functions.text import short_id

    one = lambda col, kind: standards.where(F.col("anchor").isNotNull() & F.col(col).isNotNull()).select(
        "anchor", short_id(f"{kind}_", F.col(col)).alias("other_id"), F.lit(kind).alias("type"),
    )
    return one("understanding", "eu").unionByName(one("question", "eq")).distinct()


def math_records(lines: DataFrame, key: str) -> DataFrame:
    """(key, record_no, code, grade, domain, cluster, text): numbered standards and their lettered parts, which have the number of the
    standard before them. A cluster is the latest line of more than 20 characters that begins no record and goes on with none."""
    c = F.trim("line")
    w = Window.partitionBy(key).orderBy("line_no")
    domain = c.rlike(MATH_DOMAIN_LINE)
    number, part = c.rlike(MATH_STANDARD_LINE) & ~domain, c.rlike(MATH_PART_LINE)
    state = L.fill_forward(lines, [key], ["line_no"], grade=group(c, MATH_DOMAIN_LINE, 1), domain=group(c, MATH_DOMAIN_LINE, 2))
    # a record goes on until a blank line, another record or a domain; a long line outside a record names a cluster
    state = state.withColumn(
        "_mark", F.when(domain | (c == "") | c.rlike(r"^=== .* ===$"), 0).when(number | part, 1),
    ).withColumn("_in", F.last("_mark", ignorenulls=True).over(w))
    state = state.withColumn("_new", F.when(F.coalesce("_in", F.lit(0)) == 0, F.when(F.length(c) > 20, c)))
    state = L.fill_forward(
        state, [key], ["line_no"], cluster=F.when(domain, "").otherwise(F.col("_new")),
        _number=F.when(domain, "").otherwise(group(c, MATH_STANDARD_LINE, 1)),
    )
    state = state.withColumn("record_no", F.sum((number | part).cast("int")).over(w)).where("_in = 1 and domain is not null")
    text = F.when(number, group(c, MATH_STANDARD_LINE, 2)).when(part, group(c, MATH_PART_LINE, 2)).otherwise(c)
    parts = F.array_sort(F.collect_list(F.struct("line_no", F.coalesce(text, F.lit("")).alias("t"))))
    code = F.concat(F.col("grade"), F.lit("."), F.col("domain"), F.lit("."), F.col("_number"), F.coalesce(group(c, MATH_PART_LINE, 1), F.lit("")))
    first = F.min(F.struct("line_no", code.alias("code"), "grade", "domain", "cluster"))
    g = state.groupBy(key, "record_no").agg(
        first.alias("f"), F.array_join(F.filter(F.transform(parts, lambda x: x["t"]), lambda t: t != ""), " ").alias("text"),
    )
    return g.select(key, "record_no", "f.code", "f.grade", "f.domain", F.nullif("f.cluster", F.lit("")).alias("cluster"), "text")


def math_coded_records(lines: DataFrame, key: str) -> DataFrame:
    """(key, record_no, code, grade, domain, subdomain, number, text, cluster): standards that begin with their whole code.

    A standard's text goes on to the next line that begins with a grade and a point, without blank lines and page marks. A cluster
    is the latest line of more than 20 characters outside of standards, once a domain has been named outside of them.
    """
    w = L.by(key)
    c = F.col("_c")
    t = lines.select(key, "line_no", F.trim("line").alias("_c"))
    begins = c.rlike(MATH_CODED_LINE)
    t = t.withColumn("_in", F.coalesce(F.last(F.when(c.rlike(MATH_ANY_CODE), begins), ignorenulls=True).over(w), F.lit(False)))
    outside = ~F.col("_in") & (c != "")
    t = t.withColumn("_named", F.max(outside & c.rlike(MATH_DOMAIN_NAME)).over(w))
    t = L.fill_forward(t, [key], ["line_no"], cluster=F.when(outside & F.col("_named") & (F.length(c) > 20) & ~c.rlike(MATH_NO_CLUSTER), c))
    t = t.withColumn("record_no", F.sum(begins.cast("int")).over(w)).where(F.col("_in") & (c != "") & (begins | ~F.startswith(c, F.lit("==="))))
    g = lambda i: group(c, MATH_CODED_LINE, i)
    code = F.concat(g(1), F.lit("."), F.concat_ws("-", g(2), g(3)), F.lit("."), g(4))
    parts = F.array_sort(F.collect_list(F.struct("line_no", F.when(begins, g(5)).otherwise(c).alias("t"))))
    first = F.min(F.struct("line_no", code.alias("code"), g(1).alias("grade"), g(2).alias("domain"), F.coalesce(g(3), F.lit("")).alias("subdomain"), g(4).alias("number"), "cluster"))
    return t.groupBy(key, "record_no").agg(first.alias("f"), F.trim(F.array_join(F.transform(parts, lambda x: x["t"]), " ")).alias("text")).select(
        key, "record_no", "f.code", "f.grade", "f.domain", "f.subdomain", "f.number", "text", "f.cluster",
    )
