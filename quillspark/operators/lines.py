"""Operators over the lines of texts.

A text becomes rows (key, line_no from 0, line) by :func:`exploded`; states that run over lines are windows
by key. The lines of one text are its bounded group: a text is one value of a row already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STOP_WORDS = ("and", "or", "of", "in", "to", "for", "with")


def exploded(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, line); null texts give no rows, an empty text one empty line. Only the two columns are kept."""
    src = df.select(key, F.col(text).alias("_text")).where("_text is not null")
    return src.select(key, F.posexplode(F.split("_text", "\r?\n")).alias("line_no", "line"))


def by(key: str) -> Window:
    return Window.partitionBy(key).orderBy("line_no")


def _capitals(c: Column) -> Column:
    return (c == F.upper(c)) & (c != F.lower(c))


def continues(prev: Column, cur: Column) -> Column:
    """Whether a line goes on with the sentence of the line before it; both are trimmed."""
    last_word = F.lower(F.element_at(F.split(prev, r"\s+"), -1))
    no = (
        (prev == "") | (cur == "") | F.substring(prev, -1, 1).isin(".", "!", "?", ":", ";")
        | (
            cur.rlike(r"^\p{Lu}") & ~last_word.isin(*STOP_WORDS)
        ) | _capitals(cur) | F.contains(F.substring(cur, 1, 20), F.lit(":")) | cur.rlike(r"^(\d+|[•*-])[.)] ") | cur.rlike(r"^[A-Z]+:[A-Za-z0-9]")
    )
    return F.when(prev.isNull() | no, False).when(F.endswith(prev, F.lit("-")), True).otherwise(F.length(cur) < 50)


def line_continuation(lines: DataFrame, key: str) -> DataFrame:
    """Adds ``continues`` to trimmed lines."""
    trimmed = lines.withColumn("line", F.trim("line"))
    return trimmed.withColumn("continues", continues(F.lag("line").over(by(key)), F.col("line")))


def merge_broken_lines(lines: DataFrame, key: str, glue_hyphen: bool = False) -> DataFrame:
    """Lines put together where one goes on with the other; blank lines and page markers stay by themselves.

    A hyphen at the end of a line that is gone on with is dropped; the parts are put together with a blank
    unless ``glue_hyphen``.
    """
    w = by(key)
    line, prev = F.col("line"), F.col("prev")
    own = (line == "") | line.rlike(r"^=== .* ===$")
    prev_own = (prev == "") | prev.rlike(r"^=== .* ===$")
    flagged = lines.withColumn("line", F.trim("line")).withColumn("prev", F.lag("line").over(w))
    flagged = flagged.withColumn("go", ~own & ~F.coalesce(prev_own, F.lit(True)) & continues(prev, line))
    flagged = flagged.withColumn(
        "paragraph", F.sum(F.when(F.col("go"), 0).otherwise(1)).over(w),
    ).withColumn("next_go", F.coalesce(F.lead("go").over(w), F.lit(False)))
    hyphen = F.col("next_go") & F.endswith(line, F.lit("-"))
    piece = F.when(
        hyphen, F.concat(F.expr("substring(line, 1, length(line) - 1)"), F.lit("" if glue_hyphen else " ")),
    ).otherwise(F.concat(line, F.when(F.col("next_go"), " ").otherwise("")))
    parts = F.array_sort(F.collect_list(F.struct("line_no", piece.alias("piece"))))
    return flagged.groupBy(key, "paragraph").agg(
        F.array_join(F.transform(parts, lambda x: x["piece"]), "").alias("text")
    ).withColumn("paragraph", F.col("paragraph").cast("bigint"))


def detect_headings(lines: DataFrame, key: str) -> DataFrame:
    """Adds ``heading``: the line as a heading of level 2, or null.

    Only lines after a blank line (or the first) can be one: in capitals and not ended by a mark; numbered
    and short; or short and followed by a blank line after which the text is indented.
    """
    w = by(key)
    bare = F.trim("line")
    out = lines.withColumn("bare", bare).withColumn(
        "prev_blank", F.coalesce(F.lag(F.col("bare") == "").over(w), F.lit(True)),
    ).withColumn("next_blank", F.lead(F.col("bare") == "").over(w))
    ahead = w.rowsBetween(2, 9)
    next_line = F.first(F.when(F.col("bare") != "", F.col("line")), ignorenulls=True).over(ahead)
    out = out.withColumn("ahead", next_line)
    capitals = _capitals(F.col("bare")) & ~F.substring("bare", -1, 1).isin(".", ",", ":", ";", "!", "?")
    numbered = F.col("bare").rlike(r"^\d+\.\s+[\p{L}\p{N}_]") & (F.length("bare") < 100)
    indented = F.col("next_blank") & (F.length("bare") < 80) & F.coalesce(F.col("ahead").rlike(r"^(  |\t)"), F.lit(False))
    found = F.col("prev_blank") & (F.col("bare") != "") & (capitals | numbered | F.coalesce(indented, F.lit(False)))
    return out.withColumn("heading", F.when(found, F.concat(F.lit("## "), F.col("bare")))).drop("bare", "prev_blank", "next_blank", "ahead")


def extract_sections(lines: DataFrame, key: str) -> DataFrame:
    """(key, section_no, level, heading, n_lines, content): a section for each heading with a line below it; text
    before the first heading has a null heading."""
    marked = lines.withColumn(
        "level", F.length(F.regexp_extract("line", r"^(#{1,6})\s+", 1)),
    ).withColumn("is_heading", F.col("line").rlike(r"^#{1,6}\s+"))
    numbered = marked.withColumn("section_no", F.sum(F.col("is_heading").cast("int")).over(by(key)))
    heading = F.max(F.when(F.col("is_heading"), F.trim(F.regexp_replace("line", r"^#{1,6}\s+", ""))))
    body = F.array_sort(F.collect_list(F.when(~F.col("is_heading"), F.struct("line_no", "line"))))
    out = numbered.groupBy(key, "section_no").agg(
        F.max(F.when(F.col("is_heading"), F.col("level"))).alias("level"), heading.alias("heading"),
        F.sum((~F.col("is_heading")).cast("int")).alias("n_lines"), F.array_join(F.transform(body, lambda x: x["line"]), "\n").alias("content"),
    )
    return out.where("n_lines > 0")


def split_at(lines: DataFrame, key: str, begins: Column) -> DataFrame:
    """(key, part_no, first_line, n_lines, content): parts that begin at lines for which ``begins`` holds; part 0 is what
    comes before the first."""
    numbered = lines.withColumn("_begins", begins).withColumn("part_no", F.sum(F.coalesce(F.col("_begins"), F.lit(False)).cast("int")).over(by(key)))
    body = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return numbered.groupBy(key, "part_no").agg(
        F.min_by("line", "line_no").alias("first_line"), F.count(F.lit(1)).alias("n_lines"),
        F.array_join(F.transform(body, lambda x: x["line"]), "\n").alias("content"),
    )


def split_nested(lines: DataFrame, key: str, outer: Column, inner: Column) -> DataFrame:
    """(key, outer_no, inner_no, n_lines): parts within parts; the inner number begins again in each outer part."""
    w = by(key)
    numbered = lines.withColumn("_o", outer.cast("int")).withColumn("_i", inner.cast("int")).withColumn("outer_no", F.sum("_o").over(w))
    numbered = numbered.withColumn("inner_no", F.sum("_i").over(Window.partitionBy(key, "outer_no").orderBy("line_no")))
    return numbered.groupBy(key, "outer_no", "inner_no").agg(F.count(F.lit(1)).alias("n_lines"))


def fix_section_headers(lines: DataFrame, key: str) -> DataFrame:
    """Adds ``fixed``: ``N.N Title`` becomes a heading if the line before is blank and the next is not a numbered line."""
    w = by(key)
    numbered = r"^\d+\.\d+\s+\p{Lu}"
    lone = F.col("line").rlike(numbered) & (
        F.coalesce(F.trim(F.lag("line").over(w)), F.lit("")) == ""
    ) & ~F.coalesce(F.lead("line").over(w).rlike(numbered), F.lit(False))
    return lines.withColumn("fixed", F.when(lone, F.concat(F.lit("## "), F.col("line"))).otherwise(F.col("line")))


def fill_forward(df: DataFrame, partition: list[str], order: list[str], bucket: Column | None = None, **states: Column) -> DataFrame:
    """Adds each state: its latest value that is not null, up to and with the row.

    ``bucket``: rises with the order (a day, a range of ids). With it no task gets a whole partition, as a hot key's would be: values
    run on within each bucket, and what holds at a bucket's begin comes from one row per bucket.
    """
    if bucket is None:
        w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({name: F.last(value, ignorenulls=True).over(w) for name, value in states.items()})
    given = df.withColumn("_bucket", bucket).withColumns({f"_v_{n}": v for n, v in states.items()})
    ends = given.groupBy(*partition, "_bucket").agg(
        *(F.max(F.when(F.col(f"_v_{n}").isNotNull(), F.struct(*order, f"_v_{n}"))).getField(f"_v_{n}").alias(f"_e_{n}") for n in states)
    )
    before = Window.partitionBy(*partition).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = ends.select(*partition, "_bucket", *(F.last(f"_e_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n in states))
    within = Window.partitionBy(*partition, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = _carried(given.withColumns({f"_v_{n}": F.last(f"_v_{n}", ignorenulls=True).over(within) for n in states}), held, partition)
    return out.select(*df.columns, *(F.coalesce(f"_v_{n}", f"_c_{n}").alias(n) for n in states))


def _carried(rows: DataFrame, held: DataFrame, partition: list[str]) -> DataFrame:
    keys = [*partition, "_bucket"]
    h = held.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & rows[k].eqNullSafe(h[f"_k_{k}"])
    return rows.join(h, on, "left").drop(*(f"_k_{k}" for k in keys))


def running_totals(df: DataFrame, partition: list[str], order: list[str], bucket: Column, **values: Column) -> DataFrame:
    """Adds the running total of each value, up to and with the row, in buckets as in :func:`fill_forward`. Null values count 0."""
    given = df.withColumn("_bucket", bucket).withColumns({f"_v_{n}": F.coalesce(v, F.lit(0)) for n, v in values.items()})
    before = Window.partitionBy(*partition).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = given.groupBy(*partition, "_bucket").agg(*(F.sum(f"_v_{n}").alias(f"_e_{n}") for n in values)).select(
        *partition, "_bucket", *(F.sum(f"_e_{n}").over(before).alias(f"_c_{n}") for n in values),
    )
    within = Window.partitionBy(*partition, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = _carried(given.withColumns({f"_v_{n}": F.sum(f"_v_{n}").over(within) for n in values}), held, partition)
    return out.select(*df.columns, *((F.col(f"_v_{n}") + F.coalesce(f"_c_{n}", F.lit(0))).alias(n) for n in values))


def records(lines: DataFrame, key: str, begins: Column, stops: Column, skips: Column) -> DataFrame:
    """(key, record_no, first_line, text): a record runs from a line for which ``begins`` holds to the next such line or
    the first for which ``stops`` holds; lines for which ``skips`` holds are left out."""
    w = by(key)
    numbered = lines.withColumn("_b", F.coalesce(begins, F.lit(False))).withColumn("_s", F.coalesce(stops, F.lit(False))).withColumn("_k", F.coalesce(skips, F.lit(False)))
    numbered = numbered.withColumn("record_no", F.sum(F.col("_b").cast("int")).over(w)).where("record_no > 0")
    within = Window.partitionBy(key, "record_no").orderBy("line_no")
    kept = numbered.withColumn("_stopped", F.max(F.col("_s").cast("int")).over(within)).where("_stopped = 0 and not _k")
    parts = F.array_sort(F.collect_list(F.struct("line_no", F.trim("line").alias("line"))))
    return kept.groupBy(key, "record_no").agg(
        F.min("line_no").alias("first_line"), F.array_join(F.transform(parts, lambda x: x["line"]), " ").alias("text"),
    )


def pages(df: DataFrame, key: str, text: str, mark: str = r"(?m)^=== Page \d+ ===$\n?") -> DataFrame:
    """(key, page_no, page): texts cut at page marks; blank pages are left out but counted."""
    src = df.select(key, F.col(text).alias("_text")).where("_text is not null")
    cut = src.select(key, F.posexplode(F.split("_text", mark)).alias("page_no", "page"))
    return cut.withColumn("page", F.trim("page")).where("page <> ''")
