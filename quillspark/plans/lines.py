"""Queries over lines and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunks as C
from ..operators import lines as L
from .common import base, once, once_sql

SRC = once_sql("source_document", "id", "content")


def _documents(spark, sf):
    return L.exploded(base(spark, sf, "documents", "doc_id", "text"), "doc_id", "text")


def _content(spark, sf):
    return L.exploded(once(spark, sf, "source_document", "id", "content"), "id", "content")


def line_continuation(spark: SparkSession, sf: str) -> DataFrame:
    return L.line_continuation(_content(spark, sf), "id").groupBy("id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("continues").cast("bigint")).alias("n_continued"),
    )


def merge_broken_lines(spark: SparkSession, sf: str) -> DataFrame:
    return L.merge_broken_lines(_content(spark, sf), "id").select("id", "paragraph", F.md5("text").alias("text_md5"))


def detect_headings(spark: SparkSession, sf: str) -> DataFrame:
    return L.detect_headings(_content(spark, sf), "id").where("heading is not null").select("id", "line_no", "heading")


def _as_markdown(spark, sf):
    found = L.detect_headings(_content(spark, sf), "id")
    return found.select("id", "line_no", F.coalesce("heading", "line").alias("line"))


def extract_sections(spark: SparkSession, sf: str) -> DataFrame:
    return L.extract_sections(_as_markdown(spark, sf), "id").select(
        "id", "section_no", "level", "heading", "n_lines", F.length("content").alias("n_chars"),
    )


def split_by_headings(spark: SparkSession, sf: str) -> DataFrame:
    return L.split_at(_as_markdown(spark, sf), "id", F.startswith("line", F.lit("## "))).select(
        "id", "part_no", "first_line", "n_lines", F.md5("content").alias("content_md5"),
    )


def toc_lines(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions.text import anchor

    h = F.trim(F.regexp_replace("line", r"^#{1,6}\s+", ""))
    found = _as_markdown(spark, sf).where(F.col("line").rlike(r"^#{1,6}\s+"))
    return found.select("id", "line_no", F.concat(F.lit("  - ["), h, F.lit("](#"), anchor(h), F.lit(")")).alias("entry"))


def split_marked_sections(spark: SparkSession, sf: str) -> DataFrame:
    return L.split_at(
        _content(spark, sf), "id", F.col("line").rlike(r"^=== Page \d+ ===$"),
    ).select("id", "part_no", "n_lines", F.length("content").alias("n_chars"))


def split_nested_sections(spark: SparkSession, sf: str) -> DataFrame:
    page = F.col("line").rlike(r"^=== Page \d+ ===$")
    return L.split_nested(_content(spark, sf), "id", page, F.trim("line") == "")


def fix_section_headers(spark: SparkSession, sf: str) -> DataFrame:
    return L.fix_section_headers(_content(spark, sf), "id").groupBy("id").agg(
        F.sum((F.col("fixed") != F.col("line")).cast("bigint")).alias("n_fixed"),
        F.max(F.when(F.col("fixed") != F.col("line"), F.col("fixed"))).alias("last_fixed"),
    )


def slide_split_islands(spark: SparkSession, sf: str) -> DataFrame:
    """Slides begin at lines that name one; here the lines of a title in capitals."""
    line = F.col("line")
    begins = (F.length(F.trim(line)) > 3) & (line == F.upper(line)) & (line != F.lower(line))
    return L.split_at(_content(spark, sf), "id", begins).select("id", "part_no", "n_lines")


def page_split(spark: SparkSession, sf: str) -> DataFrame:
    return L.pages(
        once(spark, sf, "source_document", "id", "content"), "id", "content", r"=== Page \d+ ===",
    ).select("id", "page_no", F.length("page").alias("n_chars"))


def question_lines(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions.text import questions

    return base(spark, sf, "documents", "doc_id", "text").where("text like '%?%'").select(
        "doc_id", F.posexplode(questions(F.col("text"))).alias("question_no", "question"),
    )


def fill_forward_state(spark: SparkSession, sf: str) -> DataFrame:
    """The latest sign-up before or at each event of a user."""
    events = base(spark, sf, "events", "event_id", "ts", "user_id", "event_type")
    return L.fill_forward(
        events, ["user_id"], ["ts", "event_id"], F.to_date("ts"), last_signup=F.when(F.col("event_type") == "signup", F.col("event_id")),
    ).select("event_id", "user_id", "last_signup")


def running_avg_eta(spark: SparkSession, sf: str) -> DataFrame:
    events = base(spark, sf, "events", "event_id", "ts", "user_id", "value")
    run = L.running_totals(
        events, ["user_id"], ["ts", "event_id"], F.to_date("ts"), cents=F.round(F.col("value") * 100).cast("bigint"), done=F.lit(1),
    )
    run = run.join(events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")), "user_id")
    mean = F.col("cents").cast("double") / F.col("done") / 100
    return run.select("event_id", mean.alias("mean_value"), (mean * (F.col("n") - F.col("done"))).alias("eta"))


def chunk_token_window(spark: SparkSession, sf: str) -> DataFrame:
    return C.token_windows(base(spark, sf, "documents", "doc_id", "text"), "text", 200, 50).select(
        "doc_id", "chunk_index", "n_tokens", F.md5("content").alias("content_md5"),
    )


def chunk_counts(spark: SparkSession, sf: str) -> DataFrame:
    chunks = C.token_windows(base(spark, sf, "documents", "doc_id", "lang", "text"), "text", 200, 50)
    return chunks.groupBy("doc_id", "lang").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("n_tokens").alias("n_tokens"))


def chunk_enriched(spark: SparkSession, sf: str) -> DataFrame:
    chunks = C.token_windows(base(spark, sf, "documents", "doc_id", "title", "source", "topics", "text"), "text", 4000, 200)
    return chunks.select("doc_id", "chunk_index", "title", "source", F.array_join("topics", ", ").alias("tags"), F.length("content").alias("n_chars"))


def chunk_overlap_check(spark: SparkSession, sf: str) -> DataFrame:
    chunks = C.token_windows(base(spark, sf, "documents", "doc_id", "text"), "text", 200, 50)
    return C.overlap_found(chunks, "doc_id").select("doc_id", "chunk_index", "overlaps")


def chunk_fixed_chars(spark: SparkSession, sf: str) -> DataFrame:
    return C.fixed_chars(base(spark, sf, "documents", "doc_id", "text"), "text").select("doc_id", "chunk_index", "content")


def chunk_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return C.sentences(base(spark, sf, "documents", "doc_id", "text"), "text", abbreviations=False).select("doc_id", "chunk_index", "content")


def chunk_sentences_abbreviations(spark: SparkSession, sf: str) -> DataFrame:
    return C.sentences(base(spark, sf, "documents", "doc_id", "text"), "text").select("doc_id", "chunk_index", "content")


def chunk_upload_rows(spark: SparkSession, sf: str) -> DataFrame:
    return C.upload_rows(
        C.fixed_chars(base(spark, sf, "documents", "doc_id", "text"), "text"), "doc_id",
    ).select("id", "chunk_index", "document_id", F.length("text").alias("n_chars"))


_LINES = rf"(SELECT id, (unnest(generate_series(0, len(l) - 1)))::INT AS line_no, unnest(l) AS line FROM (SELECT id, string_split_regex(content, '\r?\n') AS l FROM {SRC} WHERE content IS NOT NULL))"
_W = "(PARTITION BY id ORDER BY line_no)"
_GO = r"""CASE WHEN prev IS NULL OR prev = '' OR bare = '' OR right(prev, 1) IN ('.', '!', '?', ':', ';') OR (regexp_matches(bare, '^\p{Lu}') AND lower(regexp_split_to_array(prev, '\s+')[-1]) NOT IN ('and', 'or', 'of', 'in', 'to', 'for', 'with'))
    OR (bare = upper(bare) AND bare <> lower(bare)) OR contains(substring(bare, 1, 20), ':') OR regexp_matches(bare, '^(\d+|[•*-])[.)] ') OR regexp_matches(bare, '^[A-Z]+:[A-Za-z0-9]') THEN false WHEN ends_with(prev, '-') THEN true ELSE length(bare) < 50 END"""
_MD = rf"""(SELECT id, line_no, CASE WHEN prev_blank AND bare <> '' AND ((bare = upper(bare) AND bare <> lower(bare) AND right(bare, 1) NOT IN ('.', ',', ':', ';', '!', '?')) OR (regexp_matches(bare, '^\d+\.\s+[\p{{L}}\p{{N}}_]') AND length(bare) < 100)
    OR coalesce(next_blank AND length(bare) < 80 AND regexp_matches(ahead, '^(  |\t)'), false)) THEN '## ' || bare END AS heading, line FROM (
    SELECT *, coalesce(lag(bare = '') OVER {_W}, true) AS prev_blank, lead(bare = '') OVER {_W} AS next_blank, first_value(CASE WHEN bare <> '' THEN line END IGNORE NULLS) OVER (PARTITION BY id ORDER BY line_no ROWS BETWEEN 2 FOLLOWING AND 9 FOLLOWING) AS ahead
    FROM (SELECT *, trim(line) AS bare FROM {_LINES})))"""
_MDL = f"(SELECT id, line_no, coalesce(heading, line) AS line FROM {_MD})"
_CHUNKS = r"""(SELECT doc_id, lang, title, source, topics, (unnest(generate_series(0, greatest(0, ceil((len(t) - {0}) / {1})::INT))))::INT AS chunk_index, t FROM (SELECT *, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS t FROM documents WHERE text IS NOT NULL) WHERE len(t) > 0)"""
_C200, _P200 = _CHUNKS.format(200, 150), "t[chunk_index * 150 + 1 : chunk_index * 150 + 200]"

ORACLES = {
    "line_continuation": f"SELECT id, count(*) AS n_lines, sum(go::BIGINT)::BIGINT AS n_continued FROM (SELECT id, {_GO} AS go FROM (SELECT *, trim(line) AS bare, lag(trim(line)) OVER {_W} AS prev FROM {_LINES})) GROUP BY id",
    "merge_broken_lines": rf"""WITH a AS (SELECT *, trim(line) AS bare, lag(trim(line)) OVER {_W} AS prev FROM {_LINES}), b AS (SELECT *, NOT (bare = '' OR regexp_matches(bare, '^=== .* ===$')) AND NOT coalesce(prev = '' OR regexp_matches(prev, '^=== .* ===$'), true) AND {_GO} AS go FROM a),
        c AS (SELECT *, sum(CASE WHEN go THEN 0 ELSE 1 END) OVER {_W} AS paragraph, coalesce(lead(go) OVER {_W}, false) AS next_go FROM b)
        SELECT id, paragraph::BIGINT AS paragraph, md5(string_agg(CASE WHEN next_go AND ends_with(bare, '-') THEN substring(bare, 1, length(bare) - 1) || ' ' ELSE bare || CASE WHEN next_go THEN ' ' ELSE '' END END, '' ORDER BY line_no)) AS text_md5 FROM c GROUP BY id, paragraph""",
    "detect_headings": f"SELECT id, line_no, heading FROM {_MD} WHERE heading IS NOT NULL",
    "extract_sections": rf"""WITH a AS (SELECT *, regexp_matches(line, '^#{{1,6}}\s+') AS h FROM {_MDL}), b AS (SELECT *, sum(h::INT) OVER {_W} AS section_no FROM a)
        SELECT id, section_no::BIGINT AS section_no, max(CASE WHEN h THEN length(regexp_extract(line, '^(#{{1,6}})\s+', 1)) END)::INT AS level, max(CASE WHEN h THEN trim(regexp_replace(line, '^#{{1,6}}\s+', '')) END) AS heading, sum((NOT h)::INT)::BIGINT AS n_lines,
        coalesce(length(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT h)), 0)::INT AS n_chars FROM b GROUP BY id, section_no HAVING sum((NOT h)::INT) > 0""",
    "split_by_headings": f"WITH b AS (SELECT *, sum(starts_with(line, '## ')::INT) OVER {_W} AS part_no FROM {_MDL}) SELECT id, part_no::BIGINT AS part_no, min_by(line, line_no) AS first_line, count(*) AS n_lines, md5(string_agg(line, chr(10) ORDER BY line_no)) AS content_md5 FROM b GROUP BY id, part_no",
    "toc_lines": rf"""SELECT id, line_no, '  - [' || h || '](#' || regexp_replace(regexp_replace(replace(lower(h), ' ', '-'), '[.,]', '', 'g'), '[^\p{{L}}\p{{N}}_-]', '', 'g') || ')' AS entry FROM (SELECT id, line_no, trim(regexp_replace(line, '^#{{1,6}}\s+', '')) AS h FROM {_MDL} WHERE regexp_matches(line, '^#{{1,6}}\s+'))""",
    "split_marked_sections": rf"WITH b AS (SELECT *, sum(regexp_matches(line, '^=== Page \d+ ===$')::INT) OVER {_W} AS part_no FROM {_LINES}) SELECT id, part_no::BIGINT AS part_no, count(*) AS n_lines, length(string_agg(line, chr(10) ORDER BY line_no))::INT AS n_chars FROM b GROUP BY id, part_no",
    "split_nested_sections": rf"""WITH b AS (SELECT *, sum(regexp_matches(line, '^=== Page \d+ ===$')::INT) OVER {_W} AS outer_no FROM {_LINES}), c AS (SELECT *, sum((trim(line) = '')::INT) OVER (PARTITION BY id, outer_no ORDER BY line_no) AS inner_no FROM b)
        SELECT id, outer_no::BIGINT AS outer_no, inner_no::BIGINT AS inner_no, count(*) AS n_lines FROM c GROUP BY id, outer_no, inner_no""",
    "fix_section_headers": rf"""WITH a AS (SELECT *, lag(line) OVER {_W} AS p, lead(line) OVER {_W} AS n FROM {_LINES}), b AS (SELECT *, CASE WHEN regexp_matches(line, '^\d+\.\d+\s+\p{{Lu}}') AND coalesce(trim(p), '') = '' AND NOT coalesce(regexp_matches(n, '^\d+\.\d+\s+\p{{Lu}}'), false) THEN '## ' || line ELSE line END AS fixed FROM a)
        SELECT id, sum((fixed <> line)::BIGINT)::BIGINT AS n_fixed, max(CASE WHEN fixed <> line THEN fixed END) AS last_fixed FROM b GROUP BY id""",
    "slide_split_islands": f"WITH b AS (SELECT *, sum((length(trim(line)) > 3 AND line = upper(line) AND line <> lower(line))::INT) OVER {_W} AS part_no FROM {_LINES}) SELECT id, part_no::BIGINT AS part_no, count(*) AS n_lines FROM b GROUP BY id, part_no",
    "page_split": rf"SELECT id, page_no, length(trim(page))::INT AS n_chars FROM (SELECT id, (unnest(generate_series(0, len(p) - 1)))::INT AS page_no, unnest(p) AS page FROM (SELECT id, regexp_split_to_array(content, '=== Page \d+ ===') AS p FROM {SRC} WHERE content IS NOT NULL)) WHERE trim(page) <> ''",
    "question_lines": r"""WITH q AS (SELECT doc_id, list_filter(list_transform(list_transform(string_split(text, '? '), lambda x: trim(x)), lambda x: CASE WHEN ends_with(x, '?') THEN x ELSE x || '?' END), lambda x: length(x) > 5) AS q FROM documents WHERE text LIKE '%?%')
        SELECT doc_id, (unnest(generate_series(0, len(q) - 1)))::INT AS question_no, unnest(q) AS question FROM q""",
    "fill_forward_state": "SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_signup FROM events",
    "running_avg_eta": "WITH a AS (SELECT event_id, (sum(round(value * 100)::BIGINT) OVER w)::DOUBLE / row_number() OVER w / 100 AS m, count(*) OVER (PARTITION BY user_id) - row_number() OVER w AS l FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) SELECT event_id, m AS mean_value, m * l AS eta FROM a",
    "chunk_token_window": f"SELECT doc_id, chunk_index, len({_P200})::INT AS n_tokens, md5(array_to_string({_P200}, ' ')) AS content_md5 FROM {_C200}",
    "chunk_counts": f"SELECT doc_id, lang, count(*) AS n_chunks, sum(len({_P200}))::BIGINT AS n_tokens FROM {_C200} GROUP BY doc_id, lang",
    "chunk_enriched": f"SELECT doc_id, chunk_index, title, source, array_to_string(topics, ', ') AS tags, length(array_to_string(t[chunk_index * 3800 + 1 : chunk_index * 3800 + 4000], ' '))::INT AS n_chars FROM {_CHUNKS.format(4000, 3800)}",
    "chunk_overlap_check": f"SELECT doc_id, chunk_index, contains(right(lag(c) OVER (PARTITION BY doc_id ORDER BY chunk_index), 150), substring(c, 1, 50)) AS overlaps FROM (SELECT doc_id, chunk_index, array_to_string({_P200}, ' ') AS c FROM {_C200})",
    "chunk_fixed_chars": "SELECT doc_id, i::INT AS chunk_index, substring(text, (i * 500 + 1)::BIGINT, 500) AS content FROM (SELECT doc_id, text, unnest(generate_series(0, (length(text) - 1) // 500)) AS i FROM documents WHERE length(text) > 0)",
    "chunk_sentences": r"""SELECT doc_id, i::INT AS chunk_index, trim(c) AS content FROM (SELECT doc_id, unnest(generate_series(0, len(p) - 1)) AS i, unnest(p) AS c FROM (SELECT doc_id, string_split(regexp_replace(text, '([.?])\s', '\1' || chr(1), 'g'), chr(1)) AS p FROM documents WHERE text IS NOT NULL)) WHERE trim(c) <> ''""",
    "chunk_upload_rows": """WITH c AS (SELECT doc_id, i, substring(text, (i * 500 + 1)::BIGINT, 500) AS content FROM (SELECT doc_id, text, unnest(generate_series(0, (length(text) - 1) // 500)) AS i FROM documents WHERE length(text) > 0)),
        h AS (SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(doc_id || '/' || i)) AS h FROM c WHERE trim(content) <> '')
        SELECT substring(h, 1, 8) || '-' || substring(h, 9, 4) || '-5' || substring(h, 14, 3) || '-' || substring('89ab', (('0x' || substring(h, 17, 1))::INT % 4 + 1)::INT, 1) || substring(h, 18, 3) || '-' || substring(h, 21, 12) AS id, i::INT AS chunk_index, doc_id::VARCHAR AS document_id, length(content)::INT AS n_chars FROM h""",
}
QUERIES = {k: globals()[k] for k in [*ORACLES, "chunk_sentences_abbreviations"]}
