"""Queries of text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from .common import base, once, once_sql

SRC = once_sql("source_document", "id", "source_path", "content", "metadata.title", "metadata.num_pages", "metadata.file_size")
KM = once_sql("knowledge_main", "chunk_id", "text", "filename")
ITEM = once_sql("knowledge_item", "item_id", "title", "body", "url", "summary")


def title_first_line(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "documents").select("doc_id", T.title_of_text(F.col("text")).alias("title"))


def title_cascade(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf, "source_document", "id", "source_path", "content", "metadata.title").select(
        "id", T.title_cascade(F.col("title"), F.col("source_path"), F.col("content")).alias("title"),
    )


def collapse_blank_lines(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "documents").where("text is not null").select(
        "doc_id", T.collapsed_blank_lines(F.col("text")).alias("collapsed"), T.squeezed(F.col("text")).alias("squeezed"),
    )


def clean_ocr_entities(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf, "source_document", "id", "content").where("content is not null").select(
        "id", T.clean_scan_marks(F.col("content")).alias("cleaned"),
    )


def strip_md_links(spark: SparkSession, sf: str) -> DataFrame:
    linked = F.concat(
        F.lit("See [the\nguide]("), F.coalesce("url", F.lit("https://none.example/")), F.lit(") and ![image](i.png) for "), F.col("title"),
    )
    return once(spark, sf, "knowledge_item", "item_id", "url", "title").where("title is not null").select(
        "item_id", T.without_markdown_links(linked).alias("plain"),
    )


def html_to_text(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "documents").where("text is not null").select("doc_id", T.without_tags(F.col("text")).alias("plain"))


def slugify(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("title")
    return base(spark, sf, "documents").select(
        "doc_id",
        F.concat(
            T.zero_padded(F.col("doc_id") % 120), F.lit("_"), T.slug_or(t, F.concat(F.lit("section_"), F.col("doc_id").cast("string"))), F.lit(".md"),
        ).alias("file_name"),
        T.anchor(t).alias("anchor"),
    )


def sanitize_names(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "documents").where("source_path is not null").select(
        "doc_id", T.sheet_name(F.concat("source_path", F.lit("?[x]:"))).alias("sheet_name"),
    )


def parse_filename(spark: SparkSession, sf: str) -> DataFrame:
    s = T.stem(F.col("filename"))
    number = F.regexp_extract(s, r"_(\d+)$", 1)
    return once(spark, sf, "knowledge_main", "chunk_id", "filename").where("filename is not null").select(
        "chunk_id", T.extension(F.col("filename")).alias("file_type"), F.try_to_number(
            F.nullif(number, F.lit("")), F.lit("999999999"),
        ).cast("bigint").alias("number"),
        F.initcap(F.translate(F.regexp_replace(s, r"_\d+$", ""), "_-", "  ")).alias("title"),
        F.when(s.rlike(r"(?i)handbook"), "handbook").when(s.rlike(r"(?i)guide"), "guide").when(s.rlike(r"(?i)report"), "report").when(s.rlike(r"(?i)plan"), "plan").otherwise("other").alias("kind"),
    )


def truncate_text(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "documents").where("text is not null").select(
        "doc_id", T.truncated(F.col("text"), 100).alias("title"), T.truncated(F.col("text"), 300).alias("preview"),
    )


def md5_ids(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "documents").where("text is not null").select("doc_id", T.short_id("doc_", F.col("text")).alias("short_id"))


def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    t = F.encode("text", "UTF-8")
    return base(spark, sf, "documents").where("text is not null").select(
        "doc_id", F.sha2(t, 256).alias("sha256"), F.md5(t).alias("md5"), F.sha1(t).alias("sha1"),
        F.octet_length("text").cast("bigint").alias("n_bytes"),
    )


def uuid5_keys(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "documents").select("doc_id", T.uuid5(F.concat(F.lit("documents/"), F.col("doc_id").cast("string"))).alias("uuid"))


def url_classify(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf, "knowledge_item", "item_id", "url").select(
        "item_id", T.is_url(F.col("url")).alias("is_url"), T.is_video_page(F.col("url")).alias("is_video"),
        F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1).alias("host"),
    )


def route_sources(spark: SparkSession, sf: str) -> DataFrame:
    routed = once(spark, sf, "source_document", "id", "source_path").withColumn("route", T.route(F.col("source_path")))
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def classify_by_name(spark: SparkSession, sf: str) -> DataFrame:
    parent = F.regexp_extract("source_path", r"([^/]*)/[^/]*$", 1)
    return once(spark, sf, "source_document", "id", "source_path").select("id", T.framework(F.col("source_path"), parent).alias("framework"))


def render_markdown(spark: SparkSession, sf: str) -> DataFrame:
    meta = F.array_compact(
        F.array(
            *(F.when(F.col(c).isNotNull(), F.concat(F.lit(f"- **{label}**: "), F.col(c).cast("string"))) for c, label in (("num_pages", "Pages"), ("file_size", "Size")))
        )
    )
    body = F.concat_ws(
        "\n", F.concat(F.lit("# "), F.coalesce("title", F.lit("Untitled Document"))), F.lit(""), F.when(F.size(meta) > 0, F.array_join(meta, "\n")),
        F.lit(""), F.coalesce("content", F.lit("")),
    )
    return once(
        spark, sf, "source_document", "id", "content", "metadata.title", "metadata.num_pages", "metadata.file_size",
    ).select("id", F.md5(F.encode(body, "UTF-8")).alias("markdown_md5"), F.length(body).cast("bigint").alias("n_chars"))


def render_html_body(spark: SparkSession, sf: str) -> DataFrame:
    extra = F.coalesce(F.concat(F.lit("<p><em>"), F.nullif(F.trim("summary"), F.lit("")), F.lit("</em></p>")), F.lit(""))
    return once(spark, sf, "knowledge_item", "item_id", "title", "body", "summary").select(
        "item_id",
        F.concat(F.lit("<h2>"), F.coalesce("title", F.lit("")), F.lit("</h2><p>"), F.coalesce("body", F.lit("")), F.lit("</p>"), extra).alias("html"),
    )


def render_prompt(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "documents").where("text is not null").select(
        "doc_id",
        F.concat(
            F.lit("Extract the structure of this document as JSON.\n\nTitle: "), F.coalesce("title", F.lit("unknown")), F.lit("\n\n"),
            F.substring("text", 1, 5000),
        ).alias("prompt"),
    )


def fix_counts(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("content")
    return once(spark, sf, "source_document", "id", "content").where("content is not null").select(
        "id", F.regexp_count(c, F.lit(r"\n{3,}")).cast("bigint").alias("blank_runs"),
        F.regexp_count(c, F.lit(r"&(amp|lt|gt);")).cast("bigint").alias("entities"),
        F.regexp_count(c, F.lit("[‘’“”]")).cast("bigint").alias("quotes"),
        F.regexp_count(c, F.lit(r"=== Page \d+ ===")).cast("bigint").alias("markers"),
    )


def rule_extract_json(spark: SparkSession, sf: str) -> DataFrame:
    made = base(spark, sf, "documents").where("text is not null").select(
        "doc_id",
        F.to_json(
            F.struct(
                F.col("doc_id").alias("document_id"), T.title_of_text(F.col("text")).alias("title"),
                F.struct(F.lit(1).alias("level"), T.truncated(F.col("text"), 200).alias("content_summary")).alias("section"),
            )
        ).alias("j"),
    )
    return made.select(
        "doc_id", F.get_json_object("j", "$.title").alias("title"), F.get_json_object("j", "$.section.content_summary").alias("summary"),
        F.get_json_object("j", "$.document_id").cast("bigint").alias("document_id"),
    )


def json_salvage(spark: SparkSession, sf: str) -> DataFrame:
    said = F.concat(F.lit("Here it is:\n```json\n"), F.col("props"), F.lit("\n```\nDone"))
    return base(spark, sf, "events").select("event_id", F.get_json_object(T.salvaged_json(said), "$.k").cast("bigint").alias("k"))


def json_extract_props(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "events").select("event_id", F.from_json("props", "k bigint").getField("k").alias("k"))


def json_build(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "events").select(
        "event_id", F.get_json_object(F.to_json(F.struct("user_id", "event_type")), "$.event_type").alias("event_type"),
        F.get_json_object(F.to_json(F.struct("user_id", "event_type")), "$.user_id").cast("bigint").alias("user_id"),
    )


_FIRST = "list_filter(list_transform(string_split(text, chr(10)){0}, lambda x: trim(replace(replace(x, chr(9), ' '), chr(13), ' '))), lambda x: x <> '')[1]"
_CLIP = "CASE WHEN length({0}) > 80 THEN substring({0}, 1, 77) || '...' ELSE {0} END"
_SQUEEZE = r"trim(regexp_replace(replace({0}, chr(173), ''), '[ \t\r\n\f]+', ' ', 'g'))"
_TITLE = f"coalesce({_CLIP.format(_FIRST.format('[1:10]'))}, 'Untitled Document')"
_STEM = r"nullif(regexp_replace(regexp_extract({0}, '([^/]*)$', 1), '^(.+)\.[^.]*$', '\1'), '')"
_INITCAP = "array_to_string(list_transform(string_split({0}, ' '), lambda w: upper(substring(w, 1, 1)) || lower(substring(w, 2))), ' ')"
_SLUG = r"lower(regexp_replace(trim(regexp_replace(title, '[^\p{L}\p{N}_\s-]', '', 'g')), '\s+', '_', 'g'))"

ORACLES = {
    "title_first_line": f"SELECT doc_id, {_TITLE} AS title FROM documents",
    "title_cascade": f"""SELECT id, coalesce(nullif(trim(title), ''), {_INITCAP.format("translate(" + _STEM.format("source_path") + ", '_-', '  ')")},
        list_filter(list_transform(string_split(content, chr(10))[1:20], lambda x: trim(x)), lambda x: length(x) > 3 AND x = upper(x) AND x <> lower(x))[1],
        {_CLIP.format(_FIRST.format('').replace('text', 'content'))}, 'Untitled Document') AS title FROM {SRC}""",
    "collapse_blank_lines": rf"SELECT doc_id, regexp_replace(text, '\n{{3,}}', chr(10) || chr(10), 'g') AS collapsed, {_SQUEEZE.format('text')} AS squeezed FROM documents WHERE text IS NOT NULL",
    "clean_ocr_entities": rf"""SELECT id, regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(translate(content, chr(8216) || chr(8217) || chr(8220) || chr(8221), chr(39) || chr(39) || chr(34) || chr(34)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'),
        '\| +\|', '| |', 'g'), '(?m)^(\d+\.\d+) +(\p{{Lu}}[^\n]*)$', '## \1 \2', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g') AS cleaned FROM {SRC} WHERE content IS NOT NULL""",
    "strip_md_links": rf"SELECT item_id, regexp_replace('See [the' || chr(10) || 'guide](' || coalesce(url, 'https://none.example/') || ') and ![image](i.png) for ' || title, '!?\[[^\]]*\]\([^)]*\)', '', 'g') AS plain FROM {ITEM} WHERE title IS NOT NULL",
    "html_to_text": rf"""SELECT doc_id, {
        _SQUEEZE.format(r"regexp_replace(regexp_replace(text, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^<>]*>', ' ', 'g')")
    } AS plain FROM documents WHERE text IS NOT NULL""",
    "slugify": rf"""SELECT doc_id, lpad((doc_id % 120)::VARCHAR, greatest(2, length((doc_id % 120)::VARCHAR))::INT, '0') || '_' || coalesce(nullif({_SLUG}, ''), 'section_' || doc_id) || '.md' AS file_name,
        regexp_replace(regexp_replace(replace(lower(title), ' ', '-'), '[.,]', '', 'g'), '[^\p{{L}}\p{{N}}_-]', '', 'g') AS anchor FROM documents""",
    "sanitize_names": r"SELECT doc_id, translate(substring(source_path || '?[x]:', 1, 31), ':\/?*[]', '_______') AS sheet_name FROM documents WHERE source_path IS NOT NULL",
    "parse_filename": rf"""SELECT chunk_id, lower(regexp_extract(filename, '\.([A-Za-z0-9]+)$', 1)) AS file_type, try_cast(nullif(regexp_extract({_STEM.format('filename')}, '_(\d+)$', 1), '') AS BIGINT) AS number,
        {_INITCAP.format("translate(regexp_replace(" + _STEM.format("filename") + ", '_[0-9]+$', ''), '_-', '  ')")} AS title,
        CASE WHEN regexp_matches({_STEM.format('filename')}, '(?i)handbook') THEN 'handbook' WHEN regexp_matches({_STEM.format('filename')}, '(?i)guide') THEN 'guide' WHEN regexp_matches({_STEM.format('filename')}, '(?i)report') THEN 'report'
        WHEN regexp_matches({_STEM.format('filename')}, '(?i)plan') THEN 'plan' ELSE 'other' END AS kind FROM {KM} WHERE filename IS NOT NULL""",
    "truncate_text": "SELECT doc_id, CASE WHEN length(text) > 100 THEN substring(text, 1, 100) || '...' ELSE text END AS title, CASE WHEN length(text) > 300 THEN substring(text, 1, 300) || '...' ELSE text END AS preview FROM documents WHERE text IS NOT NULL",
    "md5_ids": "SELECT doc_id, 'doc_' || substring(md5(text), 1, 8) AS short_id FROM documents WHERE text IS NOT NULL",
    "content_hash": "SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5, sha1(text) AS sha1, strlen(text)::BIGINT AS n_bytes FROM documents WHERE text IS NOT NULL",
    "uuid5_keys": """WITH h AS (SELECT doc_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('documents/' || doc_id)) AS h FROM documents)
        SELECT doc_id, substring(h, 1, 8) || '-' || substring(h, 9, 4) || '-5' || substring(h, 14, 3) || '-' || substring('89ab', (('0x' || substring(h, 17, 1))::INT % 4 + 1)::INT, 1) || substring(h, 18, 3) || '-' || substring(h, 21, 12) AS uuid FROM h""",
    "url_classify": rf"""SELECT item_id, coalesce(regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]+'), false) AS is_url, coalesce(url LIKE 'https://www.youtube.com/%' OR url LIKE 'https://youtube.com/%' OR url LIKE 'https://youtu.be/%' OR url LIKE 'http://www.youtube.com/%', false) AS is_video,
        regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host FROM {ITEM}""",
    "route_sources": rf"""SELECT CASE WHEN regexp_matches(source_path, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]+') THEN 'url' ELSE coalesce(r.route, 'text') END AS route, count(*) AS n FROM {SRC} s
        LEFT JOIN (VALUES {', '.join(f"('{k}', '{v}')" for k, v in T.ROUTES.items())}) r(ext, route) ON lower(regexp_extract(source_path, '\.([A-Za-z0-9]+)$', 1)) = r.ext GROUP BY 1""",
    "classify_by_name": rf"""SELECT id, CASE {' '.join("WHEN " + " OR ".join(f"contains(lower(source_path), '{p}')" for p in parts) + f" THEN '{label}'" for label, parts in T.FRAMEWORKS)}
        ELSE coalesce(nullif(regexp_extract(source_path, '([^/]*)/[^/]*$', 1), ''), 'uncategorized') END AS framework FROM {SRC}""",
    "render_markdown": rf"""WITH m AS (SELECT id, concat_ws(chr(10), '# ' || coalesce(title, 'Untitled Document'), '', nullif(concat_ws(chr(10), '- **Pages**: ' || num_pages, '- **Size**: ' || file_size), ''), '', coalesce(content, '')) AS body FROM {SRC})
        SELECT id, md5(body) AS markdown_md5, length(body)::BIGINT AS n_chars FROM m""",
    "render_html_body": f"SELECT item_id, '<h2>' || coalesce(title, '') || '</h2><p>' || coalesce(body, '') || '</p>' || coalesce('<p><em>' || nullif(trim(summary), '') || '</em></p>', '') AS html FROM {ITEM}",
    "render_prompt": "SELECT doc_id, 'Extract the structure of this document as JSON.' || chr(10) || chr(10) || 'Title: ' || coalesce(title, 'unknown') || chr(10) || chr(10) || substring(text, 1, 5000) AS prompt FROM documents WHERE text IS NOT NULL",
    "fix_counts": rf"""SELECT id, len(regexp_extract_all(content, '\n{{3,}}'))::BIGINT AS blank_runs, len(regexp_extract_all(content, '&(amp|lt|gt);'))::BIGINT AS entities, len(regexp_extract_all(content, '[' || chr(8216) || chr(8217) || chr(8220) || chr(8221) || ']'))::BIGINT AS quotes,
        len(regexp_extract_all(content, '=== Page \d+ ==='))::BIGINT AS markers FROM {SRC} WHERE content IS NOT NULL""",
    "rule_extract_json": f"SELECT doc_id, {_TITLE} AS title, CASE WHEN length(text) > 200 THEN substring(text, 1, 200) || '...' ELSE text END AS summary, doc_id AS document_id FROM documents WHERE text IS NOT NULL",
    "json_salvage": "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events",
    "json_extract_props": "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events",
    "json_build": "SELECT event_id, event_type, user_id FROM events",
}
QUERIES = {k: globals()[k] for k in ORACLES}
