"""Text functions: Column to Column, all of built-in expressions.

Every function gives null for null and works on empty text. Letters and digits are those of any script.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_GAP = r"[^\p{L}\p{N}_]+"
#: Namespace of name-based ids (RFC 4122, appendix C: URLs).
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def truncated(c: Column, size: int, mark: str = "...") -> Column:
    """At most ``size`` characters, with ``mark`` after them if something was cut."""
    return F.when(F.length(c) > size, F.concat(F.substring(c, 1, size), F.lit(mark))).otherwise(c)


def clipped(c: Column, size: int, mark: str = "...") -> Column:
    """At most ``size`` characters, the mark included."""
    return F.when(F.length(c) > size, F.concat(F.substring(c, 1, size - len(mark)), F.lit(mark))).otherwise(c)


def collapsed_blank_lines(c: Column) -> Column:
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def squeezed(c: Column) -> Column:
    """Soft hyphens dropped, runs of white space made one blank."""
    return F.trim(F.regexp_replace(F.replace(c, F.lit("­"), F.lit("")), r"[ \t\r\n\f]+", " "))


def slug(c: Column) -> Column:
    kept = F.regexp_replace(c, r"[^\p{L}\p{N}_\s-]", "")
    return F.lower(F.regexp_replace(F.trim(kept), r"\s+", "_"))


def slug_or(c: Column, fallback: Column) -> Column:
    return F.coalesce(F.nullif(slug(c), F.lit("")), fallback)


def anchor(c: Column) -> Column:
    """The link of a heading in a table of contents."""
    dashed = F.regexp_replace(F.replace(F.lower(c), F.lit(" "), F.lit("-")), r"[.,]", "")
    return F.regexp_replace(dashed, r"[^\p{L}\p{N}_-]", "")


def zero_padded(c: Column, width: int = 2) -> Column:
    s = c.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def sheet_name(c: Column) -> Column:
    return F.translate(F.substring(c, 1, 31), ":\\/?*[]", "_______")


def clean_scan_marks(c: Column) -> Column:
    """Typographic quotes made plain, HTML entities resolved, empty table cells closed, numbered lines made headings."""
    quotes = F.translate(c, "‘’“”", "''\"\"")
    entities = F.replace(F.replace(F.replace(quotes, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))
    cells = F.regexp_replace(entities, r"\| +\|", "| |")
    return collapsed_blank_lines(F.regexp_replace(cells, r"(?m)^(\d+\.\d+) +(\p{Lu}[^\n]*)$", "## $1 $2"))


def without_markdown_links(c: Column) -> Column:
    """Links and images dropped, over several lines too."""
    return F.regexp_replace(c, r"(?s)!?\[[^\]]*\]\([^)]*\)", "")


def without_tags(c: Column) -> Column:
    body = F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    return squeezed(F.regexp_replace(body, r"<[^<>]*>", " "))


def first_line(c: Column, among: int | None = None) -> Column:
    lines = F.split(c, "\n")
    lines = F.slice(lines, 1, among) if among else lines
    return F.get(F.filter(F.transform(lines, lambda x: F.trim(F.regexp_replace(x, r"[\t\r]", " "))), lambda x: x != ""), F.lit(0))


def title_of_text(c: Column) -> Column:
    return F.coalesce(clipped(first_line(c, 10), 80), F.lit("Untitled Document"))


def stem(c: Column) -> Column:
    name = F.regexp_extract(c, r"([^/]*)$", 1)
    return F.nullif(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), F.lit(""))


def title_case(c: Column) -> Column:
    """Each word's first letter large, the rest small; words are parted by single blanks."""
    return F.initcap(c)


def capitals_line(c: Column) -> Column:
    lines = F.transform(F.slice(F.split(c, "\n"), 1, 20), lambda x: F.trim(x))
    return F.get(F.filter(lines, lambda x: (F.length(x) > 3) & (x == F.upper(x)) & (x != F.lower(x))), F.lit(0))


def title_cascade(title: Column, path: Column, text: Column) -> Column:
    """The given title, else the file's name, else a line in capitals, else the first line."""
    from_name = title_case(F.translate(stem(path), "_-", "  "))
    return F.coalesce(F.nullif(F.trim(title), F.lit("")), from_name, capitals_line(text), clipped(first_line(text), 80), F.lit("Untitled Document"))


def short_id(prefix: Column | str, c: Column) -> Column:
    return F.concat(F.lit(prefix) if isinstance(prefix, str) else prefix, F.substring(F.md5(F.encode(c, "UTF-8")), 1, 8))


def uuid5(c: Column, namespace: str = URL_NAMESPACE) -> Column:
    """Name-based UUID, version 5."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(c, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3),
        F.lit("-"), F.substring(h, 21, 12),
    )


def is_url(c: Column) -> Column:
    """Whether there is a scheme and a host."""
    return F.coalesce(c.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]+"), F.lit(False))


# Prefixes of addresses of video pages.
VIDEO_PREFIXES = ("https://www.youtube.com/", "https://youtube.com/", "https://youtu.be/", "http://www.youtube.com/")
# Extension to loader.
ROUTES = {
    "pdf": "pdf", "docx": "docx", "doc": "docx", "pptx": "pptx", "ppt": "pptx", "md": "text", "txt": "text", "json": "json", "jpg": "image",
    "jpeg": "image", "png": "image", "gif": "image", "mp4": "video", "mov": "video", "avi": "video", "mkv": "video", "mp3": "audio", "wav": "audio",
    "m4a": "audio",
}
# Parts of file names to framework, in order of precedence.
FRAMEWORKS = (
    ("ngss", ("ngss",)), ("common_core", ("ccss", "common_core")), ("c3", ("c3",)), ("colorado", ("cas", "colorado")), ("texas", ("teks", "texas")),
    ("framework", ("framework",)),
)
# End of the fixed values.


def is_video_page(c: Column) -> Column:
    found = F.lit(False)
    for p in VIDEO_PREFIXES:
        found = found | F.startswith(c, F.lit(p))
    return F.coalesce(found, F.lit(False))


def extension(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"\.([A-Za-z0-9]+)$", 1))


def route(c: Column) -> Column:
    """The loader of a path or address; unknown kinds are read as text."""
    of_extension = F.lit("text")
    for ext, name in reversed(ROUTES.items()):
        of_extension = F.when(extension(c) == ext, name).otherwise(of_extension)
    return F.when(is_video_page(c), "video_page").when(is_url(c), "url").otherwise(of_extension)


def framework(name: Column, parent: Column) -> Column:
    low = F.lower(name)
    out = F.coalesce(F.nullif(parent, F.lit("")), F.lit("uncategorized"))
    for label, parts in reversed(FRAMEWORKS):
        hit = F.lit(False)
        for p in parts:
            hit = hit | F.contains(low, F.lit(p))
        out = F.when(hit, label).otherwise(out)
    return out


def tags_of(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")


def salvaged_json(c: Column) -> Column:
    """From the first brace to the last, code fences or not."""
    return F.nullif(F.regexp_extract(c, r"(?s)(\{.*\})", 1), F.lit(""))


def words(c: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def tokens(c: Column) -> Column:
    """Runs of anything but white space."""
    return F.filter(F.split(c, r"\s+"), lambda x: x != "")


def word_count(c: Column) -> Column:
    return F.size(tokens(c))


def subtitle_text(c: Column) -> Column:
    """Subtitles without time lines, numbers and headers; a blank line leaves a blank."""
    lines = F.transform(F.split(c, "\n"), lambda x: F.trim(x))
    kept = F.filter(
        lines, lambda x: ~F.contains(x, F.lit("-->")) & ~x.rlike(r"^\d+$") & ~F.startswith(x, F.lit("WEBVTT")) & ~F.startswith(x, F.lit("<?xml")),
    )
    return F.array_join(kept, " ")


def questions(c: Column) -> Column:
    """Questions of a line, each with its mark; pieces of 5 characters or fewer are dropped."""
    parts = F.transform(F.split(c, r"\? "), lambda x: F.trim(x))
    marked = F.transform(parts, lambda x: F.when(F.endswith(x, F.lit("?")), x).otherwise(F.concat(x, F.lit("?"))))
    return F.filter(marked, lambda x: F.length(x) > 5)


def table_text(rows: Column) -> Column:
    """Rows of cells as lines, with a rule below the first; rows without content are left out."""
    lines = F.transform(
        F.filter(rows, lambda r: F.exists(r, lambda x: F.coalesce(F.trim(x), F.lit("")) != "")),
        lambda r: F.array_join(F.transform(r, lambda x: F.trim(F.coalesce(x, F.lit("")))), " | "),
    )
    head = F.get(lines, F.lit(0))
    rest = F.when(F.size(lines) > 1, F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    return F.when(F.size(lines) > 0, F.array_join(F.concat(F.array(head, F.repeat(F.lit("-"), F.length(head))), rest), "\n"))


def speech_response(c: Column) -> Column:
    """(content, language, words, error) of a speech program's answer in JSON: the first alternative of the first channel; an answer without
    one has empty content, one that is no JSON an error. ``words`` is JSON, with times."""
    first = "$.results.channels[0].alternatives[0]"
    parsed = F.get_json_object(c, "$").isNotNull()
    part = lambda path: F.get_json_object(c, path)
    return F.struct(
        F.when(parsed, F.coalesce(part(f"{first}.transcript"), F.lit(""))).alias("content"),
        F.when(part(first).isNotNull(), part("$.results.language")).alias("language"), part(f"{first}.words").alias("words"),
        F.when(c.isNull() | ~parsed, "no answer in JSON").alias("error"),
    )
