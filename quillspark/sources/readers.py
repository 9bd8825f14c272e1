"""Readers: files to rows of one shape, ``DOCUMENT``. Errors of a file are in its ``error``, never raised for the whole read.

An empty folder or pattern without files gives no rows; unreadable files a row with ``error`` and null content.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import extension, route

METADATA = T.StructType([
    T.StructField("filename", T.StringType()), T.StructField("file_type", T.StringType()), T.StructField("file_size", T.LongType()), T.StructField("created_at", T.TimestampType()), T.StructField("modified_at", T.TimestampType()),
    T.StructField("title", T.StringType()), T.StructField("author", T.StringType()), T.StructField("num_pages", T.LongType()), T.StructField("num_processed_pages", T.LongType()),
])
PAGES = T.ArrayType(T.StructType([T.StructField("page_number", T.IntegerType()), T.StructField("text", T.StringType())]))
DOCUMENT = T.StructType(
    [
        T.StructField("source_path", T.StringType()), T.StructField("content", T.StringType()), T.StructField("metadata", METADATA),
        T.StructField("pages", PAGES), T.StructField("error", T.StringType()),
    ]
)
# Extensions that are read from a folder.
EXTENSIONS = ("pdf", "docx", "doc", "pptx", "ppt", "txt", "md", "json", "jpg", "jpeg", "png", "gif", "bmp", "tiff", "mp3", "wav", "mp4", "mov", "avi")
# End of the fixed values.


def size_of(text: str) -> int:
    """Bytes of a size such as ``10M``, ``1.5G`` or ``300``."""
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([kmgt]?)b?\s*", text, re.I)
    if not m:
        raise ValueError(f"not a size: {text!r}")
    return int(float(m[1]) * 1024 ** " kmgt".index(m[2].lower() or " "))


def binary(spark: SparkSession, path: str, recursive: bool = False, pattern: str | None = None) -> DataFrame:
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    return (r.option("pathGlobFilter", pattern) if pattern else r).load(path)


def discover(spark: SparkSession, path: str, recursive: bool = False, extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """(path, route, length, modified_at) of files of known kinds; their content isn't read."""
    f = binary(spark, path, recursive).select("path", "length", F.col("modificationTime").alias("modified_at"))
    return f.where(extension(F.col("path")).isin(*extensions)).withColumn("route", route(F.regexp_replace("path", "^file:", "")))


def large_files(spark: SparkSession, path: str, least: str = "10M", n: int = 20) -> DataFrame:
    return binary(spark, path, recursive=True).select("path", "length").where(F.col("length") >= size_of(least)).orderBy(F.desc("length"), "path").limit(n)


def file_hashes(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    return binary(spark, path, recursive).select(
        "path", F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"), F.sha1("content").alias("sha1"),
    )


def _shaped(df: DataFrame) -> DataFrame:
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    meta = F.struct(
        name.alias("filename"), extension(F.col("path")).alias("file_type"), F.col("length").cast("bigint").alias("file_size"), F.lit(None).cast("timestamp").alias("created_at"), F.col("modificationTime").alias("modified_at"),
        F.col("title").cast("string").alias("title"), F.col("author").cast("string").alias("author"), F.size("pages").cast("bigint").alias("num_pages"), F.size("pages").cast("bigint").alias("num_processed_pages"),
    )
    return df.select(F.regexp_replace("path", "^file:/+", "/").alias("source_path"), "content", meta.alias("metadata"), "pages", "error")


_EXTRACTED = "path string, length bigint, modificationTime timestamp, content string, title string, author string, pages array<struct<page_number:int,text:string>>, error string"


def extracted(files: DataFrame, extract: Callable[[bytes, str], dict]) -> DataFrame:
    """Documents from the bytes of files: ``extract(content, path)`` gives content, title, author and pages, or raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for path, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                try:
                    found.append({"content": None, "title": None, "author": None, "pages": None, "error": None} | extract(data, path))
                except Exception as e:
                    found.append({"content": None, "title": None, "author": None, "pages": None, "error": f"{type(e).__name__}: {e}"[:500]})
            page = pa.list_(pa.struct([("page_number", pa.int32()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("path"), b.column("length"), b.column("modificationTime"),
                    *(pa.array([x[k] for x in found], t) for k, t in (("content", pa.string()), ("title", pa.string()), ("author", pa.string()), ("pages", page), ("error", pa.string()))),
                ],
                names=["path", "length", "modificationTime", "content", "title", "author", "pages", "error"],
            )

    return _shaped(files.select("path", "length", "modificationTime", "content").mapInArrow(run, _EXTRACTED))


def text(files: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """Text and Markdown files as a whole; JVM only."""
    return _shaped(
        files.select(
            "path", "length", "modificationTime", F.decode("content", encoding).alias("content"), F.lit(None).alias("title"),
            F.lit(None).alias("author"), F.lit(None).cast(PAGES).alias("pages"), F.lit(None).cast("string").alias("error"),
        )
    )


def json(files: DataFrame) -> DataFrame:
    """JSON files: the raw text, with an error if it can't be parsed."""
    t = text(files)
    bad = F.try_parse_json("content").isNull()
    return t.withColumn("error", F.when(bad, F.lit("not valid JSON")))


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_DC = "{http://purl.org/dc/elements/1.1/}"
_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"


def extract_docx(data: bytes, path: str) -> dict:
    """Paragraphs with a line break between, title and author of a word-processor file."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml"))
        core = ElementTree.fromstring(z.read("docProps/core.xml")) if "docProps/core.xml" in z.namelist() else None
    paragraphs = ["".join(t.text or "" for t in p.iter(f"{_W}t")) for p in body.iter(f"{_W}p")]
    find = lambda name: (core.findtext(f"{_DC}{name}") or None) if core is not None else None
    return {"content": "\n".join(paragraphs), "title": find("title"), "author": find("creator")}


def extract_pptx(data: bytes, path: str) -> dict:
    """Slides as pages; the first text of a slide is its title, notes follow below a rule."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        slides = sorted((n for n in names if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[0]))
        pages = []
        for i, n in enumerate(slides, 1):
            texts = _paragraphs(z.read(n))
            notes = f"ppt/notesSlides/notesSlide{i}.xml"
            said = _paragraphs(z.read(notes)) if notes in names else []
            title, rest = (texts[0], texts[1:]) if texts else (f"Slide {i}", [])
            pages.append({"page_number": i, "text": f"# {title}\n\n" + "\n".join(rest) + ("\n\n--- Notes ---\n" + "\n".join(said) if said else "")})
    return {"content": "\n\n".join(p["text"] for p in pages), "pages": pages}


def _paragraphs(xml: bytes) -> list[str]:
    found = ("".join(t.text or "" for t in p.iter(f"{_A}t")).strip() for p in ElementTree.fromstring(xml).iter(f"{_A}p"))
    return [t for t in found if t]


def extract_image(data: bytes, path: str) -> dict:
    """Width and height from the header of PNG, GIF and JPEG files, as text."""
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        w, h = int.from_bytes(data[16:20]), int.from_bytes(data[20:24])
    elif data[:3] == b"GIF":
        w, h = int.from_bytes(data[6:8], "little"), int.from_bytes(data[8:10], "little")
    elif data[:2] == b"\xff\xd8":
        i = 2
        while data[i] != 0xFF or not 0xC0 <= data[i + 1] <= 0xCF or data[i + 1] in (0xC4, 0xC8, 0xCC):
            i += 2 + int.from_bytes(data[i + 2 : i + 4])
        h, w = int.from_bytes(data[i + 5 : i + 7]), int.from_bytes(data[i + 7 : i + 9])
    else:
        raise ValueError("unknown image format")
    return {"content": f"width={w} height={h}"}


def load(spark: SparkSession, path: str, recursive: bool = False, providers: dict[str, Callable[[bytes, str], dict]] | None = None) -> DataFrame:
    """Documents of all known kinds below a path. ``providers``: extractors by route for kinds that need an outside program (pdf, audio,
    video, image text); without one such a file gets an error."""
    files = binary(spark, path, recursive).withColumn("_route", route(F.regexp_replace("path", "^file:", "")))
    files = files.where(extension(F.col("path")).isin(*EXTENSIONS))
    extractors = {"docx": extract_docx, "pptx": extract_pptx, "image": extract_image} | (providers or {})
    out = text(files.where("_route = 'text'")).unionByName(json(files.where("_route = 'json'")))
    for name, f in extractors.items():
        out = out.unionByName(extracted(files.where(F.col("_route") == name), f))
    missing = [r for r in ("pdf", "audio", "video") if r not in extractors]
    absent = files.where(F.col("_route").isin(*missing)).select(
        "path", "length", "modificationTime", F.lit(None).cast("string").alias("content"), F.lit(None).alias("title"), F.lit(None).alias("author"),
        F.lit(None).cast(PAGES).alias("pages"), F.concat(F.lit("no extractor for "), "_route").alias("error"),
    )
    return out.unionByName(_shaped(absent))


def csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, by the header."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')


def json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return spark.read.json(path, schema=schema)
