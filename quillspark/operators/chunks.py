"""Cutting texts into chunks for retrieval."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from heapq import nsmallest
from itertools import compress

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import tokens, uuid5
from .relational import distinct_ignoring_case

_PHRASE_WORD = re.compile(r"[^\W_]+")


def token_windows(df: DataFrame, text: str, size: int = 800, overlap: int = 100) -> DataFrame:
    """Adds ``chunk_index``, ``content`` and ``n_tokens`` and drops the text: windows of ``size`` tokens, each beginning ``size - overlap`` after the
    one before. The last window is the first that reaches the end; texts without tokens give no rows."""
    if not 0 <= overlap < size:
        raise ValueError("the overlap must be at least 0 and less than the size")
    step = size - overlap
    src = df.withColumn("_tokens", tokens(F.col(text))).drop(text)
    n = F.size("_tokens")
    last = F.greatest(F.lit(0), F.ceil((n - size) / step)).cast("int")
    # a null array explodes to nothing; a filter on the number of tokens would be pushed down and split the text twice
    out = src.withColumn("chunk_index", F.explode(F.when(n > 0, F.sequence(F.lit(0), last)))).withColumn(
        "_part", F.slice("_tokens", F.col("chunk_index") * step + 1, F.lit(size)),
    )
    return out.withColumn("content", F.array_join("_part", " ")).withColumn("n_tokens", F.size("_part")).drop("_tokens", "_part")


def overlap_found(chunks: DataFrame, key: str, head: int = 50, tail: int = 150) -> DataFrame:
    """Adds ``overlaps``: whether the chunk's head is within the tail of the chunk before it; null for a first chunk."""
    before = F.lag("content").over(Window.partitionBy(key).orderBy("chunk_index"))
    return chunks.withColumn("overlaps", F.contains(F.right(before, F.lit(tail)), F.substring("content", 1, head)))


def fixed_chars(df: DataFrame, text: str, size: int = 500) -> DataFrame:
    """Adds ``chunk_index`` and ``content`` and drops the text: pieces of ``size`` characters."""
    src = df.withColumnRenamed(text, "_text").where(F.length("_text") > 0)
    last = ((F.length("_text") - 1) / size).cast("int")
    return src.withColumn("chunk_index", F.explode(F.sequence(F.lit(0), last))).withColumn(
        "content", F.substring("_text", F.col("chunk_index") * size + 1, F.lit(size)),
    ).drop("_text")


def sentences(df: DataFrame, text: str, abbreviations: bool = True) -> DataFrame:
    """Adds ``chunk_index`` and ``content`` and drops the text: a piece ends after ``.`` or ``?`` and a white space character, but not after an
    abbreviation; the index counts blank pieces, which are left out."""
    ends = r"(?<!\w\.\w.)(?<![A-Z][a-z]\.)(?<=[.?])\s" if abbreviations else r"(?<=[.?])\s"
    src = df.withColumnRenamed(text, "_text").where("_text is not null")
    cut = src.select("*", F.posexplode(F.split("_text", ends)).alias("chunk_index", "content")).drop("_text")
    return cut.withColumn("content", F.trim("content")).where("content <> ''")


def upload_rows(chunks: DataFrame, key: str) -> DataFrame:
    """Rows for a store of chunks: id made of document and index, so that loading again changes nothing; no blank texts."""
    name = F.concat_ws("/", F.col(key).cast("string"), F.col("chunk_index").cast("string"))
    return chunks.where(F.trim(F.coalesce("content", F.lit(""))) != "").select(
        uuid5(name).alias("id"), F.col("content").alias("text"), "chunk_index", F.col(key).cast("string").alias("document_id"),
    )


# Words that no phrase of interest ends with.
STOP_WORDS = frozenset(
    """a about above after again all also am an and any are as at be because been before being below between both but by can could did do does doing
    down during each every few for from further had has have having he her here hers him his how i if in into is it its just may me might more most must
    my no nor not now of off on once one only or other our ours out over own same shall she should so some such than that the their theirs them then there
    these they this those through to too under until up upon us very was we were what when where which while who whom why will with would you your
    yours""".split()
)
# End of the fixed values.


def frequent_phrases(text: str, most_words: int, k: int) -> list[tuple[str, int]]:
    """(phrase, times) of the k most frequent runs of up to ``most_words`` words that don't end with a stop word, the first by alphabet of equal ones."""
    w = _PHRASE_WORD.findall(text.lower())
    ends = [x not in STOP_WORDS for x in w]
    n: Counter = Counter()
    for size in range(1, most_words + 1):
        n.update(compress(map(" ".join, zip(*(w[j:] for j in range(size)))), ends[size - 1 :]))
    return nsmallest(k, n.items(), key=lambda x: (-x[1], x[0]))


def top_phrases(df: DataFrame, key: str, text: str, words: int = 3, k: int = 15) -> DataFrame:
    """(key, keyword, n, rank): the k most frequent phrases of each text, as of :func:`frequent_phrases`.

    Counted where a text is read, in Arrow batches: a text's phrases are many times its size and would all be shuffled
    otherwise. Null texts and texts without words give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _few(batches):
            rows = [(r, *x, i) for r, t in enumerate(b.column("_t").to_pylist()) for i, x in enumerate(frequent_phrases(t, words, k), 1)]
            col = lambda j, t: pa.array([x[j] for x in rows], t)
            yield pa.RecordBatch.from_arrays(
                [b.column("_k").take(col(0, pa.int64())), col(1, pa.string()), col(2, pa.int64()), col(3, pa.int32())], names=[key, "keyword", "n", "rank"],
            )

    src = df.select(F.col(key).alias("_k"), F.col(text).alias("_t")).where("_t is not null")
    return src.mapInArrow(run, f"`{key}` {src.schema['_k'].dataType.simpleString()}, keyword string, n bigint, rank int")


def hybrid_tags(df: DataFrame, key: str, text: str, given: str, terms: tuple[str, ...], k: int = 15, most: int = 20) -> DataFrame:
    """(key, tags): the tags ``given`` (an array, of a model for example), the k frequent phrases and the ``terms`` that occur in the text, in this
    order, of those that differ in case only the first, at most ``most``. A null text adds nothing to what is given; null tags are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _few(batches):
            found = [[p for p, _ in frequent_phrases(t, 3, k)] if t else [] for t in b.column("_t").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("_k"), b.column("_given"), pa.array(found, pa.list_(pa.string())), b.column("_terms")], names=["_k", "_given", "_phrases", "_terms"],
            )

    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    src = df.select(
        F.col(key).alias("_k"), F.col(text).alias("_t"), F.array_compact(F.coalesce(F.col(given), F.array().cast("array<string>"))).alias("_given"),
        F.array_compact(F.array(*(F.when(F.contains(low, F.lit(t.lower())), F.lit(t)) for t in terms))).cast("array<string>").alias("_terms"),
    )
    kind = src.schema["_k"].dataType.simpleString()
    tagged = src.mapInArrow(run, f"_k {kind}, _given array<string>, _phrases array<string>, _terms array<string>")
    return tagged.select(F.col("_k").alias(key), distinct_ignoring_case(F.concat("_given", "_phrases", "_terms"), most).alias("tags"))


def _few(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
