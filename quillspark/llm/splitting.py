"""Problem 5: cutting oversized texts at natural boundaries.

Method: agglomerative merging. A text is first cut into atomic segments, at the coarsest boundaries
that make them small enough; then the pairs of neighbours wait in a heap, and the pair over the
weakest boundary (of these the smallest, then the first) is merged while the merged size and the
overlap stay within the limit.

Lengths are in code points. Every piece but the first begins with the last ``overlap_chars`` characters
before it. The pieces without these overlaps, put together, are the text exactly.

Defined results: null texts and texts within the limit give no row; a repeated key counts once; an
overlap of the limit or more is an error; a text without any blank is cut after the limit's last
character.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced

LEVELS = ("paragraph", "sentence", "word", "none")
_CUTS = (re.compile(r"\n[ \t\r]*\n[ \t\r\n]*"), re.compile(r"[.!?][ \t\r\n]+"), re.compile(r"[ \t\r\n]+"))
_BLANKS = " \t\r\n"


def _segments(text: str, start: int, end: int, level: int, limit: int, out: list[tuple[int, int]], trimmed: bool) -> None:
    """Append (end, level of the boundary at the end) of each segment."""
    if level == 3:
        out += [(e, 3) for e in [*range(start + limit, end, limit), end]]
        return
    at = start
    ends = [m.end() for m in _CUTS[level].finditer(text, start, end)]
    if not ends or ends[-1] != end:
        ends.append(end)
    for e in ends:
        size = len(text[at:e].strip(_BLANKS)) if trimmed else e - at
        if size <= limit:
            out.append((e, level))
        else:
            _segments(text, at, e, level + 1, limit, out, trimmed)
            out[-1] = (out[-1][0], level)
        at = e


def _merged(text: str, first_limit: int, limit: int, trimmed: bool) -> list[tuple[int, int, int]]:
    """(first character, end, level of the boundary at the end) of the pieces into which the atomic segments merge.

    ``first_limit`` is the limit of a piece that begins the text. With ``trimmed`` blanks at the ends of a piece don't count.
    """
    atoms: list[tuple[int, int]] = []
    _segments(text, 0, len(text), 0, limit, atoms, trimmed)
    n = len(atoms)
    begin, end, level = [0, *(e for e, _ in atoms[:-1])], [e for e, _ in atoms], [k for _, k in atoms]
    low, high = begin[:], end[:]  # what counts of a piece
    if trimmed:
        for i in range(n):
            body = text[begin[i] : end[i]]
            bare = body.lstrip(_BLANKS)
            low[i] = begin[i] + len(body) - len(bare) if bare else len(text)
            high[i] = begin[i] + len(body.rstrip(_BLANKS)) if bare else 0
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    alive = [True] * n
    size = lambda i, j: max(0, max(high[i], high[j]) - min(low[i], low[j]))
    heap: list[tuple] = []

    def offer(i: int, j: int) -> None:
        if size(i, j) <= (first_limit if begin[i] == 0 else limit):
            # boundary levels count from 0, the strongest; the weakest has the highest level
            heapq.heappush(heap, (-level[i], size(i, j), begin[i], i, j, end[j]))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, _, b, i, j, e = heapq.heappop(heap)
        if not (alive[i] and alive[j]) or begin[i] != b or end[j] != e or after[i] != j:
            continue
        low[i], high[i] = min(low[i], low[j]), max(high[i], high[j])
        end[i], level[i], alive[j], after[i] = end[j], level[j], False, after[j]
        if after[i] >= 0:
            before[after[i]] = i
        if before[i] >= 0:
            offer(before[i], i)
        if after[i] >= 0:
            offer(i, after[i])
    return [(begin[i], end[i], level[i]) for i in range(n) if alive[i]]


def boundary_level(text: str, limit: int) -> str:
    """The coarsest boundary at which all pieces, without blanks at their ends, can keep the limit: the finest that is left
    when segments have merged. Where a segment had to be cut finer, at least one such boundary is left in it."""
    return LEVELS[max((level for _, _, level in _merged(text, limit, limit, True)[:-1]), default=0)]


def split_text(text: str, max_chars: int, overlap_chars: int) -> list[tuple[int, int, int]]:
    """(first character of the overlap, first own character, end) of each piece."""
    if overlap_chars < 0 or overlap_chars >= max_chars:
        raise ValueError("the overlap must be at least 0 and less than the limit")
    if len(text) <= max_chars:
        return [(0, 0, len(text))] if text else []
    return [(max(0, b - overlap_chars), b, e) for b, e, _ in _merged(text, max_chars, max_chars - overlap_chars, False)]


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        out: list[tuple] = []
        for field, key, text, most, overlap in zip(
            *(b.column(c).to_pylist() for c in ("field_name", "record_key", "text", "max_chars", "overlap_chars"))
        ):
            level = boundary_level(text, most)
            for k, (a, own, z) in enumerate(split_text(text, most, overlap)):
                out.append((field, key, level, k, own, z, own - a, text[a:z]))
        kinds = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=_NAMES)


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        found = [boundary_level(t, most) for t, most in zip(b.column("text").to_pylist(), b.column("max_chars").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("field_name"), b.column("record_key"), pa.array(found, pa.string())], names=_NAMES[:3])


_NAMES = ["field_name", "record_key", "boundary_level", "chunk_index", "start", "end", "overlap", "piece"]
_PIECES = "field_name string, record_key string, boundary_level string, chunk_index int, start int, end int, overlap int, piece string"


def oversized(texts: DataFrame, key_col: str, text_col: str, field_name: str, spec: DataFrame) -> DataFrame:
    """Texts above the limit of ``field_name`` in ``spec`` (a table of a few rows, one per field; of several the smallest limit)."""
    limit = spec.where(F.col("field_name") == field_name).select("field_name", "max_chars", "overlap_chars").orderBy("max_chars", "overlap_chars").limit(1)
    src = texts.select(
        F.lit(field_name).alias("field_name"), F.col(key_col).cast("string").alias("record_key"), F.col(text_col).alias("text"),
    ).where("text is not null")
    return src.join(F.broadcast(limit), "field_name").where(F.length("text") > F.col("max_chars")).select(
        "field_name", "record_key", "text", "max_chars", "overlap_chars",
    )


def split_pieces(over: DataFrame) -> DataFrame:
    """The pieces of each text of :func:`oversized`, with a new sequence ``chunk_index`` from 0.

    A piece is characters ``start`` to ``end`` of the text, after ``overlap`` characters from before them.
    """
    return over.dropDuplicates(["field_name", "record_key"]).mapInArrow(_split, _PIECES)


def levels(over: DataFrame) -> DataFrame:
    """(field_name, record_key, boundary_level) of each text of :func:`oversized`, from merging its segments; no text is shuffled."""
    return over.mapInArrow(_levels, "field_name string, record_key string, boundary_level string").distinct()
