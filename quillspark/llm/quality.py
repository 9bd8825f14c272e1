"""Problem 8: text quality statistics per document and what kind of text it is.

Method: a text is cut into chunks of a fixed number of characters; each chunk gives partial counts with the
state at its two borders (the unfinished first and last line, and of these what may still change: a word or
run of blanks that touches the border); partial counts merge associatively, in a tree of fan-in ``FAN_IN``;
ratios and rule outcomes come from the merged counts. However a text is cut, the result is that of the whole.

Counts of a word or sign are made once for each different run of characters without a blank and kept in a
table; those of lines and texts are sums of rows of this table, over a batch of texts at once.

Defined results: null or blank texts give no row in ``p8_found``; in ``text_statistics`` they give zero
counts, null ratios and the kind null. A repeated document id counts once. Extra columns are ignored.
A run of characters without a blank is kept whole in the state while it may go on, as its words can't be told
before; all else in the state is of constant size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced

#: Characters of a chunk, and of texts counted at once.
CHUNK_CHARS = 32_768
#: Two levels hold 256 * 256 chunks, which is the largest string that Spark can hold.
FAN_IN = 256
BATCH_CHARS = 1_000_000

# Frequent function words by language.
COMMON_BY_LANGUAGE = {
    "en": """the and of for a an this that these those another our their his her its your my each every some any no not in on at to from by
        with without under near across within throughout beyond alongside during before after until unless while whereas although though even
        so as because since if when where who whom which what whether how is are was were be been being has have had do does did will would can
        could should may might must shall it there they we you he she i or but nor than then also however both all more most such into over
        about again""",
    "es": """el la los las un una unos unas de del al y o en con sin por para que se lo le les su sus es son fue como cada este esta porque según
        antes durante entre sobre más pero muy no ni ya""",
    "fr": """les le la des du et ou dans avec sans pour par que qui ne pas sur ce cette ces son sa ses est sont était comme chaque parce avant
        pendant selon au aux plus mais très qu""",
    "de": """der die das den dem des ein eine einen einem einer und oder in im mit ohne für von vom zu zum zur auf aus bei nach vor während ist
        sind war wie weil jede jeder jedes nicht auch sich es""",
    "it": "il lo gli uno di da con su per che e ed o non del della dei delle nel nella si come questo questa ogni prima",
    "pt": "os as um uma do da dos das em no na nos nas com sem por para que se e ou não mais seu sua ao aos",
}
# End of the fixed values.

COMMON_WORDS = frozenset(w for words in COMMON_BY_LANGUAGE.values() for w in words.split())

KINDS = ("prose", "list", "table", "junk")
_WORD = re.compile(r"\bn/a\b|[^\W_]+(?:['’][^\W_]+)*")
_LETTER = re.compile(r"[^\W\d_]")
_LATIN = re.compile(r"[a-zß-öø-ÿœ]+")
_VOWEL = re.compile(r"[aeiouyáéíóúàèìòùâêîôûäëïöüãõœæ]")
_BULLET = re.compile(r"\s*(?:[-*+•▪◦‣·–—o]\s+|\[[ xX]?\]\s*|\(?(?:\d{1,4}|[a-zA-Z]|[ivxlcIVXLC]{1,6})[.)]\s+|\d{1,4}\s+\S|[A-Z]{1,4}[-.]\d\S*\s)")
_FIELD_NAME = 41
_GAP, _INNER_GAP = re.compile(r"[^ \t](?:[ \t]{2,}|\t)"), re.compile(r"[^ \t](?:[ \t]{2,}|\t)(?=[^ \t])")
_CODED = re.compile(r"\s*\(?[A-Z]{1,4}[-.]?\d+[-.]\S*\s")
#: A lead byte of UTF-8 shown as Latin-1 with a byte after it.
_MOJIBAKE = re.compile(r"[ÂÃâÐÑ][^\x00-\x7f]")
_CODE_SIGNS = re.compile(r"[{}<>=\\^~@#$&*]")
#: Characters of scripts that are written without blanks between words, and their marks.
_WIDE = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]")
_WIDE_MARK = re.compile(r"[。，、！？；]")
_BEYOND_LATIN = re.compile(r"[\x80-\u024f]")
_TAG_CHARS = 200
_EDGE = 24
_STOPS = ".!?…。！？؟।"
_END = _STOPS + ":;\"'”’»)"
_STRAY = " \t"
_UNIT = re.compile(r"(?<=[ \t])(?=[^ \t])")

#: Counts of a run of characters without a blank, by column.
TOKEN = (
    "words", "word_chars", "letters", "digits", "common", "plain", "odd", "mixed", "pipes", "commas", "semis", "leaders", "ends", "code", "broken",
    "accents", "lower", "wide", "wide_marks", "stops", "runs",
)
#: Counts of a line that depend on blanks.
PLACED = ("chars", "spaces", "tabs", "loose", "loose_semis", "gaps")
COLUMNS = {n: i for i, n in enumerate(TOKEN + PLACED)}
_SKETCH = 512


def hash_word(w: str) -> int:
    h = 2166136261
    for c in w:
        h = ((h ^ ord(c)) * 16777619) & 0xFFFFFFFF
    return h ^ (h >> 13)


def token_counts(token: str) -> tuple[list[int], int]:
    """The counts of one run of characters without a blank, and the bits of its words in the sketch of distinct words."""
    bits = size = common = plain = odd = mixed = 0
    words = _WORD.findall(token.lower())
    for w in words:
        size += len(w)
        common += w in COMMON_WORDS
        if len(w) > 3 and _LATIN.fullmatch(w):
            plain += 1
            odd += not _VOWEL.search(w) or len(w) > 24
        mixed += not w.isalpha() and not w.isdigit() and len(w) > 12
        bits |= 1 << hash_word(w) % _SKETCH
    letters = _LETTER.findall(token)
    only_ascii = token.isascii()
    return [
        len(words), size, len(letters), sum(c.isdigit() for c in token), common, plain, odd, mixed, token.count("|"), token.count(","), token.count(";"), int("...." in token),
        token.count(".") + token.count("!") + token.count("?"), len(_CODE_SIGNS.findall(token)), 0 if only_ascii else 2 * len(_MOJIBAKE.findall(token)),
        0 if only_ascii else len(_BEYOND_LATIN.findall(token)), int(bool(letters) and letters[0].islower()), 0 if only_ascii else len(_WIDE.findall(token)),
        0 if only_ascii else len(_WIDE_MARK.findall(token)), int(token.rstrip("\"'”’»)")[-1:] in _STOPS and token.rstrip("\"'”’»)") != ""), 1,
    ], bits


class Table:
    """Counts of all runs met so far; emptied when there are very many."""

    MOST = 200_000

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.counts = np.zeros((1024, len(TOKEN)), np.int32)
        self.bits = np.zeros((1024, _SKETCH // 64), np.uint64)

    def add(self, token: str) -> int:
        n = len(self.place)
        if n == len(self.counts):
            self.counts = np.vstack([self.counts, np.zeros_like(self.counts)])
            self.bits = np.vstack([self.bits, np.zeros_like(self.bits)])
        self.place[token] = n
        self.counts[n], bits = token_counts(token)
        self.bits[n] = np.frombuffer(bits.to_bytes(_SKETCH // 8, "little"), np.uint64)
        return n

    def measure(self, parts: list[str], whole: bool) -> tuple[np.ndarray, np.ndarray]:
        """Counts (a row for each part, by ``COLUMNS``) and bits. Parts are whole lines, or begin and end where a unit does:
        a run of characters with the blanks after it, after which another run comes."""
        if len(self.place) > self.MOST:
            self.clear()
        place, add = self.place, self.add
        at: list[int] = []
        sizes, placed = [], []
        gap = _INNER_GAP if whole else _GAP
        for p in parts:
            runs = p.split()
            sizes.append(len(runs))
            at += [i if (i := place.get(t)) is not None else add(t) for t in runs]
            tabs = p.count("\t")
            placed.append((
                len(p), p.count(" ") + tabs, tabs, p.count(", ") + p.count(",\t") if "," in p else 0, p.count("; ") + p.count(";\t") if ";" in p else 0,
                len(gap.findall(p)) if tabs or "  " in p else 0,
            ))
        n = len(parts)
        out = np.zeros((n, len(COLUMNS)), np.int64)
        bits = np.zeros((n, self.bits.shape[1]), np.uint64)
        if n:
            out[:, len(TOKEN) :] = placed
        if at:
            ids, size = np.array(at), np.array(sizes)
            filled = np.flatnonzero(size)
            begin = (np.cumsum(size) - size)[filled]
            out[filled, : len(TOKEN)] = np.add.reduceat(self.counts[ids], begin, axis=0, dtype=np.int64)
            bits[filled] = np.bitwise_or.reduceat(self.bits[ids], begin, axis=0)
        return out, bits


def angles(text: str) -> tuple[int, int, int, int]:
    """Characters in tags of at most ``_TAG_CHARS`` between their brackets; characters before the first bracket if that closes, after the last
    if that opens (else -1); and all characters, or -1 if there is a bracket."""
    if "<" not in text and ">" not in text:
        return 0, -1, -1, len(text)
    total, opened, first = 0, -1, -1
    for m in re.finditer(r"[<>]", text):
        if m.group() == "<":
            opened = m.start()
        else:
            if opened >= 0 and 1 <= m.start() - opened - 1 <= _TAG_CHARS:
                total += m.start() - opened + 1
            opened = -1
        if first < 0:
            first = m.start()
    return total, first if text[first] == ">" else -1, len(text) - opened - 1 if opened >= 0 else -1, -1


def joined_angles(a: tuple, b: tuple) -> tuple[int, int, int, int]:
    if a[3] >= 0 and b[3] >= 0:
        return 0, -1, -1, a[3] + b[3]
    if a[3] >= 0:
        return b[0], b[1] + a[3] if b[1] >= 0 else -1, b[2], -1
    if b[3] >= 0:
        return a[0], a[1], a[2] + b[3] if a[2] >= 0 else -1, -1
    inside = a[2] + b[1]
    return a[0] + b[0] + (inside + 2 if a[2] >= 0 and b[1] >= 0 and 1 <= inside <= _TAG_CHARS else 0), a[1], b[2], -1


class Line:
    """A part of a line whose ends are open.

    ``left`` is its text up to the first unit that begins in it, ``right`` the last unit; between them units are counted. Without
    a unit's begin ``right`` is None. The rest is the first and last characters, the first colon, and the tags."""

    __slots__ = ("left", "right", "counts", "bits", "head", "tail", "size", "colon", "after", "tags")

    def __init__(self, text: str, table: Table):
        self.head, self.tail, self.size, self.tags = text[:_EDGE], text[-_EDGE:], len(text), angles(text)
        self.colon = text.find(":")
        self.after = text[self.colon + 1 : self.colon + 2] if self.colon >= 0 else ""
        self._cut(text, table)

    def _cut(self, text: str, table: Table) -> None:
        first = _UNIT.search(text)
        self.counts = self.bits = None
        if first is None:
            self.left, self.right = text, None
            return
        last = max(text.rfind(" "), text.rfind("\t")) + 1
        if last == len(text):  # blanks at the end belong to the last unit
            last = len(text.rstrip(_STRAY))
            last = max(text.rfind(" ", 0, last), text.rfind("\t", 0, last)) + 1
        self.left, self.right = text[: first.start()], text[last:]
        if last > first.start():
            (self.counts,), (self.bits,) = table.measure([text[first.start() : last]], False)

    def _count(self, text: str, table: Table) -> None:
        if text:
            (c,), (b,) = table.measure([text], False)
            self.add(c, b)

    def add(self, counts, bits) -> None:
        if counts is not None:
            self.counts, self.bits = (counts, bits) if self.counts is None else (self.counts + counts, self.bits | bits)

    def joined(self, b: Line, table: Table) -> Line:
        """The part of which this is the first and ``b`` the second half."""
        out = Line.__new__(Line)
        out.head, out.tail, out.size = (self.head + b.head)[:_EDGE], (self.tail + b.tail)[-_EDGE:], self.size + b.size
        if self.colon >= 0:
            out.colon, out.after = self.colon, self.after or b.head[:1]
        else:
            out.colon, out.after = (self.size + b.colon if b.colon >= 0 else -1), b.after
        out.tags = joined_angles(self.tags, b.tags)
        out._cut((self.left if self.right is None else self.right) + b.left, table)
        if self.right is not None:  # what was cut begins where a unit does
            if out.right is not None:
                out._count(out.left, table)
            else:
                out.right = out.left
            out.left = self.left
            out.add(self.counts, self.bits)
        if b.right is not None:  # and what was cut ends where one does
            if out.right is not None:
                out._count(out.right, table)
            out.right = b.right
            out.add(b.counts, b.bits)
        return out

    def ended(self, table: Table) -> tuple[np.ndarray, np.ndarray]:
        """Counts and bits of the line, of which this is the whole."""
        if self.right is None:
            return table.measure([self.left], True)
        counts, bits = table.measure([self.right], True)
        more, more_bits = table.measure([self.left], False)
        counts, bits = counts + more, bits | more_bits
        return (counts, bits) if self.counts is None else (counts + self.counts, bits | self.bits)


#: What a line adds to its text, beside its counts.
ADDED = ("lines", "blank_lines", "lines_end_punct", "symbols", "marked", "list_words", "list_common", *(f"{k}_chars" for k in KINDS), *(f"{k}_lines" for k in KINDS))
KEPT = ("chars", "words", "word_chars", "letters", "digits", "common", "lower", "stops")
TOTALS = {n: i for i, n in enumerate(KEPT + ADDED)}
_KEPT = [COLUMNS[n] for n in KEPT]


def lines_totals(counts: np.ndarray, heads: list[str], tails: list[str], fields: list[bool], tags: list[int]) -> np.ndarray:
    """What each whole line adds to its text (by ``TOTALS``): its counts and what it looks like."""
    x = {n: counts[:, i] for n, i in COLUMNS.items()}
    n = len(counts)
    matches = [_BULLET.match(h) for h in heads]
    mark = np.array([m is not None for m in matches], bool)
    # a bullet such as a) may be taken for a common word
    in_mark = np.array([bool(m) and bool(w := _WORD.findall(m.group().lower())[:1]) and w[0] in COMMON_WORDS for m in matches], np.int64)
    coded = np.array([_CODED.match(h) is not None for h in heads], bool)
    last = [t.rstrip()[-1:] for t in tails]
    ended = np.array([c != "" and c in _STOPS for c in last], bool)
    punct = np.array([c != "" and c in _END for c in last], np.int64)
    ruled = np.array([set((h + t).strip()) <= set("-|=+: ") for h, t in zip(heads, tails)], bool)
    field, tag_chars = np.array(fields, bool), np.array(tags, np.int64)
    body = x["chars"] - x["spaces"]
    common, words = x["common"] - in_mark, x["words"]
    share = common / np.maximum(words, 1)
    seen = x["letters"] + x["digits"]
    symbols = body - seen
    delims = np.maximum(x["commas"], x["semis"])
    blank = x["runs"] == 0
    prose, entry, table, junk = 0, 1, 2, 3
    rules = [
        (tag_chars > 0.5 * x["chars"], junk),
        (x["broken"] > 0.12 * np.maximum(1, x["letters"]), junk),
        ((x["leaders"] > 0) & (words <= 12), entry),
        ((seen < 0.3 * body) & ~ruled & (symbols - x["pipes"] > x["pipes"]), junk),
        ((x["code"] >= 4) & (x["code"] > 0.06 * body) & (x["pipes"] < 2) & (seen < 0.85 * body), junk),
        ((x["pipes"] >= 2) | (x["tabs"] >= 2) | (x["gaps"] >= 2), table),
        ((seen < 0.5 * body) & (body <= 100) & ruled, table),
        (seen < 0.5 * body, junk),
        ((words <= 12) & ~ended & (coded | mark & (share < 0.2)), entry),
        ((x["semis"] >= 2) & (x["semis"] >= 0.15 * words) & (share < 0.3) & (2 * x["loose_semis"] > x["semis"]), entry),
        ((x["semis"] >= 2) & (x["semis"] >= 0.15 * words) & (share < 0.3), table),
        ((x["wide"] > 0.5 * x["letters"]) & ((x["wide"] >= 12) & (x["wide_marks"] > 0) | (x["wide"] >= 40)), prose),
        (x["wide"] > 0.5 * x["letters"], entry),
        ((words >= 4) & (share >= 0.14) & (x["letters"] >= 0.6 * body), prose),
        (field & (words <= 8) & ~mark, table),
        (
            (x["commas"] >= 2) & (words <= 4 * (x["commas"] + 1)) & (x["chars"] < 160) & (x["ends"] <= x["commas"] + 2) & (x["commas"] > x["loose"]) & (2 * x["loose"] <= x["commas"]),
            table,
        ),
        ((x["accents"] > 0.35 * np.maximum(1, x["letters"])) & (share < 0.1), junk),
        (((x["letters"] == 0) | (x["digits"] > 0.6 * body) & (words >= 5)) & ((words >= 5) | (x["digits"] >= 12)), junk),
        ((x["letters"] == 0) | (x["digits"] > 0.6 * body) & (words >= 5), entry),
        (
            (x["plain"] >= 3) & (x["odd"] > 0.4 * x["plain"]) | (x["mixed"] > 0) & (x["mixed"] >= 0.4 * words) | (words <= 3) & (x["word_chars"] > 40),
            junk,
        ),
        ((words >= 8) & (symbols > 0.03 * body) & ended & (delims <= 0.2 * words) & (share >= 0.08), prose),
        # sentences with few of the common words: words in lower case, ended, more than a name or an entry
        (ended & ~mark & (words >= 4) & (x["lower"] >= 0.4 * words) & ((x["stops"] >= 2) | (words >= 6)) & (delims <= 0.3 * words), prose),
    ]
    kind = np.select([c for c, _ in rules], [k for _, k in rules], entry)
    out = np.zeros((n, len(TOTALS)), np.int64)
    out[:, : len(KEPT)] = counts[:, _KEPT]
    put = lambda name, v: out.__setitem__((slice(None), TOTALS[name]), v)
    put("lines", 1)
    put("blank_lines", blank)
    put("lines_end_punct", punct * ~blank)
    put("symbols", symbols * ~blank)
    put("marked", mark & ~blank)
    put("list_words", words * ((kind == entry) & ~blank))
    put("list_common", common * ((kind == entry) & ~blank))
    for i, k in enumerate(KINDS):
        put(f"{k}_chars", body * ((kind == i) & ~blank))
        put(f"{k}_lines", (kind == i) & ~blank)
    return out


def _field(colon: int, after: str, head: str) -> bool:
    """The name of a field, a colon, and a blank or nothing after it."""
    return 1 <= colon <= _FIELD_NAME and not head[0].isspace() and not after.strip()


def whole_lines(lines: list[str], table: Table) -> tuple[np.ndarray, np.ndarray]:
    """Totals and bits of each of the lines."""
    counts, bits = table.measure(lines, True)
    fields = [(k := t.find(":")) > 0 and _field(k, t[k + 1 : k + 2], t) for t in lines]
    tags = [angles(t)[0] if "<" in t else 0 for t in lines]
    return lines_totals(counts, [t[:_EDGE] for t in lines], [t[-_EDGE:] for t in lines], fields, tags), bits


def ended_line(line: Line, table: Table) -> tuple[np.ndarray, np.ndarray]:
    counts, bits = line.ended(table)
    return lines_totals(counts, [line.head], [line.tail], [line.colon > 0 and _field(line.colon, line.after, line.head)], [line.tags[0]]), bits


class Partial:
    """Counts of a chunk of a text: of whole lines, and the open lines at its ends; ``last`` is None if there is one line only."""

    __slots__ = ("first", "last", "total", "bits")

    def __init__(self, text: str | None, table: Table):
        self.total, self.bits = np.zeros(len(TOTALS), np.int64), np.zeros(_SKETCH // 64, np.uint64)
        if text is not None:
            first, *rest = text.split("\n")
            self.first, self.last = Line(first, table), Line(rest[-1], table) if rest else None
            if len(rest) > 1:
                totals, bits = whole_lines(rest[:-1], table)
                self.total, self.bits = totals.sum(axis=0), np.bitwise_or.reduce(bits, axis=0)

    def merged(self, b: Partial, table: Table) -> Partial:
        """Counts of this chunk's text followed by that of ``b``; associative."""
        out = Partial(None, table)
        out.total, out.bits = self.total + b.total, self.bits | b.bits
        seam = (self.last or self.first).joined(b.first, table)
        if self.last is None:
            out.first, out.last = seam, b.last
        elif b.last is None:
            out.first, out.last = self.first, seam
        else:
            totals, bits = ended_line(seam, table)
            out.first, out.last = self.first, b.last
            out.total, out.bits = out.total + totals[0], out.bits | bits[0]
        return out

    def finished(self, table: Table) -> dict:
        total, bits = self.total, self.bits
        for line in (self.first, self.last):
            if line is not None:
                t, b = ended_line(line, table)
                total, bits = total + t[0], bits | b[0]
        return outcome(total, bits)


def outcome(total: np.ndarray, bits: np.ndarray) -> dict:
    """Statistics, ratios and the rule's outcome of a text's totals."""
    t = dict(zip(TOTALS, total.tolist()))
    words, body = t["words"], sum(t[f"{k}_chars"] for k in KINDS)
    filled = t["lines"] - t["blank_lines"]
    distinct = int.from_bytes(bits.tobytes(), "little").bit_count()
    kind = None
    if body:
        best = max(("list", "table", "junk"), key=lambda k: t[f"{k}_chars"])
        other = body - t["prose_chars"]
        kind = best if other > 0.55 * body else "prose"
        marked = filled >= 3 and t["marked"] >= 0.8 * filled
        if kind == "prose" and marked:
            kind = "list"  # an enumeration, if of whole sentences
        elif kind == "list" and not marked and (
            t["list_words"] >= 8 and t["list_common"] >= 0.25 * t["list_words"]
            or t["marked"] < 0.3 * filled and words >= max(8, 4 * filled) and t["lower"] >= 0.6 * words and 25 * t["stops"] >= words
        ):
            kind = "prose"  # in lines too short to tell, or in a language whose common words aren't known
        if kind != "table" and words >= 20 and distinct <= min(12, 0.25 * words):
            kind = "junk"  # a few words over and over
        elif words >= 12 and kind == "list" and distinct <= 0.3 * min(words, 200):
            kind = "junk"
    r = lambda a, b: a / b if b else None
    return {
        "n_chars": t["chars"] + max(0, t["lines"] - 1), "n_words": words, "n_lines": t["lines"], "mean_word_length": r(t["word_chars"], words), "symbol_ratio": r(t["symbols"], body), "digit_ratio": r(t["digits"], body),
        "share_lines_end_punct": r(t["lines_end_punct"], filled), "share_common_words": r(t["common"], words), "share_marked_lines": r(t["marked"], filled), "distinct_words_sketch": distinct,
        "prose_share": r(t["prose_chars"], body), "list_share": r(t["list_chars"], body), "table_share": r(t["table_chars"], body), "junk_share": r(t["junk_chars"], body), "text_kind": kind,
    }


def whole_texts(texts: list[str], table: Table) -> list[dict]:
    """Statistics of whole texts, counted together."""
    out: list[dict] = []
    lines: list[str] = []
    begins: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal lines, begins, size
        if begins:
            totals, bits = whole_lines(lines, table)
            out.extend(map(outcome, np.add.reduceat(totals, begins, axis=0), np.bitwise_or.reduceat(bits, begins, axis=0)))
        lines, begins, size = [], [], 0

    for t in texts:
        begins.append(len(lines))
        lines += t.split("\n")
        size += len(t)
        if size > BATCH_CHARS:
            flush()
    flush()
    return out


def statistics(text: str) -> dict:
    """Statistics of one text."""
    return whole_texts([text], Table())[0]


FIELDS = [
    ("n_chars", pa.int64()), ("n_words", pa.int64()), ("n_lines", pa.int64()), ("mean_word_length", pa.float64()), ("symbol_ratio", pa.float64()), ("digit_ratio", pa.float64()),
    ("share_lines_end_punct", pa.float64()), ("share_common_words", pa.float64()), ("share_marked_lines", pa.float64()), ("distinct_words_sketch", pa.int64()), ("prose_share", pa.float64()),
    ("list_share", pa.float64()), ("table_share", pa.float64()), ("junk_share", pa.float64()), ("text_kind", pa.string()),
]
_SQL = {pa.int64(): "bigint", pa.float64(): "double", pa.string(): "string"}
SCHEMA = ", ".join(f"{n} {_SQL[t]}" for n, t in FIELDS)


def _rows(ids, found: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids, *(pa.array([x[n] for x in found], t) for n, t in FIELDS)], names=["doc_id", *(n for n, _ in FIELDS)])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = Table()
    for b in sliced(batches):
        yield _rows(b.column("doc_id"), whole_texts(b.column("text").to_pylist(), table))


def _fold(found: list[Partial], table: Table) -> Partial:
    while len(found) > 1:  # neighbours by pairs
        found = [found[i].merged(found[i + 1], table) if i + 1 < len(found) else found[i] for i in range(0, len(found), 2)]
    return found[0]


def _kept(state: Partial) -> bytes:
    import pickle

    return pickle.dumps(state)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = Table()
    for b in sliced(batches, 32):
        data = pa.array([_kept(Partial(t, table)) for t in b.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("no"), data], names=["doc_id", "no", "part"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pickle

    table = Table()
    for b in sliced(batches, 32):
        data = pa.array([_kept(_fold([*map(pickle.loads, x)], table)) for x in b.column("parts").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("no"), data], names=["doc_id", "no", "part"])


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pickle

    table = Table()
    for b in sliced(batches, 32):
        yield _rows(b.column("doc_id"), [_fold([*map(pickle.loads, x)], table).finished(table) for x in b.column("parts").to_pylist()])


def each_statistics(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Statistics and kind of every row whose text is not null; long texts of a repeated id once.

    Texts of one chunk are counted where they are read, without a shuffle. The chunks of longer ones are dealt to
    all tasks, so that a huge text isn't one task's; of these the partial counts are shuffled again.
    """
    src = documents.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.regexp_replace(F.col(text_col), "\r\n?", "\n").alias("text"),
    ).where("text is not null")
    size = F.length("text")
    short = src.where(size <= chunk_chars).mapInArrow(_whole, f"doc_id bigint, {SCHEMA}")
    chunks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk_chars}}}"), F.lit(0))  # in one pass over the text
    cut = src.where(size > chunk_chars).select("doc_id", F.posexplode(chunks).alias("no", "text")).repartition("doc_id", "no")
    parts = cut.mapInArrow(_parts, "doc_id bigint, no int, part binary").dropDuplicates(["doc_id", "no"])
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("no", "part"))), lambda x: x["part"]).alias("parts")
    once = parts.groupBy(
        "doc_id", F.floor(F.col("no") / FAN_IN).cast("int").alias("block"),
    ).agg(ordered).withColumnRenamed("block", "no").mapInArrow(_merged, "doc_id bigint, no int, part binary")
    long = once.groupBy("doc_id").agg(ordered).mapInArrow(_finished, f"doc_id bigint, {SCHEMA}")
    return short.unionByName(long)


def text_statistics(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Statistics and kind of every text that is not null: one row per id."""
    return each_statistics(documents, id_col, text_col, chunk_chars).dropDuplicates(["doc_id"])
