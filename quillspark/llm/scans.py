"""Problem 2: repairing text of scanned pages.

Method: lines of a text are told apart (marker, blank, page number, running head, heading, body); body
lines are put end to end, and word segmentation is decoded jointly over the stream of characters by
dynamic programming over a lexicon: from any character a known word may be read, with confused characters
and over any number of blanks, line breaks and their signs, and end where a blank is missing, or a token may
stay as it is, each at a cost; tokens that are known words are the anchors between which there is a choice.
Both the paragraphs and the defects of body lines come from this decoding. Of words run together each has
two letters or more, and only tokens in lower case are cut, as unknown names would fall into words.
Paragraph boundaries are chosen by dynamic programming over the lines.

The lexicon holds the words of the contents of all documents that aren't scanned, counted over the whole corpus, whose share
of all words is ``LEAST_SHARE`` or more, so that a page is read alike in a corpus of any size; there are at most 1 / ``LEAST_SHARE``
of them, which bounds what is sent to the workers. Where the corpus is too small for shares, ``LEAST_COUNT`` and ``COMMON_COUNT``
are the least counts. Chunks aren't counted: they repeat these contents, and their edited copies have misspellings of their own.

Defined results: null and empty texts give no rows; texts of documents that aren't scanned, or that have
no document, are not repaired; repeated keys count once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, released, sliced
from .transcripts import edit_distance

#: Share of all words from which a word is known, and from which it is common; never less than so many times.
LEAST_SHARE, COMMON_SHARE = 1e-6, 1.1e-5
LEAST_COUNT, COMMON_COUNT = 2, 20
#: Known words are of at most so many characters.
LONGEST_WORD = 40
BROADCAST_DOCUMENTS = 100_000
SIGNS = "-‐­¬‑"
SOFT = "‐­¬‑"

# What scanning makes of a character or pair of characters.
CONFUSED = [
    ("e", "c"), ("c", "e"), ("c", "("), ("h", "b"), ("b", "h"), ("b", "6"), ("r", "i"), ("t", "f"), ("f", "t"), ("s", "$"), ("s", "5"), ("a", "@"), ("o", "0"), ("l", "1"), ("l", "|"),
    ("l", "i"), ("i", "l"), ("i", "1"), ("i", "|"), ("i", "!"), ("g", "9"), ("g", "q"), ("q", "g"), ("v", "y"), ("y", "v"), ("u", "v"), ("n", "u"), ("u", "n"), ("z", "2"), ("d", "cl"), ("cl", "d"), ("m", "rn"), ("rn", "m"),
    ("n", "ri"), ("u", "ii"), ("w", "vv"), ("in", "m"), ("li", "h"), ("h", "li"), ("ni", "m"), ("nn", "m"), ("k", "lc"), ("ti", "b"), ("o", "c"), ("a", "o"), ("o", "a"),
]
# End of the fixed values.

#: Each character as a sequence such that confused spellings become the same.
_CANON = {
    "e": "c", "(": "c", "o": "c", "0": "c", "a": "c", "@": "c", "h": "ii", "b": "ii", "6": "ii", "n": "ii", "u": "ii", "r": "i", "l": "i", "1": "i",
    "|": "i", "!": "i", "t": "f", "$": "s", "5": "s", "9": "g", "q": "g", "y": "v", "d": "ci", "m": "iii", "w": "vv", "z": "2",
}
_CANON_TABLE = str.maketrans(_CANON)
_PAIRS: dict[str, list[tuple[str, str]]] = {}
for _true, _seen in CONFUSED:
    _PAIRS.setdefault(_seen[0], []).append((_true, _seen))

_MARKER = re.compile(r"^\s*={2,}.*={2,}\s*$")
_DIGIT = "0-9lI|oOSsBbgqZz$i!"
_NUMBER = re.compile(rf"^[-–—\[({{.~]*(?:p[a-z@(]{{0,3}}[.,:]?)?([{_DIGIT}]{{1,5}})(?:(?:of|0f|/|ot|cf|de)([{_DIGIT}]{{1,5}}))?[-–—\])}}~]*$", re.I)
_ROMAN = re.compile(r"^[-–—\[(]*m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,4})(?:ix|iv|v?i{0,4})[-–—\])]*$", re.I)
_HEADING = re.compile(r"^\s*(?:\d{1,3}[.)]\s+|[IVX]{1,5}[.)]\s+)?\S+(?:\s+\S+){0,6}\s*$")
_EDGES = ".,;:!?\"'“”’‘«»[]{}…)"
_CODE = re.compile(r"^[A-Z]{2,4}-\d{1,2}\.[A-Z]\.\d{1,2}[a-z]?$")
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_BAD_INSIDE = re.compile(r"[^\W\d_][0-9@$|(!][^\W\d_]|[^\W\d_]{2,}[0-9@$|]$|^[0-9@$|][^\W\d_]{2,}|[^\W\d_][|@$]")


def canon(word: str) -> str:
    return word.translate(_CANON_TABLE)


def word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """(word, n) of all texts; counted in the worker before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        flush = lambda: pa.RecordBatch.from_arrays(
            [pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], names=["word", "n"],
        )
        for b in sliced(batches):
            for t in b.column("t").to_pylist():
                count.update(_WORD.findall(t.lower()))
            if len(count) > 500_000:
                yield flush()
                count.clear()
        yield flush()

    return texts.select(F.col(text_col).alias("t")).where("t is not null").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Lexicon:
    """Known words with their counts, and the counts from which a word is known and common."""

    words: dict[str, int]
    least: int = LEAST_COUNT
    common: int = COMMON_COUNT


def lexicon(counts: DataFrame) -> Lexicon:
    """The known words: at most 1 / ``LEAST_SHARE`` rows come to the driver."""
    counts = materialise(counts)
    total = counts.agg(F.sum("n")).first()[0] or 0
    least, common = max(LEAST_COUNT, math.ceil(LEAST_SHARE * total)), max(COMMON_COUNT, math.ceil(COMMON_SHARE * total))
    rows = counts.where((F.col("n") >= least) & (F.length("word") <= LONGEST_WORD)).orderBy("word").toArrow()
    released(counts)
    return Lexicon(dict(zip(rows.column("word").to_pylist(), rows.column("n").to_pylist())), least, common)


class Decoder:
    """Known words and the decoding of others; remembers what it has decoded."""

    def __init__(self, known: Lexicon):
        words = self.words = known.words
        self.common, self.some = known.common, math.ceil(1.5 * known.least)
        self.by_canon: dict[str, list[str]] = {}
        self.by_delete: dict[str, list[str]] = {}
        for w, n in words.items():
            self.by_canon.setdefault(canon(w), []).append(w)
            if n >= self.common and 5 <= len(w) <= 24:
                for i in range(len(w)):
                    self.by_delete.setdefault(w[:i] + w[i + 1 :], []).append(w)
        self.memo: dict[str, tuple[str, float] | None] = {}
        self.prefixes = {w[:i] for w in words for i in range(1, len(w) + 1)}
        self.longest = max(map(len, words), default=0)
        self.first_parts = {w.split("-")[0] for w in words if "-" in w}

    def starts_compound(self, word: str) -> bool:
        return word in self.first_parts

    def known(self, word: str) -> bool:
        if word in self.words or not any(c.isalpha() for c in word):
            return True
        if "-" in word:
            return all(p in self.words for p in word.split("-") if p)
        return len(word) > 2 and word[-2:] in ("'s", "’s") and word[:-2] in self.words

    def cost(self, seen: str, true: str) -> float:
        """Cheapest way to read ``true`` as ``seen``: 1 for a confusion, 2 for any other change of a character."""
        a, b = len(seen), len(true)
        far = 9.0
        row = [[far] * (b + 1) for _ in range(a + 1)]
        row[0][0] = 0.0
        for i in range(a + 1):
            for j in range(max(0, i - 4), min(b, i + 4) + 1):
                c = row[i][j]
                if c >= far:
                    continue
                if i < a and j < b:
                    d = c + (0 if seen[i] == true[j] else 2)
                    if d < row[i + 1][j + 1]:
                        row[i + 1][j + 1] = d
                if i < a:
                    row[i + 1][j] = min(row[i + 1][j], c + 2)
                    for t, s in _PAIRS.get(seen[i], ()):
                        if seen.startswith(s, i) and true.startswith(t, j) and c + 1 < row[i + len(s)][j + len(t)]:
                            row[i + len(s)][j + len(t)] = c + 1
                if j < b:
                    row[i][j + 1] = min(row[i][j + 1], c + 2)
        return row[a][b]

    def read(self, word: str, capital: bool = False) -> tuple[str, float] | None:
        """The known word that was most likely read as ``word`` (in lower case), and the cost."""
        key = word + ("^" if capital else "")
        if key in self.memo:
            return self.memo[key]
        if len(self.memo) > 200_000:
            self.memo.clear()
        most = 1 if len(word) <= 3 else 2 if len(word) <= 8 else 3
        found = [(self.cost(word, w), -self.words[w], w) for w in self.by_canon.get(canon(word), ())]
        found = [x for x in found if 0 < x[0] <= most]
        if not found and not capital and 5 <= len(word) <= 24:
            near = {w for i in range(len(word)) for w in self.by_delete.get(word[:i] + word[i + 1 :], ())} | set(self.by_delete.get(word, ()))
            near |= {w for w in (word[:i] + word[i + 1 :] for i in range(len(word))) if self.words.get(w, 0) >= self.common}
            found = [(self.cost(word, w), -self.words[w], w) for w in near]
            found = [x for x in found if 0 < x[0] <= 2]
        if not found and "-" in word:
            parts = [p if self.known(p) else (self.read(p) or ("", 9.0))[0] for p in word.split("-")]
            if all(parts) and len(parts) > 1:
                found = [(1.0, 0, "-".join(parts))]
        self.memo[key] = min(found)[2:] + (min(found)[0],) if found else None
        return self.memo[key]

    def arcs(self, chars: str, blanks: set[int], signs: set[int], start: int) -> dict[tuple[int, str], tuple[int, int]]:
        """Known words that may be read from ``start`` on: (end, word) with (confusions, blanks inside), cheapest first.

        A blank stands before each position of ``blanks`` and may be left out, as may the character at each of ``signs``.
        """
        found: dict[tuple[int, str], tuple[int, int]] = {}
        seen: dict[tuple[int, str], tuple[int, int]] = {}
        stack = [(start, "", 0, 0)]
        while stack:
            i, word, c, b = stack.pop()
            old = seen.get((i, word))
            if old is not None and old[0] <= c and old[1] <= b:
                continue
            seen[i, word] = (c, b)
            if word in self.words and (i, word) not in found or (i, word) in found and (c, b) < found[i, word]:
                found[i, word] = (c, b)
            if i == len(chars):
                continue
            if i in signs and word:
                stack.append((i + 1, word, c, b))
            inside = b + (i in blanks and i > start)
            if word + chars[i] in self.prefixes:
                stack.append((i + 1, word + chars[i], c, inside))
            if c < 2:
                for true, read in _PAIRS.get(chars[i], ()):
                    if word + true in self.prefixes and chars.startswith(read, i):
                        within = sum(k in blanks for k in range(i + 1, i + len(read)))
                        stack.append((i + len(read), word + true, c + 1, inside + within))
        return found


def core(token: str) -> tuple[str, str, str]:
    """Marks before, the word, marks after."""
    a, z = 0, len(token)
    while z > a and token[z - 1] in _EDGES:
        z -= 1
    while a < z and token[a] in "\"'“”’‘«»[{":
        a += 1
    if a < z and token[a] == "(" and (")" in token[a:] or token[a + 1 : a + 2].isupper() or token[a + 1 : a + 2].isdigit()):
        a += 1
    return token[:a], token[a:z], token[z:]


def wrong(token: str, d: Decoder, fragment: bool = False) -> bool:
    """Whether a token is a wrongly recognised word. A fragment is only a part of a word."""
    _, w, _ = core(token)
    if not w or _CODE.match(w):
        return False
    low = w.lower()
    if re.fullmatch(r"[\d.,:%/–-]+(?:st|nd|rd|th|s|pm|am)?", low):
        return False
    if re.fullmatch(r"[\dOoIl|SB]+", w) and any(c.isdigit() for c in w):
        return True
    if not any(c.isalpha() for c in w) or low in d.words:
        return False
    if _BAD_INSIDE.search(w) or w[0] == "(" and len(w) > 3:
        return fragment or d.read(low) is not None or not re.search(r"\d", w) or any(c.islower() for c in w)
    if d.known(low):
        return False
    if fragment:  # no part of a word is likely to be a long word with one confusion
        found = d.read(low, True) if len(low) >= 5 else None
        return found is not None and found[1] <= 1
    capital = w[0].isupper()
    found = d.read(low, capital)
    if found:
        return not capital or found[1] <= 2 and d.words[found[0]] >= d.some if found[0] in d.words else True
    return False


def _letters(s: str) -> str:
    return re.sub(r"[^a-z]", "", s.lower().translate(str.maketrans("01$5@69(", "olssabgc")))


def _slug(path: str | None) -> tuple[str, str]:
    """Title and organisation as letters, from the file's path."""
    parts = [p for p in (path or "").split("/") if p]
    title = re.sub(r"(?:_\d+)?\.[a-z0-9]{1,5}$", "", parts[-1]) if parts else ""
    return _letters(title), _letters(parts[-2]) if len(parts) > 1 else ""


class Heads:
    """What the running heads of a document may say."""

    def __init__(self, title: str | None, path: str | None, sections: list[str] | None = None):
        self.sections = sections or []
        slug, org = _slug(path)
        self.titles = [t for t in dict.fromkeys([_letters(title or ""), slug]) if len(t) >= 6]
        self.org = org if len(org) >= 5 else ""

    def match(self, line: str) -> bool:
        words = line.split()
        if not words or len(line.strip()) > 110 or sum(w[0].isupper() or not w[0].isalpha() or len(w) <= 2 for w in words) < 0.5 * len(words):
            return False
        said = _letters(re.sub(r"^\s*\d[\dOIl]*\s{2,}|\s{2,}[\dOIl]+\s*$|^\s*\d+\s+|\s+\d+\s*$", " ", line))
        if len(said) < 5:
            return False
        for t in self.titles:
            if edit_distance(said, t, max(2, len(t) // 4)) <= max(2, len(t) // 4):
                return True
        for t in self.sections:
            if edit_distance(said, t, max(1, len(t) // 5)) <= max(1, len(t) // 5):
                return True
        if self.org:
            most = max(2, len(self.org) // 4)
            if edit_distance(said, self.org, most) <= most:
                return True
            m = re.search(r"\s[|\-–—•·:/]\s", line)
            if m and len(words) <= 12:
                for part in (line[: m.start()], line[m.end() :]):
                    if edit_distance(_letters(part), self.org, most) <= most:
                        return True
                for part in (line[: m.start()], line[m.end() :]):
                    if any(edit_distance(_letters(part), t, max(2, len(t) // 4)) <= max(2, len(t) // 4) for t in self.titles):
                        return True
        return False


def page_number(line: str) -> bool:
    tight = re.sub(r"\s+", "", line)
    if not 0 < len(tight) <= 24:
        return False
    m = _NUMBER.match(tight)
    if m:
        body = m.group(1)
        return any(c.isdigit() for c in tight) or tight.lower().startswith("p") and len(tight) > 2 and len(body) < len(tight) - 1 or len(body) >= 2 and set(body) <= set("lI|1O0")
    return bool(_ROMAN.match(tight)) and any(c.isalpha() for c in tight)


def kinds(lines: list[str], heads: Heads) -> list[str]:
    """marker, blank, page_number, running_head, heading or body of each line."""
    out = []
    for line in lines:
        if _MARKER.match(line):
            out.append("marker")
        elif not line.strip():
            out.append("blank")
        elif page_number(line):
            out.append("page_number")
        elif heads.match(line):
            out.append("running_head")
        else:
            out.append("body")
    for i, line in enumerate(lines):
        if out[i] == "body" and len(line.strip()) <= 60 and _HEADING.match(line) and line.rstrip()[-1] not in ".,;:!?" + SIGNS:
            words = [w for w in line.split() if any(c.isalpha() for c in w)]
            before = next((out[j] for j in range(i - 1, -1, -1)), "edge")
            if words and len(words) <= 6 and all(w[0].isupper() or w[0] in "0158$|6@(9" for w in words) and (
                before != "body" or lines[i - 1].rstrip()[-1:] in ".!?" and len(words) > 1
            ) and (len(words) > 1 or line.isupper()):
                after = next((lines[j].split() for j in range(i + 1, len(lines)) if out[j] == "body"), None)
                if after is None or after[0][:1].isupper() or not after[0][:1].isalpha():
                    out[i] = "heading"
    return out


def _title_like(line: str) -> bool:
    words = line.split()
    if not 0 < len(words) <= 7 or len(line.strip()) > 50 or line.rstrip()[-1] in ".,;:!?" + SIGNS:
        return False
    return sum(w[0].isupper() or len(w) <= 2 and w.isalpha() for w in words) >= 0.6 * len(words) and words[0][0].isupper() and len(_letters(line)) >= 6


def section_heads(text: str, title: str | None, path: str | None) -> list[str]:
    """Letters of running heads that name a section: lines like titles that come back from page to page."""
    lines = text.split("\n")
    kind = kinds(lines, Heads(title, path))
    found: list[list] = []  # letters, times, times at a page's edge, whether one stands amid a sentence
    for i, line in enumerate(lines):
        if kind[i] not in ("body", "heading") or not _title_like(line):
            continue
        before = next((lines[j].rstrip() for j in range(i - 1, -1, -1) if kind[j] == "body" and not _title_like(lines[j])), "")
        after = next((lines[j].lstrip() for j in range(i + 1, len(lines)) if kind[j] == "body" and not _title_like(lines[j])), "")
        # amid a sentence no heading stands
        amid = len(line.split()) > 1 and (before != "" and before[-1] not in ".!?\"”" or after[:1].islower())
        odd = amid or "page_number" in kind[max(0, i - 1) : i + 2] or i > 0 and kind[i - 1] == "marker"
        said = _letters(line)
        for g in found:
            if edit_distance(said, g[0], max(1, len(g[0]) // 5)) <= max(1, len(g[0]) // 5):
                g[1] += 1
                g[2], g[3] = g[2] + odd, g[3] or amid
                break
        else:
            found.append([said, 1, int(odd), amid])
    plain = "running_head" not in kind
    return [g[0] for g in found if g[3] or g[2] >= 2 or g[2] and plain]


def joined(first: str, second: str, sign: str, d: Decoder) -> tuple[str, bool] | None:
    """How two parts around a sign at a line's end are written, and whether the sign was added for the break."""
    if not any(c.isalpha() for c in first) or not second[:1].isalpha():
        return None
    a, b = core(first)[1].lower(), core(second)[1].lower()
    whole, apart = a + b, f"{a}-{b}"
    if sign in SOFT:
        return first + second, True
    n, m = d.words.get(whole, 0), d.words.get(apart, 0)
    if not n and not m:
        seen_whole, seen_apart = d.read(whole), d.read(apart) if "-" not in whole else None
        tail = apart.rpartition("-")
        if d.known(whole):
            n = 1
        elif seen_whole and seen_whole[0] in d.words and (not seen_apart or seen_whole[1] <= seen_apart[1]):
            n = 1
        elif seen_apart and seen_apart[0] in d.words or tail[0] in d.words and tail[2] in d.words and len(b) > 3 and len(a) > 3 and first[:1].islower() and any(w in d.words for w in (f"{a}-{b}",)):
            m = 1
    return (f"{first}-{second}", False) if m > n else (first + second, True)


def analyse(text: str, heads: Heads, d: Decoder) -> tuple[list[str], list[tuple[int, str]]]:
    """Kinds of the lines, and (line from 1, defect): those of body lines are the edits of decoding them."""
    lines = text.split("\n")
    kind = kinds(lines, heads)
    defects = {(i + 1, k) for i, k in enumerate(kind) if k in ("page_number", "running_head")}
    runs: list[list[int]] = [[]]
    for i, k in enumerate(kind):
        if k == "body":
            runs[-1].append(i)
        elif k == "heading" and runs[-1]:
            runs.append([])
    if not runs[-1] and len(runs) > 1:
        runs.pop()
    for at, run in enumerate(runs):
        edits = decoded([(i, lines[i]) for i in run], d, at + 1 == len(runs))[1]
        defects |= {(i + 1, k) for i, k in edits}
    return kind, sorted(defects)


def paragraphs(text: str, heads: Heads, d: Decoder) -> list[str]:
    """Continuous repaired paragraphs; heads, page numbers and markers are left out."""
    lines = text.split("\n")
    kind = kinds(lines, heads)
    rows = [i for i, k in enumerate(kind) if k in ("body", "heading")]
    if not rows:
        return []
    width = sorted(len(lines[i].rstrip()) for i in rows)[int(0.9 * (len(rows) - 1))] or 1
    # Viterbi over two states of each line: it begins a paragraph, or goes on with the one before
    best, back = [(0.0, 50.0)], []
    for p, i in zip(rows, rows[1:]):
        between = kind[p + 1 : i]
        line, prev = lines[i], lines[p].rstrip()
        begin, go = 2.0, 0.0
        if "blank" in between:
            go += 6 if not any(k in ("page_number", "running_head", "marker") for k in between) else 3
        if kind[i] == "heading" or kind[p] == "heading":
            go += 20
        if line[:2].isspace() and not lines[p][:2].isspace():
            go += 4
        if prev[-1:] in SIGNS:
            begin += 12
        elif prev[-1:] not in ".!?:\"”’»":
            begin += 4
        if len(prev) < 0.6 * width and prev[-1:] in ".!?":
            go += 3
        if line.lstrip()[:1].islower():
            begin += 4
        old = best[-1]
        pick = (0 if old[0] + (0.5 if kind[p] == "body" else 0) <= old[1] else 1)
        best.append((min(old[0] + 0.5, old[1]) + begin, min(old) + go))
        back.append((pick, 0 if old[0] <= old[1] else 1))
    state = [0 if best[-1][0] <= best[-1][1] else 1]
    for b in reversed(back):
        state.append(b[state[-1]])
    state.reverse()
    groups: list[list[int]] = []
    for i, s in zip(rows, state):
        if s == 0 or not groups:
            groups.append([])
        groups[-1].append(i)
    return [decoded([(i, lines[i]) for i in g], d)[0] for g in groups]


class Token:
    """A word of the stream with its marks; one broken at a line's end has parts on several lines."""

    __slots__ = ("text", "pre", "word", "post", "chars", "signs", "parts", "plain", "held")

    def __init__(self, text: str, line: int):
        self.parts, self.signs, self.held = [(0, line)], set(), ""
        self.put(text)

    def put(self, text: str) -> None:
        self.text = text
        self.pre, self.word, self.post = core(text)
        self.chars = self.word

    def join(self, text: str, second: str, line: int) -> None:
        """Go on with ``second`` of the next line; ``text`` is both as they are written."""
        before, signs = self.chars[:-1], set(self.signs)
        self.parts.append((len(before), line))
        self.put(text)
        self.chars, self.signs = before + "-" + core(second)[1], signs | {len(before)}

    def lines_wrong(self, d: Decoder, fragment: bool) -> list[int]:
        """Lines on which the word is wrongly recognised."""
        if not wrong(self.held or self.text, d, fragment):
            return []
        if len(self.parts) == 1:
            return [self.parts[0][1]]
        cuts = [k for k, _ in self.parts] + [len(self.chars)]
        pieces = [self.chars[x:y].lstrip("-") for x, y in zip(cuts, cuts[1:])]
        bad = [line for (_, line), piece in zip(self.parts, pieces) if wrong(piece, d, True)]
        if bad:
            return bad
        # where the whole word differs from what it should be
        true = d.read(self.word.lower(), self.word[:1].isupper())
        k = next((k for k, (x, y) in enumerate(zip(self.word.lower(), true[0])) if x != y), len(self.word)) if true else 0
        return [[line for start, line in self.parts if start <= k][-1]]


def tokens_of(rows: list[tuple[int, str]], d: Decoder, last: bool) -> tuple[list[Token], set[tuple[int, str]]]:
    """The words of lines put end to end, and the breaks with a sign; ``last`` if no body line follows."""
    out: list[Token] = []
    edits: set[tuple[int, str]] = set()
    end = ""
    for no, line in rows:
        words = line.split()
        if out and words and end[-1] in SIGNS and len(end) > 1:
            prev, second, sign = out[-1], words[0], end[-1]
            first = prev.text[:-1]
            how = joined(first, second, sign, d)
            breaks = None
            if end[-2].isalnum():
                if _CODE.match(core(prev.text + second)[1]):
                    how, breaks = None, False  # a code's own hyphen
                elif how and (second[:1].islower() or not second[:1].isalpha() or end.isupper()):
                    breaks = how[1]
                else:
                    breaks = sign in SOFT or bool(second[:1] in "@$|0165(9") and len(second) > 1 and any(c.isalpha() for c in second)
                if breaks:
                    edits.add((prev.parts[-1][1], "hyphen_break"))
            if how or breaks is not None:
                prev.join(how[0] if how else first + second if breaks else prev.text + second, second, no)
                words = words[1:]
                if not words:
                    end = second
                    continue
        out += [Token(w, no) for w in words]
        end = words[-1] if words else end
    if last and out and end[-1] in SIGNS and len(end) > 1 and end[-2].isalnum():
        a = core(end[:-1])[1].lower()
        if not (end[-1] == "-" and d.known(a) and d.starts_compound(a)):
            edits.add((out[-1].parts[-1][1], "hyphen_break"))
        out[-1].held = out[-1].text[:-1]
    return out, edits


def _single(t: Token, d: Decoder, fragment: bool) -> list[tuple[float, str, list[int]]]:
    """(cost, reading, lines that are wrong) of a token by itself."""
    bad = t.lines_wrong(d, fragment)
    if t.plain:
        return [(0.0, t.text, bad)]
    out = [(4.0 + 0.7 * max(0, len(t.word) - 6), t.text, bad)]
    if (bad or fragment and t.lines_wrong(d, False)) and not _CODE.match(t.word) and (found := d.read(t.word.lower(), t.word[:1].isupper())):
        out.append((1.0 + 0.5 * found[1], t.pre + _cased(found[0], t.word) + t.post, bad))
    return out


def _lower(s: str) -> str:
    return "".join(x if len(x := c.lower()) == 1 else c for c in s)


def _region(tokens: list[Token], d: Decoder, fragment: bool) -> tuple[list[str], list[int]]:
    """Words and wrong lines of tokens without marks between them: the cheapest way through their characters."""
    starts, raw, signs = [], "", set()
    for t in tokens:
        starts.append(len(raw))
        signs |= {len(raw) + k for k in t.signs}
        raw += t.chars
    m, chars, blanks = len(raw), _lower(raw), set(starts[1:])
    ends = [*starts[1:], m]
    of = [k for k, t in enumerate(tokens) for _ in t.chars]
    lines: list[int] = []
    for t in tokens:
        cuts = [at for at, _ in t.parts] + [len(t.chars)]
        lines += [line for (at, line), to in zip(t.parts, cuts[1:]) for _ in range(to - at)]
    first, final = dict(zip(starts, range(len(tokens)))), set(ends)
    best: list[tuple[float, int, str, list[int]]] = [(0.0, 0, "", [])] + [(1e9, 0, "", [])] * m

    def offer(i: int, j: int, cost: float, text: str, bad: list[int]) -> None:
        if best[i][0] + cost < best[j][0]:
            best[j] = (best[i][0] + cost, i, text, bad)

    for i in range(m):
        if best[i][0] >= 1e9:
            continue
        at = first.get(i)
        if at is not None:
            for cost, text, bad in _single(tokens[at], d, fragment and at == 0):
                offer(i, ends[at], cost, text, bad)
        for (j, word), (c, b) in d.arcs(chars, blanks, signs, i).items():
            over = range(of[i], of[j - 1] + 1)
            if all(tokens[k].plain for k in over):
                continue
            cut = ([over[0]] if at is None else []) + ([over[-1]] if j not in final else [])
            n = len(word)
            if cut:
                if any(not tokens[k].word.islower() or len(tokens[k].word) < 5 and not b for k in cut):
                    continue
                if n < 2 or n < 4 and d.words[word] < d.common or c > 1 or c and n < (3 if d.words[word] >= d.common else 5):
                    continue
            elif not b and (c > (1 if n <= 8 else 2) or n < 5 or c and not raw[i:j].islower()):
                continue
            if b:
                inner = [k for k in range(i + 1, j) if k in blanks]
                if n < 4 or c and (n < 6 or c > (1 if n <= 8 else 2)) or not raw[i:j].isupper() and any(raw[k].isupper() for k in inner):
                    continue
            bad = {lines[i] for _ in cut[:1]}
            if c:
                bad |= {lines[k] for k in range(i, j) if not tokens[of[k]].plain}
            if b:
                bad |= {lines[k] for k in inner if lines[k - 1] == lines[k]}
            text = (tokens[at].pre if at is not None else "") + _cased(word, raw[i:j]) + (tokens[over[-1]].post if j in final else "")
            offer(i, j, b + (1.0 + 0.5 * c if c else 0.0) + (0.0 if j in final else 2.6) + 0.01 / (1 + d.words[word]), text, sorted(bad))
    words, bad, j = [], [], m
    while j:
        _, i, text, lines_bad = best[j]
        words.append(text)
        bad += lines_bad
        j = i
    return words[::-1], bad


def decoded(rows: list[tuple[int, str]], d: Decoder, last: bool = False) -> tuple[str, set[tuple[int, str]]]:
    """Lines with their numbers put end to end and decoded: the text, and (line, defect) of what was changed.

    Words that are known by themselves stay; about each that isn't, characters are read as far as a word can go.
    """
    tokens, edits = tokens_of(rows, d, last)
    for t in tokens:
        t.plain = d.known(t.word.lower())
    fragment = bool(rows) and rows[0][0] == 0 and not rows[0][1].split()[0][:1].isupper()
    out: list[str] = []
    done, n = 0, len(tokens)

    def linked(k: int) -> bool:
        return not tokens[k].post and not tokens[k + 1].pre and tokens[k].word != "" and tokens[k + 1].word != ""

    def upto(k: int) -> None:
        nonlocal done
        for i in range(done, k):
            out.append(tokens[i].text)
            edits.update((line, "misread") for line in tokens[i].lines_wrong(d, fragment and i == 0))
        done = max(done, k)

    i = 0
    while i < n:
        if tokens[i].plain:
            i += 1
            continue
        a = i
        room = d.longest
        while a > done and linked(a - 1) and room > 0:
            a -= 1
            room -= len(tokens[a].word)
        z, room = i, d.longest
        while z + 1 < n and linked(z) and room > 0:
            z += 1
            room = room - len(tokens[z].word) if tokens[z].plain else d.longest
        upto(a)
        words, bad = _region(tokens[a : z + 1], d, fragment and a == 0)
        out += words
        edits.update((line, "misread") for line in bad)
        done = i = z + 1
    upto(n)
    return " ".join(out), edits


def decode(lines: list[str], d: Decoder) -> str:
    """One paragraph: the lines put end to end, and its words decoded jointly."""
    return decoded(list(enumerate(lines, 1)), d)[0]


def _cased(word: str, like: str) -> str:
    if len(like) > 1 and like.isupper():
        return word.upper()
    return word[:1].upper() + word[1:] if like[:1].isupper() else word


def _sections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        rows = zip(*(b.column(c).to_pylist() for c in ("text", "title", "path")))
        found = [section_heads(t, title, path) if t else [] for t, title, path in rows]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("id", "text", "title", "path")), pa.array(found, pa.list_(pa.string()))],
            names=["id", "text", "title", "path", "sections"],
        )


def scanned_documents(documents: DataFrame) -> DataFrame:
    """(id, text, title, path, sections) of scanned documents, once each."""
    once = documents.where("is_scanned and id is not null").groupBy("id").agg(
        F.max("content").alias("text"), F.max("metadata.title").alias("title"), F.max("source_path").alias("path"),
    )
    return once.mapInArrow(_sections, "id string, text string, title string, path string, sections array<string>")


def scanned_texts(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """(field_name, record_key, text, title, path, sections) of the two fields of scanned documents."""
    content = scanned_documents(documents)
    about = materialise(content.drop("text"))
    if about.count() <= BROADCAST_DOCUMENTS:
        about = F.broadcast(about)
    # beyond that size Spark's join by shuffle, which splits the rows of a hot document between tasks
    pieces = chunks.where(
        "text is not null and document_id is not null"
    ).select("chunk_id", "text", "document_id").join(about, F.col("document_id") == F.col("id"))
    rest = ("text", "title", "path", "sections")
    return content.where("text is not null").select(F.lit("source_document.content").alias("field_name"), F.col("id").alias("record_key"), *rest).unionByName(
        pieces.select(F.lit("knowledge_main.text").alias("field_name"), F.col("chunk_id").cast("string").alias("record_key"), *rest)
    )


def corpus_lexicon(documents: DataFrame) -> Lexicon:
    return lexicon(word_counts(documents.where("not coalesce(is_scanned, false)"), "content"))


def _each(words, run_one, names: list[str], types: list[pa.DataType]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = None
        for b in sliced(batches):
            d = d or Decoder(words.value)
            out: list[tuple] = []
            for field, key, text, title, path, sections in zip(
                *(b.column(c).to_pylist() for c in ("field_name", "record_key", "text", "title", "path", "sections"))
            ):
                out += [(field, key, *x) for x in run_one(text, Heads(title, path, sections), d)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)

    return run


def defects(texts: DataFrame, words: Lexicon) -> DataFrame:
    """(field_name, record_key, line_no, defect)."""
    shared = texts.sparkSession.sparkContext.broadcast(words)
    run = _each(
        shared, lambda t, h, d: analyse(t, h, d)[1], ["field_name", "record_key", "line_no", "defect"],
        [pa.string(), pa.string(), pa.int64(), pa.string()],
    )
    return texts.mapInArrow(run, "field_name string, record_key string, line_no bigint, defect string").distinct()


def repaired(texts: DataFrame, words: Lexicon) -> DataFrame:
    """(field_name, record_key, paragraph_no, paragraph)."""
    shared = texts.sparkSession.sparkContext.broadcast(words)
    run = _each(
        shared, lambda t, h, d: enumerate(paragraphs(t, h, d), 1), ["field_name", "record_key", "paragraph_no", "paragraph"],
        [pa.string(), pa.string(), pa.int32(), pa.string()],
    )
    return texts.dropDuplicates(["field_name", "record_key"]).mapInArrow(
        run, "field_name string, record_key string, paragraph_no int, paragraph string",
    )
