"""Problem 3: raw transcripts into clean speaker turns.

Method: an Aho-Corasick automaton, one for each recording, finds the labels of its speakers (and pieces of their
names, for labels spelt wrong), fillers, words of sounds and the marks about notes; context rules decide which hits
count (a label only as a whole, at the head of an utterance and followed by a mark that ends labels, a note only
between two marks of a kind, a filler only as whole words and, where it may be speech, by the words and marks
beside it and the recording's language); the intervals of the hits that count are subtracted from the utterance;
windows over the utterances in order of time build the turns.

An utterance begins at a line with a mark of its own (a clock time, a cue, ``>>`` or a header line with a
name and a time); other lines go on with the utterance before them. An utterance without a label goes on
with the speaker before it. A label is matched to the roster by full name, parts of it, initials, title
and last name, role, number, or a spelling near one full name.

Defined results: a recording without speech gives no turn; a null or blank transcript is replaced by the
recording's chunks, ordered by ``chunk_index`` where that is complete and distinct, else by
``time_start``; labels that are on no roster, or speech before any label, have ``speaker_no`` 0; repeated
ids count once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import sliced
from .quality import COMMON_BY_LANGUAGE

# Hesitation sounds and empty phrases that are no speech, and labels of unknown persons.
HESITATIONS = """uh uhh uhhh um umm ummm er err erm ah ahh eh ehh eeh em emm hm hmm hmmm mm mmm mhm mm-hmm mmhmm uh-huh huh oh äh ähm hä ehm euh heu
este este...""".split()
PHRASES = ["you know", "i mean", "like,", "kind of", "sort of", "okay so", "well,", "o sea", "pues", "bueno,"]
UNKNOWN_LABELS = [
    "unknown speaker", "unknown", "unidentified voice", "unidentified speaker", "unidentified", "audience member", "audience", "caller", "speaker ?",
    "spk_?", "multiple speakers", "all", "voice", "participant",
]
#: Words before the number of a speaker.
NUMBERED = ["speaker", "spk", "spkr", "s", "sprecher", "hablante", "locuteur", "voice", "person"]
#: Marks that open a note, the one that closes it, and how many characters may stand between.
NOTE_MARKS = [("[", "]", 80), ("{", "}", 80), ("<", ">", 80), ("(", ")", 80), ("*", "*", 60), ("♪", "♪", 200)]
# End of the fixed values.

_TIME = r"(?:\d{1,2}:)?\d{1,3}:\d{2}(?:[.,]\d{1,3})?"
_CUE = re.compile(rf"^\s*({_TIME})\s*-->\s*{_TIME}.*$")
_BRACKETED = re.compile(rf"^\s*[\[(]\s*({_TIME})\s*[\])]\s*")
_PIPED = re.compile(rf"^\s*({_TIME})\s*\|\s*")
_CHEVRON = re.compile(r"^\s*>>\s*")
_NAME_TIME = re.compile(rf"^\s*(\S.{{0,60}}?)\s*[\[(]\s*({_TIME})\s*[\])]\s*:?\s*$")
_NAME_SPACES_TIME = re.compile(rf"^\s*(\S.{{0,60}}?)(?:\s{{2,}}|\t)\s*({_TIME})\s*$")
_VOICE = re.compile(r"^\s*<v(?:\.\S+)?\s+([^>]{1,80})>\s*", re.I)
_LABEL_END = re.compile(r"\s*(\([^()]{1,40}\))?\s*(?::(?!\d)|\||\s-\s|\s–\s|\s—\s|>)\s*")
_NUMBER_AFTER = re.compile(r"[\s_#-]*0*(\d{1,4})$")
_TITLE = re.compile(r"^(?:dr|mr|mrs|ms|prof|sr|sra|hr|fr|herr|frau|m|mme)\.?\s+", re.I)
_CUT_OFF = re.compile(r"\b([^\W\d_]{1,6})- (?=\1)", re.I)
_WORDS = re.compile(r"[^\W_]+")
# Words of sounds that stand in round brackets.
SOUNDS = """laughter laughs laughing laugh applause claps clapping cough coughs coughing sigh sighs sighing noise noises music playing phone rings ringing door
closes closing opens slams knock knocks chair scrapes crosstalk chatter background inaudible unintelligible pause silence static beep whisper whispers murmur
murmurs breath breathes inhales exhales clears throat sniffs gasps footsteps typing paper rustles rustling bell buzz click risas aplausos tos ruido música silencio
inaudible suspira puerta teléfono rires applaudissements toux bruit musique soupir lachen beifall husten geräusch musik""".split()
# Words before a phrase, or after it, with which it is real speech; phrases that need a mark after them; words of other languages.
_NOUN_BEFORE = "what which any some all no same other different new certain a the this that these those another each every one two many".split()
REAL_AFTER = {
    "kind of": {*_NOUN_BEFORE}, "sort of": {*_NOUN_BEFORE}, "you know": {*"as what if do did how don't didn't would should could whatever who".split()},
    "i mean": {*"what do did how if whatever".split()}, "like,": {*"look looks looked feel feels felt sound sounds seem seems would i'd we'd they'd".split()},
    "bueno,": {*"es muy ser fue era sería más tan lo algo nada".split()},
}
REAL_BEFORE = {"okay so": {"far"}}
NEEDS_MARK = {"you know", "i mean", "o sea", "este"}
REAL_IN = {"de": {"um", "er"}, "pt": {"em", "um"}}
# End of the fixed values.
_WORD_BEFORE = re.compile(r"([^\s,.;:!?…]+)\s*$")
_WORD_AFTER = re.compile(r"\s*([^\W\d_]+)")
_LANGUAGES = {k: frozenset(w.split()) for k, w in COMMON_BY_LANGUAGE.items()}


def seconds(clock: str) -> float:
    total = 0.0
    for part in clock.replace(",", ".").split(":"):
        total = total * 60 + float(part)
    return total


def _automaton(more: dict[str, list[tuple]]):
    """Finds fillers, words of sounds and marks of notes, and what else is given: (kind, word, what it means) lists by word."""
    import ahocorasick

    entries: dict[str, list[tuple]] = {k: list(v) for k, v in more.items()}
    marks = {m for mark in NOTE_MARKS for m in mark[:2]}
    for kind, words in (("hesitation", HESITATIONS), ("phrase", PHRASES), ("sound", SOUNDS), ("mark", marks)):
        for w in words:
            entries.setdefault(w, []).append((kind, None))
    a = ahocorasick.Automaton()
    for w, found in entries.items():
        a.add_word(w, (w, found))
    a.make_automaton()
    return a


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance, or ``most + 1`` if it is more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > most:
            return most + 1
    return row[-1]


def _plain(s: str) -> str:
    return re.sub(r"\s+", " ", s.strip().lower())


class Roster:
    """The automaton of a recording, with the labels of its speakers.

    Label entries are the forms of a speaker's name and role, labels of unknown persons, and words before a number. A label that is
    spelt wrong in at most k places has at least one of k + 1 pieces of the name as it is, at most k characters off its
    place: pieces are entries, too, and their hits say which names are compared.
    """

    def __init__(self, speakers: list[tuple[int, str, str]]):
        self.numbers = {n for n, _, _ in speakers}
        entries: dict[str, list[tuple]] = {}
        add = lambda word, *what: entries.setdefault(word, []).append(what)
        for n, f, role in speakers:
            parts = _plain(f or "").split()
            if parts:
                first, last = parts[0], parts[-1]
                for form in {
                    " ".join(parts), first, last, f"{first} {last[0]}.", f"{first} {last[0]}", f"{first[0]}. {last}", f"{first[0]} {last}",
                    f"{first[0]}.{last[0]}.", f"{first[0]}. {last[0]}.", f"{first[0]}{last[0]}", f"{last}, {first}",
                }:
                    add(form, "label", n)
                for name, k in ((" ".join(parts), 2), (last, 1)):
                    cuts = [i * len(name) // (k + 1) for i in range(k + 2)]
                    for x, y in zip(cuts, cuts[1:]):
                        if y > x:
                            add(name[x:y], "piece", (n, name, k, x))
            if role and _plain(role):
                add(_plain(role), "label", n)
        for label in UNKNOWN_LABELS:
            add(label, "unknown", None)
        for word in NUMBERED:
            add(word, "numbered", None)
        self.automaton = _automaton(entries)

    def hits(self, low: str) -> list[tuple[int, int, str, object, str]]:
        """(begin, end, kind, meaning, word) of all entries in a text in lower case."""
        return [(end + 1 - len(w), end + 1, kind, what, w) for end, (w, found) in self.automaton.iter(low) for kind, what in found]

    def number(self, label: str) -> int | None:
        """The speaker of a label, 0 for someone not on the roster, None for what is no label."""
        label = _plain(label)
        title = _TITLE.match(label)
        begins = {0, title.end()} if title else {0}
        ends = {len(label), len(label.split(" (")[0])}
        hits = self.hits(label)
        for a, z, kind, what, word in hits:
            if a == 0 and kind == "numbered" and (m := _NUMBER_AFTER.match(label, z)):
                return int(m.group(1)) if int(m.group(1)) in self.numbers else 0
            if a == 0 and kind == "unknown" and (z == len(label) or word.startswith(("unknown", "unidentified"))):
                return 0
        for a, z in ((0, len(label)), *((x, len(label)) for x in begins - {0}), *((0, y) for y in ends - {len(label)})):
            found = [what for x, y, kind, what, _ in hits if kind == "label" and (x, y) == (a, z)]
            if found:
                return min(found)  # of two speakers that share a form, the first on the roster
        if len(label) < 6:
            return None
        names = {what[:3] for a, _, kind, what, _ in hits if kind == "piece" and any(abs(a - x - what[3]) <= what[2] for x in begins)}
        bare = label[max(begins) :]
        near = sorted((d, n) for n, name, k in names if (d := edit_distance(label if k == 2 else bare, name, k)) <= k and (d < 2 or len(label) >= 9))
        if near and (len(near) == 1 or near[0][0] < near[1][0] or near[0][1] == near[1][1]):
            return near[0][1]
        return None


def _person(label: str) -> bool:
    """Whether a label that is on no list looks like one: initials, or names and titles in capitals."""
    words = label.split()
    return 0 < len(words) <= 4 and not any(c.isdigit() for c in label) and all(re.match(r"(?:[^\W\d_]\.)+$|[^\W\d_][\w'’-]*\.?$", w) and w[0].isupper() for w in words) and (
        len(words) > 1 or label.isupper() or "." in label
    )


def _head(text: str, roster: Roster, marked: bool) -> tuple[int | None, int]:
    """The label at the head of an utterance and where the speech begins."""
    v = _VOICE.match(text)
    if v:
        return _resolved(roster, v.group(1)), v.end()
    lead = len(text) - len(text.lstrip())
    m = _LABEL_END.search(text, lead, lead + 90)
    if not m or "\n" in text[lead : m.start()].strip():
        return None, 0
    label = text[lead : m.start()].strip()
    if not label:
        return None, m.end() if marked else 0
    number = roster.number(label)
    if number is not None:
        return number, m.end()
    return (0, m.end()) if marked and _person(label) else (None, 0)


def _resolved(roster: Roster, label: str) -> int:
    n = roster.number(re.sub(r"\s*\([^()]*\)\s*$", "", label))
    return 0 if n is None else n


def utterances(text: str, roster: Roster) -> list[list]:
    """[time or None, speaker number or None, text] in the order of the text."""
    out: list[list] = []
    cue: float | None = None
    in_cue = False
    for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        bare = line.strip()
        if bare.startswith("WEBVTT") or bare.startswith("NOTE ") and in_cue:
            continue
        m = _CUE.match(line)
        if m:
            if out and re.fullmatch(r"\s*\d+\s*", out[-1][2].rpartition("\n")[2]):
                out[-1][2] = out[-1][2].rpartition("\n")[0]  # the cue's number
            out.append([seconds(m.group(1)), None, ""])
            in_cue = True
            cue = out[-1][0]
            continue
        if in_cue:
            if not bare:
                in_cue = False
                continue
            out[-1][2] += ("\n" if out[-1][2] else "") + line
            continue
        if not bare:
            continue
        m = _BRACKETED.match(line) or _PIPED.match(line)
        if m:
            out.append([seconds(m.group(1)), None, line[m.end() :]])
            continue
        m = _CHEVRON.match(line)
        if m:
            out.append([None, None, line[m.end() :]])
            continue
        m = _NAME_TIME.match(line) or _NAME_SPACES_TIME.match(line)
        if m:
            label = re.sub(r"\s*\([^()]*\)\s*$", "", m.group(1))
            number = roster.number(label)
            if number is not None or _person(label):
                out.append([seconds(m.group(2)), number or 0, ""])
                continue
        number, begin = (None, 0) if cue is not None else _head(line, roster, False)
        if number is not None:
            out.append([None, number, line[begin:]])
        elif out:
            out[-1][2] += "\n" + line
        else:
            out.append([None, None, line])
    found = []
    for t, number, body in out:
        if number is None:
            number, begin = _head(body, roster, True)
            body = body[begin:]
        found.append([t, number, body])
    return found


def language(text: str) -> str:
    """The language with the most frequent words in the text."""
    counts = Counter(re.findall(r"[^\W\d_]+", text.lower()))
    return max(_LANGUAGES, key=lambda k: sum(counts[w] for w in _LANGUAGES[k]))


def filler(low: str, a: int, z: int, word: str, lang: str) -> bool:
    """Whether a hesitation or phrase is one by the words and marks about it."""
    marked = low[z : z + 1] in (",", "…", "–", "—") or low.startswith(("...", " –", " —", " -"), z)
    if word in REAL_IN.get(lang, ()):
        return marked
    before = low[max(0, a - 40) : a].rstrip()
    if word == "este":
        return low.startswith(("...", "…"), z) or marked and before[-1:] in ("", ",", ".", "!", "?")
    if word in NEEDS_MARK and not (marked or before[-1:] == "," and low[z : z + 1] in ("", ".", "!", "?")):
        return False
    m = _WORD_BEFORE.search(before)
    if m and m.group(1) in REAL_AFTER.get(word, ()):
        return False
    m = _WORD_AFTER.match(low, z)
    return not (m and m.group(1) in REAL_BEFORE.get(word, ()))


def noted(hits: list[tuple], low: str) -> list[tuple[int, int]]:
    """Intervals of notes, from the hits of their marks and of words of sounds: in brackets that hold no other of their kind, in round
    brackets if these are double or half of the words in them are of sounds, and between marks in a line."""
    cut: list[tuple[int, int]] = []
    for opening, closing, most in NOTE_MARKS:
        at = [(a, w) for a, _, kind, _, w in hits if kind == "mark" and w in (opening, closing)]
        if opening == closing:
            i = 0
            while i < len(at):
                a, z = at[i][0], at[i + 1][0] if i + 1 < len(at) else -1
                if 1 <= z - a - 1 <= most and (opening == "♪" or "\n" not in low[a:z]):
                    cut.append((a, z + 1))
                    i += 1
                elif opening == "♪":
                    cut.append((a, a + 1))
                i += 1
            continue
        for (a, w), (z, x) in zip(at, at[1:]):
            if w != opening or x != closing or z - a - 1 > most:
                continue
            if opening != "(":
                cut.append((a, z + 1))
            elif low[a - 1 : a] == "(" and low[z + 1 : z + 2] == ")":
                cut.append((a - 1, z + 2))
            elif inside := sum(1 for s, e, kind, _, _ in hits if kind == "sound" and a < s and e <= z and _bounded(low, s, e)):
                if 2 * inside >= len(_WORDS.findall(low[a + 1 : z])):
                    cut.append((a, z + 1))
    return cut


def _bounded(low: str, a: int, z: int) -> bool:
    """Whether a hit is of whole words."""
    return not (a and (low[a - 1].isalnum() or low[a - 1] == "-") or z < len(low) and (low[z].isalnum() or low[z] == "-"))


def clean(text: str, roster: Roster, lang: str = "en") -> tuple[str, bool]:
    """The speech without notes and hesitations, and whether any is left; phrases are speech where nothing else is said."""
    low = text.lower()
    if len(low) != len(text):  # some capitals become longer
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    hits = [h for h in roster.hits(low) if h[2] in ("hesitation", "phrase", "sound", "mark")]
    cut, phrases = noted(hits, low), []
    for a, z, kind, _, w in hits:
        if kind in ("hesitation", "phrase") and _bounded(low, a, z) and filler(low, a, z, w, lang):
            while z < len(low) and low[z] in ",.…" and kind == "hesitation":
                z += 1
            (cut if kind == "hesitation" else phrases).append((a, z))
    said = _without(text, cut + phrases)
    if phrases and not _WORDS.search(said):
        said = _without(text, cut)
    return said, bool(_WORDS.search(said))


def _without(text: str, cut: list[tuple[int, int]]) -> str:
    kept, at = [], 0
    for a, z in sorted(cut):  # subtraction of intervals that may overlap
        if a > at:
            kept.append(text[at:a])
        at = max(at, z)
    kept.append(text[at:])
    said = re.sub(r"\s+", " ", " ".join(kept)).strip()
    return _CUT_OFF.sub("", re.sub(r"\s+([,.;:!?])", r"\1", said))


def parse(text: str, speakers: list[tuple[int, str, str]]) -> list[tuple[int, int, str]]:
    """(place in time, speaker number, clean speech) of the utterances with speech."""
    roster = Roster(speakers)
    found = utterances(text, roster)
    known = 0.0
    for i, u in enumerate(found):  # an utterance without a time stays behind the one before it
        known = u[0] if u[0] is not None else known
        u.append((known, i))
    found.sort(key=lambda u: u[3])
    out, now, lang = [], 0, language(text)
    for k, (_, number, body, _) in enumerate(found):
        if number is not None:
            now = number
        said, speech = clean(body, roster, lang)
        if speech:
            out.append((k, now, said))
    return out


def recordings(items: DataFrame, chunks: DataFrame) -> DataFrame:
    """(audio_id, text): the transcript, else the chunks in their order."""
    item = items.groupBy("audio_id").agg(
        F.max("uuid").alias("uuid"), F.max(F.when(F.length(F.trim("transcript")) > 0, F.col("transcript"))).alias("transcript"),
    )
    time = F.when(~F.isnan("time_start"), F.col("time_start"))
    piece = chunks.where("text is not null and of_audio_item.uuid is not null").groupBy("chunk_id").agg(
        F.max("of_audio_item.uuid").alias("uuid"), F.max("text").alias("text"), F.max(time).alias("time"), F.max("chunk_index").alias("place"),
    )
    need = item.where("transcript is null and uuid is not null").select("audio_id", "uuid")
    by = piece.join(need, "uuid").groupBy("audio_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "time", "chunk_id", "text"))).alias("by_place"),
        (F.count("place") == F.count(F.lit(1))).alias("complete"), (F.countDistinct("place") == F.count(F.lit(1))).alias("distinct_"),
    )
    by_time = F.array_sort(
        F.transform(
            "by_place",
            lambda x: F.struct(x["time"].alias("time"), x["place"].alias("place"), x["chunk_id"].alias("chunk_id"), x["text"].alias("text")),
        )
    )
    texts = F.when(
        F.col("complete") & F.col("distinct_"), F.transform("by_place", lambda x: x["text"]),
    ).otherwise(F.transform(by_time, lambda x: x["text"]))
    joined = by.select("audio_id", F.array_join(texts, "\n").alias("text"))
    return item.where("transcript is not null").select("audio_id", F.col("transcript").alias("text")).unionByName(joined)


def _utterance_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        out = []
        for i, text, people in zip(*(b.column(c).to_pylist() for c in ("audio_id", "text", "people"))):
            out += [(i, *u) for u in parse(text, [(p["speaker_no"], p["full_name"], p["role_name"]) for p in people or []])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.string()))],
            names=["audio_id", "place", "speaker_no", "said"],
        )


def turns(items: DataFrame, chunks: DataFrame, roster: DataFrame) -> DataFrame:
    """(audio_id, turn_no, speaker_no, text)."""
    people = roster.where("speaker_no is not null").groupBy("audio_id").agg(
        F.array_sort(F.collect_set(F.struct("speaker_no", "full_name", "role_name"))).alias("people")
    )
    spoken = recordings(items, chunks).join(people, "audio_id", "left").select("audio_id", "text", "people").mapInArrow(
        _utterance_rows, "audio_id bigint, place int, speaker_no int, said string",
    )
    order = Window.partitionBy("audio_id").orderBy("place")
    change = spoken.withColumn(
        "new", F.when(F.lag("speaker_no").over(order) == F.col("speaker_no"), 0).otherwise(1),
    ).withColumn("turn_no", F.sum("new").over(order).cast("int"))
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "said"))), lambda x: x["said"]), " ")
    return change.groupBy("audio_id", "turn_no").agg(F.min("speaker_no").alias("speaker_no"), said.alias("text"))
