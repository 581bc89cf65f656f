"""License scans: short notices found in whole texts, a few edits allowed.

A notice of n characters, 8 at least, may differ by n // 12 edits, at least one; the
short `cc by` forms must be exact. By the pigeonhole principle, a phrase split into
one more piece than it may have edits keeps one piece unchanged, so an Aho-Corasick
search for all pieces finds every candidate. At each candidate the exact phrase is
tried first; else every run of whole words that starts and ends within the edits of
the candidate's ends is matched as a whole by the regex library's bounded-error
matching, which verifies the edits and gives the span. Texts are searched as their lower-cased words joined by single
spaces, so punctuation and line breaks between words do not matter.

Texts are scanned where they lie: no shuffle, and memory for one batch.

Base notices (`base=True`) also count exactly: all places where their words stand
consecutively. Fuzzy spans never replace exact ones.

Defined cases: a null or wordless text has no spans, score 0 and empty labels;
repeated rows are judged alike; an empty table gives no rows; other columns are
ignored; of fuzzy spans of one notice that overlap, the one with fewer edits, then
the earlier one, is reported.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.llm.common import map_arrow, utf8, word_line

CHARACTERS_PER_EDIT = 12
SHORTEST_FUZZY = 8
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class Notice(NamedTuple):
    label: str
    phrase: str
    base: bool = False
    exact: bool = False

    @property
    def edits(self) -> int:
        short = self.exact or len(self.phrase) < SHORTEST_FUZZY
        return 0 if short else max(1, len(self.phrase) // CHARACTERS_PER_EDIT)


# The four base phrases and their labels.
BASE = [
    Notice("gpl", "gnu general public license", True),
    Notice("apache", "apache license", True),
    Notice("cc-by", "cc by", True, True),
    Notice("mit", "mit license", True),
]
MORE = [
    Notice("agpl", "gnu affero general public license"),
    Notice("lgpl", "gnu lesser general public license"),
    Notice("mpl", "mozilla public license"),
    Notice("epl", "eclipse public license"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification"),
    Notice("bsd", "bsd license"),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Notice("isc", "isc license"),
    Notice("unlicense", "released into the public domain"),
    Notice("cc-by", "creative commons attribution"),
    Notice("cc-by-nc", "cc by nc", exact=True),
    Notice("cc-by-nd", "cc by nd", exact=True),
    Notice("cc-by-sa", "cc by sa", exact=True),
    Notice("cc0", "cc0 1 0 universal"),
]
NOTICES = BASE + MORE


class Span(NamedTuple):
    """A verified notice: words [first_word, last_word], bytes [start, end) of the text, edits."""

    label: str
    phrase: str
    base: bool
    first_word: int
    last_word: int
    edits: int
    start: int
    end: int


def pieces(phrase: str, edits: int) -> list[tuple[int, str]]:
    """The phrase cut into edits + 1 pieces of about equal length, with their offsets."""
    cuts = [len(phrase) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    def __init__(self, notices: Sequence[Notice] = tuple(NOTICES)):
        self.notices = list(notices)
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(self.notices):
            for offset, piece in pieces(notice.phrase, notice.edits):
                seeds.setdefault(piece, []).append((number, offset))
        self.seeds = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.seeds.add_word(piece, (len(piece), places))
        self.seeds.make_automaton()
        self.fuzzy = [
            regex.compile(rf"(?b)(?:{regex.escape(n.phrase, literal_spaces=True)}){{e<={n.edits}}}")
            if n.edits
            else None
            for n in self.notices
        ]

    def candidates(self, line: str) -> dict[int, set[int]]:
        """By notice, where its phrase would start according to a piece found."""
        found: dict[int, set[int]] = {}
        for last, (length, places) in self.seeds.iter(line):
            for number, offset in places:
                found.setdefault(number, set()).add(last - length + 1 - offset)
        return found

    def matches(self, line: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) of exact and, where none overlaps, of fuzzy matches."""
        out = []
        for number, starts in self.candidates(line).items():
            notice, size = self.notices[number], len(self.notices[number].phrase)
            exact, near = [], []
            for start in sorted(starts):
                if start >= 0 and line.startswith(notice.phrase, start) and self._whole(line, start, start + size):
                    exact.append((start, start + size, 0))
                elif notice.edits:
                    near.extend(self._near(line, number, start))
            taken = list(exact)
            for span in sorted(set(near), key=lambda s: (s[2], s[0], s[1])):
                if all(span[1] <= a or span[0] >= b for a, b, _ in taken):
                    taken.append(span)
            out.extend((number, *span) for span in taken)
        return out

    def _near(self, line: str, number: int, start: int) -> Iterator[tuple[int, int, int]]:
        """Runs of whole words that are the notice but for its edits, starting within these of `start`."""
        edits, size = self.notices[number].edits, len(self.notices[number].phrase)
        ends = [b for b in self._around(start + size, edits, len(line)) if b == len(line) or line[b] == " "]
        for a in self._around(start, edits, len(line)) if ends else ():
            if a == 0 or line[a - 1] == " ":
                for b in ends:
                    if abs(b - a - size) <= edits and (m := self.fuzzy[number].fullmatch(line, a, b)):
                        yield a, b, sum(m.fuzzy_counts)

    @staticmethod
    def _around(place: int, by: int, length: int) -> range:
        return range(max(0, place - by), min(length, place + by) + 1)

    @staticmethod
    def _whole(line: str, start: int, end: int) -> bool:
        return (start == 0 or line[start - 1] == " ") and (end == len(line) or line[end] == " ")

    def scan(self, text: bytes | None) -> tuple[int, list[Span]]:
        """Number of words, and the spans in order of place."""
        raw = word_line(text)
        if not raw:
            return 0, []
        line = raw.decode("utf-8", "replace")
        spans, matches = [], self.matches(line)
        blanks = [i for i, c in enumerate(line) if c == " "] if matches else []
        for number, start, end, edits in matches:
            notice = self.notices[number]
            first, last = bisect_left(blanks, start), bisect_left(blanks, end)
            spans.append(Span(notice.label, notice.phrase, notice.base, first, last, edits, 0, 0))
        if spans:
            places = [m.span() for m in WORD.finditer(text)]
            spans = [s._replace(start=places[s.first_word][0], end=places[s.last_word][1]) for s in spans]
        return raw.count(b" ") + 1, sorted(spans, key=lambda s: (s.start, s.end, s.label, s.phrase))


SPAN = pa.struct(
    [
        ("label", pa.string()),
        ("phrase", pa.string()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("edits", pa.int64()),
        ("start", pa.int64()),
        ("end", pa.int64()),
    ]
)
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label:string,phrase:string,first_word:long,last_word:long,edits:long,"
    "start:long,end:long>>"
)


def _joined(labels: Iterable[str]) -> str:
    return ",".join(sorted(set(labels)))


def _summary(n_words: int, spans: list[Span]) -> tuple:
    base = [s for s in spans if s.base and s.edits == 0]
    starts = [s.first_word for s in base]
    return (
        n_words,
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        _joined(s.label for s in base),
        _joined(s.label for s in spans),
        max((1 - s.edits / len(s.phrase) for s in spans), default=0.0),
        [{k: v for k, v in s._asdict().items() if k != "base"} for s in spans],
    )


def scan_licenses(docs: DataFrame, notices: Sequence[Notice] = tuple(NOTICES)) -> DataFrame:
    """One row per document; see SCHEMA. `first_word` and `last_word` are starts of exact base places."""
    scanners: list[Scanner] = []

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not scanners:
            scanners.append(Scanner(notices))
        rows = [_summary(*scanners[0].scan(text)) for text in batch.column(1).to_pylist()]
        kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), pa.list_(SPAN)]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        names = "doc_id n_words n_base first_word last_word base_labels labels score spans".split()
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text")), scan, SCHEMA)
