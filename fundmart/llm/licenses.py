"""License scans: fuzzy search for short notices.

A text is read as lower-case words joined by single spaces. A notice may be found with a
few edits, ``k``; cut into ``k + 1`` pieces, at least one piece must then stand there
unchanged (pigeonhole). All pieces of all notices are sought at once as exact seeds, each
seed points to the place where its notice would lie; if an edit bound says that it may be
there, bounded-error matching of the regex library verifies that place by itself and reports
the span with the fewest edits.
Where notices overlap, the one with the smaller share of edits wins; the places of the
others are searched again beside it. No seed, place or match is left out, however many
there are.

The base phrases are found exactly, as words that stand consecutively.

Defined results: a null or empty text has no words and no labels; ``first_word`` and
``last_word`` are null without a base place; very long texts are scanned whole; repeated rows
give repeated results; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from fundmart.llm.base import named, query, table, text_of

# Base phrases and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# The openings of well-known notices, as lower-case words.
NOTICES = [
    ("agpl", "gnu affero general public license"),
    ("apache", "licensed under the apache license version"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("cc-by", "licensed under the creative commons attribution"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-nd", "licensed under cc by nd"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc0", "has been dedicated to the public domain"),
    ("gpl", "licensed under the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("proprietary", "unauthorized copying of this file is strictly prohibited"),
    ("reserved", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
# One edit for every so many characters of a notice.
CHARS_PER_EDIT = 10

SCHEMA = (
    "doc_id {id}, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, spans string"
)

# Letters in lower case; everything in ASCII that is no letter or digit is a space.
_LOWER = bytes(
    code + 32 if 65 <= code <= 90
    else code if 48 <= code <= 57 or 97 <= code <= 122 or code >= 128
    else 32
    for code in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def allowed_edits(notice: str) -> int:
    return max(1, len(notice) // CHARS_PER_EDIT)


def seeds(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of nearly equal length, with their places in the notice."""
    parts = edits + 1
    bounds = [len(notice) * i // parts for i in range(parts + 1)]
    return [(a, notice[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


class EditBound:
    """Whether some part of a text is within so many edits of a notice.

    The columns of the edit matrix are kept as bits of two whole numbers (Myers), which is far
    cheaper than a search for the best match.
    """

    def __init__(self, notice: str, edits: int) -> None:
        self.size, self.edits, self.places = len(notice), edits, {}
        for i, char in enumerate(notice):
            self.places[char] = self.places.get(char, 0) | 1 << i

    def holds(self, text: str, a: int, b: int) -> bool:
        every, last = (1 << self.size) - 1, 1 << (self.size - 1)
        more, less, distance = every, 0, self.size
        for i in range(a, b):
            equal = self.places.get(text[i], 0)
            cross = equal | less
            level = (((equal & more) + more) ^ more) | equal
            up, down = less | (every & ~(level | more)), more & level
            distance += 1 if up & last else -1 if down & last else 0
            if distance <= self.edits:
                return True
            up, down = (up << 1) & every, (down << 1) & every
            more, less = down | (every & ~(cross | up)), up & cross
        return False


class Scanner:
    """Seeds of all notices in one automaton, and a bounded-error pattern per notice."""

    def __init__(self, notices=NOTICES, base=None) -> None:
        import ahocorasick
        import regex

        self.base = [(f" {p} ".encode(), label) for p, label in (BASE if base is None else base).items()]
        self.notices = notices
        self.edits = [allowed_edits(text) for _, text in notices]
        self.patterns = [
            regex.compile(f"(?b)(?:{regex.escape(text)}){{e<={k}}}")
            for (_, text), k in zip(notices, self.edits, strict=True)
        ]
        self.bounds = [EditBound(text, k) for (_, text), k in zip(notices, self.edits, strict=True)]
        at_seed: dict[str, list[tuple[int, int]]] = {}
        for i, ((_, text), k) in enumerate(zip(notices, self.edits, strict=True)):
            for offset, piece in seeds(text, k):
                at_seed.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in at_seed.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def base_places(self, joined: bytes) -> list[tuple[int, str]]:
        """(word number, label) of every place of every base phrase."""
        padded = b" " + joined + b" "
        places = []
        for phrase, label in self.base:
            at = padded.find(phrase)
            word = last = 0
            while at >= 0:
                word += padded.count(b" ", last, at)
                last = at
                places.append((word, label))
                at = padded.find(phrase, at + 1)
        return places

    def notices_in(self, joined: str) -> list[tuple[int, int, str, int, int]]:
        """(start, end, label, edits, notice length) of every notice, without overlaps."""
        windows: set[tuple[int, int, int]] = set()
        for end, (length, targets) in self.automaton.iter(joined):
            for i, offset in targets:
                begin = end + 1 - length - offset
                k = self.edits[i]
                last = begin + len(self.notices[i][1]) + k
                windows.add((i, max(begin - k, 0), min(last, len(joined))))
        # The best match of each window; more of a window is searched when that one is settled.
        heap: list[tuple] = []
        for window in windows:
            self._search(heap, joined, *window)
        chosen: list[tuple[int, int, str, int, int]] = []
        taken: list[tuple[int, int]] = []
        while heap:
            _, match, (i, a, b) = heapq.heappop(heap)
            if not _overlapping(taken, *match[:2]):
                chosen.append(match)
                bisect.insort(taken, match[:2])
            # A worse match of the same window may stand beside what is taken.
            for start, end in _overlapping(taken, a, b):
                self._search(heap, joined, i, a, start)
                a = end
            self._search(heap, joined, i, a, b)
        return sorted(chosen)

    def _search(self, heap: list[tuple], joined: str, i: int, a: int, b: int) -> None:
        """Put the best match of notice ``i`` between ``a`` and ``b``, if any, on the heap."""
        label, text = self.notices[i]
        if b - a < len(text) - self.edits[i] or not self.bounds[i].holds(joined, a, b):
            return
        found = self.patterns[i].search(joined, a, b)
        if found and found.end() > found.start():
            edits = sum(found.fuzzy_counts)
            match = (found.start(), found.end(), label, edits, len(text))
            order = (edits / len(text), -len(text), found.start(), label)
            heapq.heappush(heap, (order, match, (i, a, b)))

    def scan(self, text: str) -> tuple:
        words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split(b" ")
        words = [w for w in words if w]
        joined = b" ".join(words)
        base = self.base_places(joined)
        plain = joined.decode("utf-8", "surrogatepass")
        notices = self.notices_in(plain)
        base_labels = {label for _, label in base}
        labels = base_labels | {label for _, _, label, _, _ in notices}
        numbers = [word for word, _ in base]
        score = max([1.0] * bool(base) + [1 - k / n for *_, k, n in notices], default=0.0)
        return (
            len(words),
            len(base),
            min(numbers, default=None),
            max(numbers, default=None),
            ",".join(sorted(base_labels)),
            ",".join(sorted(labels)),
            score,
            _spans(text, plain, notices),
        )


def _overlapping(taken: list[tuple[int, int]], a: int, b: int) -> list[tuple[int, int]]:
    """The spans of ``taken`` (sorted, without overlaps) that overlap a to b."""
    at = bisect.bisect_left(taken, (a, a))
    if at and taken[at - 1][1] > a:
        at -= 1
    return taken[at : bisect.bisect_left(taken, (b, b))]


def _spans(text: str, joined: str, notices: list) -> str:
    """label:start:end:edits in code points of the text itself; whole words."""
    if not notices:
        return ""
    words = list(_WORD.finditer(text.translate(_UPPER)))
    out, number, at = [], 0, 0
    for a, b, label, edits, _ in notices:
        number += joined.count(" ", at, a)
        at = a
        last = min(number + joined.count(" ", a, b - 1), len(words) - 1)
        first = number + (joined[a : a + 1] == " ")
        out.append(f"{label}:{words[min(first, last)].start()}:{words[last].end()}:{edits}")
    return ",".join(out)


_UPPER = {code: code + 32 for code in range(65, 91)}


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices=NOTICES, base=None
) -> DataFrame:
    """One row per document: words, base places and labels, all labels, score and spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices, base)
        for batch in batches:
            rows = [scanner.scan(t.as_py()) for t in batch.column(1)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 8
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    rows = docs.select(named(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    schema = SCHEMA.format(id=rows.schema["doc_id"].dataType.simpleString())
    names = [part.split()[0] for part in schema.split(", ")]
    return rows.mapInArrow(run, schema)


@query()
def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))
