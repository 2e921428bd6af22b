"""Short licence notices in texts, also misspelt ones.

Texts are lower-cased and their words joined by one space. A notice may be off by a few
edits (letters put in, left out or exchanged), its ``exact`` words excepted. Cut in one
piece more than it may have edits, it keeps at least one piece whole wherever it stands:
the pieces of all notices are looked up in one pass by an automaton. Around every place
that a piece points to, the ``regex`` library's matching with bounded errors verifies the
notice and gives its span and edits; a match begins and ends at words. Of matches of one notice
that overlap, that with the fewest edits stays.

Texts are handled one at a time inside tasks, whole; nothing is shuffled, and what is
held for a text is a small multiple of it. Defined results: null or empty text has no
words and no notices; spans are code points of the source, end exclusive.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ROW, boxed, field
from quire.session import ship_package


@dataclass(frozen=True)
class Notice:
    """Words of a notice, its label, the edits it may have and the words that have none."""
    label: str
    words: str
    edits: int = 0
    exact: tuple[str, ...] = ()


# Phrases that count as base places, with their labels.
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))

# Notices. A word that tells one licence from another is exact.
NOTICES = (
    Notice("mit", "under the mit license", 2, ("mit",)),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("apache-2", "apache license version 2", 2, ("2",)),
    Notice("cc-by-nc", "cc by nc"),
    Notice("cc-by-nc", "creative commons attribution noncommercial", 3),
    Notice("cc-by-nc", "creative commons attribution non commercial", 3),
    Notice("cc-by-sa", "cc by sa"),
    Notice("cc-by-sa", "creative commons attribution sharealike", 3),
    Notice("cc-by-sa", "creative commons attribution share alike", 3),
    Notice("cc0", "cc0 1 0 universal", 1, ("cc0",)),
    Notice("gpl-2", "gnu general public license version 2", 3, ("2",)),
    Notice("gpl-3", "gnu general public license version 3", 3, ("3",)),
    Notice("lgpl", "gnu lesser general public license", 3, ("lesser",)),
    Notice("agpl", "gnu affero general public license", 3, ("affero",)),
    Notice("mpl-2", "mozilla public license version 2", 2, ("2",)),
    Notice("epl", "eclipse public license", 2, ("eclipse",)),
    Notice("boost", "boost software license version 1", 2, ("1",)),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 6),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", 6),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 5),
)

_WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: Byte by byte: capitals lowered, what is in no word a space. UTF-8 beyond ASCII is in words.
NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 0x20 for b in range(256))


def pieces(words: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece): ``edits`` + 1 pieces of nearly equal length."""
    n, k = len(words), edits + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, words[a:b]) for a, b in zip(cuts, cuts[1:])]


def bounded(notice: Notice) -> regex.Pattern:
    """The notice up to the end of a word, the best match. What lies between exact words
    may have the notice's edits; whether all have no more in sum is seen from the match."""
    words, body, loose = notice.words.split(" "), [], []
    if not set(notice.exact) <= set(words):
        raise ValueError(f"{notice.exact} are not all words of {notice.words!r}")
    for w in [*words, None]:
        if (w is None or w in notice.exact) and loose:
            text = regex.escape(" ".join(loose), special_only=True, literal_spaces=True)
            body.append(f"(?:{text}){{e<={notice.edits}}}" if notice.edits else text)
            loose = []
        if w in notice.exact:
            body.append(regex.escape(w, special_only=True))
        elif w is not None:
            loose.append(w)
    return regex.compile(f"(?b){' '.join(body)}(?![^ ])")


def spaced(text: str, s: int, e: int) -> bool:
    """Whether a stretch begins and ends with words."""
    return (s == 0 or text[s - 1] == " ") and (e == len(text) or text[e] == " ")


class Scanner:
    """Finds notices in normal texts (words joined by single spaces)."""

    def __init__(self, notices: tuple[Notice, ...] = NOTICES, base: tuple[tuple[str, str], ...] = BASE):
        self.base = dict((words, label) for label, words in base)
        known = {n.words for n in notices}
        self.notices = (*notices, *(Notice(label, words) for words, label in self.base.items() if words not in known))
        self.patterns = [bounded(n) for n in self.notices]
        owners: dict[str, list[tuple[int, int]]] = {}
        for k, n in enumerate(self.notices):
            for at, piece in pieces(n.words, n.edits):
                owners.setdefault(piece, []).append((k, at))
        self.seeds = ahocorasick.Automaton()
        for piece, own in owners.items():
            self.seeds.add_word(piece, (len(piece), own))
        self.seeds.make_automaton()

    def candidates(self, text: str) -> set[tuple[int, int]]:
        """(notice, place) pairs: where a seed says that the notice begins, give or take its edits."""
        return {(k, last + 1 - size - at) for last, (size, own) in self.seeds.iter(text) for k, at in own}

    def verified(self, k: int, at: int, text: str) -> tuple[int, int, int, int] | None:
        """(start, end, notice, edits) of the best match around a candidate place."""
        size, edits = len(self.notices[k].words), self.notices[k].edits
        hi = min(len(text), at + size + edits)
        # a word that is cut off must not look like one that ends there
        tail = "" if hi == len(text) or text[hi] == " " else "x"
        best = None
        # every word that begins within reach is tried: a search leaves out edits before its first character
        start = max(0, at - edits)
        if start and text[start - 1] != " ":
            start = text.find(" ", start) + 1 or -1
        while 0 <= start <= at + edits and (best is None or best[3]):
            m = self.patterns[k].match(text[start:hi] + tail)
            if m is not None and (n := sum(m.fuzzy_counts)) <= edits and (best is None or n < best[3]):
                best = (start, start + m.end(), k, n)
            start = text.find(" ", start) + 1 or -1
        return best

    def matches(self, text: str, candidates: set[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, edits) in a normal text, by place. Of matches of one notice
        that overlap, that with the fewest edits stays, then the first."""
        found = {m for k, at in candidates if (m := self.verified(k, at, text))}
        out: list[tuple[int, int, int, int]] = []
        taken: dict[int, list[tuple[int, int]]] = {}
        for s, e, k, n in sorted(found, key=lambda m: (m[3], m[0], m[1])):
            own = taken.setdefault(k, [])
            i = bisect_left(own, (s, e))
            if (i == 0 or own[i - 1][1] <= s) and (i == len(own) or own[i][0] >= e):
                own.insert(i, (s, e))
                out.append((s, e, k, n))
        return sorted(out)

    def scan(self, raw: bytes) -> tuple[int, list, list]:
        """Of a text in UTF-8: number of words; base places (word, label); spans (label,
        start, end, edits, likeness) in code points of the source."""
        plain = raw.translate(NORMAL)
        words = plain.split()
        text = b" ".join(words).decode(errors="replace")
        candidates = self.candidates(text)
        if not candidates:
            return len(words), [], []
        base = sorted({(at, w) for k, at in candidates if (w := self.notices[k].words) in self.base and at >= 0
                       and text.startswith(w, at) and spaced(text, at, at + len(w))})
        found = self.matches(text, candidates)
        if not found:
            return len(words), [], []
        # word beginnings of the joined text, and word places of the source
        sizes = np.fromiter(map(len, text.split(" ")), np.int64, len(words)) + 1
        begins = np.cumsum(sizes) - sizes
        places = [m.span() for m in regex.finditer(rb"[^ ]+", plain)]
        point = np.cumsum(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80) - 1
        spans = []
        for s, e, k, n in found:
            a = int(point[places[np.searchsorted(begins, s, side="right") - 1][0]])
            b = int(point[places[np.searchsorted(begins, e, side="right") - 1][1] - 1]) + 1
            spans.append((self.notices[k].label, a, b, n, max(0.0, 1 - n / len(self.notices[k].words))))
        return len(words), [(int(np.searchsorted(begins, at)), self.base[w]) for at, w in base], spans


@lru_cache(maxsize=4)
def scanner(notices: tuple[Notice, ...], base: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(notices, base)


FOUND = ("n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, "
         "score double, spans array<struct<label: string, start: long, end: long, edits: int, likeness: double>>")


def found(text: Column, notices: tuple[Notice, ...] = NOTICES, base: tuple[tuple[str, str], ...] = BASE) -> Column:
    """Struct of FOUND: words, base places, labels, the best likeness and all spans."""
    span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()),
                               ("likeness", pa.float64())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64(), span]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    @F.arrow_udf(FOUND)
    def of(texts: pa.Array) -> pa.Array:
        scan, rows = scanner(notices, base).scan, []
        for value in texts.cast(pa.large_binary()):
            n_words, places, spans = scan(value.as_py() or b"")
            starts = [w for w, _ in places]
            rows.append((n_words, len(starts), min(starts, default=None), max(starts, default=None),
                         sorted({x for _, x in places}), sorted({x[0] for x in spans} | {x for _, x in places}),
                         max((x[4] for x in spans), default=0.0),
                         [dict(zip(("label", "start", "end", "edits", "likeness"), x)) for x in spans]))
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)
    return of(text)


def scan(docs: DataFrame, text_col: str = "text", notices: tuple[Notice, ...] = NOTICES,
         base: tuple[tuple[str, str], ...] = BASE) -> DataFrame:
    """Each document as the struct ``_row`` with the columns of FOUND."""
    ship_package(docs.sparkSession)
    rows = boxed(docs).select(ROW, found(field(text_col), notices, base).alias("_found"))
    return rows.select(ROW, "_found.*")
