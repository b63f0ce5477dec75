"""Fuzzy search for short licence notices.

Texts become words (A-Z in lower case; everything but ASCII letters, digits and
non-ASCII characters is a border) joined by single blanks.  A notice may be found
with a bounded number of edits.  It is split into one piece more than it may have
edits, so by the pigeonhole principle at least one piece stands unchanged in any
occurrence.  One automaton finds all pieces of all notices; hits that put the
notice at nearly the same place share a window, and the regex library's
bounded-error matching verifies each window and counts the edits.  Base phrases
are found word by word, without edits.

Defined cases: a null text counts as empty and has no words and no notices.  An
empty table gives an empty result.  A repeated row is a row of its own.  Of
overlapping matches, of one notice or of several, the one counts that covers most
(``len(notice) - EDIT_COST * edits``), then the earlier, then the notice listed
first.  Spans cover whole words, also where a match begins or ends inside one.
Output columns replace input columns of the same name.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.common import mapped, sheltered

# Phrases of the base and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Short notices by label.  They are searched with edits, those of the base included.
NOTICES = [
    ("gpl", "gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "mozilla public license"),
    ("epl", "eclipse public license"),
    ("boost", "boost software license"),
    ("ofl", "sil open font license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "creative commons attribution"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc0", "cc0 1 0 universal"),
]
# One edit for so many characters of a notice, and three at most.
CHARS_PER_EDIT = 10
MOST_EDITS = 3
# What an edit costs a match that overlaps another, in characters of its notice.
EDIT_COST = 5
# Verified windows a worker remembers: notices are the same line in many texts.
REMEMBERED = 20_000

# In ASCII everything but digits and letters ends a word; A-Z become a-z.
_FOLD = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or 48 <= byte <= 57 or 97 <= byte <= 122 else 32
    for byte in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_NEW = ("_n_words", "_base", "_notices")
_DDL = """_n_words long,
  _base array<struct<label:string,phrase:string,first_word:long,last_word:long,start:long,end:long>>,
  _notices array<struct<label:string,notice:string,edits:long,first_word:long,last_word:long,start:long,end:long,text:string>>"""
_PLACE = [(name, pa.int64()) for name in ("first_word", "last_word", "start", "end")]
_ARROW = (
    pa.int64(),
    pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.string()), *_PLACE])),
    pa.list_(pa.struct([("label", pa.string()), ("notice", pa.string()), ("edits", pa.int64()), *_PLACE, ("text", pa.string())])),
)


def edits_of(notice: str) -> int:
    return min(MOST_EDITS, len(notice) // CHARS_PER_EDIT)


def folded(text: str) -> tuple[str, int]:
    """The words of a text between single blanks, and their number."""
    words = text.encode("utf-8").translate(_FOLD).split()
    return f" {b' '.join(words).decode('utf-8')} ", len(words)


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits`` + 1 pieces of nearly equal length with their offsets: one of them survives ``edits`` edits."""
    cuts = [len(notice) * place // (edits + 1) for place in range(edits + 2)]
    return [(start, notice[start:end]) for start, end in pairwise(cuts)]


class Scanner:
    """All notices as one automaton of pieces, and a verifying pattern for each."""

    def __init__(self, notices: list[tuple[str, str]], base: dict[str, str]):
        self.notices = [(label, notice, edits_of(notice)) for label, notice in notices]
        self.base = [(label, phrase) for phrase, label in base.items()]
        # What a found string stands for: (notice, offset in it), or (-1 - phrase, 0) of the base.
        uses: dict[str, list[tuple[int, int]]] = {}
        for place, (_, notice, edits) in enumerate(self.notices):
            for offset, piece in pieces(notice, edits):
                uses.setdefault(piece, []).append((place, offset))
        for place, (_, phrase) in enumerate(self.base):
            uses.setdefault(f" {phrase} ", []).append((-1 - place, 0))
        self.automaton = ahocorasick.Automaton()
        for piece, use in uses.items():
            self.automaton.add_word(piece, (len(piece), use))
        self.automaton.make_automaton()
        self.patterns = [
            regex.compile(f"(?:{regex.escape(notice)}){{e<={edits}}}", regex.BESTMATCH) for _, notice, edits in self.notices
        ]
        self.verified = lru_cache(REMEMBERED)(self._verified)

    def _verified(self, place: int, window: str) -> tuple[int, int, int] | None:
        """(start, end, edits) of the best match of a notice in a window."""
        match = self.patterns[place].search(window)
        return (*match.span(), sum(match.fuzzy_counts)) if match else None

    def hits(self, flat: str) -> tuple[list[tuple[int, int]], dict[int, list[int]]]:
        """(phrase, start) of the base; for each notice the places where a surviving piece would make it begin."""
        base, starts = [], {}
        for last, (length, uses) in self.automaton.iter(flat):
            for place, offset in uses:
                if place < 0:
                    base.append((-1 - place, last - length + 2))
                else:
                    starts.setdefault(place, []).append(last - length + 1 - offset)
        return base, starts

    def matches(self, flat: str, starts: dict[int, list[int]]) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, edits), in order, without overlaps."""
        found = set()
        for place, begins in starts.items():
            _, notice, edits = self.notices[place]
            first = last = None
            for begin in [*sorted(set(begins)), None]:
                if first is not None and (begin is None or begin > first + 2 * edits):
                    # Edits move the true beginning by as many characters at most.
                    low = max(0, first - edits)
                    match = self.verified(place, flat[low : last + len(notice) + edits])
                    if match:
                        found.add((low + match[0], low + match[1], place, match[2]))
                    first = None
                first, last = begin if first is None else first, begin
        order = sorted(found, key=lambda one: (EDIT_COST * one[3] - len(self.notices[one[2]][1]), one))
        chosen: list[tuple[int, int, int, int]] = []
        ends: list[int] = []
        for one in order:
            # Chosen matches do not overlap, so their ends are in the order of their starts.
            at = bisect_right(ends, one[0])
            if at == len(chosen) or chosen[at][0] >= one[1]:
                chosen.insert(at, one)
                ends.insert(at, one[1])
        return chosen

    def scan(self, text: str) -> tuple[int, list[dict], list[dict]]:
        """Number of words, base places and notices of a text."""
        flat, n_words = folded(text)
        places, starts = self.hits(flat)
        matches = self.matches(flat, starts)
        if not places and not matches:
            return n_words, [], []
        blanks = [at for at, char in enumerate(flat) if char == " "]
        spans = [match.span() for match in _WORD.finditer(text)]

        def where(start: int, end: int) -> dict:
            first, last = bisect_right(blanks, start) - 1, bisect_right(blanks, end - 1) - 1
            # A match may begin or end with a blank, which belongs to no word of it.
            first += flat[start] == " " and first + 1 < n_words and end > start + 1 and first < last
            last -= flat[end - 1] == " " and last > first
            first, last = min(first, n_words - 1), min(last, n_words - 1)
            return {"first_word": first, "last_word": last, "start": spans[first][0], "end": spans[last][1]}

        base = [
            {"label": self.base[place][0], "phrase": self.base[place][1], **where(start, start + len(self.base[place][1]))}
            for place, start in places
        ]
        notices = []
        for start, end, place, edits in matches:
            at = where(start, end)
            label, notice, _ = self.notices[place]
            notices.append({"label": label, "notice": notice, "edits": edits, **at, "text": text[at["start"] : at["end"]]})
        return n_words, base, notices


def find_notices(df: DataFrame, text: str = "text", notices: list[tuple[str, str]] = NOTICES, base: dict[str, str] = BASE) -> DataFrame:
    """The input without its text, with ``n_words``, ``base`` places and ``notices`` of each text.

    Words count from 0, both ends of a word range belong to it; characters are code
    points of the given text, the end exclusive.
    """
    inner, given = sheltered(df)
    keep, inside = [name for name in inner.columns if name != f"_in{df.columns.index(text)}"], f"_in{df.columns.index(text)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices, base)
        for batch in batches:
            found = [scanner.scan(value.as_py() or "") for value in batch.column(inside)]
            results = [pa.array([row[place] for row in found], kind) for place, kind in enumerate(_ARROW)]
            yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in keep], *results], [*keep, *_NEW])

    schema = T.StructType([*inner.select(*keep).schema.fields, *T.StructType.fromDDL(_DDL).fields])
    result = ("n_words", "base", "notices")
    return mapped(inner.select(*keep, inside), run, schema).select(
        *[given[name] for name in df.columns if name not in (text, *result)],
        *[F.col(inner_name).alias(name) for inner_name, name in zip(_NEW, result)],
    )


def notice_digest(found: DataFrame) -> DataFrame:
    """Counts, places, labels and a score of each row of ``find_notices``.

    The score is 1 with a base phrase, otherwise the best notice's share of
    characters without edits, and 0 without any notice.
    """
    labels = F.array_sort(F.array_distinct(F.concat("base.label", "notices.label")))
    best = F.array_max(F.transform("notices", lambda one: 1.0 - one["edits"] / F.length(one["notice"])))
    return found.select(
        *[name for name in found.columns if name not in ("base", "notices")],
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.first_word").alias("first_word"), F.array_max("base.first_word").alias("last_word"),
        F.concat_ws(",", F.array_sort(F.array_distinct("base.label"))).alias("base_labels"),
        F.concat_ws(",", labels).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )
