"""Fuzzy search for short license notices (operator 1).

Method: every notice phrase may be found with up to ``edits`` character edits.
By the pigeonhole principle a phrase cut into ``edits + 1`` pieces keeps one
piece intact in any such place, so an Aho-Corasick scan for all pieces (the
exact seeds) proposes every place. The ``regex`` library then matches the
phrase with bounded errors in the small window around each seed, which verifies
the place and gives its edit count and span.

Texts are lower-cased (A-Z only) and reduced to their words, joined by single
spaces; a place starts and ends at word boundaries. One text is one row and
nothing is shuffled. Places of one notice that overlap are reduced to the ones
with the fewest edits (then the leftmost); places without edits never overlap
each other, so none of those is lost.

Defined results: a null or empty text has no words, no place, score 0; repeated
rows each give their own row; a text of any length is scanned whole, in time in
proportion to its length and, per place, the logarithm of their number; extra
columns are kept, but for one named ``license_scan``, which the result replaces.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import small_batches


class Notice(NamedTuple):
    label: str
    phrase: str
    base: bool = False


# The three base notices of the task, then the labels this method adds.
NOTICES = (
    Notice("mit", "under the mit license", True),
    Notice("apache-2", "apache license version 2", True),
    Notice("cc-by-nc", "cc by nc", True),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Notice("apache-2", "licensed under the apache license version 2 0"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification"),
    Notice("gpl", "gnu general public license"),
    Notice("lgpl", "gnu lesser general public license"),
    Notice("agpl", "gnu affero general public license"),
    Notice("mpl", "mozilla public license"),
    Notice("epl", "eclipse public license"),
    Notice("cc-by", "creative commons attribution license"),
    Notice("cc-by-nc", "creative commons attribution noncommercial"),
    Notice("cc-by-sa", "creative commons attribution sharealike"),
    Notice("cc0", "cc0 1 0 universal public domain dedication"),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose"),
    Notice("unlicense", "this is free and unencumbered software released into the public domain"),
    Notice("all-rights-reserved", "all rights reserved"),
)

# One edit is allowed for each so many characters of a phrase.
CHARS_PER_EDIT = 10

SCHEMA = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, places array<struct<label: string, phrase: string, base: boolean, edits: int, "
    "first_word: bigint, start: bigint, end: bigint>>"
)

_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def edits_for(phrase: str) -> int:
    return len(phrase) // CHARS_PER_EDIT


def pieces(phrase: str, edits: int) -> list[tuple[int, str]]:
    """``(offset, piece)`` of ``edits + 1`` pieces of nearly equal length that make up the phrase."""
    n = edits + 1
    cuts = [len(phrase) * i // n for i in range(n + 1)]
    return [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=4)
def _machine(notices: tuple[Notice, ...]):
    """Seed automaton and bounded-error patterns, built once in a worker."""
    import ahocorasick
    import regex

    seeds: dict[str, list[tuple[int, int]]] = {}
    patterns = []
    for i, n in enumerate(notices):
        k = edits_for(n.phrase)
        patterns.append((regex.compile(rf"(?b)(?<= )(?:{regex.escape(n.phrase)}){{e<={k}}}(?= )"), k))
        for at, piece in pieces(n.phrase, k):
            seeds.setdefault(piece, []).append((i, at))
    automaton = ahocorasick.Automaton()
    for piece, uses in seeds.items():
        automaton.add_word(piece, (len(piece), uses))
    automaton.make_automaton()
    return automaton, patterns


def find_places(joined: str, notices: tuple[Notice, ...] = NOTICES) -> list[tuple[int, int, int, int]]:
    """``(start, end, notice, edits)`` in the joined words, by start."""
    automaton, patterns = _machine(notices)
    candidates = set()
    for last, (size, uses) in automaton.iter(joined):
        for i, at in uses:
            candidates.add((i, last + 1 - size - at))
    found: dict[int, set[tuple[int, int, int]]] = {}
    for i, begin in candidates:
        pattern, k = patterns[i]
        # one character more on either side for the word boundaries
        window = (max(0, begin - k - 1), begin + len(notices[i].phrase) + k + 1)
        if m := pattern.search(joined, *window):
            found.setdefault(i, set()).add((sum(m.fuzzy_counts), m.start(), m.end()))
    out = []
    for i, places in found.items():
        # kept places don't overlap, so by start they are by end too, and only the neighbours can be in the way
        kept: list[tuple[int, int, int]] = []
        for edits, a, b in sorted(places):
            at = bisect_left(kept, (a,))
            if (at == 0 or kept[at - 1][1] <= a) and (at == len(kept) or kept[at][0] >= b):
                kept.insert(at, (a, b, edits))
        out += [(a, b, i, edits) for a, b, edits in kept]
    return sorted(out)


def scan_text(text: str | None, notices: tuple[Notice, ...] = NOTICES) -> tuple:
    words = (text or "").encode().translate(_TO_WORDS).split()
    joined = f" {b' '.join(words).decode()} "
    places = find_places(joined, notices) if words else []
    if not places:
        return len(words), 0, None, None, "", "", 0.0, []
    spans = [m.span() for m in re.finditer("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text)]
    blanks = [m.start() for m in re.finditer(" ", joined)]
    rows = []
    for a, b, i, edits in places:
        first, last = bisect_left(blanks, a) - 1, bisect_left(blanks, b) - 1
        n = notices[i]
        rows.append((n.label, n.phrase, n.base, edits, first, spans[first][0], spans[last][1]))
    base = [r for r in rows if r[2] and r[3] == 0]
    return (
        len(words),
        len(base),
        min((r[4] for r in base), default=None),
        max((r[4] for r in base), default=None),
        ",".join(sorted({r[0] for r in base})),
        ",".join(sorted({r[0] for r in rows})),
        max(1 - r[3] / len(r[1]) for r in rows),
        rows,
    )


def license_scan(docs: DataFrame, text: str = "text", notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """``docs`` with one more column ``license_scan``, a struct of ``SCHEMA``; other columns are kept.

    ``places`` holds every place: label, phrase, edits, first word, and the span
    in code points of the given text.
    """
    names = [f.split()[0] for f in SCHEMA.split(", ")[:8]]

    @F.pandas_udf(SCHEMA)
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = [scan_text(t, notices) for t in texts]
        out = pd.DataFrame(rows, columns=names)
        for c in ("first_word", "last_word"):
            out[c] = out[c].astype("Int64")
        out["places"] = [[dict(zip(_PLACE, p)) for p in r[7]] for r in rows]
        return out

    return small_batches(docs).withColumn("license_scan", scan(F.col(text).cast("string")))


_PLACE = ("label", "phrase", "base", "edits", "first_word", "start", "end")


def summary(scanned: Column) -> list[Column]:
    """The summary columns of a ``license_scan`` struct."""
    return [
        scanned[c].alias(c)
        for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places")
    ]
