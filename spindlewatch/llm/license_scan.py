"""Licence notices in texts, exact and with small errors.

A text's words, lower-cased and joined by single spaces, are searched for short notices. A notice with at most
``k`` errors, cut into ``k + 1`` pieces, has at least one piece without error: pieces are found as plain strings,
and only the neighbourhood of one is matched with bounded errors, on word boundaries.
"""

from typing import NamedTuple

import pyarrow as pa
import regex

from spindlewatch.llm.common import list_array, map_texts, ship
from spindlewatch.llm.decontaminate import words_of_text

ship(__name__)

# The phrases whose exact places count, with their labels.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# Notices that are also found with errors.
NOTICES = [
    *BASE,
    ("gpl", "gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms"),
    ("mpl", "mozilla public license"),
    ("cc", "creative commons attribution"),
    ("reserved", "all rights reserved"),
]

# One error per so many bytes of a notice.
BYTES_PER_ERROR = 8

NOTICE = pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("errors", pa.int32())])
PLACE = pa.struct([("label", pa.string()), ("start", pa.int32())])


class Search(NamedTuple):
    label: str
    phrase: bytes
    errors: int
    pieces: list
    match: object


def searches(notices, bytes_per_error=BYTES_PER_ERROR):
    """Pieces and pattern of each notice."""
    out = []
    for label, phrase in notices:
        data = phrase.encode()
        errors = len(data) // bytes_per_error
        at = [len(data) * i // (errors + 1) for i in range(errors + 2)]
        pieces = [(a, data[a:b]) for a, b in zip(at, at[1:])]
        pattern = regex.compile(rb"(?b)(?<= )(?:%s){e<=%d}(?= )" % (regex.escape(data, literal_spaces=True), errors))
        out.append(Search(label, data, errors, pieces, pattern))
    return out


def occurrences(text, phrase):
    at = text.find(phrase)
    while at >= 0:
        yield at
        at = text.find(phrase, at + 1)


def candidates(text, search):
    """Neighbourhoods of exact pieces, in order; those that overlap as one."""
    around = []
    for offset, piece in search.pieces:
        for at in occurrences(text, piece):
            start = at - offset - search.errors - 1
            around.append((max(0, start), at - offset + len(search.phrase) + search.errors + 1))
    out = []
    for start, end in sorted(around):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def notices_in(text, search):
    """(start, end, errors) in ``text`` of every notice that matches within its errors, none overlapping.

    Of a range the best match comes first, wherever it is; what is before and behind it is searched in turn.
    """
    ranges, out = list(map(tuple, candidates(text, search))), []
    while ranges:
        start, end = ranges.pop()
        found = search.match.search(text, start, end)
        if found is None or found.start() == found.end():
            continue
        a, b = found.span()
        ranges += [(start, a), (b, end)]
        # No part of a word left over, and no space taken for a letter at either end.
        if text[a] != 0x20 and text[b - 1] != 0x20:
            out.append((a, b, sum(found.fuzzy_counts)))
    return sorted(out)


def scan_text(words, base, patterns):
    """Exact places of the base phrases, and all notices, by word."""
    text = b" " + b" ".join(words) + b" "
    places, notices = [], []
    for label, phrase in base:
        for at in occurrences(text, phrase):
            places.append({"label": label, "start": text.count(b" ", 0, at)})
    for search in patterns:
        for a, b, errors in notices_in(text, search):
            first = text.count(b" ", 0, a) - 1
            last = first + text.count(b" ", a, b) + 1
            notices.append({"label": search.label, "start": first, "end": last, "errors": errors})
    places.sort(key=lambda p: p["start"])
    notices.sort(key=lambda n: (n["start"], n["label"]))
    return places, notices


def find_licenses(docs, text="text", base=BASE, notices=NOTICES, keep=None):
    """``docs`` with n_words, ``places``, ``notices`` and ``score``; columns of those names are replaced.

    ``places`` are all places where a base phrase's words stand in a row (label and first word, from 0), also
    overlapping ones. ``notices`` are the matches with errors (label, span of words, end excluded, and the
    number of edited bytes of the joined words). ``score`` is 1 for an exact notice, less by the share of
    edited bytes for the best other, and 0 without any. A null or empty text has no words and no notice.
    """
    lengths = {label: len(phrase.encode()) for label, phrase in notices}
    fields = [
        ("n_words", pa.int64(), "bigint"),
        ("places", pa.list_(PLACE), "array<struct<label:string,start:int>>"),
        ("notices", pa.list_(NOTICE), "array<struct<label:string,start:int,end:int,errors:int>>"),
        ("score", pa.float64(), "double"),
    ]

    def make():
        exact = [(label, b" " + phrase.encode() + b" ") for label, phrase in base]
        patterns = searches(notices)

        def run(texts):
            counts, places, found, scores = [], [], [], []
            for content in texts:
                words = words_of_text(content)
                here, near = scan_text(words, exact, patterns) if words else ([], [])
                counts.append(len(words))
                places.append(here)
                found.append(near)
                best = [1.0] * bool(here) + [1.0 - n["errors"] / lengths[n["label"]] for n in near]
                scores.append(max(best, default=0.0))
            return [
                pa.array(counts, pa.int64()),
                list_array(places, PLACE),
                list_array(found, NOTICE),
                pa.array(scores, pa.float64()),
            ]

        return run

    return map_texts(docs, text, fields, make, keep)
