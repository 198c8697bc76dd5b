"""License scans: exact phrases by words, and fuzzy search for short notices.

Fuzzy search: a notice of m characters may be hit with k = m // 10 edits. Cut into k + 1 pieces,
at least one piece survives any k edits (pigeonhole), so all pieces of all notices are looked up
at once by an Aho-Corasick automaton, and only around its hits the ``regex`` library's
bounded-error matching verifies the notice and reports span and edits. Letters A-Z are
compared in lower case, and each white-space character as a space; spans refer to the
text as given.

Base phrases are places where a phrase's words stand consecutively, words being runs of
``[0-9a-z]`` and all characters beyond ASCII.

Defined results: null and empty texts have no words, labels or findings and score 0. Where
findings overlap, the one of fewest edits is kept, then the first, then the longest, then that
of the notice listed first. Repeated rows and rows without id are scanned each. The score is the largest share of
a found notice that needed no edit; 1 where a base phrase stands; 0 without any.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from loopcount.llm.common import runs, prepare, sliced, text_rows, utf8

#: Phrase and label of the base scan.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Short notices of well-known licenses and the label of each.
NOTICES = {
    "licensed under the apache license, version 2.0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted, free of charge, to any person obtaining a copy": "mit",
    "licensed under cc by-nc": "cc-by-nc",
    "licensed under cc by-sa": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "under the gnu general public license": "gpl",
    "under the gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "all rights reserved": "reserved",
    "dedicated to the public domain": "public-domain",
}
EDITS_PER_CHARACTER = 1 / 10

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_PLAIN = {c: c + 32 for c in range(65, 91)} | {c: 32 for c in (9, 10, 11, 12, 13)}


@dataclass(frozen=True)
class Finding:
    notice: str
    label: str
    begin: int
    end: int
    edits: int

    @property
    def likeness(self) -> float:
        return 1 - self.edits / len(self.notice)


class Notices:
    """The searcher for a set of notices."""

    def __init__(self, notices: dict[str, str] = NOTICES, edits_per_character: float = EDITS_PER_CHARACTER):
        self.notices = [(text, label, int(len(text) * edits_per_character)) for text, label in notices.items()]
        self.patterns = [regex.compile(rf"(?b)(?:{regex.escape(text)}){{e<={k}}}") for text, _, k in self.notices]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for i, (text, _, k) in enumerate(self.notices):
            cut = [len(text) * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(cut, cut[1:]):
                pieces.setdefault(text[a:b], []).append((i, a))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[Finding]:
        plain = text.translate(_PLAIN)
        found: dict[int, set[tuple[int, int, int]]] = {}
        exact: dict[int, int] = {}
        for end, (size, places) in self.automaton.iter(plain):
            for i, offset in places:
                notice, _, k = self.notices[i]
                begin = end + 1 - size - offset
                if exact.get(i, -1) == begin:
                    continue
                if plain.startswith(notice, max(begin, 0)) and begin >= 0:
                    exact[i] = begin
                    found.setdefault(i, set()).add((0, begin, begin + len(notice)))
                    continue
                if not k:
                    continue
                m = self.patterns[i].search(plain, max(0, begin - k), begin + len(notice) + k)
                if m:
                    found.setdefault(i, set()).add((sum(m.fuzzy_counts), m.start(), m.end()))
        out: list[Finding] = []
        kept: list[tuple[int, int]] = []
        spans = [(edits, begin, -end, i) for i, mine in found.items() for edits, begin, end in mine]
        for edits, begin, minus, i in sorted(spans):
            # Kept spans don't overlap, so only the two neighbours can meet this one.
            at = bisect_left(kept, (begin, -minus))
            if (at and kept[at - 1][1] > begin) or (at < len(kept) and kept[at][0] < -minus):
                continue
            kept.insert(at, (begin, -minus))
            out.append(Finding(*self.notices[i][:2], begin, -minus, edits))
        return sorted(out, key=lambda f: f.begin)


def base_places(column: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, str]]]]:
    """Number of words, and (word number, label) of all base places, of each text of a slice."""
    raw, at = utf8(column)
    raw = _LOWER[raw]
    inside = _WORD[raw]
    begin, _ = runs(inside, at)
    first = np.searchsorted(begin, at)
    places: list[list[tuple[int, str]]] = [[] for _ in range(len(column))]
    joined = raw.tobytes()
    gap = rb"[^0-9a-z\x80-\xff]+"
    for phrase, label in BASE.items():
        for m in re.finditer(gap.join(w.encode() for w in phrase.split()), joined):
            a, b = m.span()
            doc = int(np.searchsorted(at, a, "right")) - 1
            if b <= at[doc + 1] and (a == at[doc] or not inside[a - 1]) and (b == at[doc + 1] or not inside[b]):
                places[doc].append((int(np.searchsorted(begin, a) - first[doc]), label))
    return np.diff(first), places


_FIELDS = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
           ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
           ("findings", pa.list_(pa.struct([("label", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())])))]
_DDL = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "findings array<struct<label string, begin long, end long, edits long>>")


def scan(docs: DataFrame, notices: dict[str, str] = NOTICES) -> DataFrame:
    """A row a text: base places and labels, fuzzy findings (spans in characters), labels, score."""
    prepare(docs.sparkSession)

    def run(batches) -> Iterator[pa.RecordBatch]:
        searcher = Notices(notices)
        for batch in sliced(batches):
            n_words, places = base_places(batch.column(1))
            rows = []
            for text, base in zip(batch.column(1).to_pylist(), places):
                found = searcher.find(text) if text else []
                labels = {label for _, label in base}
                at = [p for p, _ in base]
                score = 1.0 if base else max((f.likeness for f in found), default=0.0)
                rows.append((len(base), min(at, default=None), max(at, default=None), ",".join(sorted(labels)),
                             ",".join(sorted(labels | {f.label for f in found})), score,
                             [{"label": f.label, "begin": f.begin, "end": f.end, "edits": f.edits} for f in found]))
            columns = [batch.column(0), pa.array(n_words, pa.int64())]
            columns += [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_FIELDS[2:])]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(_FIELDS))

    return text_rows(docs).mapInArrow(run, _DDL)
