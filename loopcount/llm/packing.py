"""Hierarchical packing of documents into sequences of several lengths.

Every task tokenises its documents and packs them in windows of bounded size, so that no id
crosses the network. A document longer than the longest context gives whole sequences of that
length; its rest is routed to the smallest context tier that holds it. Tiers are packed from
the longest to the shortest, each into sequences of its own length: a rest of the tier opens a
sequence, the gap is filled with the largest rests that fit (best fit, from its own and all
shorter tiers), and the last of the gap by cutting one rest. What a tier has left has, with all
shorter ones, fewer ids than one of its sequences, and waits for the task's next documents; at
the end of a task its pieces become sequences of powers of two. So no sequence needs padding.

Sequences of one tier are dealt to step groups of equal number whose attention cost (the sum of
squared piece lengths) is balanced: the costliest sequences go first, each to the lightest group
that has room.

Defined results: a document with null or empty text consists of the end id alone; rows without
id and repeated rows are packed as documents of their own.
"""

from __future__ import annotations

import heapq
import json
import zlib
from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from loopcount.llm.bpe import byte_alphabet
from loopcount.llm.common import prepare, sliced, text_rows

CONTEXT = 1024
#: Shorter contexts; a rest goes to the smallest that holds it.
TIERS = (128, 256, 512, 1024)
#: Ids that a task holds before it packs them; a longer document is a window of its own.
WINDOW_IDS = 1 << 21
STEP_SEQUENCES = 8
END_ID = 0

#: The split pattern that the vocabulary file names by "ByteLevel" with "use_regex"; a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokens:
    """Ids of whole texts, the same as the ``tokenizers`` library's, by the faster ``tiktoken``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {c: bytes([b]) for b, c in enumerate(byte_alphabet())}
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {b"".join(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in specials}
        self._fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=specials)
        self._specials = set(specials)
        self._path, self._slow = path, None

    def __call__(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        try:
            return self._fast.encode_to_numpy(text, allowed_special=self._specials, disallowed_special=())
        except BaseException as e:  # its regular expressions give up on very long runs of white space
            if type(e).__name__ != "PanicException" and not isinstance(e, ValueError):
                raise
            if self._slow is None:  # seldom needed, so not held by every worker
                self._slow = Tokenizer.from_file(self._path)
                self._slow.no_truncation()
                self._slow.no_padding()
            return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint32)


def split_rests(lengths: list[int], context: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Whole sequences and rests, each as (length, document, start)."""
    whole, rests = [], []
    for doc, n in enumerate(lengths):
        whole += [(context, doc, at) for at in range(0, n - context + 1, context)]
        if n % context:
            rests.append((n % context, doc, n - n % context))
    return whole, rests


def pack_rests(rests: list[tuple[int, int, int]], context: int, tiers: tuple[int, ...]):
    """(full sequences of the tiers' lengths as lists of pieces, pieces left over: of each tier and
    all shorter ones fewer ids than one of its sequences)."""
    tier_of = lambda n: next(t for t in tiers if n <= t)
    shelves: dict[int, list[tuple[int, int, int]]] = {t: [] for t in tiers}
    for rest in rests:
        shelves[tier_of(rest[0])].append(rest)
    for shelf in shelves.values():
        shelf.sort()
    order = sorted(tiers, reverse=True)
    full = []

    def take_best(gap: int, among: list[int]):
        """The longest rest of at most ``gap`` ids."""
        for t in among:
            shelf = shelves[t]
            if shelf and shelf[0][0] <= gap:
                return shelf.pop(bisect_right(shelf, (gap, 1 << 62, 0)) - 1)
        return None

    for at, length in enumerate(order):
        among = order[at:]
        left = sum(r[0] for t in among for r in shelves[t])
        while shelves[length] and left >= length:
            first = shelves[length].pop()
            pieces, gap = [first], length - first[0]
            while gap:
                best = take_best(gap, among)
                if best is None:  # every rest is longer: cut the shortest one
                    n, doc, start = next(shelves[t].pop(0) for t in reversed(among) if shelves[t])
                    best, rest = (gap, doc, start), (n - gap, doc, start + gap)
                    insort(shelves[tier_of(rest[0])], rest)
                pieces.append(best)
                gap -= best[0]
            full.append(pieces)
            left -= length
    return full, [r for t in order for r in reversed(shelves[t])]


def powers(pieces: list[tuple[int, int, int]], context: int) -> list[list[tuple[int, int, int]]]:
    """The pieces one after another in sequences whose lengths are powers of two."""
    left, out, i, used = sum(p[0] for p in pieces), [], 0, 0
    while left:
        room = min(context, 1 << (left.bit_length() - 1))
        left -= room
        sequence = []
        while room:
            n, doc, start = pieces[i]
            step = min(room, n - used)
            sequence.append((step, doc, start + used))
            used, room = used + step, room - step
            if used == n:
                i, used = i + 1, 0
        out.append(sequence)
    return out


def step_groups(sequences: list[list[tuple[int, int, int]]], size: int) -> list[int]:
    """A group for each sequence: ``size`` sequences a group, attention cost balanced."""
    cost = [sum(p[0] * p[0] for p in s) for s in sequences]
    groups = [(0, g, 0) for g in range(-(-len(sequences) // size))]
    heapq.heapify(groups)
    out = [0] * len(sequences)
    for i in sorted(range(len(sequences)), key=lambda i: (-cost[i], i)):
        load, g, n = heapq.heappop(groups)
        out[i] = g
        if n + 1 < size:
            heapq.heappush(groups, (load + cost[i], g, n + 1))
    return out


_FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
           ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int64()), ("step_group", pa.int64())]
_SCHEMA = pa.schema(_FIELDS)
_DDL = ", ".join(f"{name} long" for name, _ in _FIELDS)
_tokens: dict[str, Tokens] = {}


class _Task:
    """Packs one task's documents; sequence ids and group ids start at the task's own base."""

    def __init__(self, base: int, context: int, tiers: tuple[int, ...]):
        self.base, self.context, self.tiers = base, context, tiers
        self.sequences = self.groups = 0
        self.left: list[tuple[int, int, int]] = []
        self.held: list[tuple[int | None, np.ndarray]] = []

    def window(self, docs: list[tuple[int | None, np.ndarray]], final: bool) -> pa.RecordBatch:
        """Pack what was left and ``docs``; the pieces left over wait for the next window."""
        begin = len(self.held)
        docs = self.held + docs
        whole, rests = split_rests([len(ids) for _, ids in docs[begin:]], self.context)
        shift = lambda pieces: [(n, doc + begin, start) for n, doc, start in pieces]
        full, left = pack_rests(self.left + shift(rests), self.context, self.tiers)
        sequences = [[p] for p in shift(whole)] + full
        if final:
            sequences += powers(left, self.context)
            left = []
        by_tier = defaultdict(list)
        for s in sequences:
            by_tier[sum(p[0] for p in s)].append(s)
        columns: list[list] = [[] for _ in _FIELDS]
        for tier in sorted(by_tier, reverse=True):
            group = step_groups(by_tier[tier], STEP_SEQUENCES)
            for s, g in zip(by_tier[tier], group):
                offset = 0
                for n, doc, start in s:
                    doc_id, ids = docs[doc]
                    row = (doc_id, start, n, zlib.crc32(ids[start:start + n].tobytes()), len(ids),
                           self.base + self.sequences, offset, tier, self.base + self.groups + g)
                    for column, value in zip(columns, row):
                        column.append(value)
                    offset += n
                self.sequences += 1
            self.groups += max(group) + 1
        used = sorted({doc for _, doc, _ in left})
        renamed = {doc: i for i, doc in enumerate(used)}
        self.held = [docs[doc] for doc in used]
        self.left = [(n, renamed[doc], start) for n, doc, start in left]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_SCHEMA)


def pack(docs: DataFrame, path: str, context: int = CONTEXT, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group): a row a piece."""
    prepare(docs.sparkSession)

    def run(batches) -> Iterator[pa.RecordBatch]:
        if path not in _tokens:
            _tokens[path] = Tokens(path)
        encode = _tokens[path]
        task = _Task(TaskContext.get().partitionId() << 36, context, tiers)
        window, size = [], 0
        end = np.array([END_ID], np.uint32)
        for batch in sliced(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.concatenate([encode(text or ""), end]).astype("<u4", copy=False)
                if size and size + len(ids) > WINDOW_IDS:
                    yield task.window(window, final=False)
                    window, size = [], 0
                window.append((doc_id, ids))
                size += len(ids)
        yield task.window(window, final=True)

    return text_rows(docs).mapInArrow(run, _DDL)
