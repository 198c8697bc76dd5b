"""BPE encoding and decoding of whole texts with constant memory.

Encoding is a transducer with bounded lookahead. From the merge list alone it computes how
many symbols beyond a token's end can still change that token (``MergeList.lookahead``). A
pre-token is merged in windows; tokens that end at least that far before the window's end are
stable and are emitted, the rest stays. Most pre-tokens fit in one window, so all windows of a
slice of texts are merged together, in arrays. Texts longer than a slice are split, encoded and
decoded a run of pre-tokens (``RUN``) after another. Decoding feeds the bytes of one token after
another to an incremental UTF-8 state machine; ids and decoded text are hashed as they come.

The lookahead: a boundary at the end of a token changes only if a merge (a, b) crosses it with
a ending there. That merge happens or not depending on text to the right of b only through a
merge of lower rank whose left part lies on the right spine of b (b, its right part, and so
on). So the reach of a merge r is len(right(r)) plus the largest reach of a merge of lower rank
whose left part is on that spine, and the lookahead is the largest reach; one pass in rank
order finds it.

Defined results: null and empty texts have no tokens; rows without id and repeated rows are
kept as they are; the strings of special tokens in a text become those tokens, as in the
``tokenizers`` library.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from loopcount.llm.common import SLICE_BYTES, prepare, sliced, text_rows

#: White space in the sense of Unicode, which also ends a pre-token.
SPACE = "\t-\r \x85\xa0  -     　"
#: The pre-tokens of the vocabulary file ("pattern" of its split step); fixed values.
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+")
_SPACES = re.compile(f"[{SPACE}]+")
#: Words whose tokens a worker remembers; when full, it starts anew.
REMEMBERED = 1 << 18
#: Pre-tokens of a long text that are encoded together; longer words than that are not remembered.
RUN = 1 << 16
_NEVER = np.int64(1 << 40)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + other.index(b)) for b in range(256)]


class MergeList:
    """Merges by rank, with array lookups and the sufficient lookahead."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_of = {i: t for t, i in vocab.items()} | {i: t for t, i in self.specials.items()}
        alphabet = byte_alphabet()
        self.first = np.array([vocab[c] for c in alphabet], np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in alphabet], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[self._join(a, b)] for a, b in pairs], np.int64)
        self.pieces: dict[bool, dict[int, bytes]] = {}
        self.size = max(self.token_of) + 1
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made[order]
        length = np.zeros(self.size, np.int64)
        for i, t in self.token_of.items():
            length[i] = max(1, len(t.removesuffix(self.suffix)) if self.suffix else len(t))
        self.length = length
        self.proper, self.lookahead = self._reach(left.tolist(), right.tolist(), made.tolist())
        self.window = max(64, 4 * (self.lookahead + int(length.max())))

    def _join(self, a: str, b: str) -> str:
        return a + b

    def _reach(self, left: list[int], right: list[int], made: list[int]) -> tuple[bool, int]:
        right_part: dict[int, int] = {}
        born: dict[int, int] = {}
        farthest: dict[int, int] = {}
        proper, most = True, 0
        for rank, (a, b, c) in enumerate(zip(left, right, made)):
            proper &= born.get(a, -1) < rank and born.get(b, -1) < rank and c not in born
            reach, spine = 0, b
            while spine is not None:
                reach = max(reach, farthest.get(spine, 0))
                spine = right_part.get(spine)
            reach += int(self.length[b])
            farthest[a] = max(farthest.get(a, 0), reach)
            right_part.setdefault(c, b)
            born.setdefault(c, rank)
            most = max(most, reach)
        made_at = {c: i for i, c in reversed(list(enumerate(made)))}
        proper &= all(made_at.get(a, -1) < i and made_at.get(b, -1) < i for i, (a, b) in enumerate(zip(left, right)))
        return proper, most

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of each pair; a rank of _NEVER where there is no such merge."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = self.key[at] == key
        return np.where(hit, self.rank[at], _NEVER), self.made[at]

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """Apply the merges to every window (stretches of ``symbols`` of the given sizes), lowest
        rank first and leftmost among equals."""
        out: list[np.ndarray] = [symbols[:0]] * len(sizes)
        todo, symbols = np.arange(len(sizes)), symbols.copy()
        last = np.zeros(len(symbols), bool)
        last[np.cumsum(sizes) - 1] = True
        rank, product = np.full(len(symbols), _NEVER), np.zeros(len(symbols), np.int64)
        touched = np.flatnonzero(~last)
        while True:
            rank[touched], product[touched] = self.look_up(symbols[touched], symbols[touched + 1])
            start = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(rank, start)
            active = least < _NEVER
            if not active.all():
                for i, s, n in zip(todo[~active].tolist(), start[~active].tolist(), sizes[~active].tolist()):
                    out[i] = symbols[s:s + n]
                keep = np.repeat(active, sizes)
                symbols, rank, product, last = symbols[keep], rank[keep], product[keep], last[keep]
                todo, sizes, least = todo[active], sizes[active], least[active]
                if not len(todo):
                    break
                start = np.cumsum(sizes) - sizes
            at = np.flatnonzero(rank == np.repeat(least, sizes))
            owner = np.searchsorted(start, at, "right") - 1
            if self.proper:
                # All places of that rank; in a run of overlapping places every second one.
                new = np.ones(len(at), bool)
                new[1:] = at[1:] != at[:-1] + 1
                run = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
                chosen = (np.arange(len(at)) - run) % 2 == 0
            else:
                chosen = np.ones(len(at), bool)
                chosen[1:] = owner[1:] != owner[:-1]
            at, owner = at[chosen], owner[chosen]
            symbols[at] = product[at]
            last[at] = last[at + 1]
            rank[at] = _NEVER
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            moved = at - np.arange(len(at))
            symbols, rank, product, last = symbols[keep], rank[keep], product[keep], last[keep]
            sizes = sizes - np.bincount(owner, minlength=len(sizes))
            touched = np.unique(np.concatenate([moved, moved[moved > 0] - 1]))
            touched = touched[~last[touched]]
        return out

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The first symbols of all words, and the number of each word's."""
        coded = [w.encode("utf-8") for w in words]
        raw = np.frombuffer(b"".join(coded), np.uint8)
        sizes = np.array([len(c) for c in coded], np.int64)
        got = self.first[raw]
        end = np.cumsum(sizes) - 1
        got[end] = self.last[raw[end]]
        return got, sizes

    def stable_tokens(self, word: str, window: int | None = None) -> Iterator[np.ndarray]:
        """Tokens of a pre-token of any length, as soon as they are stable."""
        window = max(window or self.window, 2 * self.lookahead + 2 * int(self.length.max()))
        symbols, _ = self.symbols([word])
        at = 0
        while at < len(symbols):
            part = symbols[at:at + window]
            tokens, = self.merge(part, np.array([len(part)]))
            if at + window < len(symbols):
                end = np.cumsum(self.length[tokens])
                tokens = tokens[end <= window - self.lookahead - 1]
                at += int(end[len(tokens) - 1])
            else:
                at = len(symbols)
            yield tokens


class Encoder:
    """Texts to ids, with remembered words: (ids, ids joined by a space) of each."""

    def __init__(self, path: str):
        self.merges = MergeList(path)
        specials = sorted(self.merges.specials, key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self._specials = set(specials)
        self.known: dict[str, tuple[list[int], str]] = {}

    @staticmethod
    def normal(text: str) -> str:
        """NFC, white space runs as one space, each character in lower case by itself."""
        if text.isascii():
            return text.lower()
        text = _SPACES.sub(" ", unicodedata.normalize("NFC", text))
        return text.lower() if "Σ" not in text else "".join(map(str.lower, text))

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a whole text; a special token's string is one of its own."""
        if self._special is None or not any(s in text for s in self._specials):
            return WORDS.findall(self.normal(text))
        return list(self.each_word(text))

    def each_word(self, text: str) -> Iterator[str]:
        """The same one after another."""
        at = 0
        for m in self._special.finditer(text) if self._special else ():
            yield from (w[0] for w in WORDS.finditer(self.normal(text[at:m.start()])))
            yield m[0]
            at = m.end()
        yield from (w[0] for w in WORDS.finditer(self.normal(text[at:])))

    def ids(self, word: str) -> list[int]:
        if word in self._specials:
            return [self.merges.specials[word]]
        return [int(i) for part in self.merges.stable_tokens(word) for i in part]

    @staticmethod
    def _entry(ids: list[int]) -> tuple[list[int], str]:
        return ids, " ".join(map(str, ids))

    def learn(self, words: Iterable[str]) -> None:
        """Encode words not met yet: those of one window together, longer ones by streaming."""
        short = []
        for w in words:
            if len(w) > RUN:
                continue
            if w in self._specials or len(w) * 4 > self.merges.window:
                self.known[w] = self._entry(self.ids(w))
            else:
                short.append(w)
        for a in range(0, len(short), 20_000):
            part = short[a:a + 20_000]
            for w, ids in zip(part, self.merges.merge(*self.merges.symbols(part))):
                self.known[w] = self._entry(ids.tolist())

    def streams(self, texts: list[str]) -> Iterator[Iterator[tuple[list[int], str]]]:
        """Of each text the ids and the ids joined by a space, part after part."""
        if len(texts) > 1 or sum(map(len, texts)) <= SLICE_BYTES:
            split = [self.words(t) for t in texts]
            self._learn_all(set().union(*split))
            yield from map(self._emitted, split)
        else:
            yield from map(self._runs, texts)

    def _runs(self, text: str) -> Iterator[tuple[list[int], str]]:
        words = self.each_word(text)
        while run := list(islice(words, RUN)):
            self._learn_all(set(run))
            yield from self._emitted(run)

    def _learn_all(self, words: set[str]) -> None:
        new = words.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = words
        self.learn(new)

    def _emitted(self, words: list[str]) -> Iterator[tuple[list[int], str]]:
        found = list(map(self.known.get, words))
        at = 0
        for i in [i for i, e in enumerate(found) if e is None] if None in found else ():
            yield self._joined(found[at:i])
            for part in self.merges.stable_tokens(words[i]):
                yield self._entry(part.tolist())
            at = i + 1
        yield self._joined(found[at:])

    @staticmethod
    def _joined(entries: list[tuple[list[int], str]]) -> tuple[list[int], str]:
        return list(chain.from_iterable([e[0] for e in entries])), " ".join([e[1] for e in entries])


class Decoder:
    """Ids to text one token after another: ``feed`` returns what is certain by now.

    ``separator`` stands between tokens. With ``plain`` the pieces are the vocabulary's own
    strings, as ``tokenizers`` decodes a file without a decoder; else the bytes they stand for,
    with a space for the end of a word.
    """

    def __init__(self, merges: MergeList, plain: bool = True):
        self._state = codecs.getincrementaldecoder("utf-8")("replace")
        self._separator = b" " if plain else b""
        self._begun = False
        if plain not in merges.pieces:
            merges.pieces[plain] = dict(self._pieces(merges, plain))
        self._piece = merges.pieces[plain]

    @staticmethod
    def _pieces(merges: MergeList, plain: bool) -> Iterator[tuple[int, bytes]]:
        byte = {c: bytes([b]) for b, c in enumerate(byte_alphabet())}
        for i, t in merges.token_of.items():
            if plain or t in merges.specials:
                yield i, t.encode("utf-8")
            else:
                body, end = (t[:-len(merges.suffix)], b" ") if merges.suffix and t.endswith(merges.suffix) else (t, b"")
                yield i, b"".join(byte[c] for c in body) + end

    def feed(self, ids: Iterable[int]) -> str:
        pieces = list(map(self._piece.__getitem__, ids))
        if not pieces:
            return ""
        before = self._separator if self._begun else b""
        self._begun = True
        return self._state.decode(before + self._separator.join(pieces))

    def finish(self) -> str:
        return self._state.decode(b"", final=True)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text."""
    prepare(docs.sparkSession)

    def run(batches):
        encoder = _encoder(path)
        for batch in sliced(batches):
            n, ids, decoded = [], [], []
            for parts in encoder.streams([t or "" for t in batch.column(1).to_pylist()]):
                count, of_ids, of_text, decoder = 0, hashlib.sha256(), hashlib.sha256(), Decoder(encoder.merges)
                for part, joined in parts:
                    if part:
                        of_ids.update(f"{' ' if count else ''}{joined}".encode())
                        of_text.update(decoder.feed(part).encode("utf-8"))
                        count += len(part)
                of_text.update(decoder.finish().encode("utf-8"))
                n.append(count)
                ids.append(of_ids.hexdigest())
                decoded.append(of_text.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)], schema=_SCHEMA)

    return text_rows(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
