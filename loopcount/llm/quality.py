"""Quality classifier: a generalised additive model with pairwise interactions.

Features are numbers of the whole text (lengths, shares of kinds of characters and words,
repetition), computed in arrays over slices of texts. Training is cyclic boosting: in every
round each feature in turn gets one shallow tree on its bins, added to the feature's lookup
table; then the pairs with the strongest remaining interaction are boosted in the same way.
A score is the logistic of the sum of table entries, found by binning alone.

The model is fitted on a sample of at most ``SAMPLE`` labelled rows that are not held out, by a
hash of the id; every row is scored. The number of rounds is chosen on a fifth of the sample.

Defined results: null and empty texts have features like any other text (all zero) and get the
score learned for them. A doc_id that is labelled more than once counts once, with the larger
label. Without usable labels every score is 0.5; with labels of one kind, that label's share.
Repeated rows and rows without id are scored each.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loopcount.llm.common import held_out, prepare, sliced, span_hashes, runs, mix, text_rows, utf8

#: Labelled rows that the model is fitted on, at most.
SAMPLE = 20_000
THRESHOLD = 0.3
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 80
RATE = 0.15
LEAVES = 3
RIDGE = 1.0

# --- features ---------------------------------------------------------------------------

FEATURES = ("log_bytes", "log_words", "word_bytes", "upper", "digit", "symbol", "stop", "wide", "lines", "odd_end",
            "no_letter", "capital_words", "distinct_words", "top_word", "distinct_triples", "distinct_lines", "stops_per_word", "short_words")
_SPACE, _UPPER, _LOWER, _DIGIT, _STOP, _SYMBOL, _WIDE = range(7)


def _kinds() -> np.ndarray:
    kind = np.full(256, _SYMBOL, np.uint8)
    kind[[*range(9, 14), 32]] = _SPACE
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = _UPPER, _LOWER, _DIGIT, _WIDE
    kind[[ord(c) for c in ".,;:!?'\"()-"]] = _STOP
    return kind


_KIND = _kinds()


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per owner: the number of different hashes and the count of the most frequent one."""
    if not len(owner):
        return np.zeros(n), np.zeros(n)
    key = np.sort((owner.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
    first = np.concatenate([[True], key[1:] != key[:-1]])
    begin = np.flatnonzero(first)
    count = np.diff(np.append(begin, len(key)))
    mine = (key[begin] >> np.uint64(44)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, mine, count)
    return np.bincount(mine, minlength=n).astype(float), top


def features(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text of a slice (fewer than 2**20 rows)."""
    raw, at = utf8(column)
    n = len(column)
    kind = _KIND[raw]
    size = np.diff(at).astype(float)
    total = np.maximum(size, 1)
    share = []
    for k in range(7):
        part = np.concatenate([[0], np.cumsum(kind == k)])
        share.append((part[at[1:]] - part[at[:-1]]).astype(float))
    newline = np.concatenate([[0], np.cumsum(raw == 10)])
    lines = (newline[at[1:]] - newline[at[:-1]]).astype(float) + 1
    begin, end = runs(kind != _SPACE, at)
    owner = np.searchsorted(at, begin, "right") - 1
    words = np.bincount(owner, minlength=n).astype(float)
    per_word = np.maximum(words, 1)
    of_word = lambda hit: np.bincount(owner[hit], minlength=n) / per_word
    inside = lambda *kinds: np.concatenate([[0], np.cumsum(np.isin(kind, kinds))])
    letters, uppers = inside(_UPPER, _LOWER, _WIDE), inside(_UPPER)
    n_letters = letters[end] - letters[begin]
    hashes = span_hashes(raw, begin, end)
    distinct, top = _distinct(owner, hashes, n)
    same = (owner[2:] == owner[:-2]) if len(owner) > 2 else np.zeros(0, bool)
    triple = mix(hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(5) + hashes[2:] * np.uint64(7)) if len(owner) > 2 else hashes[:0]
    triples, _ = _distinct(owner[:-2][same], triple[same], n)
    line_begin, line_end = runs(raw != 10, at)
    line_owner = np.searchsorted(at, line_begin, "right") - 1
    full_lines = np.bincount(line_owner, minlength=n).astype(float)
    distinct_lines, _ = _distinct(line_owner, span_hashes(raw, line_begin, line_end), n)
    alpha = np.maximum(share[_UPPER] + share[_LOWER], 1)
    out = np.stack([
        np.log1p(size), np.log1p(words), (size - share[_SPACE]) / per_word, share[_UPPER] / alpha, share[_DIGIT] / total,
        share[_SYMBOL] / total, share[_STOP] / total, share[_WIDE] / total, lines / total, of_word(kind[end - 1] == _SYMBOL),
        of_word(n_letters == 0), of_word((uppers[end] - uppers[begin] == n_letters) & (n_letters > 1)), distinct / per_word, top / per_word,
        triples / np.maximum(words - 2, 1), distinct_lines / np.maximum(full_lines, 1), share[_STOP] / per_word, of_word(end - begin <= 2),
    ], axis=1)
    return out


# --- the model --------------------------------------------------------------------------


@dataclass
class Additive:
    """Lookup tables by feature and by pair of features."""
    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-total))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The gain and place of the best cut of a stretch of bins; place 0: none."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    best = int(gain.argmax())
    return (float(gain[best]), best + 1) if gain[best] > 1e-9 else (0.0, 0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Leaf values by bin of a tree that is grown by its best cut until it has ``leaves``."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(*_best_cut(g[a:b], h[a:b]), i) for i, (a, b) in enumerate(parts)]
        gain, place, i = max(cuts)
        if not place:
            break
        a, b = parts.pop(i)
        parts += [(a, a + place), (a + place, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The gain and the leaf values of a tree of depth two: one cut of the rows, then of each side's columns."""
    best = (0.0, np.zeros_like(g))
    for cut in range(1, len(g)):
        out, gain = np.zeros_like(g), -float(_gain(g.sum(), h.sum()))
        for a, b in ((0, cut), (cut, len(g))):
            gs, hs = g[a:b].sum(axis=0), h[a:b].sum(axis=0)
            more, _ = _best_cut(gs, hs)
            gain += more + float(_gain(gs.sum(), hs.sum()))
            out[a:b] = _shallow_tree(gs, hs, 2)
        if gain > best[0]:
            best = (gain, out)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    if not len(y):
        return Additive(0.0)
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Additive(float(np.log(share / (1 - share))))
    if y.min() == y.max():
        return model
    quantiles = lambda n: [np.unique(np.quantile(x[:, j], np.arange(1, n) / n)) for j in range(x.shape[1])]
    model.edges, model.coarse = quantiles(BINS), quantiles(PAIR_BINS)
    fine = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    rough = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.coarse)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    check = np.arange(len(y)) % 5 == 4
    check &= len(y) >= 50
    learn = ~check
    total = np.full(len(y), model.base)

    def loss() -> float:
        rows = check if check.any() else learn
        t = total[rows]
        return float((np.logaddexp(0, t) - y[rows] * t).mean())

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return np.where(learn, y - p, 0), np.where(learn, p * (1 - p), 0)

    def boost(tables: list[np.ndarray], cells: list[np.ndarray], tree) -> None:
        """Cycles over the tables while the loss on the checked rows falls; keeps the best state."""
        nonlocal total
        best = (loss(), [t.copy() for t in tables], total.copy())
        for r in range(ROUNDS):
            for table, cell in zip(tables, cells):
                g, h = slopes()
                shape = table.shape
                step = RATE * tree(np.bincount(cell, g, table.size).reshape(shape), np.bincount(cell, h, table.size).reshape(shape))
                table += step
                total = total + step.reshape(-1)[cell]
            now = loss()
            if now < best[0]:
                best = (now, [t.copy() for t in tables], total.copy())
            elif now > best[0] * 1.05 + 1e-4:
                break
        for table, kept in zip(tables, best[1]):
            table[...] = kept
        total = best[2]

    boost(model.tables, fine, lambda g, h: _shallow_tree(g, h, LEAVES))
    g, h = slopes()
    strength = []
    for a in range(x.shape[1]):
        for b in range(a + 1, x.shape[1]):
            shape = (len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)
            cell = rough[a] * shape[1] + rough[b]
            gain, _ = _pair_tree(np.bincount(cell, g, shape[0] * shape[1]).reshape(shape), np.bincount(cell, h, shape[0] * shape[1]).reshape(shape))
            strength.append((gain, a, b))
    model.pairs = [(a, b) for gain, a, b in sorted(strength, key=lambda s: (-s[0], s[1:]))[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)) for a, b in model.pairs]
    if model.pairs:
        boost(model.pair_tables, [rough[a] * (len(model.coarse[b]) + 1) + rough[b] for a, b in model.pairs], lambda g, h: _pair_tree(g, h)[1])
    return model


# --- on Spark ---------------------------------------------------------------------------

_ROW = "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES)


def train(docs: DataFrame, labels: DataFrame) -> Additive:
    """The model from at most SAMPLE labelled rows of ``docs`` that are not held out."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    n = known.count()
    place = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30))
    # A little fewer than SAMPLE rows pass the hash; the limit only makes the bound certain.
    chosen = known.filter(place < int(min(1.0, 0.97 * SAMPLE / max(n, 1)) * (1 << 30))).orderBy("doc_id").limit(SAMPLE)

    def run(batches):
        for batch in sliced(batches):
            x = features(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, x.T)], names=["doc_id", *FEATURES])

    rows = text_rows(docs).join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    got = rows.mapInArrow(run, _ROW).join(F.broadcast(chosen), "doc_id").orderBy("doc_id", *FEATURES).limit(SAMPLE).toArrow()
    x = np.stack([np.asarray(got[f]) for f in FEATURES], axis=1) if got.num_rows else np.zeros((0, len(FEATURES)))
    return fit(x, np.asarray(got["quality"], dtype=float))


def score(docs: DataFrame, model: Additive) -> DataFrame:
    """(doc_id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(features(batch.column(1))))], names=["doc_id", "score"])

    return text_rows(docs).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches THRESHOLD."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    at = docs.columns.index("text")

    def run(batches):
        for batch in sliced(batches, at):
            yield batch.filter(pa.array(shared.value.score(features(batch.column(at))) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def quality_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    prepare(docs.sparkSession)
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
