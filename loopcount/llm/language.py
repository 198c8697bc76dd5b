"""Language identification by interpolated Kneser-Ney character models, one a language.

Counting: every task counts windows of four characters of the training texts by language; Spark
adds the counts up over the whole corpus and writes them as a table, which grows with the
corpus. Letters of all scripts stand for themselves, in lower case; a run of other characters
is one symbol. Continuation counts, discounts and the calibration are sums and counts of that
table. A window's hash is 64 bits; a language's model is sorted arrays of hashes, of its windows
and their parts, with a number beside each, and is looked up by binary search.

Models reach the tasks in passes: the table is measured, and languages share a broadcast up to
``MODEL_ROWS`` windows; a language of more is cut by a hash of its windows' third character, so
that a window and all its shorter parts lie in one piece. Losses of several passes are added up
by Spark. So neither the driver nor a task holds more than a pass, however many languages there
are; with one pass, which is the rule, texts are scored where they are read.

Scoring: the language of the lowest cross-entropy per character wins. ``score`` is the winner's
posterior at the text's length (at most ``EVIDENCE`` characters count, neighbouring windows
being dependent), halved where it is rejected. Calibrated rejection: a language accepts a text
up to the middle between its entropy on its own counts and the entropy of text without any
structure (its letters in no order, or ``FLAT`` equally likely ones), plus ``DEVIATIONS``
standard errors at the text's length; entropy and error come from the corpus counts. So texts
that mix learned languages stay, and letters in no order go.

Defined results: texts that are null or have no letter get ``und`` and score 0; so does every
text where nothing was learned. Rows without language, id or letters teach nothing. Repeated
rows each count. Ties go to the language first in order.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loopcount.llm.common import held_out, mix, prepare, sliced, stored

ORDER = 4
#: Equally likely letters of a text without structure, at least.
FLAT = 32
EVIDENCE = 200
DEVIATIONS = 6.0
UNKNOWN = "und"
#: Windows of the models that tasks hold at once (about 100 bytes each when in use).
MODEL_ROWS = 1 << 22
#: Bytes of text whose windows are looked up together, each different one once.
SLICE = 1 << 21
#: Windows that a task counts before it passes them on, and whose values it remembers.
HELD = 1 << 20

_RATIO = np.uint64(0x9E3779B97F4A7C15)

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """The lower-case code point of each code point that is a letter, else 0."""
    if not _letters:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if not 0xD800 <= c < 0xE000:
                ch = chr(c)
                if ch.isalpha():
                    table[c] = ord(ch.lower()[0])
        _letters.append(table)
    return _letters[0]


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of all texts (0 for a run of characters that are no letters), the texts'
    offsets in them, and whether each text has a letter."""
    size = np.array([len(t) if t else 0 for t in texts], np.int64)
    joined = "".join([t or "" for t in texts])
    table = letters()
    code = table[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    ends = np.cumsum(size)
    keep = code > 0
    inner = keep.copy()
    inner[1:] |= keep[:-1]
    begin = ends[:-1] if len(size) else ends
    begin = begin[begin < len(code)]
    inner[begin] = keep[begin]
    at = np.concatenate([[0], np.cumsum(inner)])[np.concatenate([[0], ends])]
    n = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], ends])]
    return code[inner], at, np.diff(n) > 0


def windows(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The window (four symbols, 0 before a text) that ends at each symbol, the texts' offsets, and
    whether each text has a letter."""
    own, at, has = symbols(texts)
    place = np.arange(len(own)) - np.repeat(at[:-1], np.diff(at))
    rows = np.zeros((ORDER, len(own)), np.uint64)
    rows[-1] = own
    for back in range(1, ORDER):
        rows[-1 - back, back:] = own[:-back] if back else own
        rows[-1 - back, place < back] = 0
    return rows, at, has


def hashes(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each column of symbols: a polynomial, so that parts have theirs by the same rule."""
    key = np.zeros(rows.shape[1], np.uint64)
    for row in rows:
        key = key * _RATIO + mix(row)
    return key


def _distinct(rows: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different columns of ``rows``, and how often each occurs (or the sums of n)."""
    _, first, where = np.unique(hashes(rows), return_index=True, return_inverse=True)
    count = np.bincount(where, minlength=len(first)) if n is None else np.bincount(where, weights=n, minlength=len(first)).astype(np.int64)
    return rows[:, first], count


# --- counting ---------------------------------------------------------------------------


def count_windows(docs: DataFrame, training: Column) -> DataFrame:
    """(lang, a, b, c, d, n) over all training rows of ``docs`` (doc_id, text, lang)."""
    names = ["lang", "a", "b", "c", "d", "n"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def flush():
            for lang, (rows, n) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), *[pa.array(r.astype(np.int32)) for r in rows], pa.array(n.astype(np.int64))], names=names)
            held.clear()

        for batch in sliced(batches, size=SLICE):
            langs = np.array(batch.column(2).to_pylist(), dtype=object)
            texts = np.array(batch.column(1).to_pylist(), dtype=object)
            for lang in sorted(set(langs.tolist())):
                rows, n = _distinct(windows(texts[langs == lang].tolist())[0])
                if lang in held:
                    rows, n = _distinct(np.concatenate([held[lang][0], rows], axis=1), np.concatenate([held[lang][1], n]))
                held[lang] = rows, n
            if sum(len(n) for _, n in held.values()) > HELD:
                yield from flush()
        yield from flush()

    rows = docs.filter(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = rows.select("doc_id", "text", "lang").mapInArrow(run, "lang string, a int, b int, c int, d int, n long")
    return counted.groupBy("lang", "a", "b", "c", "d").agg(F.sum("n").alias("n"))


# --- models -----------------------------------------------------------------------------


@dataclass
class Levels:
    """What is the same for all pieces of a language: the discount of each order from 1, the
    symbols with their continuation counts, and after calibration the accepted entropy and the
    variance of a character's."""
    discounts: list[float]
    symbols: np.ndarray
    continuations: np.ndarray
    limit: float = 0.0
    variance: float = 0.0


def discount(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once else 0.5


class Model:
    """A piece of a language's model: sorted hashes with a number beside each, for the windows and
    for the contexts of every order."""

    def __init__(self, levels: Levels, rows: np.ndarray, n: np.ndarray):
        self.seen, self.contexts = {}, {}
        order = np.argsort(levels.symbols)
        total = max(1, int(levels.continuations.sum()))
        kinds = len(levels.symbols)
        flat = max(FLAT, kinds + 1)
        self.unseen = levels.discounts[0] * kinds / total / flat
        first = hashes(levels.symbols[order].astype(np.uint64)[None, :])
        self._add(self.seen, 1, first, np.maximum(levels.continuations[order] - levels.discounts[0], 0) / total + self.unseen)
        tables = {ORDER: (rows, n)}
        for k in range(ORDER - 1, 1, -1):  # of shorter windows: how many symbols stand before them
            tables[k] = _distinct(tables[k + 1][0][1:])
        for k in range(2, ORDER + 1):
            rows, n = tables[k]
            context = hashes(rows[:-1])
            key, where = np.unique(context, return_inverse=True)
            sums, kinds = np.bincount(where, weights=n), np.bincount(where)
            self._add(self.contexts, k, key, levels.discounts[k - 1] * kinds / sums)
            own = np.maximum(n - levels.discounts[k - 1], 0) / sums[where]
            self._add(self.seen, k, hashes(rows), own + self.contexts[k][1][np.searchsorted(self.contexts[k][0], context)] * self._of(k - 1, rows[1:]))

    @staticmethod
    def _add(tables: dict, k: int, key: np.ndarray, value: np.ndarray) -> None:
        order = np.argsort(key)
        tables[k] = key[order], value[order]

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], key: np.ndarray, default: np.ndarray | float) -> np.ndarray:
        if not len(table[0]):
            return np.broadcast_to(default, key.shape).astype(float)
        at = np.minimum(np.searchsorted(table[0], key), len(table[0]) - 1)
        return np.where(table[0][at] == key, table[1][at], default)

    def _of(self, k: int, rows: np.ndarray) -> np.ndarray:
        """Probability of each last symbol behind the k - 1 before it."""
        if k == 1:
            return self._find(self.seen[1], hashes(rows), self.unseen)
        shorter = self._find(self.contexts[k], hashes(rows[:-1]), 1.0) * self._of(k - 1, rows[1:])
        return self._find(self.seen[k], hashes(rows), shorter)

    def losses(self, rows: np.ndarray) -> np.ndarray:
        return -np.log(self._of(ORDER, rows))


def _piece(third: np.ndarray, pieces: int) -> np.ndarray:
    return (mix(third.astype(np.uint64)) % np.uint64(pieces)).astype(np.int64)


@dataclass
class Trained:
    """The written table of windows, and what was learned of each language (in order)."""
    counts: DataFrame
    languages: list[str]
    levels: dict[str, Levels]
    pieces: dict[str, int]
    rows: dict[str, int]

    def passes(self) -> list[list[tuple[str, int]]]:
        """(language, piece) of each broadcast."""
        out, held = [[]], 0
        for lang in self.languages:
            for piece in range(self.pieces[lang]):
                size = self.rows[lang] // self.pieces[lang]
                if out[-1] and held + size > MODEL_ROWS:
                    out, held = [*out, []], 0
                out[-1].append((lang, piece))
                held += size
        return out


@dataclass
class Pass:
    """What a task gets: the windows of some pieces of languages, and all languages' levels."""
    pieces: list[tuple[str, int, int, np.ndarray, np.ndarray]]
    languages: list[str]
    levels: dict[str, Levels]
    token: str = field(default_factory=lambda: uuid.uuid4().hex)


def train(docs: DataFrame, training: Column) -> Trained:
    """Counts over the whole corpus, in a table that Spark writes; the driver gets each language's
    discounts, symbols and sums."""
    counts = stored(count_windows(docs, training), "language-windows")
    tables = {ORDER: counts.select("lang", "a", "b", "c", "d", "n")}
    for k, keys in ((3, ["b", "c", "d"]), (2, ["c", "d"]), (1, ["d"])):
        tables[k] = stored(tables[k + 1].groupBy("lang", *keys).agg(F.count("*").alias("n")), f"language-order-{k}")
    shares = {k: {r["lang"]: r for r in t.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"),
                                                               F.count("*").alias("rows")).collect()} for k, t in tables.items()}
    found: dict[str, list[tuple[int, int]]] = {}
    for r in tables[1].orderBy("lang", "d").toLocalIterator():
        found.setdefault(r["lang"], []).append((r["d"], r["n"]))
    languages = sorted(found)
    levels = {x: Levels([discount(shares[k][x]["once"], shares[k][x]["twice"]) for k in range(1, ORDER + 1)],
                        *(np.array(v, np.int64) for v in zip(*found[x]))) for x in languages}
    rows = {x: shares[ORDER][x]["rows"] for x in languages}
    out = Trained(counts, languages, levels, {x: max(1, -(-rows[x] // MODEL_ROWS)) for x in languages}, rows)
    _calibrate(out)
    return out


def _calibrate(trained: Trained) -> None:
    """Each language's accepted cross-entropy and the variance of a character's, over its own counts."""
    if not trained.languages:
        return
    known = trained.counts.sparkSession.sparkContext.broadcast((trained.levels, trained.pieces))

    def add_piece(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column(0).dictionary_encode()
            piece, third = np.zeros(batch.num_rows, np.int32), np.asarray(batch.column(3))
            for i, x in enumerate(lang.dictionary.to_pylist()):
                mine = np.asarray(lang.indices) == i
                piece[mine] = _piece(third[mine], known.value[1][x])
            yield batch.append_column("piece", pa.array(piece))

    def run(table: pa.Table) -> pa.Table:
        rows, n = np.array([np.asarray(table[x]) for x in "abcd"], np.uint64), np.asarray(table["n"])
        lang = table["lang"][0].as_py()
        loss = Model(known.value[0][lang], rows, n).losses(rows)
        return pa.table({"lang": [lang], "n": [float(n.sum())], "loss": [float((n * loss).sum())], "square": [float((n * loss * loss).sum())]})

    rows = trained.counts.select("lang", "a", "b", "c", "d", "n").mapInArrow(add_piece, "lang string, a int, b int, c int, d int, n long, piece int")
    sums = rows.groupBy("lang", "piece").applyInArrow(run, "lang string, n double, loss double, square double")
    single = {x: 0.0 for x in trained.languages}
    alone = trained.counts.groupBy("lang", "d").agg(F.sum("n").cast("double").alias("n"))
    total = F.sum("n").alias("n")
    for r in alone.groupBy("lang").agg(total, F.sum(F.col("n") * F.log("n")).alias("s")).collect():
        single[r["lang"]] = float(np.log(r["n"]) - r["s"] / r["n"])
    for r in sums.groupBy("lang").agg(total, F.sum("loss").alias("loss"), F.sum("square").alias("square")).collect():
        level, entropy = trained.levels[r["lang"]], r["loss"] / r["n"]
        level.limit = (entropy + max(np.log(FLAT), single[r["lang"]])) / 2
        level.variance = max(0.0, r["square"] / r["n"] - entropy**2)


def _pass(trained: Trained, pieces: list[tuple[str, int]]) -> Pass:
    """The windows of some pieces, at most ``MODEL_ROWS`` of them (or a single piece)."""
    wanted = sorted({x for x, _ in pieces})
    got = trained.counts.filter(F.col("lang").isin(wanted)).toArrow().combine_chunks()
    lang = got["lang"].combine_chunks().dictionary_encode()
    number = {x: i for i, x in enumerate(lang.dictionary.to_pylist())}
    lang = np.asarray(lang.indices)
    rows, n = np.array([np.asarray(got[x]) for x in "abcd"], np.uint64).reshape(ORDER, -1), np.asarray(got["n"])
    out = []
    for x, piece in pieces:
        mine = np.flatnonzero(lang == number.get(x, -1))
        mine = mine[_piece(rows[2, mine], trained.pieces[x]) == piece] if trained.pieces[x] > 1 else mine
        out.append((x, piece, trained.pieces[x], rows[:, mine].astype(np.uint32), n[mine]))
    return Pass(out, trained.languages, trained.levels)


# --- scoring ----------------------------------------------------------------------------


class Scorer:
    """Looks windows up; what it has looked up it remembers, up to ``HELD`` windows."""

    def __init__(self, known: Pass):
        self.pieces = [(known.languages.index(x), piece, pieces, Model(known.levels[x], rows.astype(np.uint64), n)) for x, piece, pieces, rows, n in known.pieces]
        self.width = len(known.languages)
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros((0, self.width))

    def _new(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((rows.shape[1], self.width))
        for i, piece, pieces, model in self.pieces:
            mine = np.flatnonzero(_piece(rows[2], pieces) == piece) if pieces > 1 else slice(None)
            out[mine, i] = model.losses(rows[:, mine])
        return out

    def losses(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(one row a text, one column a language) sums of losses; symbols; whether there is a letter."""
        rows, at, has = windows(texts)
        key, first, where = np.unique(hashes(rows), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, key)
        hit = np.minimum(place, max(0, len(self.keys) - 1))
        new = np.flatnonzero(self.keys[hit] != key) if len(self.keys) else np.arange(len(key))
        if len(new):
            fresh = self._new(rows[:, first[new]])
            if len(self.keys) + len(new) > HELD:
                self.keys, self.values = np.zeros(0, np.uint64), np.zeros((0, self.width))
                fresh, new = self._new(rows[:, first]), np.arange(len(key))
            self.keys, order = np.unique(np.concatenate([self.keys, key[new]]), return_index=True)
            self.values = np.concatenate([self.values, fresh])[order]
        loss = self.values[np.searchsorted(self.keys, key)]
        out = np.zeros((len(texts), self.width))
        filled = np.flatnonzero(np.diff(at))
        for i in range(self.width):
            if len(filled):
                out[filled, i] = np.add.reduceat(loss[where, i], at[filled])
        return out, np.diff(at), has


_scorers: dict[str, Scorer] = {}


def _scorer(known: Pass) -> Scorer:
    if known.token not in _scorers:
        _scorers.clear()
        _scorers[known.token] = Scorer(known)
    return _scorers[known.token]


def verdict(sums: np.ndarray, n: np.ndarray, has: np.ndarray, languages: list[str], levels: dict[str, Levels]) -> list[pa.Array]:
    """Arrays (lang_pred, score, accepted, cross_entropy) from each text's sums of losses."""
    rows = len(n)
    known = has & (n > 0) & bool(languages)
    best, accepted, score, lowest = np.zeros(rows, int), known, np.zeros(rows), np.zeros(rows)
    if languages and rows:
        limit, variance = (np.array([getattr(levels[x], name) for x in languages]) for name in ("limit", "variance"))
        entropy = sums / np.maximum(n, 1)[:, None]
        best = entropy.argmin(axis=1)
        lowest = np.where(known, entropy[np.arange(rows), best], 0.0)
        weight = np.exp(-(entropy - entropy.min(axis=1)[:, None]) * np.minimum(n, EVIDENCE)[:, None])
        accepted = known & (lowest <= limit[best] + DEVIATIONS * np.sqrt(variance[best] / np.maximum(n, 1)))
        score = np.where(known, np.where(accepted, 1.0, 0.5) / weight.sum(axis=1), 0.0)
    return [pa.array([languages[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()), pa.array(score), pa.array(accepted), pa.array(lowest)]


RESULT = "lang_pred string, score double, accepted boolean, cross_entropy double"
_RESULT = ["lang_pred", "score", "accepted", "cross_entropy"]


def judged(docs: DataFrame, trained: Trained) -> DataFrame:
    """``docs`` with the columns of ``RESULT`` for each whole ``text``, under a struct ``found``."""
    sc = docs.sparkSession.sparkContext
    at = docs.columns.index("text")
    passes = trained.passes()

    def found(columns: list[pa.Array]) -> pa.Array:
        return pa.StructArray.from_arrays(columns, names=_RESULT)

    if len(passes) == 1:
        shared = sc.broadcast(_pass(trained, passes[0]))

        def run(batches) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches, at, SLICE):
                known = shared.value
                yield batch.append_column("found", found(verdict(*_scorer(known).losses(batch.column(at).to_pylist()), known.languages, known.levels)))

        return docs.mapInArrow(run, docs.select("*", F.lit(None).cast(f"struct<{RESULT.replace(' ', ':').replace(',:', ',')}>").alias("found")).schema)

    # Several passes: rows are numbered in a written table, and the losses of the passes added up.
    numbered = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "language-rows")
    parts = []
    for pieces in passes:
        shared = sc.broadcast(_pass(trained, pieces))

        def run(batches, shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches, 1, SLICE):
                sums, n, has = _scorer(shared.value).losses(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(sums), pa.list_(pa.float64())), pa.array(n), pa.array(has)], names=["_row", "sums", "n", "has"])

        parts.append(stored(numbered.select("_row", "text").mapInArrow(run, "_row long, sums array<double>, n long, has boolean"), "language-pass"))
    total = F.array(*[F.sum(F.col("sums")[i]) for i in range(len(trained.languages))]).alias("sums")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    added = every.groupBy("_row").agg(total, F.max("n").alias("n"), F.max("has").alias("has"))
    light = sc.broadcast((trained.languages, trained.levels))

    def judge(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.array(batch.column(1).to_pylist(), float).reshape(batch.num_rows, -1)
            columns = verdict(sums, np.asarray(batch.column(2)), np.asarray(batch.column(3).to_pylist(), bool), *light.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), found(columns)], names=["_row", "found"])

    verdicts = added.select("_row", "sums", "n", "has").mapInArrow(judge, f"_row long, found struct<{RESULT.replace(' ', ':').replace(',:', ',')}>")
    return numbered.join(verdicts, "_row").select(*docs.columns, "found")


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang), with all their columns, that a language accepts."""
    prepare(docs.sparkSession)
    rows = judged(docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text")), train(_training_rows(docs), _training()))
    return rows.filter("found.accepted").select("row.*")


def _training_rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))


def _training() -> Column:
    return F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))


def languages_of(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted, cross_entropy); learned from rows not held out."""
    prepare(docs.sparkSession)
    rows = _training_rows(docs)
    found = judged(rows.select("doc_id", "text"), train(rows, _training()))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "found.*")
