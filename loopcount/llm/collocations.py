"""Phrase collocations by dynamic itemset counting.

The corpus is dealt into ``SHARDS`` shards, scanned in a cycle; lengths are interleaved. Words
are counted from the first shard on. A longer phrase becomes active as soon as both phrases of
one word less in it (all but its last, all but its first word) have reached the threshold in
what was scanned so far, at whatever shard that is, and is counted from the next shard on until
it has seen each shard once. Scanning ends when nothing is active. A phrase at the threshold
has all its parts at the threshold, so every such phrase is activated at last, and every count
of an activated phrase is a full cycle's, hence exact.

Which phrases have reached the threshold, and after which step, stands in one table of bytes a
length, by hash (``slots``: a sixteenth of the text's bytes, at most ``MOST_SLOTS``), which
tasks get by broadcast. A slot keeps the first step written to it. So a phrase that shares its
slot with a frequent one may be active early or needlessly, at the same step in all tasks, and
is still counted for one full cycle: collisions cost time, never a count.

Tasks count in arrays: words of a slice of texts are numbered exactly, phrases are numbers of
pairs. Words are added up as text; a phrase is the 64-bit keys of its words, added up by Spark
together with what was counted before, so a step has one shuffle. A phrase that ends its cycle
below the threshold is left out. At the end phrases are spelled by joins with the words; if
another word has the key of a frequent one, all is counted again with other keys.

Defined results: a null text is empty; a null lang counts as ``und``; a document counts as
often as it occurs, ids don't matter. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loopcount.llm.common import mix, prepare, runs, shared_folder, sliced, span_hashes, stored, utf8

SHARDS = 2
MOST_SLOTS = 1 << 24
LEAST_SLOTS = 1 << 16
#: Bytes of text counted together in a task; a longer text is counted alone.
SLICE = 1 << 20
NEVER = 255

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"] + list(range(10, 14))] = True
_SEPARATOR = _BREAK.copy()
_SEPARATOR[[32, 9]] = True
_FIRST, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

_WORDS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("c", pa.int64())])


class SameKey(Exception):
    """Two words have one key; they are counted again with other keys."""


def _keys(lang: pa.Array, word: pa.Array, salt: int) -> np.ndarray:
    """The 64-bit key of each word of a language."""
    def hashes(column: pa.Array) -> np.ndarray:
        raw, at = utf8(column)
        return span_hashes(raw, at[:-1], at[1:])
    return mix(hashes(word) * _LAST + mix(hashes(lang) + np.uint64(salt) * _FIRST))


def _longer(key: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mix(key * _FIRST + last * _LAST)


class Words:
    """The words of a slice of texts in order: ``number`` counts pairs of language and word, whose
    ``keys`` and texts are known; ``follows`` marks words whose next word stands in the same piece."""

    def __init__(self, lang: pa.Array, text: pa.Array, salt: int = 0):
        raw, at = utf8(text)
        raw = _LOWER[raw]
        inside = ~_SEPARATOR[raw]
        begin, end = runs(inside, at)
        ends = np.zeros(len(begin) + 1, np.int64)
        np.cumsum(end - begin, out=ends[1:])
        words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(ends), pa.py_buffer(raw[inside])).dictionary_encode()
        langs = lang.fill_null("und").cast(pa.large_string()).dictionary_encode()
        doc = np.searchsorted(at, begin, side="right") - 1
        n_langs = max(1, len(langs.dictionary))
        number = np.asarray(words.indices).astype(np.int64) * n_langs + np.asarray(langs.indices)[doc]
        count = np.bincount(number, minlength=len(words.dictionary) * n_langs)
        seen = np.flatnonzero(count)
        place = np.zeros(len(count), np.int64)
        place[seen] = np.arange(len(seen))
        self.number, self.count = place[number], count[seen]
        self.lang, self.text = langs.dictionary.take(pa.array(seen % n_langs)), words.dictionary.take(pa.array(seen // n_langs))
        self.keys = _keys(self.lang, self.text, salt)
        breaks = np.cumsum(_BREAK[raw])[begin] if len(begin) else begin
        self.follows = (doc[:-1] == doc[1:]) & (breaks[:-1] == breaks[1:])

    def counted(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([self.lang.cast(pa.string()), self.text.cast(pa.string()), pa.array(self.count.astype(np.int64))], schema=_WORDS)


def _columns(longest: int) -> list[str]:
    return [f"k{i}" for i in range(1, longest + 1)]


def count_active(words: Words, reached: list[np.ndarray], step: int, shards: int) -> Iterator[pa.RecordBatch]:
    """(size, keys of the words, since, c) of the phrases that are active in this step: their counts,
    and the step after which they became active. reached: for each length but the last, the table
    of steps after which its phrases reached the threshold."""
    n, longest = max(1, len(words.keys)), len(reached) + 1
    # Positions whose phrase of ``size`` words lies in one piece and whose two parts are reached.
    place = np.arange(len(words.number))
    key, code, since = words.keys[words.number], words.number, np.zeros(len(place), np.uint8)
    for size, table in enumerate(reached, 2):
        # No earlier than its own parts, whatever phrase shares its slot.
        when = np.maximum(table[(key & np.uint64(len(table) - 1)).astype(np.int64)], since)
        # place is sorted; the part that begins at the next word has to be a reached one too.
        at = np.flatnonzero((place[:-1] + 1 == place[1:]) & words.follows[place[:-1]]) if len(place) else place
        since = np.maximum(when[at], when[at + 1])
        at, since = at[since != NEVER], since[since != NEVER]
        last = words.number[place[at] + size - 1]
        key, code, place = _longer(key[at], words.keys[last]), code[at] * n + last, place[at]
        active = since >= max(0, step - shards)
        if active.any():
            _, where, count = np.unique(code[active], return_index=True, return_counts=True)
            begin = place[active][where]
            keys = [pa.array(words.keys[words.number[begin + k]].view(np.int64) if k < size else np.zeros(len(begin), np.int64)) for k in range(longest)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(begin), size, np.int32)), *keys, pa.array(since[active][where].astype(np.int32)),
                                              pa.array(count.astype(np.int64))], names=["size", *_columns(longest), "since", "c"])
        if size < longest:  # small numbers again for the next length
            code = np.unique(code, return_inverse=True)[1]


def _each_slice(fn):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced([batch], size=SLICE):
                yield from fn(part)
    return run


def _slots_of(reached: DataFrame, n_slots: int) -> np.ndarray:
    """The slots of phrases (k1, k2, ...): one bit each, put together by Spark, at most ``MOST_SLOTS`` of them."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.asarray(batch.column(0)).view(np.uint64)
            for column in batch.columns[1:]:
                key = _longer(key, np.asarray(column).view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array((key & np.uint64(n_slots - 1)).astype(np.int64))], names=["slot"])

    slots = reached.mapInArrow(run, "slot long")
    bits = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toArrow()
    word, value = np.asarray(bits["word"]), np.asarray(bits["bits"]).astype(np.int64)
    on = np.unpackbits(value.view(np.uint8), bitorder="little").reshape(-1, 64).astype(bool) if len(word) else np.zeros((0, 64), bool)
    row, bit = np.nonzero(on)
    return word[row] * 64 + bit


def _with_keys(words: DataFrame, salt: int) -> DataFrame:
    """Words (lang, phrase, ...) with their key ``k1``."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("k1", pa.array(_keys(batch.column(0), batch.column(1), salt).view(np.int64)))

    return words.mapInArrow(run, words.select("*", F.lit(0).cast("long").alias("k1")).schema)


def phrase_counts(documents: DataFrame, longest: int = 3, at_least: int = 10, shards: int = SHARDS) -> list[DataFrame]:
    """For each length from 1: (lang, phrase, c), the exact counts of all words, and of the longer
    phrases that occur ``at_least`` times."""
    spark = documents.sparkSession
    prepare(spark)
    own = F.xxhash64(F.col("doc_id").cast("string"), "text")
    docs = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.pmod(own, F.lit(shards)).cast("int").alias("shard"))
    folder = shared_folder(spark, "dic-shards")
    docs.write.partitionBy("shard").parquet(folder)
    corpus = spark.read.schema("lang string, text string, shard int").parquet(folder)
    salt = 0
    while True:
        try:
            return _cycle(corpus, longest, at_least, shards, salt)
        except SameKey:
            salt += 1


def _cycle(corpus: DataFrame, longest: int, at_least: int, shards: int, salt: int) -> list[DataFrame]:
    spark = corpus.sparkSession
    size_of = corpus.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_slots = 1 << min(MOST_SLOTS.bit_length() - 1, max(LEAST_SLOTS.bit_length() - 1, int(size_of // 16).bit_length()))
    reached = [np.full(n_slots, NEVER, np.uint8) for _ in range(longest - 1)]
    newly: dict[tuple[int, int], bool] = {}  # (length, step): something reached the threshold then
    columns = _columns(longest)
    ddl = "size int, " + ", ".join(f"{c} long" for c in columns) + ", since int, c long"
    words = phrases = None

    def counted(rows: DataFrame, before: DataFrame | None, key: list[str]) -> DataFrame:
        """Totals after a step, and of them what the step added."""
        now = rows.withColumn("new", F.col("c"))
        both = now if before is None else now.unionByName(before.withColumn("new", F.lit(0).cast("long")))
        return both.groupBy(*key).agg(F.sum("c").alias("c"), F.sum("new").alias("new"))

    risen = (F.col("c") >= at_least) & (F.col("c") - F.col("new") < at_least)
    for step in range(longest * shards):
        shard = corpus.filter(F.col("shard") == step % shards).select("lang", "text")
        slots: dict[int, np.ndarray] = {}
        # A phrase's slots may be another's, so any shorter length may have activated it.
        active = [k for k in range(2, longest + 1) if any(newly.get((j, s)) for j in range(1, k) for s in range(max(0, step - shards), step))]
        if active:
            known = spark.sparkContext.broadcast(reached)
            run = _each_slice(lambda part, known=known, step=step: count_active(Words(part.column(0), part.column(1), salt), known.value, step, shards))
            total = counted(shard.mapInArrow(run, ddl), phrases, ["size", *columns, "since"])
            # A full cycle below the threshold: out.
            total = stored(total.filter((F.col("c") >= at_least) | (F.col("since") + shards > step)), f"dic-phrases-{step}")
            known.destroy()
            for k in [k for k in active if k < longest]:
                slots[k] = _slots_of(total.filter((F.col("size") == k) & risen).select(*columns[:k]), n_slots)
            phrases = total.drop("new")
        if step < shards:
            run = _each_slice(lambda part: [Words(part.column(0), part.column(1)).counted()])
            total = stored(counted(shard.mapInArrow(run, "lang string, phrase string, c long"), words, ["lang", "phrase"]), f"dic-words-{step}")
            if longest > 1:
                slots[1] = _slots_of(_with_keys(total.filter(risen), salt).select("k1"), n_slots)
            words = total.drop("new")
        for k, found in slots.items():
            newly[k, step] = bool(len(found))
            table = reached[k - 1]
            table[found[table[found] == NEVER]] = step

    out = [words]
    if longest > 1:
        # Phrases are spelled by the keys of their words; no other word may have the key of a frequent one.
        keyed = stored(_with_keys(words, salt), "dic-vocabulary")
        if keyed.groupBy("k1").agg(F.count("*").alias("n"), F.max("c").alias("c")).filter((F.col("n") > 1) & (F.col("c") >= at_least)).head(1):
            raise SameKey
        frequent = keyed.filter(F.col("c") >= at_least)
        none = spark.createDataFrame([], ddl).drop("since")
        many = none if phrases is None else phrases.drop("since").filter(F.col("c") >= at_least)
        for k in range(2, longest + 1):
            spelled = many.filter(F.col("size") == k)
            for i, c in enumerate(columns[:k]):
                word = frequent.select(F.col("k1").alias(f"key{i}"), F.col("phrase").alias(f"w{i}"), *([F.col("lang").alias("lang")] if i == 0 else []))
                spelled = spelled.join(word, F.col(c) == F.col(f"key{i}"))
            out.append(stored(spelled.select("lang", F.concat_ws(" ", *[f"w{i}" for i in range(k)]).alias("phrase"), "c"), f"dic-length-{k}"))
    return out


def collocations(documents: DataFrame, longest: int = 3, at_least: int = 10, first: int = 2000, share: int = 50, shards: int = SHARDS) -> DataFrame:
    """Each language's ``first`` phrases (lang, rank, phrase, a, l, r, n, score) of two to ``longest``
    words: score is floor(10**6 a a / (l r)) of the lowest-scoring cut into two parts of counts l
    and r; phrases inside a longer one of ``share`` percent of their count are dropped."""
    by_size = phrase_counts(documents, longest, at_least, shards)
    n = by_size[0].groupBy("lang").agg(F.sum("c").alias("n"))
    known = reduce(DataFrame.unionByName, by_size[:-1]).filter(F.col("c") >= at_least)
    candidates = reduce(DataFrame.unionByName, by_size[1:]).select("lang", "phrase", F.col("c").alias("a")).withColumn("words", F.split("phrase", " "))

    part = lambda name, count: known.select(F.col("lang").alias(f"{name}_lang"), F.col("phrase").alias(name), F.col("c").alias(count))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr("array_join(slice(words, 1, k), ' ')").alias("head"),
                       F.expr("array_join(slice(words, k + 1, size(words)), ' ')").alias("rest"))
    heads, rests = part("part1", "l"), part("part2", "r")
    cuts = cuts.join(heads, (F.col("lang") == F.col("part1_lang")) & (F.col("head") == F.col("part1")))
    cuts = cuts.join(rests, (F.col("lang") == F.col("part2_lang")) & (F.col("rest") == F.col("part2")))
    exact = F.expr("(1000000 * cast(a as decimal(38, 0)) * a) div (cast(l as decimal(38, 0)) * r)")
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut"))

    inner = candidates.filter(F.size("words") > 2).withColumn("k", F.explode(F.sequence(F.lit(2), F.size("words") - 1)))
    inner = inner.withColumn("at", F.explode(F.expr("sequence(1, size(words) - k + 1)")))
    inner = inner.select("lang", F.expr("array_join(slice(words, at, k), ' ')").alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))

    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= first)
    return ranked.join(F.broadcast(n), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
