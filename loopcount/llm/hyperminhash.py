"""Near-duplicate detection with HyperMinHash sketches, and the components of its links.

A document is the set of its distinct word n-grams, as 64-bit hashes. The top bits of a hash
choose one of ``BUCKETS`` buckets; a bucket keeps its smallest hash as a 16-bit register: the
number of leading zeros, then ``MANTISSA`` bits behind the first one. An empty bucket borrows
the register of another one, found in an order of its own that is the same in all documents;
so a register of two sets agrees with the probability of their Jaccard similarity, however
small the sets are.

Candidates share a band, ``ROWS`` consecutive registers. A candidate's similarity is estimated
from its agreeing registers, less those that two different minima share by chance (expected
from the sizes of both sets); from ``SLACK`` below the wanted similarity, texts are read and
full sets compared. At a similarity of 0.8 a pair shares none of the 51 bands with a
probability of 2e-9 for independent registers, and is estimated below 0.6 with one of 2e-12;
the dependence of borrowed registers raises both to some 1e-7.

Documents with identical sets (of equal size and two equal 64-bit sums over mixed hashes) are
one class, and classes are compared by their smallest document. Groups are not expanded into
all their pairs: a first round compares the members of a band's list with its smallest member,
a second one with a member chosen by hash, another in each list. The last round compares, in
blocks of ``BLOCK`` members, all whose components still differ, and passes on the pairs (once,
from the first band they share) whose estimate is high enough and whose sets can overlap enough
by their bitmaps (each bit of one that the other lacks stands for an n-gram the other lacks).
A pair that is left out lies in one component already.

Defined results: a text without words, or null, has an empty set, its own component and no
links; with fewer than n words the whole sequence is the only n-gram. A row without id has no
component (null), links with nothing and has a null ``kept``. Rows that share an id are
linked, if both have words. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loopcount.llm.common import mix, prepare, sliced, small_enough, stored, text_rows
from loopcount.llm.jaccard import bitmap, components, shingle_sets

BUCKETS = 256
MANTISSA = 10
ROWS = 5
BANDS = BUCKETS // ROWS
#: An estimate may stay this far below the wanted similarity.
SLACK = 0.2
#: Bits, one a register, that may differ in the second round: a fourth (a tenth is expected at 0.8).
FAR = 64
#: Members of a list that are compared in one task; shorter lists share tasks of about TASK_ROWS members.
BLOCK = 512
TASK_ROWS = 4096
#: The bands are made for similarities from here on.
LEAST_PERCENT = 80
#: Identical sets from which a class is looked up by broadcast, not in one shuffled group.
HOT_COPIES = 2048

_RANDOM = np.random.default_rng(11)
#: The buckets that an empty bucket asks, in its order.
_BORROW = np.array([_RANDOM.permutation(BUCKETS) for _ in range(BUCKETS)])
_EDGES = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(56)
_BAND_SEED = _RANDOM.integers(1, 2**63, size=(BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_PLACE = _RANDOM.integers(1, 2**63, size=BUCKETS, dtype=np.uint64) | np.uint64(1)
_SUMS = [np.uint64(x) for x in _RANDOM.integers(1, 2**63, size=3)]


def registers(x: np.ndarray) -> np.ndarray:
    """The ``BUCKETS`` registers of a sorted set of hashes; all 0 for the empty set."""
    if not len(x):
        return np.zeros(BUCKETS, np.uint16)
    at = np.searchsorted(x, _EDGES)
    end = np.append(at[1:], len(x))
    filled = at < end
    # 53 of the 56 bits behind the bucket's number, so that a double holds them exactly.
    value = ((x[np.minimum(at, len(x) - 1)] << np.uint64(8)) >> np.uint64(11)).astype(np.float64)
    part, exponent = np.frexp(value)
    mantissa = np.where(value > 0, (2 * part - 1) * (1 << MANTISSA), 0).astype(np.int64)
    out = ((np.where(value > 0, 53 - exponent, 53) << MANTISSA) + mantissa).astype(np.uint16)
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = _BORROW[empty]
        out[empty] = out[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return out


@lru_cache(maxsize=4096)
def _chance(size_class: int) -> float:
    load = 2.0 ** (size_class / 2) / BUCKETS
    zeros = np.arange(54)[:, None]
    low = 2.0 ** (-zeros - 1) * (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA))
    width = 2.0 ** (-zeros - 1) / (1 << MANTISSA)
    p = np.exp(-load * low) * -np.expm1(-load * width)
    return float((p * p).sum() / (p.sum() ** 2))


def by_chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that registers of different minima agree, for sets of about equal size: the sum
    over all registers of the squared probability that a bucket's smallest hash has it."""
    classes = np.rint(np.log2(np.maximum(n * 1.0, 1)) + np.log2(np.maximum(m * 1.0, 1))).astype(np.int64)
    found, where = np.unique(classes, return_inverse=True)
    return np.array([_chance(int(c)) for c in found])[where] if len(found) else np.zeros(0)


def estimate(n: np.ndarray, a: np.ndarray, m: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard similarity of sets of n and m elements with registers a and b
    (one row a pair)."""
    agree = (a == b).mean(axis=1)
    chance = by_chance(n, m)
    return np.maximum(0.0, (agree - chance) / (1 - chance))


def short_bits(x: np.ndarray) -> np.ndarray:
    """One bit of every register as four longs; a register that others borrowed gives each of
    them a bit of its own."""
    mixed = mix(x.astype(np.uint64) * _PLACE + _PLACE)
    return np.packbits((mixed >> np.uint64(63)).astype(bool), bitorder="little").view(np.int64)


_SKETCH = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("registers", pa.binary()), ("bitmap", pa.binary())])
_SKETCH_DDL = "doc_id long, n long, s1 long, s2 long, registers binary, bitmap binary"


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """Size, identity, registers and bitmap of every document's set."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            n, s1, s2, regs, maps = [], [], [], [], []
            for x in shingle_sets(batch.column(1), words):
                x = np.sort(mix(x + _SUMS[0]))
                n.append(len(x))
                s1.append(int(mix(x + _SUMS[1]).sum(dtype=np.uint64)) - (1 << 63))
                s2.append(int(mix(x ^ _SUMS[2]).sum(dtype=np.uint64)) - (1 << 63))
                regs.append(registers(x).tobytes())
                maps.append(bitmap(x))
            numbers = [pa.array(c, pa.int64()) for c in (n, s1, s2)]
            columns = [batch.column(0), *numbers, pa.array(regs, pa.binary()), pa.array(maps, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=_SKETCH)

    return docs.mapInArrow(run, _SKETCH_DDL)


def _register_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def bands(classes: DataFrame) -> DataFrame:
    """(key, band, rep, n) for each band of every class."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            regs = _register_rows(batch.column(2))[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
            key = mix((mix(regs + _BAND_SEED) * _BAND_SEED).sum(axis=2, dtype=np.uint64))
            at = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
            band = pa.array(np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows))
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), band, batch.column(0).take(at), batch.column(1).take(at)],
                                             names=["key", "band", "rep", "n"])

    return classes.select("rep", "n", "registers").mapInArrow(run, "key long, band int, rep long, n long")


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose estimated similarity is at most ``SLACK`` below the wanted one."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = np.asarray(batch.column(2)), np.asarray(batch.column(4))
            found = estimate(n, _register_rows(batch.column(3)), m, _register_rows(batch.column(5)))
            at = pa.array(np.flatnonzero(found >= percent / 100 - SLACK))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    of = lambda s: classes.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("registers").alias(f"registers_{s}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "n_a", "registers_a", "n_b", "registers_b").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The links (u, v): pairs whose full sets, read from their texts, have the similarity."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "hmh-ids")
    few = small_enough(ids, 16)
    texts = stored(docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi"), "hmh-texts")

    def run(batches) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None, None)
        for batch in batches:
            for part in sliced(sliced([batch], text_column=1), text_column=3):
                keys = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist()))
                fresh = [i for i, key in enumerate(keys) if key != (keys[i - 1] if i else last[:2])]
                left = dict(zip(fresh, shingle_sets(part.column(1).take(pa.array(fresh, pa.int64())), words))) if fresh else {}
                keep = []
                for i, y in enumerate(shingle_sets(part.column(3), words)):
                    if i in left:
                        last = (*keys[i], left[i])
                    x = last[2]
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    if shared and 100 * shared >= percent * (len(x) + len(y) - shared):
                        keep.append(i)
                at = pa.array(keep, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(2).take(at)], names=["u", "v"])

    of = lambda s: texts.select(F.col("doc_id").alias(s), F.coalesce("text", F.lit("")).alias(f"text_{s}"))
    joined = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "text_a", "b", "text_b")
    return joined.mapInArrow(run, "u long, v long")


def _folded(maps: list[bytes]) -> dict[int, np.ndarray]:
    """The bitmaps of each length and, folded in two, of twice that length, as words; rows of others are 0."""
    sizes = np.array([len(m) for m in maps])
    out = {}
    for size in np.unique(sizes).tolist():
        rows = np.zeros((len(maps), size // 8), np.uint64)
        for i in np.flatnonzero((sizes == size) | (sizes == 2 * size)):
            words = np.frombuffer(maps[i], np.uint64)
            rows[i] = words if len(words) == size // 8 else words[:size // 8] | words[size // 8:]
        out[size] = rows
    return out


def pairs_of_list(rep, n, comp, regs, maps: list[bytes], block, band: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (a, b), a < b, of members that may be linked: components differ, sizes, registers and
    bitmaps allow the similarity, and no earlier band than the list's is shared, as its list has
    them too. Where members are of two blocks, only pairs across these."""
    folded, sizes = _folded(maps), np.array([len(m) for m in maps])
    two = block.min() != block.max()
    left, right = [], []
    for i in range(len(rep)):
        ok = (comp != comp[i]) & (n * 100 >= percent * n[i]) & (n[i] * 100 >= percent * n)
        # Each pair once: from the first block, or from the member of the smaller id.
        ok &= ((block > block[i]) if two else (rep > rep[i]))
        at = np.flatnonzero(ok)
        same = regs[at] == regs[i]
        at, same = (x[estimate(n[at], regs[at], np.full(len(at), n[i]), regs[i]) >= percent / 100 - SLACK] for x in (at, same))
        at = at[~same[:, :band * ROWS].reshape(len(at), band, ROWS).all(axis=2).any(axis=1)]
        for size in np.unique(np.minimum(sizes[at], sizes[i])).tolist():
            some = at[np.minimum(sizes[at], sizes[i]) == size]
            mine, other = folded[size][i], folded[size][some]
            shared = np.minimum(n[i] - np.bitwise_count(mine & ~other).sum(axis=1, dtype=np.int64), n[some] - np.bitwise_count(other & ~mine).sum(axis=1, dtype=np.int64))
            some = some[100 * shared >= percent * (n[i] + n[some] - shared)]
            left.append(np.full(len(some), rep[i]))
            right.append(rep[some])
    a = np.concatenate(left) if left else np.zeros(0, np.int64)
    b = np.concatenate(right) if right else np.zeros(0, np.int64)
    return np.minimum(a, b), np.maximum(a, b)


def across(lists: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of members of a list (key, band, rep, n, comp) that may be linked, each once."""
    members = lists.groupBy("key").agg(F.count("*").alias("members"))
    few = members.filter(F.col("members") <= BLOCK)
    tasks = max(1, -(-(few.agg(F.sum("members")).first()[0] or 0) // TASK_ROWS))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    rows = lists.join(members, "key").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # A long list has a task for each pair of blocks, short lists share one.
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("key"), F.lit(tasks))).otherwise(F.col("key"))
    rows = rows.select("key", "band", "block", "rep", "n", "comp", task.alias("task"), (F.col("blocks") > 1).alias("long"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def run(table: pa.Table) -> pa.Table:
        key = np.asarray(table["key"])
        order = np.argsort(key, kind="stable")
        rep, n, comp, block, band = (np.asarray(table[c])[order] for c in ("rep", "n", "comp", "block", "band"))
        regs = _register_rows(table["registers"])[order]
        maps = table["bitmap"].take(pa.array(order)).to_pylist()
        cuts = np.flatnonzero(np.diff(key[order], prepend=key[order][0] - 1 if len(key) else 0))
        found = [(np.zeros(0, np.int64),) * 2]
        for a, b in zip(cuts, np.append(cuts[1:], len(key))):
            found.append(pairs_of_list(rep[a:b], n[a:b], comp[a:b], regs[a:b], maps[a:b], block[a:b], int(band[a]), percent))
        return pa.table({"a": np.concatenate([f[0] for f in found]), "b": np.concatenate([f[1] for f in found])})

    rows = rows.join(classes.select("rep", "registers", "bitmap"), "rep")
    return rows.groupBy("task", "long", "i", "j").applyInArrow(run, "a long, b long")


def _same_id(used: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (u, v) between the classes of rows that share an id but differ in their sets."""
    key = ["n", "s1", "s2"]
    several = used.groupBy("doc_id").agg(F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high")).filter("low <> high")
    rows = stored(used.select("doc_id", *key).join(several.select("doc_id"), "doc_id", "left_semi"), "hmh-same-id")
    return rows.join(classes.select(*key, "rep"), key).select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))


def near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``documents``; ``kept`` marks the
    smallest id of each component; for similarities of 80 percent and more."""
    if percent < LEAST_PERCENT:
        raise ValueError(f"the bands find similarities of {LEAST_PERCENT} percent and more, not of {percent}")
    prepare(documents.sparkSession)
    docs = text_rows(documents)
    sets = stored(sketches(docs, words), "hmh-sketches")
    used = sets.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = stored(used.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.first("registers").alias("registers"),
                                                        F.first("bitmap").alias("bitmap"), F.count("*").alias("copies")), "hmh-classes")

    def similar_size(n: str, m: str):
        return (F.col(n) * 100 >= percent * F.col(m)) & (F.col(m) * 100 >= percent * F.col(n))

    def links_of(pairs: DataFrame) -> DataFrame:
        checked = stored(likely(stored(pairs.distinct(), "hmh-pairs"), classes, percent), "hmh-likely")
        return stored(confirmed(checked, docs, words, percent), "hmh-links")

    # First round: to the smallest member of each list.
    rows = bands(classes)
    hubs = rows.groupBy("key").agg(F.count("*").alias("members"), F.min(F.struct("rep", "n")).alias("hub")).filter("members > 1")
    lists = stored(rows.join(hubs.select("key", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hub_n")), "key"), "hmh-lists")
    first = lists.filter((F.col("rep") != F.col("hub")) & similar_size("n", "hub_n")).select(F.col("hub").alias("a"), F.col("rep").alias("b"))
    links = links_of(first).unionByName(_same_id(used, classes))

    def add_bits(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([short_bits(r) for r in _register_rows(batch.column(1))]).reshape(-1, 4) if batch.num_rows else np.zeros((0, 4), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(4)]], names=["rep", "b0", "b1", "b2", "b3"])

    bits = classes.select("rep", "registers").mapInArrow(add_bits, "rep long, b0 long, b1 long, b2 long, b3 long")
    columns = ["rep", "n", "comp", "b0", "b1", "b2", "b3"]

    def open_lists(lists: DataFrame) -> DataFrame:
        """The lists whose members' components still differ, with these."""
        placed = lists.select("key", "band", "rep", "n").join(components(links), F.col("rep") == F.col("node"), "left")
        placed = stored(placed.select("key", "band", "rep", "n", F.coalesce("component", "rep").alias("comp")), "hmh-placed")
        mixed = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("key")
        return stored(placed.join(mixed, "key"), "hmh-open")

    # Second round: to a member chosen by hash, another one in each list.
    lists = open_lists(lists)
    side = lambda df, s: df.select("key", *[F.col(c).alias(f"{c}_{s}") for c in columns])
    marked = lists.join(bits, "rep")
    hub = marked.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "rep").alias("at"), *columns)).alias("hub")).select("key", "hub.*")
    apart = sum((F.bit_count(F.col(f"b{i}_a").bitwiseXOR(F.col(f"b{i}_b"))) for i in range(1, 4)), F.bit_count(F.col("b0_a").bitwiseXOR(F.col("b0_b"))))
    near = side(marked, "b").join(side(hub, "a"), "key").filter((F.col("comp_a") != F.col("comp_b")) & similar_size("n_a", "n_b") & (apart <= FAR))
    links = links.unionByName(links_of(near.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b"))))

    # Last round: all members whose components still differ, in blocks.
    final = components(links.unionByName(links_of(across(open_lists(lists), classes, percent))))

    of_class = classes.select("n", "s1", "s2", "rep", "copies").join(final.withColumnRenamed("node", "rep"), "rep", "left")
    of_class = stored(of_class.select("n", "s1", "s2", "copies", F.coalesce("component", "rep").alias("component")), "hmh-of-class")
    # Rows of large classes find theirs by broadcast, if those classes are few enough; the others by a shuffle.
    hot = stored(of_class.filter(F.col("copies") >= HOT_COPIES).drop("copies"), "hmh-hot")
    few = small_enough(hot, 64)
    rows, key = sets.select("doc_id", "n", "s1", "s2"), ["n", "s1", "s2"]
    usual = rows.join(F.broadcast(hot.select(*key)), key, "left_anti") if few else rows
    out = usual.join(of_class.drop("copies"), key, "left")
    if few:
        out = out.unionByName(rows.join(F.broadcast(hot), key))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
