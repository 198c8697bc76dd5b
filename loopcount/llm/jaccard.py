"""N-gram Jaccard join with grouped prefixes, and the components of its links.

A document is the set of its distinct word n-grams, as 64-bit hashes. Two sets of similarity t
share an n-gram among the first n - ceil(t n) + 1 of each in any common order, rare n-grams
first. Documents with identical sets are one class; classes with identical prefixes and size
are one group, and only groups are joined on the n-grams of their prefixes. Group pairs pass
the size and the position filter; then members are expanded. A pair of members first compares
bitmaps of the two sets (each bit of one that the other lacks stands for an n-gram the other
lacks, which bounds the overlap); of what is left the texts are read and the full sets of their
n-grams' hashes compared. (Classes are told by their size and two 64-bit sums over the hashes.)

No group of many similar documents is expanded into all its pairs, as the result is components:
a first round links every group to the smallest group of each posting list, a second one
compares, within the posting lists, only members whose components still differ. A pair that is
left out lies in one component already, so no component is missed.

The order of n-grams only decides how long posting lists get, never the result: n-grams that
are frequent in a sample of the documents (``SAMPLE_SHARE``, at most ``SAMPLE_DOCS`` of them)
come last, the most frequent at the end, at most ``HEAVY_MOST`` of them being told apart.

Defined results: a text without words, or null, has an empty set, its own component and no
links; with fewer than n words the whole sequence is the only n-gram. A row without id has no
component (null) and links with nothing. Rows that share an id are one document and linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loopcount.llm.common import mix, runs, prepare, sliced, small_enough, span_hashes, stored, text_rows, utf8

SAMPLE_SHARE = 1 / 32
SAMPLE_DOCS = 1 << 20
#: Documents of the sample that an n-gram stands in to count as frequent.
HEAVY_DOCS = 3
HEAVY_MOST = 1 << 18
#: Identical sets from which a class is looked up by broadcast, not in one shuffled group.
HOT_COPIES = 2048

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, *range(9, 14)]] = True
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                               0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xD6E8FEB86659FD93)]


def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text of a slice."""
    raw, at = utf8(column)
    raw = _LOWER[raw]
    begin, end = runs(~_SEPARATOR[raw], at)
    hashes = span_hashes(raw, begin, end)
    first = np.searchsorted(begin, at)
    n = max(0, len(hashes) - words + 1)
    grams = np.full(n, np.uint64(words))
    for k in range(words):
        grams = mix(grams + hashes[k:k + n] * _ODD[k % len(_ODD)])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(grams[a:b - words + 1]))
        else:
            whole = np.full(min(1, b - a), np.uint64(b - a))
            for k in range(b - a):
                whole = mix(whole + hashes[a + k:a + k + 1] * _ODD[k % len(_ODD)])
            out.append(whole)
    return out


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _signature(x: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that identify a sorted set."""
    a = int(mix(x + _ODD[0]).sum(dtype=np.uint64))
    b = int(mix(x * _ODD[1] + _ODD[2]).sum(dtype=np.uint64))
    return a - (1 << 63), b - (1 << 63)


def heavy_grams(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams found frequent in a sample, sorted, and the place of each by its frequency (the
    least frequent first); a hint for the order only."""
    n = max(1, docs.count())
    share = min(SAMPLE_SHARE, SAMPLE_DOCS / n)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = shingle_sets(batch.column(1), words)
            gram, count = np.unique(np.concatenate(sets), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(count)], names=["gram", "n"])

    chosen = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit("order")), F.lit(1 << 30)) < int(share * (1 << 30)))
    got = (chosen.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= HEAVY_DOCS)
           .orderBy(F.desc("n"), "gram").limit(HEAVY_MOST).toArrow())
    gram, n = np.asarray(got["gram"]).view(np.uint64), np.asarray(got["n"])
    place = np.empty(len(gram), np.int64)
    place[np.lexsort((gram, n))] = np.arange(len(gram))
    order = np.argsort(gram)
    return gram[order], place[order]


_SETS = [("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()),
         ("prefix", pa.list_(pa.int64())), ("bits", pa.binary())]
_SETS_DDL = "doc_id long, n long, s1 long, s2 long, p1 long, p2 long, prefix array<long>, bits binary"


def bitmap(x: np.ndarray) -> bytes:
    """One bit for each hash, by its low bits, in a power of two of at least twice as many bits."""
    size = max(64, 1 << (2 * len(x) - 1).bit_length()) if len(x) else 64
    bits = np.zeros(size, bool)
    bits[(x & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def most_shared(n: int, a: bytes, m: int, b: bytes) -> int:
    """A bound of what sets of n and m elements share, by their bitmaps."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[:len(x) // 2] | x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] | y[len(y) // 2:]
    return min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))


def prefixes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Size, set signature, prefix signature, prefix and bitmap of every document."""
    heavy = docs.sparkSession.sparkContext.broadcast(heavy_grams(docs, words))

    def run(batches) -> Iterator[pa.RecordBatch]:
        late, place = heavy.value
        for batch in sliced(batches):
            rows = []
            for x in shingle_sets(batch.column(1), words):
                if len(late):
                    at = np.minimum(np.searchsorted(late, x), len(late) - 1)
                    is_late = late[at] == x
                    ordered = np.concatenate([x[~is_late], x[is_late][np.argsort(place[at[is_late]])]])
                else:
                    ordered = x
                p = ordered[:prefix_length(len(x), percent)]
                rows.append((len(x), *_signature(x), *_signature(p), p.view(np.int64), bitmap(x)))
            columns = [batch.column(0)] + [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_SETS[1:])]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(_SETS))

    return docs.mapInArrow(run, _SETS_DDL)


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over links (u, v), for nodes with links.

    Alternates large-star and small-star steps, each written to the shared folder, until the
    links form stars around the smallest nodes."""
    def unique(df: DataFrame) -> DataFrame:
        return df.filter("u <> v").distinct()

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = stored(unique(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), "links")
    before = state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        now = unique(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = now.groupBy("u").agg(F.min("v").alias("m"))
        joined = now.join(least, "u")
        now = stored(unique(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))), "stars")
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def possible(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the bitmaps (doc_id, n, bits) of both don't exclude."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, x, m, y = (batch.column(i).to_pylist() for i in range(6))
            keep = [i for i in range(len(a)) if 100 * (s := most_shared(n[i], x[i], m[i], y[i])) >= percent * (n[i] + m[i] - s)]
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    of = lambda name: bitmaps.select(F.col("doc_id").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"))
    joined = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "n_a", "bits_a", "n_b", "bits_b")
    return joined.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts really have the similarity."""
    pairs = stored(possible(pairs, sets, percent).distinct(), "pairs")
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "pair-ids")
    side = F.broadcast(ids) if small_enough(ids, 16) else ids
    texts = stored(docs.join(side, "doc_id", "left_semi"), "pair-texts")

    def run(batches) -> Iterator[pa.RecordBatch]:
        known: tuple[int | None, str | None, np.ndarray | None] = (None, None, None)
        for batch in batches:
            for part in sliced(sliced([batch], text_column=1), text_column=3):
                ids_a, texts_a = part.column(0).to_pylist(), part.column(1).to_pylist()
                new = [i for i, (a, t) in enumerate(zip(ids_a, texts_a)) if (a, t) != (ids_a[i - 1], texts_a[i - 1]) or not i]
                sets = dict(zip(new, shingle_sets(part.column(1).take(pa.array(new)), words)))
                keep = []
                for i, y in enumerate(shingle_sets(part.column(3), words)):
                    if i in sets:
                        known = (ids_a[i], texts_a[i], sets[i])
                    x = known[2]
                    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
                        continue
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    if shared and 100 * shared >= percent * (len(x) + len(y) - shared):
                        keep.append(i)
                at = pa.array(keep, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(2).take(at)], names=["u", "v"])

    text_of = lambda name: texts.select(F.col("doc_id").alias(name), F.coalesce("text", F.lit("")).alias(f"text_{name}"))
    joined = pairs.join(text_of("b"), "b").join(text_of("a"), "a").select("a", "text_a", "b", "text_b")
    return stored(joined.mapInArrow(run, "u long, v long"), "verified")


def keep_one_of_each(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``documents`` without all but the smallest id of each component; of rows that
    repeat an id one stays, rows without id stay all."""
    found = stored(near_duplicates(documents, words, percent), "near-copies")
    gone = stored(found.filter(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct(), "gone")
    again = stored(found.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), "again")
    hint = lambda df: F.broadcast(df) if small_enough(df, 16) else df
    kept = documents.join(hint(gone), "doc_id", "left_anti").select(*documents.columns)
    if not again.head(1):
        return kept
    once = kept.join(hint(again), "doc_id", "left_anti").select(*documents.columns)
    return once.unionByName(kept.join(hint(again), "doc_id", "left_semi").select(*documents.columns).dropDuplicates(["doc_id"]))


def near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``documents``."""
    prepare(documents.sparkSession)
    docs = text_rows(documents)
    sets = stored(prefixes(docs, words, percent), "prefixes")
    used = sets.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = used.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.first("p1").alias("p1"), F.first("p2").alias("p2"),
                                                   F.count("*").alias("copies"))
    groups = used.groupBy("n", "p1", "p2").agg(F.min("doc_id").alias("gid"), F.min_by("prefix", "doc_id").alias("prefix"))
    members = stored(classes.join(groups.drop("prefix"), ["n", "p1", "p2"]).select("rep", "gid", "n"), "members")

    postings = groups.select("gid", "n", F.posexplode("prefix").alias("pos", "gram"))
    shared = postings.groupBy("gram").agg(F.count("*").alias("groups"), F.min("gid").alias("hub"), F.min_by("n", "gid").alias("hub_n"),
                                            F.min_by("pos", "gid").alias("hub_pos")).filter("groups > 1")
    lists = stored(postings.join(shared.drop("groups"), "gram"), "posting-lists")

    def similar_size(n: str, m: str):
        return (F.col(n) * 100 >= percent * F.col(m)) & (F.col(m) * 100 >= percent * F.col(n))

    def reaches(n: str, pos: str, m: str, other: str):
        # The first common n-gram in the order has all others behind it, in both sets.
        most = F.least(F.col(n) - F.col(pos), F.col(m) - F.col(other))
        return most * 100 >= percent * (F.col(n) + F.col(m) - most)

    # First round: to the smallest group of each posting list, and to the group's smallest member.
    hubs = lists.filter((F.col("gid") != F.col("hub")) & similar_size("n", "hub_n") & reaches("n", "pos", "hub_n", "hub_pos")).select(F.col("hub").alias("a"), F.col("gid").alias("b"))
    own = members.filter("rep <> gid").select(F.col("gid").alias("a"), F.col("rep").alias("b"))
    first = hubs.unionByName(own).distinct()
    links = verified(first, used, docs, words, percent)
    found = components(links)

    # Second round: members of a posting list or a group whose components still differ.
    placed = members.join(found, members["rep"] == found["node"], "left").select("rep", "gid", "n", F.coalesce("component", "rep").alias("comp"))
    placed = stored(placed, "placed")
    mixed_groups = placed.groupBy("gid").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    expanded = lists.select("gram", "gid", "pos").join(mixed_groups, "gid")
    mixed = expanded.groupBy("gram").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low <> high").select("gram")
    open_lists = stored(expanded.select("gram", "gid", "pos").join(mixed, "gram").join(placed, "gid").select("gram", "pos", "rep", "n", "comp"), "open-lists")

    def two(df: DataFrame, key: str, more: list[str]) -> tuple[DataFrame, DataFrame]:
        side = lambda s: df.select(key, *[F.col(c).alias(f"{c}_{s}") for c in ("rep", "n", "comp", *more)])
        return side("a"), side("b")

    left, right = two(open_lists, "gram", ["pos"])
    enough = reaches("n_a", "pos_a", "n_b", "pos_b")
    differ = (F.col("rep_a") < F.col("rep_b")) & (F.col("comp_a") != F.col("comp_b"))
    across = left.join(right, (left["gram"] == right["gram"]) & differ & similar_size("n_a", "n_b") & enough)
    inside = placed.join(mixed_groups.filter("low <> high").select("gid"), "gid")
    left, right = two(inside, "gid", [])
    within = left.join(right, (left["gid"] == right["gid"]) & differ)
    pairs = reduce(DataFrame.unionByName, [d.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")) for d in (across, within)]).distinct()
    second = verified(pairs.join(first, ["a", "b"], "left_anti"), used, docs, words, percent)
    final = components(links.unionByName(second))

    of_class = classes.select("n", "s1", "s2", "rep", "copies").join(final.withColumnRenamed("node", "rep"), "rep", "left")
    of_class = stored(of_class.select("n", "s1", "s2", "copies", F.coalesce("component", "rep").alias("component")), "classes")
    # Rows of large classes find theirs by broadcast, if those classes are few enough; the others by a shuffle.
    hot = stored(of_class.filter(F.col("copies") >= HOT_COPIES).drop("copies"), "hot-classes")
    few = small_enough(hot, 64)
    rows, key = sets.select("doc_id", "n", "s1", "s2"), ["n", "s1", "s2"]
    usual = rows.join(F.broadcast(hot.select(*key)), key, "left_anti") if few else rows
    placed_rows = usual.join(of_class.drop("copies"), key, "left")
    if few:
        placed_rows = placed_rows.unionByName(rows.join(F.broadcast(hot), key))
    return placed_rows.select("doc_id", F.col("n").alias("n_shingles"),
                              F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
