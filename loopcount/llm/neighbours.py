"""Approximate nearest neighbours by largest inner product.

Low-dimensional stable projections indexed by kd-trees: a query meets the projected
neighbours in the order of their projected distance, verifies each by its true inner product,
and stops when a chi-square test says that a nearer vector would have shown up by now.

Largest inner product becomes smallest Euclidean distance by one more coordinate
sqrt(M*M - |x|*|x|) (M: the largest norm of the row's norm band; the query, scaled to norm M,
has 0 there). Projected on ``PROJECTIONS`` Gaussian directions, a squared distance D*D turns
into D*D times a chi-square variable, hence the test: stop once the next projected squared
distance exceeds ``quantile(CONFIDENCE)`` times the squared distance of the k-th best found.

On Spark: equal vectors are collapsed first (only the k+1 smallest ids of each can be in a
result). The top of the kd-tree is fitted on a sample of at most ``SAMPLE`` vectors and deals
all vectors to cells; a cell, or each of the slices of about ``CELL_ROWS`` vectors that a larger
one is split into, is one task with a kd-tree of its own. A first round searches every
query's home cell, a second one only the cells that the test, with the bound found so far,
cannot exclude.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component
take no part, nor do rows without id; only vectors of the query's length are candidates; rows
with the query's own id are not; a query id that occurs more than once is asked once, with the
smallest of its vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loopcount.llm.common import prepare, stored
from loopcount.llm.topk import matrix, usable

PROJECTIONS = 8
CONFIDENCE = 0.97
#: Vectors on which the top of the tree is fitted; all vectors are indexed.
SAMPLE = 1 << 14
CELL_ROWS = 1 << 13
#: Cells of one vector length and norm band; cells of more than CELL_ROWS vectors are split by hash.
MOST_CELLS = 1 << 12
#: Queries that one task searches in a cell.
QUERY_BLOCK = 1 << 13
LEAF = 64
#: Bound of the error of single-precision scores, as a share of the squared largest norm.
ROUNDING = 1e-5
#: Projected neighbours verified between two tests at first; as many as before afterwards.
VERIFY = 128

_LIST = "qid long, score double, vec_id long"
_LIST_SCHEMA = pa.schema([("qid", pa.int64()), ("score", pa.float64()), ("vec_id", pa.int64())])


def chi_square_quantile(p: float, degrees: int) -> float:
    """x with P(chi-square <= x) = p, for an even number of degrees (a finite Poisson sum)."""
    def below(x: float) -> float:
        term = total = 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


def directions(length: int) -> np.ndarray:
    """The projection of vectors of ``length`` components and the added one."""
    return np.random.default_rng([7, length]).standard_normal((length + 1, PROJECTIONS))


def project(x: np.ndarray, largest: float) -> np.ndarray:
    room = np.sqrt(np.maximum(0.0, largest * largest - (x * x).sum(axis=1)))
    return x @ directions(x.shape[1])[:-1] + room[:, None] * directions(x.shape[1])[-1]


def project_query(q: np.ndarray) -> np.ndarray:
    return q @ directions(q.shape[1])[:-1]


class Tree:
    """A kd-tree on points: leaves are stretches of ``order``, with tight boxes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        order, cuts, todo = np.arange(len(points)), [], [(0, len(points))]
        while todo:
            a, b = todo.pop()
            part = points[order[a:b]]
            spread = part.max(axis=0) - part.min(axis=0)
            if b - a <= leaf or not spread.max() > 0:
                cuts.append((a, b))
                continue
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, spread.argmax()], middle)]
            todo += [(a, a + middle), (a + middle, b)]
        self.order, self.cuts = order, np.array(sorted(cuts))
        self.points = points[order]
        self.low = np.array([self.points[a:b].min(axis=0) for a, b in self.cuts])
        self.high = np.array([self.points[a:b].max(axis=0) for a, b in self.cuts])

    def box_distance(self, q: np.ndarray) -> np.ndarray:
        off = np.maximum(0, np.maximum(self.low - q, q - self.high))
        return (off * off).sum(axis=1)


def search(tree: Tree, x: np.ndarray, q: np.ndarray, q_projected: np.ndarray, largest: float, k: int, kth: float, stop: float):
    """Rows (numbers in ``tree.order``) and scores of the verified vectors that may be among the
    k best; q: scaled to norm ``largest``; kth: a score that the k-th best is known to reach.
    x and q may be of single precision: ``ROUNDING`` covers their error, the caller scores exactly."""
    box = tree.box_distance(q_projected)
    nearest = np.argsort(box)
    scores, rows = np.zeros(0), np.zeros(0, np.int64)
    waiting, waiting_rows = np.zeros(0), np.zeros(0, np.int64)
    at, take, verified = 0, 8, 0
    slack = ROUNDING * largest * largest

    def reach() -> float:
        return stop * (max(0.0, 2 * largest * largest - 2 * kth) + slack)

    while True:
        limit = reach()
        end = at
        while end < len(nearest) and end - at < take and box[nearest[end]] <= limit:
            end += 1
        if end > at:
            got = np.concatenate([np.arange(a, b) for a, b in tree.cuts[nearest[at:end]]])
            off = tree.points[got] - q_projected
            distance = np.einsum("ij,ij->i", off, off)
            near = distance <= limit
            waiting, waiting_rows = np.concatenate([waiting, distance[near]]), np.concatenate([waiting_rows, got[near]])
        more = end < len(nearest) and box[nearest[end]] <= limit
        ready = box[nearest[end]] if more else math.inf
        order = np.argsort(waiting)
        waiting, waiting_rows = waiting[order], waiting_rows[order]
        done, n_ready = 0, int(np.searchsorted(waiting, ready, "right"))
        while done < n_ready and waiting[done] <= reach():
            step = waiting_rows[done:min(n_ready, done + max(VERIFY, verified))]
            scores, rows = np.concatenate([scores, x[step] @ q]), np.concatenate([rows, step])
            done += len(step)
            verified += len(step)
            if len(scores) >= k:
                bar = np.partition(scores, len(scores) - k)[len(scores) - k]
                kth = max(kth, bar)
                if len(scores) > 4 * k:
                    keep = scores >= bar - slack
                    scores, rows = scores[keep], rows[keep]
        waiting, waiting_rows = waiting[done:], waiting_rows[done:]
        if not more:
            return rows, scores
        at, take = end, 2 * take


def _cell_search(k: int):
    """Per cell: rows (vid, ids, v, band_max) against queries (qid, v, kth)."""
    stop = chi_square_quantile(CONFIDENCE, PROJECTIONS)

    def run(cells: pa.Table, queries: pa.Table) -> pa.Table:
        out = [[], [], []]
        if cells.num_rows and queries.num_rows:
            (_, x), = matrix(cells["v"])
            (_, q), = matrix(queries["v"])
            largest = cells["largest"][0].as_py()
            ids = cells["ids"].combine_chunks()
            id_at, id_values = np.asarray(ids.offsets), np.asarray(ids.values)
            tree = Tree(project(x, largest))
            x = x[tree.order]
            norm = np.sqrt((q * q).sum(axis=1))
            scaled = q * (largest / norm)[:, None]
            flat = project_query(scaled)
            quick, scaled = x.astype(np.float32), scaled.astype(np.float32)
            bound = np.asarray(queries["kth"]) * largest / norm
            for i, qid in enumerate(np.asarray(queries["qid"])):
                rows, _ = search(tree, quick, scaled[i], flat[i], largest, k, bound[i], stop)
                exact = (x[rows] * q[i]).sum(axis=1)
                if len(rows) > k:
                    keep = exact >= np.partition(exact, len(rows) - k)[len(rows) - k]
                    rows, exact = rows[keep], exact[keep]
                original = tree.order[rows]
                count = id_at[original + 1] - id_at[original]
                members = np.concatenate([id_values[id_at[o]:id_at[o + 1]] for o in original]) if len(rows) else np.zeros(0, np.int64)
                score = np.repeat(exact, count)
                best = np.lexsort((members, -score))[:k]
                out[0].append(np.full(len(best), qid))
                out[1].append(score[best])
                out[2].append(members[best])
        kinds = (np.int64, np.float64, np.int64)
        return pa.Table.from_arrays([np.concatenate(o) if o else np.zeros(0, t) for o, t in zip(out, kinds)], schema=_LIST_SCHEMA)
    return run


def _fit(sample: np.ndarray, n_cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A complete binary tree of median splits: (axis, threshold) of its inner nodes in heap
    order, and the box of each of its n_cells (a power of two) leaves."""
    axis, cut = np.zeros(n_cells, np.int64), np.full(n_cells, np.inf)
    low, high = np.full((2 * n_cells, PROJECTIONS), -np.inf), np.full((2 * n_cells, PROJECTIONS), np.inf)
    parts = {1: sample}
    for node in range(1, n_cells):
        part = parts.pop(node)
        if len(part):
            axis[node] = (part.max(axis=0) - part.min(axis=0)).argmax()
            cut[node] = np.median(part[:, axis[node]])
        a, c = axis[node], cut[node]
        for child, side in ((2 * node, part[:, a] < c), (2 * node + 1, part[:, a] >= c)):
            parts[child] = part[side]
            low[child], high[child] = low[node], high[node]
        high[2 * node][a] = low[2 * node + 1][a] = c
    return axis, cut, low[n_cells:], high[n_cells:]


def _home(points: np.ndarray, tree) -> np.ndarray:
    axis, cut, low, _ = tree
    node = np.ones(len(points), np.int64)
    for _ in range(int(math.log2(len(low)))):
        node = 2 * node + (points[np.arange(len(points)), axis[node]] >= cut[node])
    return node - len(low)


def _deal(trees: dict, largest: dict, home: bool, skip_home: bool):
    """Adds (kind, cell) to rows: to vectors and first-round queries their home cell, to
    second-round queries the cells that the test with their bound cannot exclude."""
    stop = chi_square_quantile(CONFIDENCE, PROJECTIONS)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            take, kinds, cells = [], [], []
            for rows, x in matrix(batch.column("v")):
                norm = np.sqrt((x * x).sum(axis=1))
                bands = _band(norm)
                for kind, tree in trees.items():
                    length, band = kind
                    if length != x.shape[1]:
                        continue
                    top = largest[kind]
                    if home and "ids" in batch.schema.names:
                        sel = np.flatnonzero(bands == band)
                        if len(sel):
                            take.append(rows[sel])
                            cells.append(_home(project(x[sel], top), tree))
                            kinds.append(np.full(len(sel), kind_id(kind)))
                        continue
                    flat = project_query(x * (top / norm)[:, None])
                    mine = _home(flat, tree)
                    if home:
                        take.append(rows)
                        cells.append(mine)
                        kinds.append(np.full(len(rows), kind_id(kind)))
                        continue
                    kth = np.asarray(batch.column("kth"))[rows] * top / norm
                    reach = stop * np.maximum(0, 2 * top * top - 2 * kth) + 1e-9 * top * top
                    for i in range(len(rows)):
                        off = np.maximum(0, np.maximum(tree[2] - flat[i], flat[i] - tree[3]))
                        near = np.flatnonzero((off * off).sum(axis=1) <= reach[i])
                        near = near[near != mine[i]] if skip_home else near
                        take.append(np.full(len(near), rows[i]))
                        cells.append(near)
                        kinds.append(np.full(len(near), kind_id(kind)))
            at = np.concatenate(take) if take else np.zeros(0, np.int64)
            part = batch.take(pa.array(at, pa.int64()))
            part = part.append_column("kind", pa.array(np.concatenate(kinds) if take else at, pa.int64()))
            yield part.append_column("cell", pa.array(np.concatenate(cells) if take else at, pa.int64()))
    return run


def _band(norm: np.ndarray) -> np.ndarray:
    """Norms within a factor of two share a band; the cut lies away from 1."""
    return np.floor(np.log2(norm) + 0.5).astype(np.int64)


def kind_id(kind: tuple[int, int]) -> int:
    return kind[0] * 4096 + kind[1] + 2048


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest found, nearest first."""
    spark = vectors.sparkSession
    prepare(spark)
    nonzero = lambda df: usable(df).filter(F.exists("v", lambda x: x != 0))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    ids = (nonzero(vectors).withColumn("nth", first).filter(F.col("nth") <= k + 1)
           .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    asked = nonzero(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    distinct = asked.groupBy("v").agg(F.min("vec_id").alias("qid"))

    # What the driver learns: a sample of bounded size, and the size and largest norm of each band.
    n = max(1, vectors.count())
    share = min(1.0, SAMPLE / n)
    part = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    sample = nonzero(vectors).filter(part).select("v").limit(SAMPLE).toArrow()
    bands = (nonzero(vectors).select(F.size("v").alias("length"), norm.alias("norm"))
             .groupBy("length", F.floor(F.log2("norm") + 0.5).alias("band")).agg(F.count("*").alias("n"), F.max("norm").alias("norm")).collect())
    largest = {(r["length"], r["band"]): r["norm"] for r in bands}
    trees = {}
    parts = dict((m.shape[1], m) for _, m in matrix(sample["v"])) if sample.num_rows else {}
    for r in bands:
        kind = (r["length"], r["band"])
        x = parts.get(r["length"], np.zeros((0, r["length"])))
        x = x[_band(np.sqrt((x * x).sum(axis=1))) == r["band"]]
        cells = 1 << min(int(math.log2(MOST_CELLS)), max(0, math.ceil(math.log2(max(1, r["n"] / CELL_ROWS)))))
        trees[kind] = _fit(project(x, largest[kind]), cells)
    known = spark.sparkContext.broadcast((trees, largest))
    place = lambda home, skip=False: lambda batches: _deal(*known.value, home, skip)(batches)

    top = spark.createDataFrame([(kind_id(x), v) for x, v in largest.items()] or [(-1, 1.0)], "kind long, largest double")
    dealt = stored(ids.mapInArrow(place(True), "v array<double>, ids array<long>, kind long, cell long").join(F.broadcast(top), "kind"), "cell-rows")
    kinds = "qid long, v array<double>, kth double, kind long, cell long"
    q1 = distinct.select("qid", "v", F.lit(float("-inf")).alias("kth")).mapInArrow(place(True), kinds)
    by = ("kind", "cell")

    slices = stored(dealt.groupBy(*by).agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("slices")), "cell-slices")

    def round_of(q: DataFrame) -> DataFrame:
        # A cell with many queries or vectors is searched by several tasks; a row a cell tells by how many.
        q = stored(q, "queries")
        parts = stored(q.groupBy(*by).agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("parts")).join(F.broadcast(slices), list(by)), "cells")
        cells = dealt.join(F.broadcast(parts), list(by)).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        cells = cells.withColumn("slice", F.pmod(F.xxhash64("v"), F.col("slices")).cast("int"))
        again = parts.select(*[F.col(c).alias(c) for c in parts.columns])  # columns of its own, for the second use
        asking = q.join(F.broadcast(again), list(by)).withColumn("part", F.pmod(F.xxhash64("qid"), F.col("parts")).cast("int"))
        asking = asking.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        return cells.groupBy(*by, "part", "slice").cogroup(asking.groupBy(*by, "part", "slice")).applyInArrow(_cell_search(k + 1), _LIST)

    order = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    one = round_of(q1).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k + 1)
    bound = one.filter(F.col("nth") == k + 1).select("qid", F.col("score").alias("kth"))
    q2 = (distinct.join(bound, "qid", "left").select("qid", "v", F.coalesce("kth", F.lit(float("-inf"))).alias("kth"))
          .mapInArrow(place(False, True), kinds))
    found = one.select("qid", "score", "vec_id").unionByName(round_of(q2))
    lists = (found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k + 1)
             .groupBy("qid").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), F.col("vec_id")))).alias("best")))

    # Every query row gets the list of its vector, without itself; salted, as copies may be many.
    salts = 8
    member = asked.join(distinct, "v").select(F.col("vec_id").alias("query_id"), "qid", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).alias("salt"))
    lists = lists.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    own = F.slice(F.filter("best", lambda r: r["vec_id"] != F.col("query_id")), 1, k)
    return (member.join(lists, ["qid", "salt"]).select("query_id", F.posexplode(own).alias("at", "row"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("row.vec_id").alias("vec_id"), (-F.col("row.minus")).alias("score")))
