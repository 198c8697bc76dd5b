"""Hard negatives by exact inner products, found in cover trees over norm-augmented candidates.

An anchor's positives are the rows of its own label with the highest scores; its hard negatives
for a positive are the best rows of other labels whose score lies in a window of shares of the
positive's score. A score is the inner product of vectors of whole numbers, floor(scale * x).

A candidate x gets one more coordinate sqrt(M*M - |x|*|x|) (M: the largest norm), so that all lie
on a sphere of radius M; an anchor has 0 there, and inner products don't change. Each level of
a cover tree has centers apart from each other by at least the radius with which they cover
their parent's points (chosen farthest first, ``FAN`` at most a node; the radius is half the
parent's or, at full fan, the measured one). If a node's points lie within a chord r of its
center c, their angles to it are at most 2 asin(r / 2M), which bounds their scores from both
sides by the anchor's angle to c. Anchors descend in blocks: the node of the highest bound comes
first; an anchor leaves out nodes below the best scores it found or outside all its windows; leaves
are scored exactly, for the anchors that are left, in one product.

On Spark: equal vectors of one label are collapsed (only their smallest ids can be in a result).
Pivots from a sample of at most ``SAMPLE`` vectors deal all vectors to cells, a cell of more than
``CELL_ROWS`` vectors to slices; a slice and a block of anchors is one task with a cover tree of
its own. Anchors meet the cells that their bounds, by the cell's pivot and radius, cannot
exclude: for positives after their home cell was searched, for negatives by the windows.

Defined results: a row whose id, label or vector is null, or whose vector is empty or holds a
null or non-finite component, takes no part. Only vectors of the anchor's length are its
candidates, and no row with its own id. An anchor id that occurs more than once is asked once,
with its smallest label and vector; exact repeats of a row count once. Ties go to smaller ids.
Scores are exact; beyond ``MOST`` they are clipped (``MOST`` is the largest long), and clipped
scores tie. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loopcount.llm.common import prepare, small_enough, stored
from loopcount.llm.topk import MOST, matrix

SAMPLE = 1 << 14
CELL_ROWS = 1 << 13
MOST_CELLS = 1 << 12
BLOCK_ROWS = 1 << 13
FAN = 16
LEAF = 128
#: Anchors that descend together.
STEP = 256
#: Bound of the error of a bound, as a share of the product of the norms.
ROUNDING = 1e-9


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): doubles while those are exact integers, else Python integers."""
    if not x.size or np.abs(x).max() * scale < 2.0**52:
        return np.floor(scale * x)
    one = lambda v: int(v) * scale if abs(v) >= 2.0**53 else math.floor(scale * float(v))
    return np.array([[one(v) for v in row] for row in x], dtype=object)


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The whole numbers s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


class CoverTree:
    """Nodes over the rows of ``points``: ``center``, ``radius``, a stretch ``begin:end`` of ``order``
    and ``children`` (none: a leaf)."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.center, self.radius, self.begin, self.end, self.children = [], [], [], [], []
        if len(points):
            off = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
            todo = [self._add(0, off.max(), 0, len(points))]
            while todo:
                todo += self._split(points, todo.pop())
        self.center, self.radius = np.array(self.center, np.int64), np.array(self.radius, np.float64)

    def _add(self, center: int, radius: float, begin: int, end: int) -> int:
        self.center.append(center)
        self.radius.append(radius)
        self.begin.append(begin)
        self.end.append(end)
        self.children.append([])
        return len(self.center) - 1

    def _split(self, points: np.ndarray, node: int) -> list[int]:
        a, b = self.begin[node], self.end[node]
        if b - a <= LEAF or not self.radius[node] > 0:
            return []
        rows = self.order[a:b]
        part, center = points[rows], self.center[node]
        centers, nearest = [center], np.zeros(len(rows), np.int64)
        off = np.sqrt(((part - points[center]) ** 2).sum(axis=1))
        while len(centers) < FAN and off.max() > self.radius[node] / 2:
            new = int(rows[off.argmax()])
            to_new = np.sqrt(((part - points[new]) ** 2).sum(axis=1))
            nearer = to_new < off
            nearest[nearer], off[nearer] = len(centers), to_new[nearer]
            centers.append(new)
        by = np.argsort(nearest, kind="stable")
        self.order[a:b] = rows[by]
        cuts = a + np.searchsorted(nearest[by], np.arange(len(centers) + 1))
        radius = [off[nearest == i].max(initial=0.0) for i in range(len(centers))]
        self.children[node] = [self._add(c, radius[i], int(cuts[i]), int(cuts[i + 1])) for i, c in enumerate(centers) if cuts[i] < cuts[i + 1]]
        return self.children[node]


def bounds(product: np.ndarray, radius: np.ndarray, norms: np.ndarray, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """The lowest and highest scores of points within ``radius`` of centers on the sphere of radius
    ``largest`` (rows) with anchors of the given norms (columns), by the centers' scores."""
    size = norms * largest
    angle = np.arccos(np.clip(product / np.where(size > 0, size, 1), -1, 1))
    reach = 2 * np.arcsin(np.minimum(1, radius / (2 * largest) if largest > 0 else radius * 0))[:, None]
    slack = ROUNDING * size + 1e-6
    return size * np.cos(np.minimum(np.pi, angle + reach)) - slack, size * np.cos(np.maximum(0, angle - reach)) + slack


class Cell:
    """The candidates of a cell as whole numbers, with their tree."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, ids: pa.Array):
        norm = np.sqrt((x * x).sum(axis=1))
        self.largest = float(norm.max())
        room = np.sqrt(np.maximum(0.0, self.largest**2 - norm * norm))
        tree = CoverTree(np.column_stack([x, room]))
        self.tree, self.x, self.labels = tree, x[tree.order], labels[tree.order]
        self.centers = x[tree.center]
        at, values = np.asarray(ids.offsets), np.asarray(ids.values)
        self.ids = [values[at[o]:at[o + 1]] for o in tree.order]

    def about(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        norms = np.sqrt((q * q).sum(axis=1))
        return bounds(self.centers @ q.T, self.tree.radius, norms, self.largest)

    def best(self, q: np.ndarray, low: np.ndarray, high: np.ndarray, labels: np.ndarray, alike: bool, least: np.ndarray, most: np.ndarray,
             k: int) -> list[list[list[tuple[int, int]]]]:
        """For each anchor (a row of q, a column of low and high) and each of its ranges of scores (its
        row of least and most; an empty one has least > most) the k best (-score, id) among rows
        of its label, or of others.

        Anchors descend together: the node of the highest bound comes first, and is left out by
        every anchor none of whose ranges it can still improve."""
        tree, floor = self.tree, least.astype(float)
        found = [[[] for _ in row] for row in floor]
        top = most.max(axis=1, initial=-np.inf)
        reach = np.minimum(high, top)  # of a node, for an anchor
        heap = [(-reach[0].max(initial=-np.inf), 0)]
        while heap:
            _, node = heapq.heappop(heap)
            wanted = ((high[node][:, None] >= floor) & (low[node][:, None] <= most) & (floor <= most)).any(axis=1)
            if not wanted.any():
                continue
            if tree.children[node]:
                for child in tree.children[node]:
                    heapq.heappush(heap, (-reach[child].max(), child))
                continue
            a, b = tree.begin[node], tree.end[node]
            rows = np.flatnonzero(wanted)
            score = q[rows] @ self.x[a:b].T
            fit = (self.labels[a:b][None, :] == labels[rows][:, None]) == alike
            for w in range(floor.shape[1]):
                hit = fit & (score >= floor[rows, w][:, None]) & (score <= most[rows, w][:, None])
                for i in np.flatnonzero(hit.any(axis=1)):
                    anchor, at = rows[i], np.flatnonzero(hit[i])
                    if len(at) > k:  # each row has an id at least, so no other score can be among the k best
                        at = at[score[i, at] >= np.partition(score[i, at], len(at) - k)[len(at) - k]]
                    best = found[anchor][w]
                    best += [(-int(score[i, j]), int(v)) for j in at for v in self.ids[a + j]]
                    if len(best) >= k:
                        best.sort()
                        del best[k:]
                        floor[anchor, w] = max(floor[anchor, w], -best[-1][0])
        return [[sorted(f) for f in row] for row in found]


def _plain(x, labels, ids: pa.Array, q, fit, ranges, k) -> list[list[tuple[int, int]]]:
    """``Cell.best`` of one anchor for numbers beyond exact doubles, by Python integers."""
    at, values = np.asarray(ids.offsets), np.asarray(ids.values)
    scores = [max(-MOST, min(MOST, sum(int(a) * int(b) for a, b in zip(row, q)))) if fit[i] else None for i, row in enumerate(x)]
    return [sorted((-s, int(v)) for i, s in enumerate(scores) if s is not None and r[0] <= s <= r[1] for v in values[at[i]:at[i + 1]])[:k] for r in ranges]


_FOUND = pa.schema([("qid", pa.int64()), ("positive", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64())])
_FOUND_DDL = "qid long, positive long, score long, vec_id long"


def _search(scale: int, k: int, shares: tuple[int, int] | None):
    """Per cell: rows (ids, label, v) against anchors (qid, label, v, kth, scores). Without shares the k
    best of the anchor's label from kth on, else the k best of other labels in each score's window."""
    def run(cells: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if cells.num_rows and anchors.num_rows:
            (_, x), = matrix(cells["v"])
            (_, q), = matrix(anchors["v"])
            x, q = integers(x, scale), integers(q, scale)
            ids, labels = cells["ids"].combine_chunks(), np.asarray(cells["label"])
            exact = x.dtype != object and q.dtype != object and math.sqrt((x * x).sum(axis=1).max() * (q * q).sum(axis=1).max()) < 2.0**52
            cell = Cell(x, labels, ids) if exact else None
            own, qids = np.asarray(anchors["label"]), anchors["qid"].to_pylist()
            kth, scores = anchors["kth"].to_pylist(), anchors["scores"].to_pylist()
            marks = [[0] if shares is None else s for s in scores]
            ranges = [[(t, math.inf)] if shares is None else [window(m, *shares) for m in s] for t, s in zip(kth, marks)]
            for a in range(0, len(q), STEP):
                part = range(a, min(len(q), a + STEP))
                if exact:
                    width = max((len(marks[i]) for i in part), default=0)
                    least, most = np.full((len(part), width), np.inf), np.full((len(part), width), -np.inf)
                    for i in part:
                        for w, (x0, x1) in enumerate(ranges[i]):
                            least[i - a, w], most[i - a, w] = x0, x1
                    low, high = cell.about(q[a:a + STEP])
                    lists = cell.best(q[a:a + STEP], low, high, own[a:a + STEP], shares is None, least, most, k)
                else:
                    lists = [_plain(x, labels, ids, q[i], (labels == own[i]) == (shares is None), ranges[i], k) for i in part]
                for i, of_anchor in zip(part, lists):
                    for mark, best in zip(marks[i], of_anchor):
                        for minus, v in best:
                            for column, value in zip(out, (qids[i], mark, -minus, v)):
                                column.append(value)
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in out], schema=_FOUND)
    return run


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each row and the distance to it."""
    if not len(pivots):
        return np.zeros(len(x), np.int64), np.full(len(x), np.inf)
    cell = np.concatenate([((pivots * pivots).sum(axis=1) - 2 * (x[a:a + 1024] @ pivots.T)).argmin(axis=1) for a in range(0, len(x), 1024)])
    return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))


def _augmented(x: np.ndarray, largest: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(0.0, largest * largest - (x * x).sum(axis=1)))])


def _rounded(x: np.ndarray, scale: int) -> np.ndarray:
    """The whole numbers as doubles, beyond 2**53 rounded; kept where their squares add up."""
    return np.clip(np.floor(scale * np.clip(x, -1e140, 1e140)), -1e145, 1e145)


def _place(known, scale: int, home: bool, shares: tuple[int, int] | None):
    """Adds (length, cell, off) to vectors, and to anchors a row for each cell that they have to
    meet: the home cell, or those that kth or the windows of their scores cannot exclude."""
    pivots, largest, radius = known

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            take, lengths, cells, offs = [], [], [], []

            def add(rows, length, cell, off):
                take.append(rows)
                lengths.append(np.full(len(rows), length))
                cells.append(cell)
                offs.append(off)

            for rows, x in matrix(batch.column("v")):
                length = x.shape[1]
                if length not in largest:
                    continue
                whole, top, centers = _rounded(x, scale), largest[length], pivots.get(length, np.zeros((0, length + 1)))
                if "qid" not in batch.schema.names:
                    add(rows, length, *_nearest(_augmented(whole, top), centers))
                    continue
                mine, _ = _nearest(np.column_stack([whole, np.zeros(len(whole))]), centers)
                if home:
                    add(rows, length, mine, np.zeros(len(rows)))
                    continue
                reach = np.array([radius.get((length, c), -1.0) for c in range(max(1, len(centers)))])
                norms = np.sqrt((whole * whole).sum(axis=1))
                if len(centers):
                    low, high = bounds(centers[:, :-1] @ whole.T, np.maximum(reach, 0), norms, top)
                else:
                    low, high = np.full((1, len(rows)), -np.inf), np.full((1, len(rows)), np.inf)
                low, high = np.minimum(low, float(MOST)), np.maximum(high, -float(MOST))  # clipped as scores are
                kth, scores = batch.column("kth").to_pylist(), batch.column("scores").to_pylist()
                for i, row in enumerate(rows):
                    if shares is None:
                        meet = high[:, i] >= kth[row]
                        meet[mine[i]] = False
                    else:
                        meet = np.zeros(len(reach), bool)
                        for a, b in (window(s, *shares) for s in scores[row]):
                            meet |= (high[:, i] >= a) & (low[:, i] <= b)
                    cell = np.flatnonzero(meet & (reach >= 0))
                    add(np.full(len(cell), row), length, cell, np.zeros(len(cell)))
            at = np.concatenate(take) if take else np.zeros(0, np.int64)
            part = batch.take(pa.array(at, pa.int64()))
            for name, column, kind in (("length", lengths, np.int64), ("cell", cells, np.int64), ("off", offs, np.float64)):
                part = part.append_column(name, pa.array(np.concatenate(column).astype(kind) if take else np.zeros(0, kind)))
            yield part
    return run


def _pivots(sample: pa.Table, sizes: dict[int, int], largest: dict[int, float], scale: int) -> dict[int, np.ndarray]:
    """Of each vector length as many sample vectors as it needs cells, on the sphere."""
    out = {}
    for _, x in matrix(sample["v"]) if sample.num_rows else []:
        cells = min(MOST_CELLS, -(-sizes[x.shape[1]] // CELL_ROWS))
        out[x.shape[1]] = np.unique(_augmented(_rounded(x, scale), largest[x.shape[1]])[:cells], axis=0)
    return out


def labelled(df: DataFrame) -> DataFrame:
    """(vec_id, label, v array<double>) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return (df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0)).filter(~bad))


def hard_negatives(rows: DataFrame, anchors: DataFrame, scale: int = 256, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row of
    ``anchors`` and each of its ``positives`` best rows of the same label, the ``negatives`` best rows of
    other labels with low * positive_score <= 100 * negative_score <= high * positive_score.

    rows, anchors: (vec_id, label, embedding)."""
    spark = rows.sparkSession
    prepare(spark)

    keep = max(positives, negatives) + 1
    every = labelled(rows).dropDuplicates()
    nth = F.row_number().over(Window.partitionBy("label", "v").orderBy("vec_id"))
    ids = (every.withColumn("nth", nth).filter(F.col("nth") <= keep).groupBy("label", "v")
           .agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    ids = stored(ids, "hn-vectors")
    asked = labelled(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("own")).select("vec_id", "own.label", "own.v")
    asked = stored(asked, "hn-anchors")
    distinct = asked.groupBy("label", "v").agg(F.min("vec_id").alias("qid"))

    # What the driver learns: a sample of bounded size, and per vector length size and largest norm.
    whole = F.transform("v", lambda x: F.greatest(F.least(F.lit(float(scale)) * x, F.lit(1e145)), F.lit(-1e145)))
    norm = F.sqrt(F.aggregate(whole, F.lit(0.0), lambda a, x: a + (F.abs(x) + 1) * (F.abs(x) + 1)))
    lengths = ids.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n"), F.max(norm).alias("norm")).collect()
    sizes, largest = {r["length"]: r["n"] for r in lengths}, {r["length"]: r["norm"] for r in lengths}
    share = min(1.0, SAMPLE / max(1, sum(sizes.values())))
    chosen = F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    sample = ids.filter(chosen).orderBy(F.xxhash64("v"), F.col("ids")[0]).limit(SAMPLE).select("v").toArrow()
    pivots = _pivots(sample, sizes, largest, scale)

    known = spark.sparkContext.broadcast((pivots, largest, {}))
    place = lambda known, home, shares: lambda batches: _place(known.value, scale, home, shares)(batches)
    dealt = stored(ids.mapInArrow(place(known, True, None), "label long, v array<double>, ids array<long>, length long, cell long, off double"), "hn-cells")
    by = ["length", "cell"]
    cells = stored(dealt.groupBy(*by).agg(F.max("off").alias("radius"), F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("slices")), "hn-slices")
    radius = {(r["length"], r["cell"]): r["radius"] * (1 + ROUNDING) for r in cells.collect()}
    known = spark.sparkContext.broadcast((pivots, largest, radius))
    asking = "qid long, label long, v array<double>, kth long, scores array<long>, length long, cell long, off double"

    def found(q: DataFrame, home: bool, k: int, shares: tuple[int, int] | None) -> DataFrame:
        # A cell with many vectors or anchors is searched by several tasks; a row a cell tells by how many.
        q = stored(q.select("qid", "label", "v", "kth", "scores").mapInArrow(place(known, home, shares), asking), "hn-asking")
        parts = stored(q.groupBy(*by).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts")).join(F.broadcast(cells), by), "hn-parts")
        again = parts.select(*[F.col(c).alias(c) for c in parts.columns])  # columns of its own, for the second use
        left = dealt.join(F.broadcast(parts), by).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        left = left.withColumn("slice", F.pmod(F.xxhash64("v"), F.col("slices")).cast("int"))
        right = q.join(F.broadcast(again), by).withColumn("part", F.pmod(F.xxhash64("qid"), F.col("parts")).cast("int"))
        right = right.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        return left.groupBy(*by, "part", "slice").cogroup(right.groupBy(*by, "part", "slice")).applyInArrow(_search(scale, k, shares), _FOUND_DDL)

    none = F.array().cast("array<long>").alias("scores")
    at = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    first = found(distinct.withColumns({"kth": F.lit(-MOST), "scores": F.array().cast("array<long>")}), True, positives + 1, None)
    first = stored(first, "hn-home")
    kth = first.withColumn("nth", at("qid")).filter(F.col("nth") == positives + 1).select("qid", F.col("score").alias("kth"))
    rest = distinct.join(kth, "qid", "left").select("qid", "label", "v", F.coalesce("kth", F.lit(-MOST)).alias("kth"), none)
    lists = first.unionByName(found(rest, False, positives + 1, None)).withColumn("nth", at("qid")).filter(F.col("nth") <= positives + 1)
    lists = stored(lists.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("nth", "score", "vec_id"))).alias("best"),
                                            F.collect_set("score").alias("scores")), "hn-positives")

    windows = distinct.join(lists.select("qid", "scores"), "qid").withColumn("kth", F.lit(-MOST))
    best = found(windows, False, negatives + 1, (low, high)).withColumn("nth", at("qid", "positive")).filter(F.col("nth") <= negatives + 1)
    best = best.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("positive", "nth", "score", "vec_id"))).alias("negatives"))
    answers = stored(lists.drop("scores").join(best, "qid").join(distinct, "qid").select("label", "v", "best", "negatives"), "hn-answers")

    # Every anchor gets the lists of its label and vector, without rows of its own id.
    row_bytes = 8 * max(largest, default=0) + 32 * (positives + 1) * (negatives + 2)
    answers = F.broadcast(answers) if small_enough(answers, row_bytes) else answers
    out = asked.join(answers, ["label", "v"]).select(F.col("vec_id").alias("anchor_id"), "negatives", F.posexplode(
        F.slice(F.filter("best", lambda r: r["vec_id"] != F.col("vec_id")), 1, positives)).alias("p", "positive"))
    mine = F.filter("negatives", lambda r: (r["positive"] == F.col("positive.score")) & (r["vec_id"] != F.col("anchor_id")))
    out = out.select("anchor_id", "positive", F.posexplode(F.slice(mine, 1, negatives)).alias("at", "negative"))
    return out.select("anchor_id", F.col("positive.vec_id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"),
                      F.col("negative.vec_id").alias("negative_id"), F.col("positive.score").alias("positive_score"),
                      F.col("negative.score").alias("negative_score"))
