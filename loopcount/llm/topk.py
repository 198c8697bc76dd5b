"""Exact top-k search by integer inner product: tiled matrix products, partial selection per
tile, and a tree that merges each query's lists.

Rows are dealt by a hash of their id into shards and query blocks of bounded size; one task
multiplies one block with one shard and keeps k rows a query, so neither side is ever
gathered in one place. The lists of ``FAN_IN`` shards at a time are merged until one is left.

Defined results: a vector that is null, empty or holds a null or non-finite component takes no
part, nor does a row without id. Only vectors of the query's length are its candidates. Rows
with the query's own id are not candidates; other repeated rows each count. A query id that
occurs more than once is asked once, with the smallest of its vectors. Scores are exact
integers; beyond ``MOST``, the largest long, they are clipped, and clipped scores tie.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loopcount.llm.common import prepare

SCALE = 1024
MOST = 2**63 - 1
SHARD_ROWS = 1 << 14
BLOCK_ROWS = 1 << 14
FAN_IN = 16
#: Rows of the block multiplied at once, so that a product stays at some tens of MB.
STEP = 128

_OUT = "query_id long, shard long, vec_id long, score long"
_SCHEMA = pa.schema([("query_id", pa.int64()), ("shard", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def usable(df: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return (df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .filter(F.col("vec_id").isNotNull() & (F.size("v") > 0)).filter(~bad))


def matrix(column: pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of doubles) for each vector length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at = np.asarray(column.offsets)
    values = np.asarray(column.values)
    length = np.diff(at)
    out = []
    for d in np.unique(length):
        rows = np.flatnonzero(length == d)
        out.append((rows, values[at[rows][:, None] + np.arange(d)]))
    return out


def integers(x: np.ndarray) -> np.ndarray:
    """floor(1024 * x): doubles while those are exact integers, else Python integers."""
    if not x.size or np.abs(x).max() < 2.0**42:
        return np.floor(SCALE * x)
    one = lambda v: int(v) * SCALE if abs(v) >= 2.0**53 else math.floor(SCALE * float(v))
    return np.array([[one(v) for v in row] for row in x], dtype=object)


def _norm(x: np.ndarray) -> float:
    return float(np.sqrt((x * x).sum(axis=1).max())) if x.dtype != object else math.inf


def best_of_tile(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> list[tuple[np.ndarray, ...]]:
    """(query ids, vector ids, scores) of each query's k best rows of the tile, ties to smaller ids."""
    order = np.argsort(ids, kind="stable")
    ids, x, n = ids[order], x[order], len(ids)
    # Partial sums stay below the product of the norms (Cauchy-Schwarz), so these types are exact.
    bound = _norm(q) * _norm(x)
    out = []
    if bound * n >= 2.0**61:
        for i, row in zip(q_ids, q.astype(object)):
            score = [max(-MOST, min(MOST, sum(int(a) * int(b) for a, b in zip(row, y)))) for y in x]
            best = sorted((j for j in range(n) if ids[j] != i), key=lambda j: (-score[j], ids[j]))[:k]
            out.append((np.full(len(best), i), ids[best], np.array([score[j] for j in best], np.int64)))
        return out
    kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
    q, xt = q.astype(kind), np.ascontiguousarray(x.astype(kind).T)
    later = np.arange(n - 1, -1, -1, dtype=np.int64)
    none = np.int64(-2**62)
    for a in range(0, len(q_ids), STEP):
        asked = q_ids[a:a + STEP]
        key = (q[a:a + STEP] @ xt).astype(np.int64) * n + later
        left, right = np.searchsorted(ids, asked, "left"), np.searchsorted(ids, asked, "right")
        for r in np.flatnonzero(right > left):
            key[r, left[r]:right[r]] = none
        top = min(k, n)
        at = np.argpartition(key, n - top, axis=1)[:, n - top:] if top < n else np.broadcast_to(np.arange(n), key.shape)
        got = np.take_along_axis(key, at, axis=1)
        keep = got > none
        out.append((np.repeat(asked, keep.sum(axis=1)), ids[at[keep]], got[keep] // n))
    return out


def _tile(k: int):
    def run(key, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if vectors.num_rows and queries.num_rows:
            ids, q_ids = np.asarray(vectors["vec_id"]), np.asarray(queries["vec_id"])
            of_length = {m.shape[1]: (rows, m) for rows, m in matrix(vectors["v"])}
            for q_rows, q in matrix(queries["v"]):
                if q.shape[1] in of_length:
                    rows, x = of_length[q.shape[1]]
                    found += best_of_tile(q_ids[q_rows], integers(q), ids[rows], integers(x), k)
        parts = [np.concatenate([np.asarray(f[i], np.int64) for f in found]) if found else np.zeros(0, np.int64) for i in range(3)]
        return pa.Table.from_arrays([parts[0], np.full(len(parts[0]), key[1].as_py(), np.int64), parts[1], parts[2]], schema=_SCHEMA)
    return run


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` rows with the highest exact score."""
    prepare(vectors.sparkSession)
    n_shards = max(1, -(-vectors.count() // SHARD_ROWS))
    n_blocks = max(1, -(-queries.count() // BLOCK_ROWS))
    rows = usable(vectors)
    asked = usable(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(n_shards)).alias("shard")
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_blocks)).alias("block")
    every = lambda n, name: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(name)
    left = rows.select("vec_id", "v", shard, every(n_blocks, "block"))
    right = asked.select("vec_id", "v", block, every(n_shards, "shard"))
    lists = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInArrow(_tile(k), _OUT)
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), F.col("vec_id")))), 1, k)
    while True:
        n_shards = -(-n_shards // FAN_IN)
        parent = F.floor(F.col("shard") / FAN_IN).cast("long").alias("shard")
        merged = lists.groupBy("query_id", parent).agg(best.alias("best"))
        if n_shards == 1:
            return (merged.select("query_id", F.posexplode("best").alias("at", "row"))
                    .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("row.vec_id").alias("vec_id"),
                            (-F.col("row.minus")).alias("score")))
        lists = (merged.select("query_id", "shard", F.explode("best").alias("row"))
                 .select("query_id", "shard", F.col("row.vec_id").alias("vec_id"), (-F.col("row.minus")).alias("score")))
