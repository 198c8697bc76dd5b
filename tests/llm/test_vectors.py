"""op1 and op4 against brute force, with nulls, zero vectors, ties, copies and huge components."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loopcount.llm import neighbours, topk

NAN, INF = float("nan"), float("inf")


def brute_topk(rows, step, k):
    ok = [(i, [math.floor(1024 * x) if abs(x) < 2.0**53 else int(x) * 1024 for x in map(float, np.array(e, np.float32))]) for i, e, _ in rows
          if i is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    out = {}
    for i, q in ok:
        if i % step == 0:
            found = [(-max(-topk.MOST, min(topk.MOST, sum(a * b for a, b in zip(q, e)))), j) for j, e in ok if j != i and len(e) == len(q)]
            out[i] = [(j, -s) for s, j in sorted(found)[:k]]
    return {i: v for i, v in out.items() if v}


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def some(n, d, seed, levels=None):
    rnd = random.Random(seed)
    rows = [(i, [rnd.choice(levels) if levels else rnd.gauss(0, 1) for _ in range(d)], 0) for i in range(n)]
    odd = [(n, None, 0), (n + 1, [], 0), (n + 2, [None] * d, 0), (n + 3, [NAN] * d, 0), (n + 4, [INF] + [0.0] * (d - 1), 0), (None, [1.0] * d, 0), (n + 6, [1.0], 1), (0 + 10 * n, [2.0], 1)]
    return rows + odd


@pytest.mark.parametrize("levels", [None, (-0.5, 0.0, 0.25)])
def test_topk_is_exact_with_ties(vectors, monkeypatch, levels):
    monkeypatch.setattr(topk, "SHARD_ROWS", 16)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 8)
    monkeypatch.setattr(topk, "FAN_IN", 3)
    rows = some(150, 4, 5, levels)
    df = vectors(rows)
    assert lists(topk.exact_topk(df, df.filter("vec_id % 10 = 0"), 6)) == brute_topk(rows, 10, 6)


def test_topk_of_huge_components_and_few_rows(vectors):
    rows = [(0, [3e18, -1e10], 0), (1, [1e17, 1.0], 0), (2, [-1e17, 5.0], 0), (3, [0.0, 0.0], 0)]
    df = vectors(rows)
    assert lists(topk.exact_topk(df, df, 10)) == brute_topk(rows, 1, 10)


def test_topk_of_an_empty_table(vectors):
    df = vectors([])
    assert topk.exact_topk(df, df, 10).count() == 0


def brute_neighbours(rows, step, k):
    ok = [(i, np.array(e, np.float32).astype(float)) for i, e, _ in rows if i is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    out = {}
    for i, q in ok:
        if i % step == 0:
            found = sorted((-(q * e).sum(), j) for j, e in ok if j != i and len(e) == len(q))[:k]
            if found:
                out[i] = found
    return out


def test_neighbours_of_few_rows_are_exact_with_copies_and_norms(vectors):
    rnd = random.Random(3)
    copies = [(200 + i, [0.5, 0.5, 0.0, 0.0], 0) for i in range(60)]
    scaled = [(300 + i, [rnd.gauss(0, 10.0 ** (i % 3)) for _ in range(4)], 0) for i in range(40)]
    rows = some(100, 4, 8) + copies + scaled + [(500, [0.0] * 4, 0)]
    df = vectors(rows)
    got = lists(neighbours.nearest_neighbours(df, df.filter("vec_id % 20 = 0"), 5))
    want = brute_neighbours(rows, 20, 5)
    assert set(got) == set(want)
    hits = total = 0
    for i, found in want.items():
        assert [s for _, s in got[i]] == sorted((s for _, s in got[i]), reverse=True) and i not in [j for j, _ in got[i]]
        hits += sum(math.isclose(a, -b, rel_tol=1e-9, abs_tol=1e-9) for (_, a), (b, _) in zip(got[i], found))
        total += len(found)
    assert hits >= 0.9 * total
    assert [j for j, _ in got[220]] == [200, 201, 202, 203, 204] or got[220][0][1] > 0.5


def test_neighbours_over_several_cells_reach_the_recall(vectors, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 256)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((2000, 32)).astype(np.float32)
    df = vectors([(i, v.tolist(), 0) for i, v in enumerate(x)])
    got = lists(neighbours.nearest_neighbours(df, df.filter("vec_id % 20 = 0"), 20))
    x = x.astype(float)
    hits = 0
    for q in range(0, 2000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len({j for j, _ in got[q]} & set(np.argsort(-s, kind="stable")[:20].tolist()))
    assert hits >= 0.9 * 100 * 20


def test_neighbours_of_an_empty_table(vectors):
    df = vectors([])
    assert neighbours.nearest_neighbours(df, df, 20).count() == 0


def test_chi_square_quantile():
    assert math.isclose(neighbours.chi_square_quantile(0.95, 2), 5.991, abs_tol=1e-3)
    assert math.isclose(neighbours.chi_square_quantile(0.95, 8), 15.507, abs_tol=1e-3)


def test_recall_at_the_confidence(spark):
    x = np.random.default_rng(5).standard_normal((3000, 16))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = lists(neighbours.nearest_neighbours(df, df.filter("vec_id % 10 = 0")))
    hits = 0
    for i in range(0, 3000, 10):
        score = x @ x[i]
        score[i] = -np.inf
        hits += len({j for j, _ in got[i]} & set(np.argsort(-score)[:20].tolist()))
    assert hits >= 0.9975 * 6000  # 0.9967 with a confidence of 0.95


def test_large_cells_are_split(vectors, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 64)
    monkeypatch.setattr(neighbours, "MOST_CELLS", 1)
    whole = neighbours._cell_search

    def bounded(k):
        run = whole(k)

        def search(cells, queries):
            assert cells.num_rows <= 128
            return run(cells, queries)
        return search

    monkeypatch.setattr(neighbours, "_cell_search", bounded)
    rows = some(600, 4, 9)
    df = vectors(rows)
    got = lists(neighbours.nearest_neighbours(df, df.filter("vec_id % 10 = 0"), 5))
    x = np.array([e for i, e, _ in rows[:600]], np.float32).astype(float)
    hits = 0
    for i in range(0, 600, 10):
        score = x @ x[i]
        score[i] = -np.inf
        hits += len({j for j, _ in got[i]} & set(np.argsort(-score)[:5].tolist()))
    assert hits >= 0.98 * 300
