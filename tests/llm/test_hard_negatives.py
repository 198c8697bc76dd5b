"""op13 against brute force: tree invariants, bounds, windows, ties, copies, nulls and huge components."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from loopcount.llm import hard_negatives as hn

NAN, INF = float("nan"), float("inf")


def brute(rows, step, scale=256, positives=5, negatives=3, low=50, high=95):
    def whole(x):
        x = float(np.float32(x))
        return int(x) * scale if abs(x) >= 2.0**53 else math.floor(scale * x)

    ok = sorted({(i, label, tuple(map(whole, e))) for i, e, label in rows
                 if i is not None and label is not None and e and all(x is not None and math.isfinite(x) for x in e)})
    asked, out = {}, []
    for i, label, e in ok:
        if i % step == 0:
            asked.setdefault(i, (label, e))
    for i, (label, e) in asked.items():
        scored = sorted((-max(-hn.MOST, min(hn.MOST, sum(a * b for a, b in zip(e, f)))), j, other) for j, other, f in ok if j != i and len(f) == len(e))
        for minus, j, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [s for s in scored if s[2] != label and low * -minus <= 100 * -s[0] <= high * -minus]
            out += [(i, j, r, s[1], -minus, -s[0]) for r, s in enumerate(fit[:negatives], 1)]
    return sorted(out)


def result(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.collect()))


def some(n, d, seed, levels=None, labels=3):
    rnd = random.Random(seed)
    rows = [(i, [rnd.choice(levels) if levels else rnd.gauss(0, 1) for _ in range(d)], rnd.randrange(labels)) for i in range(n)]
    odd = [(n, None, 0), (n + 1, [], 0), (n + 2, [None] * d, 0), (n + 3, [NAN] * d, 0), (n + 4, [INF] + [0.0] * (d - 1), 0), (None, [1.0] * d, 0),
           (n + 5, [1.0] * d, None), (n + 6, [1.0], 1), (10 * n, [2.0], 1), (10 * n + 1, [1.0], 0), (10 * n + 2, [0.0] * d, 2), (20 * n, [0.0] * d, 2)]
    return rows + odd


@pytest.mark.parametrize("levels,labels", [(None, 3), ((-0.5, 0.0, 0.25), 3), (None, 40)])
def test_equals_brute_force_over_many_cells(vectors, monkeypatch, levels, labels):
    monkeypatch.setattr(hn, "CELL_ROWS", 40)
    monkeypatch.setattr(hn, "BLOCK_ROWS", 8)
    monkeypatch.setattr(hn, "LEAF", 4)
    rows = some(260, 5, 4, levels, labels)
    df = vectors(rows)
    got = result(hn.hard_negatives(df, df.filter("vec_id % 10 = 0")))
    assert got == brute(rows, 10) and len(got) > 20


def test_hot_vector_repeated_ids_and_repeated_rows(vectors, monkeypatch):
    monkeypatch.setattr(hn, "CELL_ROWS", 16)
    rows = some(60, 3, 8, (0.5, 0.25, 1.0))
    rows += [(1000 + i, [0.5, 0.5, 0.5], i % 2) for i in range(200)]
    rows += [(1000, [0.5, 0.5, 0.5], 0)] * 5 + [(1000, [0.25, 0.25, 0.5], 1), (1010, [1.0, 1.0, 1.0], 0), (1010, [1.0, 1.0, 1.0], 1)]
    df = vectors(rows)
    assert result(hn.hard_negatives(df, df.filter("vec_id % 10 = 0"))) == brute(rows, 10)


def test_huge_components_and_other_shares(vectors):
    rows = [(0, [3e18, -1e10], 0), (1, [1e17, 1.0], 0), (2, [-1e17, 5.0], 1), (3, [0.0, 0.0], 1), (4, [2e18, 3.0], 1), (5, [1e16, 1e16], 1), (6, [1.0, 2.0], 0)]
    df = vectors(rows)
    assert result(hn.hard_negatives(df, df, low=10, high=100)) == brute(rows, 1, low=10, high=100)
    mixed = [(i, [1e30 if i == 3 else 1.0 * i, 1.0], i % 2) for i in range(12)]
    assert result(hn.hard_negatives(vectors(mixed), vectors(mixed), low=1, high=100)) == brute(mixed, 1, low=1, high=100)


def test_empty_table_and_no_other_label(vectors):
    df = vectors([])
    assert hn.hard_negatives(df, df).count() == 0
    alone = vectors([(0, [1.0, 1.0], 0), (1, [1.0, 0.5], 0)])
    assert hn.hard_negatives(alone, alone).count() == 0


def test_windows():
    for score in [*range(-300, 300), 10**17, 2**63 - 1, -(2**63 - 1)]:
        a, b = hn.window(score, 50, 95)
        for s in (a - 1, a, b, b + 1):
            assert (50 * score <= 100 * s <= 95 * score) == (a <= s <= b)


@pytest.mark.parametrize("clusters", [0, 12])
def test_tree_covers_separates_and_bounds(clusters):
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(3000, 8)) * (0.05 if clusters else 1) + (rnd.normal(size=(clusters, 8))[rnd.integers(0, clusters, 3000)] if clusters else 0)
    x = np.floor(256 * x)
    cell = hn.Cell(x, rnd.integers(0, 4, 3000), pa.array([[i] for i in range(3000)]))
    tree = cell.tree
    assert sorted(tree.order) == list(range(3000))
    largest = np.sqrt((x * x).sum(axis=1)).max()
    sphere = np.column_stack([x, np.sqrt(np.maximum(0, largest**2 - (x * x).sum(axis=1)))])
    q = np.floor(256 * rnd.normal(size=(20, 8)))
    low, high = cell.about(q)
    for node, center in enumerate(tree.center):
        rows = tree.order[tree.begin[node]:tree.end[node]]
        assert np.sqrt(((sphere[rows] - sphere[center]) ** 2).sum(axis=1)).max() <= tree.radius[node] * (1 + 1e-12)
        scores = x[rows] @ q.T
        assert (scores <= high[node]).all() and (scores >= low[node]).all()
        children = tree.children[node]
        if children:
            assert sorted(r for c in children for r in range(tree.begin[c], tree.end[c])) == list(range(tree.begin[node], tree.end[node]))
            centers = sphere[tree.center[children]]
            gaps = np.sqrt(((centers[:, None] - centers) ** 2).sum(axis=2))[np.triu_indices(len(children), 1)]
            assert len(gaps) == 0 or gaps.min() >= max(tree.radius[children]) * (1 - 1e-12)


def test_descent_leaves_nodes_out():
    """On clustered vectors most leaves are never scored."""
    rnd = np.random.default_rng(6)
    middle = rnd.normal(size=(30, 16))
    x = np.floor(256 * (middle[rnd.integers(0, 30, 6000)] + 0.05 * rnd.normal(size=(6000, 16))))
    cell = hn.Cell(x, np.zeros(6000, np.int64), pa.array([[i] for i in range(6000)]))
    q, every = x[:10], []
    low, high = cell.about(q)

    class Labels(np.ndarray):
        def __getitem__(self, at):
            every.append(at)
            return np.asarray(self)[at]

    cell.labels = cell.labels.view(Labels)
    # Each anchor alone: otherwise a leaf counts that only some of a block look into.
    for i in range(10):
        (found,), = cell.best(q[i:i + 1], low[:, i:i + 1], high[:, i:i + 1], np.zeros(1), True, np.full((1, 1), -hn.MOST), np.full((1, 1), np.inf), 6)
        best = np.sort(x @ q[i])[::-1][:6].astype(int)
        assert [-s for s, _ in found] == best.tolist()
    assert sum(at.stop - at.start for at in every) < 10 * 6000 / 4
    together = cell.best(q, low, high, np.zeros(10), True, np.full((10, 1), -hn.MOST), np.full((10, 1), np.inf), 6)
    assert [[-s for s, _ in f] for f, in together] == [np.sort(x @ v)[::-1][:6].astype(int).tolist() for v in q]
