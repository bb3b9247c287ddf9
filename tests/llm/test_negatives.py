import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ladle.llm import negatives as ng

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, anchors=100):
    """The contract in plain Python, over rows that take part."""
    use = []
    for key, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((key, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    last = lambda key: (key is None, key or 0)
    out = []
    for key, label, v in set(u for u in use if u[0] is not None and u[0] % anchors == 0):
        scored = sorted(((dot(v, w), k, own) for k, own, w in use if len(w) == len(v)), key=lambda s: (-s[0], last(s[1])))
        for p, pid, _ in [s for s in scored if s[2] == label and s[1] != key][:5]:
            far = [s for s in scored if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p][:10]
            out += [(key, pid, i + 1, k, p, s) for i, (s, k, _) in enumerate(far)]
    return sorted(out, key=repr)


def mined(spark, rows, parts=3, anchors=100):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(map(tuple, ng.mine(ng.usable(df), F.col("id") % anchors == 0).collect()), key=repr)


def random_rows(n, dims, seed, labels=10, grid=None):
    rng = random.Random(seed)
    value = (lambda: rng.randint(-grid, grid) / 8) if grid else (lambda: rng.gauss(0, 0.2))
    return [(i, [value() for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("dims,grid", [(8, None), (2, None), (2, 3), (1, 1)])
def test_against_brute_force(spark, dims, grid):
    rows = random_rows(900, dims, dims, grid=grid)  # a grid makes most scores tie
    assert mined(spark, rows, anchors=30) == brute(rows, anchors=30)


def test_odd_rows(spark):
    rows = random_rows(150, 3, 1, labels=2) + [
        (200, None, 1), (300, [1.0, None, 1.0], 1), (400, [1.0, float("nan"), 1.0], 1), (500, [float("inf"), 1.0, 1.0], 0),
        (600, [0.1, 0.2, 0.3], None), (None, [0.4, 0.4, 0.4], 1), (700, [], 0), (701, [], 0), (702, [], 1), (800, [0.5], 0), (801, [0.25], 0),
        (802, [0.3], 1), (803, [0.11], 1), (900, [0.3, 0.3, 0.3], 1), (900, [0.3, 0.3, 0.3], 1), (901, [0.3, 0.3, 0.3], 1), (901, [0.3, 0.3, 0.3], 1)]
    assert mined(spark, rows, anchors=50) == brute(rows, anchors=50)


def test_large_numbers_and_clashing_columns(spark):
    rows = [(i, [x * 3e6 for x in v], label) for i, v, label in random_rows(80, 4, 5, labels=2)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS v", "3 AS x", "4 AS a", "5 AS w", "6 AS rank", "7 AS h")
    got = sorted(map(tuple, ng.mine(ng.usable(df), F.col("id") % 20 == 0).collect()), key=repr)
    assert got == brute(rows, anchors=20)


def test_one_label_holds_nearly_all_rows_and_vectors_repeat(spark):
    """A hot label, and a vector that a third of the rows share."""
    rows = [(i, [0.5, 0.25] if i % 3 == 0 else v, 0 if i % 50 else 1) for i, v, _ in random_rows(1500, 2, 9)]
    assert mined(spark, rows, parts=5) == brute(rows)


def test_many_blocks_and_trees(spark, monkeypatch):
    monkeypatch.setattr(ng, "BLOCK_BYTES", 200)
    rows = random_rows(700, 4, 11)
    assert mined(spark, rows, parts=6, anchors=20) == brute(rows, anchors=20)


def test_no_anchor_and_empty_table(spark):
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 0)]) == []
    df = spark.createDataFrame([], SCHEMA)
    assert ng.mine(ng.usable(df), F.col("id") % 100 == 0).collect() == []


def one_tree(n, dims, seed, clusters):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 3000, (clusters, dims))
    v = np.floor(centre[rng.integers(0, clusters, n)] + rng.normal(0, 20, (n, dims))).astype(np.int64)
    return np.arange(n), rng.integers(0, 5, n), v


def test_ranges_eliminate_siblings(monkeypatch):
    """Over clustered vectors most subtrees are never opened, and the result stays exact."""
    monkeypatch.setattr(ng, "LEAF_ROWS", 32)
    ids, labels, v = one_tree(6000, 6, 1, 60)
    tree = ng.Tree.from_bytes(ng.Tree.build(ids, labels, ng._narrow(v)).to_bytes())
    at = np.arange(0, 6000, 100)
    anchors, seen = ng.Anchors(ids[at], labels[at], v[at]), [0, 0]
    every = np.full((len(at), 1), ng.NO_SCORE + 1)
    best = ng.Best(every, -every, 5)
    ng.search(tree, anchors, best, True, seen)
    assert seen[1] == 6000 * len(at) and seen[0] < 0.35 * seen[1]
    for k, row in enumerate(at):
        own = np.flatnonzero((labels == labels[row]) & (ids != row))
        s = v[own] @ v[row]
        o = np.lexsort((own, -s))[:5]
        assert best.score[k, 0].tolist() == s[o].tolist() and best.id[k, 0].tolist() == own[o].tolist()


@pytest.mark.parametrize("seed", range(4))
def test_tree_holds_every_vector_within_its_ranges(monkeypatch, seed):
    monkeypatch.setattr(ng, "LEAF_ROWS", 8)
    ids, labels, v = one_tree(700, 3, seed, 5 if seed else 1)
    if seed == 3:
        v[:] = 7  # all alike: one leaf
    tree = ng.Tree.build(ids, labels, v)
    assert sorted(tree.ids.tolist()) == ids.tolist()
    assert (v[tree.ids] == tree.vectors).all()

    def rows(c):
        if tree.node[c] < 0:
            return list(range(tree.begin[c], tree.end[c]))
        n = tree.node[c]
        return [r for x in range(tree.first[n], tree.first[n + 1]) for r in rows(x)]

    for n in range(len(tree.first) - 1):
        children = range(tree.first[n], tree.first[n + 1])
        for c in children:
            for i, p in enumerate(children):
                d = np.linalg.norm(tree.vectors[rows(c)] - tree.points[p], axis=1)
                if len(d):
                    assert tree.near[c, i] - 1e-6 <= d.min() and d.max() <= tree.wide[c, i] + 1e-6
