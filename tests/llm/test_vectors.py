import math
import random

import numpy as np
from conftest_llm import roots

from tidemark.llm import embedding_near_dedup as nd


def brute(rows):
    def ok(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [(i, np.array(v) / np.linalg.norm(v), l) for i, v, l in rows if l is not None and ok(v)]
    links = [(a[0], b[0]) for x, a in enumerate(good) for b in good[x + 1 :] if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] >= 0.98]
    ids = [r[0] for r in rows]
    root = roots(ids, links)
    return {i: (sum(i in e for e in links), root[i], root[i] == i) for i in ids}


def make(n=240, dim=8, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 and rows:
            _, base, label = rows[rng.randrange(len(rows))]
            rows.append((i, [x + rng.gauss(0, 0.04) * (i % 2) for x in base], label if rng.random() < 0.9 else 1))
        else:
            rows.append((i, [rng.gauss(0, 1) for _ in range(dim)], rng.choice([0, 1])))
    return rows


ODD = [(1000, None, 0), (1001, [], 0), (1002, [0.0] * 8, 0), (1003, [1.0, None] + [0.0] * 6, 0), (1004, [float("nan")] * 8, 0), (1005, [float("inf")] * 8, 0), (1006, [1.0] * 8, None), (1007, [1.0] * 3, 0), (1008, [2.0] * 3, 0), (1009, [1e200] * 8, 1), (1010, [1e-200] * 8, 1)]
SCHEMA = "vec_id long, embedding array<double>, label int"


def test_near_vectors(spark, monkeypatch):
    rows = make() + ODD
    want = brute([(i, None if v is None else v, l) for i, v, l in rows if i < 1009] )
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as c", "2 as h", "3 as copies", "4 as shell").repartition(3)
    got = {r.vec_id: tuple(r)[1:] for r in nd.near_vectors(df).collect()}
    assert {i: got[i] for i in want if want[i][0] or i >= 1000} == {i: w for i, w in want.items() if w[0] or i >= 1000}
    assert {i: g for i, g in got.items() if i < 1000} == {i: w for i, w in want.items() if i < 1000}
    assert got[1009][:2] == (1, 1009) and got[1010][:2] == (1, 1009)  # their squares overflow or vanish, their cosine is 1
    monkeypatch.setattr(nd, "TILE", 16)
    assert {r.vec_id: tuple(r)[1:] for r in nd.near_vectors(df).collect()} == got
    assert nd.near_vectors(df.limit(0)).count() == 0
    twice = nd.near_vectors(spark.createDataFrame([(7, [1.0, 2.0], 0), (7, [1.0, 2.0], 0), (None, [1.0, 2.0], 0)], SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.n_links) for r in twice) == [(0, 0), (7, 1), (7, 1)]


def test_dual_traversal_finds_exactly_the_pairs():
    rng = np.random.RandomState(1)
    centers = rng.randn(30, 16)
    x = np.repeat(centers, 12, 0) + rng.randn(360, 16) * 0.08
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j = nd.dual_pairs(x, None, 0.98)
    a, b = np.nonzero(np.triu(x @ x.T >= 0.98, 1))
    assert sorted(zip(i, j)) == sorted(zip(a, b)) and len(i) > 300
    i, j = nd.dual_pairs(x[:200], x[200:], 0.98)
    a, b = np.nonzero(x[:200] @ x[200:].T >= 0.98)
    assert sorted(zip(i, j)) == sorted(zip(a, b))


def test_cover_tree_levels():
    rng = np.random.RandomState(2)
    x = rng.randn(200, 4)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    stack = [nd.cover_tree(x, 0.05)]
    while stack:
        node = stack.pop()
        assert (nd.chords(x[node.members], x[[node.center]])[:, 0] <= node.radius + nd.SLACK / 2).all()
        if node.children:
            assert sorted(np.concatenate([c.members for c in node.children])) == sorted(node.members) and node.children[0].center == node.center
            stack += node.children
