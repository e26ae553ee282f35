"""Top-k: bounds, work saved, repeated ids and hot vectors."""

import numpy as np
import pytest

from loomgraph.llm import topk

SCHEMA = "vec_id long, embedding array<double>"


def brute(items, k, every):
    """By integers; an id may stand for several vectors."""
    whole = sorted({(i, tuple(int(np.floor(64 * x)) for x in v)) for i, v in items})
    out = []
    for q in sorted({i for i, _ in whole if i % every == 0}):
        scored = sorted((-sum(a * b for a, b in zip(own, v, strict=False)), i) for qi, own in whole if qi == q for i, v in whole if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return out


def answer(spark, items, k, every, **more):
    return sorted(tuple(r) for r in topk.top_k(spark.createDataFrame(items, SCHEMA).repartition(3), k=k, every=every).collect())


def test_large_components_do_not_lose_the_best(spark):
    """Squares beyond 53 bits: a bound that cancels would drop the best row, or all."""
    items = [(0, [1e9 / 64, 7 / 64]), (1, [1e9 / 64, (1e9 + 7) / 64])] + [(100 + i, [(1e9 + 5) / 64, (i - 512) / 64]) for i in range(1024)]
    got = topk.top_k(spark.createDataFrame(items, SCHEMA), k=1).where("query_id = 0").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 1000000007000000049)]


@pytest.mark.parametrize(("block", "queries"), [(4096, 2048), (40, 8), (3, 2)])
def test_hot_vectors_and_repeated_ids(spark, monkeypatch, block, queries):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", queries)
    monkeypatch.setattr(topk, "CHUNK", 2)
    rng = np.random.default_rng(1)
    hot = [0.5, 0.25, -1.0]
    items = [(i, hot if i % 3 == 0 else [float(x) for x in rng.normal(size=3)]) for i in range(120)]
    items += [(5, [9.0, 9.0, 9.0]), (5, [8.0, 8.0]), (10, [9.0, 9.0, 9.0]), (10, hot), (10, hot), (-20, [1.0]), (300, [1e200, 0.0]), (301, [-1e200])]
    items = [(i, v) for i, v in items if max(map(abs, v)) < 1e100]
    assert answer(spark, items, 4, 5) == brute(items, 4, 5)


def test_components_whose_squares_overflow(spark):
    items = [(i, [10.0 ** (150 + i), float(i)]) for i in range(6)] + [(20 + i, [float(i), 1.0]) for i in range(6)]
    got = answer(spark, items, 2, 20)
    assert got[:2] == [(0, 1, 1, 2**63 - 1), (0, 2, 2, 2**63 - 1)]  # scores are cut off at 64 bits, ties go to smaller ids
    assert got[2:] == [(20, 1, 21, 64 * 64), (20, 2, 22, 64 * 64)] or len(got) == 4


def test_clustered_vectors_are_mostly_not_evaluated(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 512)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16))
    x = centres[rng.integers(0, 20, 4000)] + 0.05 * rng.normal(size=(4000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    got = topk.work(df, k=10, every=200).collect()
    assert len(got) == 20
    assert sum(r.evaluated for r in got) < 0.05 * sum(r.candidates for r in got)
    items = [(i, v.tolist()) for i, v in enumerate(x)]
    want = brute(items, 3, 1000)
    assert [r for r in answer(spark, items, 3, 1000)] == want


def test_candidates_come_in_order_of_each_querys_own_bound():
    """With k = 1 and a bound that is met, later candidates are left."""
    rng = np.random.default_rng(5)
    c = np.floor(64 * rng.normal(size=(3000, 2)))
    q = np.floor(64 * rng.normal(size=(8, 2)))
    p = topk.pivots_of(c[:200], 32)
    dc, dq = topk.distances(c, p), topk.distances(q, p)
    for i, got, s, n in topk.best(q, dq, np.full(8, topk.LEAST), np.full(8, topk.LEAST), c, dc, np.arange(3000), 1):
        assert s[0] == (q[i] @ c.T).max()
        assert got[0] == (q[i] @ c.T).argmax()
        assert n <= 64 + 256


def test_bounds_are_never_below_scores():
    rng = np.random.default_rng(8)
    for scale in (1.0, 1e5, 1e12, 1e155):
        c, q = (np.floor(scale * rng.normal(size=(n, 5))) for n in (200, 40))
        p = topk.pivots_of(c, 16)
        norm = lambda x: topk._norms(x)
        bound = topk.bounds(topk.distances(q, p), topk.distances(c, p), norm(q), norm(c), 5)
        exact = [[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in c] for x in q]
        assert all(bound[i, j] == np.inf or int(bound[i, j]) >= exact[i][j] - 1 for i in range(40) for j in range(200) if exact[i][j] > -(2**62))
