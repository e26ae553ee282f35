import random

import pytest

from helpers import rows, swept
from loomgraph.operators import graph
from loomgraph.operators.titles import resolved_titles

PAGES = "pos long, id long, title string, ns int, redirect_to string, timestamp string, text string"


def pages(spark, items):
    return spark.createDataFrame([(i, i, t, 0, r, None, "") for i, (t, r) in enumerate(items, 1)], PAGES)


def test_redirects(spark):
    items = [("C", None), ("B", "C"), ("A", "B"), ("X", "Y"), ("Y", "X"), ("S", "S"), ("D", "Nowhere")]
    assert rows(resolved_titles(pages(spark, items))) == [("A", 1), ("B", 1), ("C", 1)]


def test_redirect_depth(spark):
    chain = [("T", None), ("R4", "T"), ("R3", "R4"), ("R2", "R3"), ("R1", "R2"), ("R0", "R1"), ("RR", "R0")]
    got = dict(rows(resolved_titles(pages(spark, chain))))
    assert set(got) == {"T", "R4", "R3", "R2", "R1"}  # at most 4 hops


def test_titles_repeat_and_beat_redirects(spark):
    items = [("A", None), ("A", None), ("B", "A"), ("B", None), ("b", "B")]
    assert rows(resolved_titles(pages(spark, items))) == [("A", 2), ("B", 4), ("b", 4)]


@pytest.fixture
def four(spark):
    v = spark.createDataFrame([(10,), (20,), (30,), (40,)], "id long")
    return v, spark.createDataFrame([(10, 20), (10, 30), (20, 30), (30, 40)], "src long, dst long")


def test_degree(four):
    assert rows(graph.degree(*four)) == [(10, 2), (20, 2), (30, 3), (40, 1)]
    assert rows(graph.out_degree(*four)) == [(10, 2), (20, 1), (30, 1), (40, 0)]
    assert rows(graph.in_degree(*four)) == [(10, 0), (20, 1), (30, 2), (40, 1)]


def test_loops_and_parallel_edges(spark):
    v = spark.createDataFrame([(1,), (2,)], "id long")
    e = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "src long, dst long")
    assert rows(graph.degree(v, e)) == [(1, 4), (2, 2)]


def brute_rank(ids, edges, k, d=0.85):
    out = {v: sum(a == v for a, _ in edges) for v in ids}
    r = dict.fromkeys(ids, 1 / len(ids))
    for _ in range(k):
        r = {v: (1 - d) / len(ids) + d * sum(r[a] / out[a] for a, b in edges if b == v) for v in ids}
    return r


def test_pagerank_against_brute_force(spark):
    rng = random.Random(3)
    ids = list(range(1, 25))
    edges = [(rng.choice(ids[:20]), rng.choice(ids)) for _ in range(80)]
    v, e = spark.createDataFrame([(i,) for i in ids], "id long"), spark.createDataFrame(edges, "src long, dst long")
    got = graph.pagerank(v, e, max_iterations=6, epsilon=None)
    want = brute_rank(ids, edges, 6)
    assert got.iterations == 6
    assert all(abs(r.rank - want[r.id]) < 1e-12 for r in got.ranks.collect())
    assert graph.pagerank(v, e, max_iterations=50, epsilon=1e-3).iterations < 50


def test_pagerank_of_nothing(spark):
    v, e = spark.createDataFrame([], "id long"), spark.createDataFrame([], "src long, dst long")
    assert graph.pagerank(v, e).iterations == 0


def test_closed(spark, four):
    v, e = four
    assert rows(graph.closed(v.where("id < 40"), e)) == [(10, 20), (10, 30), (20, 30)]


@pytest.mark.parametrize("mode", ["rounds", "in place"])
def test_communities(spark, mode):
    clique = [(a, b) for g in ((1, 2, 3, 4), (11, 12, 13, 14)) for a in g for b in g if a < b] + [(4, 11)]
    v = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 11, 12, 13, 14, 99)], "id long")
    got = dict(rows(graph.communities(v, spark.createDataFrame(clique, "src long, dst long"), mode=mode)))
    assert got[99] == 99
    assert len({got[i] for i in (1, 2, 3)}) == 1
    assert len({got[i] for i in (12, 13, 14)}) == 1
    if mode == "in place":  # settled: every label is one of the most frequent among the neighbours
        for x in (1, 2, 3, 4, 11, 12, 13, 14):
            near = [got[b] for a, b in clique if a == x] + [got[a] for a, b in clique if b == x]
            assert near.count(got[x]) == max(map(near.count, near))


@pytest.mark.parametrize("most", [1, 2, 50])
def test_in_place_equals_a_plain_sweep_in_the_same_order(spark, most):
    rng = random.Random(7)
    ids = list(range(1, 61))
    edges = [(1, i) for i in ids] + [(rng.choice(ids), rng.choice(ids)) for _ in range(90)] + [(5, 5), (5, 5), (9, 9), (1, 99), (2, 3), (2, 3)]
    v, e = spark.createDataFrame([(i,) for i in ids], "id long"), spark.createDataFrame(edges, "src long, dst long")
    colour = dict(rows(graph.coloured(v, graph.closed(v, e))))
    assert set(colour) == set(ids) and all(colour[a] != colour[b] for a, b in edges if a != b and b != 99)
    assert sorted(set(colour.values())) == list(range(max(colour.values()) + 1))
    want, _ = swept(ids, edges, sorted(ids, key=lambda i: (colour[i], i)), most)
    assert dict(rows(graph.communities(v, e, max_rounds=most, mode="in place"))) == want


def test_a_graph_of_two_sides_swings_at_once_and_settles_in_place(spark):
    left, right = range(1, 4), range(11, 14)
    edges = [(a, b) for a in left for b in right]
    ids = [*left, *right]
    v, e = spark.createDataFrame([(i,) for i in ids], "id long"), spark.createDataFrame(edges, "src long, dst long")
    a, b = (dict(rows(graph.communities(v, e, max_rounds=n))) for n in (6, 7))
    assert a != b  # never settles
    got = dict(rows(graph.communities(v, e, max_rounds=6, mode="in place")))
    assert got == dict(rows(graph.communities(v, e, max_rounds=7, mode="in place"))) and len(set(got.values())) == 1


def test_in_place_without_edges_or_vertices(spark):
    none, v = spark.createDataFrame([], "src long, dst long"), spark.createDataFrame([(3,), (4,)], "id long")
    assert rows(graph.communities(v, none, mode="in place")) == [(3, 3), (4, 4)]
    assert rows(graph.communities(v.limit(0), none, mode="in place")) == []
    with pytest.raises(ValueError):
        graph.communities(v, none, mode="other")


def test_hubs_are_cut_into_parts(spark, monkeypatch):
    rng = random.Random(9)
    ids = list(range(1, 60))
    edges = [(1, i) for i in ids] + [(i, 2) for i in ids] + [(rng.choice(ids), rng.choice(ids)) for _ in range(60)]
    v, e = spark.createDataFrame([(i,) for i in ids], "id long"), spark.createDataFrame(edges, "src long, dst long")
    ranks, labels = rows(graph.pagerank(v, e, max_iterations=3, epsilon=None).ranks), rows(graph.communities(v, e, max_rounds=3))
    monkeypatch.setattr(graph, "CUT", 7)
    cut = rows(graph.pagerank(v, e, max_iterations=3, epsilon=None).ranks)
    assert [i for i, _ in cut] == [i for i, _ in ranks]
    assert all(abs(a - b) < 1e-12 for (_, a), (_, b) in zip(cut, ranks, strict=True))
    assert rows(graph.communities(v, e, max_rounds=3)) == labels


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan


def test_a_round_does_not_shuffle_the_edges(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rounds = graph.Rounds(spark)
        e = spark.range(5000).selectExpr("id % 97 as src", "id % 89 as dst", "0.5D as w")
        w = rounds.bucketed(e, "edges", "src")
        ranks = rounds.put(spark.range(97).selectExpr("id", "1.0D as rank"))
        n, plan = exchanges(graph._spread(w, ranks, None))
        assert n == 2, plan  # the ranks, and the partial sums
        near = rounds.bucketed(e.selectExpr("src as near", "dst as id", "1L as n"), "near", "near")
        n, plan = exchanges(graph._votes(near, ranks.selectExpr("id", "cast(rank as long) as community"), None))
        assert n == 2, plan
        parts = rounds.put(spark.createDataFrame([(1, 3)], "id long, parts long"), "parts")
        w = rounds.bucketed(graph._cut(e, "src", "dst", parts), "cut", "src", "part")
        n, plan = exchanges(graph._spread(w, ranks, parts))
        assert n == 4, plan  # the few parts meet the ranks first
        rounds.delete()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
