"""Vector codes against plain Lloyd rounds in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from llm_help import duck
from loomgraph.llm import codes
from loomgraph.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, code string, v int, error string, part string"


def lloyd(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(codes, errors, codebooks) of (id, vector) rows, without numpy."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max((len(v) for _, v in kept), default=0) // parts) * parts
    w = width // parts
    cut = [[(v + [0] * width)[p * w : (p + 1) * w] for p in range(parts)] for _, v in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    for turn in range(rounds + 1):
        got = [[min(((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(books[p]))) for p, x in enumerate(c)] for c in cut]
        if turn == rounds:
            break
        for p in range(parts):
            for j in range(len(books[p])):
                own = [c[p] for c, g in zip(cut, got) if g[p][1] == j]
                if own:
                    books[p][j] = [sum(col) // len(own) for col in zip(*own)]
    out = [(i, bytes(j for _, j in g), min(sum(d for d, _ in g), codes.MOST)) for (i, _), g in zip(kept, got)]
    return out, ",".join(str(x) for p in books for e in p for x in e)


def made(spark, rows, **kw):
    full = [(i, v, (i or 0) % 3 if i != 4 else None, "x", 1, "y", "z") for i, v in rows]
    return codes.compress(spark.createDataFrame(full, SCHEMA).repartition(3), **kw)


def check(spark, rows, **kw):
    got = made(spark, rows, **kw)
    plain = {k: x for k, x in kw.items() if k != "groups"}
    want, text = lloyd([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], **plain)
    assert got.books.text() == text
    assert sorted((r.id is None, r.id or 0, bytes(r.code), r.error) for r in got.rows.collect()) == sorted((i is None, i or 0, c, e) for i, c, e in want)
    return got


def clustered(n, dim, seed=0, spread=0.05, centres=30):
    rng = np.random.default_rng(seed)
    mid = rng.normal(size=(centres, dim))
    return [(int(i), (mid[rng.integers(centres)] + rng.normal(size=dim) * spread).tolist()) for i in rng.permutation(n)]


@pytest.mark.parametrize("kw", [{}, {"entries": 7, "rounds": 6}, {"entries": 40, "groups": 5, "scale": 4}, {"parts": 2, "entries": 16, "rounds": 0}, {"groups": 1, "entries": 20}, {"groups": 500, "entries": 60}])
def test_against_plain_rounds(spark, kw):
    check(spark, clustered(700, 8, spread=0.3), **kw)


def test_many_ties(spark):
    rng = random.Random(2)
    check(spark, [(i, [rng.choice([0.0, 1 / 1024, -1 / 1024]) for _ in range(8)]) for i in range(600)], entries=50)
    check(spark, [(i, [0.5] * 8) for i in range(300)])  # one vector again and again: the first entry takes all


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0] * 8), (2, None), (3, [1.0, None] * 4), (4, [-0.5] * 8), (4, [0.25] * 8), (4, [0.25] * 8), (5, [nan] * 8), (6, [inf] + [0.0] * 7), (None, [2.0] * 8), (7, []), (8, [3.0] * 3), (9, [-0.0] * 8), (10, [0.1] * 10)]
    check(spark, rows, entries=5)
    check(spark, [(7, []), (8, [])])
    assert made(spark, []).rows.collect() == [] and made(spark, [(1, None)]).books.text() == ""


def test_components_beyond_53_bits(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1, -1]) * 10 ** rng.uniform(-3, 37) for _ in range(8)]) for i in range(60)]
    got = check(spark, rows, entries=9)
    assert got.books.wide and max(r.error for r in got.rows.collect()) == codes.MOST


def test_bounds_leave_groups_out(spark):
    got = check(spark, clustered(3000, 16, spread=0.02), entries=64)
    assert got.scanned[0] == got.all_  # no bounds yet
    assert got.scanned[-1] < 0.3 * got.all_


def test_decompress(spark):
    got = made(spark, clustered(200, 8), entries=32)
    back = {r.id: r.vector for r in codes.decompress(got.rows, got.books).collect()}
    for r in got.rows.collect():
        assert back[r.id] == [float(x) for p, e in enumerate(r.code) for x in got.books.entries[p, e]]


def test_query_against_sql_and_plain_rounds(spark):
    d = "/root/testdata/sf0.001"
    vectors = table(spark, d, "embeddings")
    got = codes.op11_vector_codes(spark, d).collect()
    want, text = lloyd([(r.vec_id, r.embedding) for r in vectors.collect()])
    assert sorted((r.vec_id, r.code, r.error) for r in got) == sorted((i, c.hex(), e) for i, c, e in want)
    assert {r.codebooks_sha256 for r in got} == {hashlib.sha256(text.encode()).hexdigest()}
    names, rows = duck(codes.SQL, embeddings=vectors)
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(rows)
