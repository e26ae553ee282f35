"""Words, sketches, components."""

import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from loomgraph.llm.components import components
from loomgraph.llm.sketch import jaccard, registers
from loomgraph.llm.words import ALNUM, NOT_SPACE, grams, words
from helpers import rows


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB9 \t\n.é日\x00-", max_size=30)), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    for inside, pattern in ((NOT_SPACE, rb"[^\x20\x09-\x0D]+"), (ALNUM, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        w = words(pa.array(texts, pa.string()), inside)
        lower = [bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode()) for t in texts]
        want = [re.findall(pattern, t) for t in lower]
        got = [[bytes(w.data[w.starts[i] : w.ends[i]]) for i in range(a, b)] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        assert got == want
        flat = [x for t in want for x in t]
        assert len(set(flat)) == len(set(w.hash.tolist()))


def test_grams_stay_in_their_text():
    w = words(pa.array(["a b c", "a b", "", "a b c d"]), NOT_SPACE)
    g, ok = grams(w, 3)
    assert ok.tolist() == [True, False, False, False, False, True, True, False, False]
    assert g[0] == g[5] != g[6]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
    for n, shared in ((1, 1), (7, 6), (300, 270), (2000, 1000)):
        a, b = pool[:n], pool[n - shared : 2 * n - shared]
        both = np.unique(np.concatenate([a, b]))
        flat, sizes = np.concatenate([a, b, both]), np.array([len(a), len(b), len(both)])
        r = registers(flat, np.repeat(np.arange(3), sizes), sizes, 1024)
        assert (np.maximum(r[0], r[1]) == r[2]).all()  # larger registers are smaller minima
        j = shared / (2 * n - shared)
        assert abs(jaccard(r[:1], r[1:2], np.array([float(n)]), np.array([float(n)]))[0] - j) < 0.08
    assert (registers(np.zeros(0, np.uint64), np.zeros(0, int), np.array([0]), 8) == 0).all()


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(7, 7)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    got = dict(rows(components(spark.createDataFrame(edges, "a long, b long"))))
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
