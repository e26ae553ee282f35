import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from llm_help import plain, same_as_sql
from loomgraph.llm import decontaminate, mix, near
from loomgraph.llm.sketch import registers

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
ODD = [(900, None), (901, ""), (902, " \t\n"), (903, "one two"), (904, "ONE two"), (905, "one two three four five"), (None, "one two three four five"), (906, "a " * 3000), (907, "a " * 3000)]


def family(rng, first, n, edits, words=80):
    base = [rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(words)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9999)}"
        out.append((first + i, " ".join(w), f"s{i % 3}"))
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    items = family(rng, 0, 30, 6) + family(rng, 100, 12, 1) + family(rng, 200, 8, 3, 12)
    return items + [(300 + i, "same text here for every copy of it") for i in range(9)] + [i for i in ODD if i[0] is not None]


def test_near_duplicates_against_sql(make, corpus):
    docs = make(corpus)
    same_as_sql(near.near_duplicates(docs), near.SQL, documents=docs)


def test_near_duplicates_in_blocks(make, corpus, monkeypatch):
    """Clusters far above the size of a block, by refinement and by several blocks."""
    want = plain(near.near_duplicates(make(corpus)))
    monkeypatch.setattr(near, "BLOCK", 4)
    assert plain(near.near_duplicates(make(corpus))) == want


def test_blocks_hold_no_list_of_their_links():
    """Blocks of two parts whose members are all linked: memory follows the members, not their two million links."""
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 5000, 60)]
    texts = []
    for _ in range(2 * near.BLOCK):
        w = list(base)
        w[rng.integers(60)] = f"v{rng.integers(10**6)}"
        texts.append(" ".join(w))
    ids, text = pa.array(range(len(texts))), pa.array(texts)
    flat, n = near.shingle_sets(text)
    regs = registers(flat, np.repeat(np.arange(len(n)), n), n, near.M)
    blocks = {
        near._verify: (pa.table({"id": ids, "text": text}), 70),
        near._alike: (pa.table({"id": ids, "n": n, "sketch": pa.array([r.tobytes() for r in regs], pa.binary())}), 0.5),
    }
    for f, (rows, threshold) in blocks.items():
        tracemalloc.start()
        out = f(rows, threshold)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 60 << 20, (f.__name__, peak)
        assert out.num_rows == len(texts) - 1  # one tree
        root = list(range(len(texts)))
        for a, b in zip(out.column("a").to_pylist(), out.column("b").to_pylist(), strict=True):
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            assert a != b
            root[a] = b


def test_near_duplicates_edges(make):
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near.near_duplicates(make(ODD)).collect()}
    assert got[900, 0] == (900, True)
    assert got[903, 1] == got[904, 1] == (903, True) or got[904, 1] == (903, False)
    assert got[None, 1] == (None, True)
    assert got[907, 1] == (906, False)
    assert near.near_duplicates(make([])).count() == 0
    twice = near.near_duplicates(make([(1, "a b c d e f"), (1, "a b c d e f")])).collect()
    assert [(r.component_id, r.kept) for r in twice] == [(1, True)] * 2


def test_mix_against_sql(make, corpus):
    rng = random.Random(2)
    items = [(i, " ".join(["w"] * rng.randrange(40)), rng.choice(["a", "a", "a", "b", "B", "ß", "", None, "zero"])) for i in range(400)]
    items = [(i, None if s == "zero" else t, s) for i, t, s in items] + [(None, "x y", "a"), (7, "one more", "a")]
    docs = make(items)
    same_as_sql(mix.mix(docs), mix.SQL, documents=docs)


def test_mix_budgets(make, corpus):
    out = mix.mix(make(corpus), carry=("source",)).collect()
    for source in {r.source for r in out}:
        own = [r for r in out if r.source == source]
        assert sum(r.taken for r in own) == int(own[0].target)
        assert all(0 <= r.taken <= 3 * r.size for r in own)
    assert mix.mix(make([])).count() == 0
    assert [tuple(r) for r in mix.mix(make([(1, None)])).collect()] == [(1, 0, 0, 0.0, 0)]
    carried = mix.mix(make(corpus), carry=("text", "source"))
    assert plain(carried.select("doc_id", "size", "source_size", "target", "taken")) == plain(mix.mix(make(corpus)))
    twice = make(corpus + [(1, "other words", "s0"), (None, "x", "s1")])
    carried = mix.mix(twice, carry=("text", "score"))
    assert plain(carried.select("doc_id", "size", "source_size", "target", "taken")) == plain(mix.mix(twice))
    assert {r.text for r in carried.where("doc_id = 1").collect()} == {corpus[1][1], "other words"}
    assert {r.score for r in carried.collect()} == {"x"}


def test_mix_of_long_texts(make):
    out = {r.doc_id: r for r in mix.mix(make([(1, "w " * 300_000, "a"), (2, "v" * 500_000, "b"), (3, "x y", "b")])).collect()}
    assert (out[1].size, out[2].size, out[3].size) == (300_000, 1, 2)


@pytest.fixture
def leaky(spark, make):
    rng = random.Random(5)
    item = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    items = [(1, item(30)), (2, item(10)), (3, item(7)), (4, item(4)), (5, "Only"), (6, None), (7, ""), (8, "rep " * 15), (10, item(12)), (10, item(12)), (None, item(11))]
    bench = spark.createDataFrame([(i, t, "q") for i, t in items], "item_id long, text string, doc_id string")
    texts = [t for _, t in items if t]
    docs = [(i, " ".join([item(rng.randrange(12)), " ".join(rng.choice(texts).split()[rng.randrange(3) :]).upper(), item(rng.randrange(12))])) for i in range(150)]
    docs += [(200, texts[0].replace(" ", "-- ")), (201, None), (202, ""), (203, "only"), (204, "rep " * 40), (205, texts[0][:-30]), (206, item(30)), (206, item(30))]
    return make(docs), bench


def test_decontaminate_against_sql(leaky):
    docs, bench = leaky
    got = decontaminate.decontaminate(docs.dropDuplicates(["doc_id"]), bench.where("item_id is not null"))
    same_as_sql(got.drop("items"), decontaminate.SQL, documents=docs.dropDuplicates(["doc_id"]), benchmark=bench.where("item_id is not null"))


def test_decontaminate_joined_path_agrees(leaky):
    docs, bench = leaky
    assert plain(decontaminate.decontaminate(docs, bench, max_local=-1)) == plain(decontaminate.decontaminate(docs, bench))
    carried = [decontaminate.decontaminate(docs, bench, max_local=n, carry=("text", "lang")).where("contaminated") for n in (-1, 10**6)]
    assert plain(carried[0].select("doc_id", "text", "lang", "n_hit")) == plain(carried[1].select("doc_id", "text", "lang", "n_hit"))


def test_decontaminate_long_text_and_clashing_columns(leaky, make):
    docs, bench = leaky
    item = bench.where("item_id = 1").first().text
    long = make([(1, "filler words " * 100_000 + item + " and more " * 50_000), (2, "filler words " * 100_000)])
    for max_local in (-1, 10**9):
        got = {r.doc_id: r for r in decontaminate.decontaminate(long, bench, max_local=max_local, carry=("score", "mark", "source")).collect()}
        assert (got[1].n_words, got[1].n_hit >= 30, got[2].contaminated) == (200_000 + len(item.split()) + 100_000, True, False)
        assert (got[1].score, got[1].mark, got[1].source) == ("x", "z", "s")


def test_decontaminate_a_window_that_all_documents_hold(make, spark):
    """One fingerprint is the join key of every document."""
    shared = " ".join(WORDS[:10])
    docs = make([(i, f"a{i} {shared} z{i}") for i in range(300)] + [(None, shared), (7, shared)])
    bench = spark.createDataFrame([(i, f"b{i} {shared}") for i in range(20)], "item_id long, text string")
    for max_local in (-1, 10**9):
        got = decontaminate.decontaminate(docs, bench, max_local=max_local).collect()
        assert {(r.n_hit, r.n_items) for r in got} == {(10, 20)} and len(got) == 302


def test_decontaminate_empty_tables(leaky, make):
    docs, bench = leaky
    assert decontaminate.decontaminate(make([]), bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0
