import hashlib
import os
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_help import plain, same_as_sql
from loomgraph.llm import labelled, licenses, quality, tokens, topk, toxicity, warc
from loomgraph.llm.common import shared_dir, table

SF = "/root/testdata/sf0.01"


# --- WARC


@pytest.mark.parametrize("range_bytes", [997, 50_000, 1 << 24])
def test_warc_round_trip(spark, range_bytes):
    rng = random.Random(6)
    html = [None, "", "a", "é" * 40, "x" * 60_000, "\x1f\x8b\x08 WARC/1.1\r\n\r\n"] + ["".join(rng.choices("abcdef<>é", k=rng.randrange(4000))) for _ in range(40)]
    items = [(i, rng.choice([None, "http://a b\r\nX: y", "http://x"]), rng.choice(html), "q") for i in range(120)] + [(5, "u", "dup", "q")] * 2
    pages = spark.createDataFrame(items, "page_id long, url string, html string, sha1 string").repartition(4)
    archives = warc.write_warc(pages, f"{shared_dir(spark)}/w{range_bytes}")
    got = warc.read_warc(spark, archives, range_bytes=range_bytes)
    same_as_sql(got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"), warc.SQL, pages=pages)
    want = {i: (h or "").encode() for i, _, h, _ in items[:120]}
    assert all(bytes(r.payload) == want[r.page_id] for r in got.where("record_type = 'response' and page_id <> 5").collect())
    assert plain(warc.listed(spark, f"{shared_dir(spark)}/w{range_bytes}").drop("payload")) == plain(got.drop("payload"))
    whole = spark.read.format("binaryFile").load(f"{shared_dir(spark)}/w{range_bytes}").select("content")
    assert plain(warc.read_warc(spark, whole, whole=True).drop("payload")) == plain(got.drop("payload"))


def test_warc_edges(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_warc(spark, warc.write_warc(pages, f"{shared_dir(spark)}/w0")).count() == 0
    lone = spark.createDataFrame([(None, None, "x"), (None, None, "x")], "page_id long, url string, html string")
    assert warc.read_warc(spark, warc.write_warc(lone, f"{shared_dir(spark)}/w1")).count() == 2


# --- licenses


def brute_licenses(text):
    """Licenses by containment over the whole text, without windows."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    own = grams(cut(text))
    return {n for n, t in licenses.TEMPLATES if (s := grams(cut(t))) and len(s & own) >= 0.8 * len(s)}


def test_licenses_against_brute_force(make):
    rng = random.Random(9)
    fill = lambda n: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet"]) + str(rng.randrange(99)) for _ in range(n))
    docs = []
    for i, (_, t) in enumerate(licenses.TEMPLATES):
        w = t.split()
        docs += [(i, f"{fill(20)} {t.upper()} {fill(9)}"), (100 + i, f"{fill(5)} {' '.join(w[: len(w) // 3])} {fill(9)}")]
        if len(w) > 30:
            w[len(w) // 2] = "changed"
            docs.append((200 + i, " ".join(w)))
    got = {r.doc_id: {m.license for m in r.matches} for r in licenses.licenses(make(docs)).collect()}
    for i, t in docs:
        assert got[i] <= brute_licenses(t)
        assert bool(got[i]) == bool(brute_licenses(t))
    for i, (name, _) in enumerate(licenses.TEMPLATES):
        assert name in got[i]


def test_licenses_edges(make):
    got = {r.doc_id: r.matches for r in licenses.licenses(make([(1, None), (2, ""), (3, "MIT License"), (4, "x " * 5000 + "Released under the MIT License."), (None, "Released under the MIT License.")])).collect()}
    assert [len(got[k]) for k in (1, 2, 3, 4, None)] == [0, 0, 0, 1, 1]
    assert (got[4][0].start, got[4][0].words, got[4][0].containment) == (5000, 5, 1.0)
    assert licenses.licenses(make([])).count() == 0


# --- tokens


@pytest.fixture(scope="module")
def counter():
    return tokens.Counter(tokens.ranks_of(tokens.VOCABULARY))


PARTS = ["a", "b ", " ", "  ", "'", "'re", "s", "é", "1", "22", "!", "\n", " \n", "日本", "the ", " word"]


@settings(max_examples=120, deadline=None)
@given(st.data())
def test_edits_count_as_a_full_encoding(counter, data):
    draw = lambda n: "".join(data.draw(st.lists(st.sampled_from(PARTS), max_size=n)))
    text = draw(300)
    tree = tokens.Tree(text, counter)
    for _ in range(4):
        at, n, new = data.draw(st.integers(0, len(text) + 2)), data.draw(st.sampled_from([0, 1, 3, 80])), draw(6)
        tree.edit(at, n, new)
        at = min(at, len(text))
        text = text[:at] + new + text[at + n :]
        assert tree.text == text
        assert tree.tokens == len(counter.encode(text))
        assert [p for b in tree.blocks for p in b[0]] == counter.find(text)


def test_token_counts(make, counter):
    docs = make([(1, None), (2, ""), (3, "Hello world, hello"), (4, "word " * 20_000), (None, "x")])
    got = {r.doc_id: r for r in tokens.token_counts(docs, edits=tokens.EDITS).collect()}
    assert (got[1].tokens, got[2].tokens, got[None].tokens) == (0, 0, 1)
    assert got[4].tokens == len(counter.encode("word " * 20_000))
    assert got[4].reencoded < 40
    assert tokens.token_counts(make([])).count() == 0
    assert {r.tokens == r.tokens_edited for r in tokens.token_counts(docs).collect()} == {True}


# --- classifiers


@pytest.mark.parametrize(("module", "label", "f", "least"), [(toxicity, "toxic", "toxicity", 0.93), (quality, "quality", "quality", 0.97)])
def test_held_out_accuracy(spark, module, label, f, least):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    out = getattr(module, f)(docs, labels)
    held = out.where("held_out").join(labels, "doc_id").select("predicted", label).collect()
    assert len(held) > 60
    assert np.mean([r.predicted == r[label] for r in held]) >= least
    assert out.count() == docs.count()
    assert out.where("score < 0 or score > 1 or score is null").count() == 0


@pytest.mark.parametrize("f", [toxicity.toxicity, quality.quality])
def test_classifier_edges(spark, make, f):
    docs = make([(1, None), (2, ""), (3, "bad bad"), (None, "good"), (3, "bad bad"), *((i, "some text") for i in range(4, 20))])
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int, text string")
    assert {r.score for r in f(docs, empty).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1, 1, "x") for i in (*range(1, 20), None)], empty.schema)
    assert {r.score for r in f(docs, one).collect()} == {1.0}
    assert f(make([]), empty).count() == 0
    same = {r.score for r in f(docs, one).collect() if r.doc_id == 3}
    assert len(same) == 1


def test_splits(spark, make):
    import zlib

    docs = make([(i, "x") for i in range(60)])
    assert {r.doc_id for r in docs.where(labelled.part(3) == 1).collect()} == {i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1}


# --- top-k


def brute(items, k, every):
    out = []
    ok = {}
    for i, v in items:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ok.setdefault(i, [int(np.floor(64 * np.float64(np.float32(x)))) for x in v])
    for q in ok:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(ok[q], ok[c], strict=False)), c) for c in ok if c != q)
            out += [(q, n, c, max(-(2**63), min(2**63 - 1, -s))) for n, (s, c) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [8, 4096])
def test_top_k_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", 4)
    rng = np.random.default_rng(7)
    items = [(i, [float(x) for x in rng.normal(size=6).astype(np.float32)]) for i in range(90)]
    items += [(100 + i, items[3][1]) for i in range(40)] + [(200, None), (205, []), (210, [float("nan")] * 6), (215, [None] * 6), (220, [1.0, 2.0]), (225, [0.0] * 6), (None, items[0][1]), (5, items[5][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in items], "vec_id long, embedding array<float>, score int").repartition(3)
    assert sorted(tuple(r) for r in topk.top_k(df, k=7, every=5).collect()) == brute(items, 7, 5)
    assert topk.top_k(df.limit(0)).count() == 0


def test_top_k_of_large_components(spark):
    items = [(i, [1e6 * (i + 1), -3.0e6, 1e6]) for i in range(12)]
    df = spark.createDataFrame([(i, v) for i, v in items], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in topk.top_k(df, k=3, every=2).collect()) == brute(items, 3, 2)


def test_products_are_exact():
    big = np.array([[2.0**40, 3.0]])
    assert topk.products(big, big)[0, 0] == 2**63 - 1
    assert topk.products(np.array([[2.0**27 + 1]]), np.array([[2.0**27 + 1]]))[0, 0] == (2**27 + 1) ** 2
