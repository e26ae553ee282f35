"""The registered queries that SQL cannot express, over a whole given table, against slow versions written apart."""

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from loomgraph.llm import labelled, licenses, pii, quality, toxicity
from loomgraph.llm.common import table
from test_pii import LEFT
from test_scorers import quality_buckets, quality_fit, toxic_score
from test_trees_licenses import shingles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}


def test_op4(spark, texts):
    got = {r.doc_id: r for r in licenses.op4_licenses(spark, SF).collect()}
    assert set(got) == set(texts)
    own = [(n, set(shingles(t))) for n, t in licenses.TEMPLATES]
    some = exact = 0
    for i, text in texts.items():
        there = set(shingles(text or ""))
        share = {}
        for n, s in own:
            share[n] = max(share.get(n, 0), len(s & there) / len(s))
        want = {n for n, x in share.items() if x >= 0.8}
        found = set(filter(None, got[i].licenses.split(",")))
        assert found <= want and bool(found) == bool(want)
        # A license is not named only where every shingle of its notices that is there lies in notices that are named.
        named = set().union(*(s for n, s in own if n in found))
        assert all(s & there <= named or len((s & there) - named) < 0.8 * len(s) for n, s in own if n in want - found)
        exact += found == want
        assert (got[i].n_matches > 0) == bool(want)
        if found:
            some += 1
            assert 0.8 <= got[i].containment <= max(share[n] for n in found)
    assert some and exact > 0.9 * len(texts)


def learned(spark, module, label, parts, held, rows, texts):
    """The model, fitted again here on rows chosen by plain Python."""
    labels = {r.doc_id: r[label] for r in table(spark, SF, "labels").collect()}
    ids = sorted(i for i, y in labels.items() if y is not None and zlib.crc32(str(i).encode()) % parts != held and i in texts and len(texts[i] or "") <= labelled.LONGEST)
    assert len(ids) <= rows
    return module.train(pa.array([texts[i] for i in ids]), np.array([labels[i] for i in ids]))


def test_op6(spark, texts):
    model = learned(spark, toxicity, "toxic", 3, 1, 12_000, texts)
    got = {r.doc_id: r for r in toxicity.op6_toxicity(spark, SF).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        want = model["constant"] if "constant" in model else toxic_score(model, text)
        assert got[i].score == pytest.approx(want, abs=1e-6)
        assert got[i].predicted == int(got[i].score >= 0.7)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)


def test_op8(spark, texts):
    """Scores from a model that is fitted and applied without arrays."""
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    ids = sorted(i for i, y in labels.items() if y is not None and zlib.crc32(str(i).encode()) % 4 != 2 and i in texts and len(texts[i] or "") <= labelled.LONGEST)
    found = {i: quality_buckets(t, True) for i, t in texts.items()}
    weight, bias = quality_fit([found[i] for i in ids], [labels[i] for i in ids])
    got = {r.doc_id: r for r in quality.op8_quality(spark, SF).collect()}
    assert set(got) == set(texts)
    for i, (buckets, n) in found.items():
        z = bias + sum(weight.get(b, 0.0) for b in buckets) / max(1, n)
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-5)
        assert got[i].predicted == int(got[i].score >= 0.7)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)


def test_op9(spark, texts):
    got = {r.doc_id: r for r in pii.op9_pii(spark, SF).collect()}
    assert set(got) == set(texts)
    again = {r.doc_id: r.text for r in pii.op9_pii(spark, SF).collect()}
    assert again == {i: r.text for i, r in got.items()}
    for i, text in texts.items():
        originals = [m[m.lastindex or 0] for p in LEFT for m in re.finditer(p, text or "")]
        assert not any(o in got[i].text for o in originals)
        assert (got[i].n_entities > 0) >= bool(originals)
        assert (got[i].n_entities == 0) == (got[i].text == text) == (got[i].kinds == "")
        assert 0 < got[i].n_distinct <= got[i].n_entities or not got[i].n_entities


def test_key_of_the_session(spark, texts):
    docs = table(spark, SF, "documents")
    drawn = pii.secret_of(docs)
    assert drawn == pii.secret_of(docs.repartition(7))
    assert drawn != pii.secret_of(docs.where("doc_id <> 3"))
    spark.conf.set("spark.loomgraph.pii.key", "named")
    try:
        assert pii.secret_of(docs) == "named"
    finally:
        spark.conf.unset("spark.loomgraph.pii.key")
