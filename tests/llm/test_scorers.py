"""Scores of the classifiers against scorers written without arrays."""

import math
import pickle
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from loomgraph.llm import quality, toxicity
from loomgraph.llm.words import stream

M = (1 << 64) - 1
TEXTS = ["Some words here, and some words there. Some words here, and BAD!", "bad bad bad", "", None, "Ünïcödé wörds in a text \t\n with  spaces", "x", "good " * 300 + "Bad.", "a b c d e f g"]


def mixed(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M
    return x ^ (x >> 31)


def labelled(n):
    rng = np.random.default_rng(1)
    words = ["alpha", "beta", "gamma", "delta", "bad", "worse", "Bad!", "good"]
    y = np.arange(n) % 2
    return pa.array([" ".join(rng.choice(words[4:] if k else words[:5], 12)) for k in y]), y


def toxic_grams(text):
    """Buckets of a text's character n-grams."""
    letters, factors = stream(256, 55).tolist(), (stream(9, 56) | np.uint64(1)).tolist()
    raw = [32 if b in (9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()]
    found = set()
    for n in toxicity.GRAMS:
        for i in range(len(raw) - n + 1):
            total = sum(letters[raw[i + j]] * factors[j] for j in range(n)) & M
            bucket = (((total + n - 1) * 0x9E3779B97F4A7C15) & M) >> (64 - toxicity.BITS)
            found.add(bucket)
    return found


def toxic_score(model, text):
    found = {b for b in toxic_grams(text) if model["kept"][b]}
    z = model["bias"] + sum(float(model["weight"][b]) for b in found)
    return 1 / (1 + math.exp(-z))


def test_toxicity_scores():
    model = toxicity.train(*labelled(80))
    assert model["kept"].sum() > 10
    got = toxicity.score(model, pa.array(TEXTS))
    assert np.allclose(got, [toxic_score(model, t) for t in TEXTS], atol=1e-6)
    fewer = toxicity.train(*labelled(80), kept=7)
    assert fewer["kept"].sum() == 7
    assert toxicity.train(*labelled(80), least_count=10**6)["kept"].sum() == 0


def toxic_fit(texts, y, kept, least_count, least_surprise, penalty=1e-4, steps=400):
    """Log-count ratios, kept buckets and regression, each text and feature one by one."""
    grams, n = [toxic_grams(t) for t in texts], (sum(1 - k for k in y), sum(y))
    counts = {}
    for g, k in zip(grams, y, strict=True):
        for b in g:
            counts.setdefault(b, [0, 0])[k] += 1
    ratio = {b: math.log((c[1] + 1) / (n[1] + 2) / ((c[0] + 1) / (n[0] + 2))) for b, c in counts.items()}
    surprise = {}
    for b, c in counts.items():
        expected = sum(c) * n[1] / len(y)
        surprise[b] = (c[1] - expected) / math.sqrt(max(expected * n[0] / len(y), 1e-9)) if sum(c) >= least_count else 0.0
    top = sorted(sorted(counts), key=lambda b: -abs(surprise[b]))[:kept]
    top = [b for b in top if abs(surprise[b]) >= least_surprise]
    held = [[b for b in g if b in set(top)] for g in grams]
    w, bias = dict.fromkeys(top, 0.0), math.log(n[1] / n[0])
    m, v, mb, vb = dict.fromkeys(top, 0.0), dict.fromkeys(top, 0.0), 0.0, 0.0
    for t in range(1, steps + 1):
        err = [1 / (1 + math.exp(-(bias + sum(w[b] * ratio[b] for b in h)))) - k for h, k in zip(held, y, strict=True)]
        g = {b: penalty * w[b] for b in top}
        for h, e in zip(held, err, strict=True):
            for b in h:
                g[b] += e * ratio[b] / len(y)
        gb = sum(err) / len(y)
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        for b in top:
            m[b], v[b] = 0.9 * m[b] + 0.1 * g[b], 0.99 * v[b] + 0.01 * g[b] ** 2
            w[b] -= 0.03 * (m[b] / (1 - 0.9**t)) / (math.sqrt(v[b] / (1 - 0.99**t)) + 1e-8)
        bias -= 0.03 * (mb / (1 - 0.9**t)) / (math.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    return {b: w[b] * ratio[b] for b in top}, bias


def test_toxicity_fit():
    col, y = labelled(40)
    model = toxicity.train(col, y, kept=60)
    weight, bias = toxic_fit(col.to_pylist(), y.tolist(), 60, toxicity.LEAST_COUNT, toxicity.LEAST_SURPRISE)
    kept = set(np.flatnonzero(model["kept"]).tolist())
    assert len(kept) > 20 and kept == set(weight)
    assert model["bias"] == pytest.approx(bias, abs=1e-6)
    assert all(float(model["weight"][b]) == pytest.approx(x, abs=1e-5) for b, x in weight.items())


def quality_buckets(text, shapes):
    """Buckets of a text's n-grams, with repeats, and its number of words; shapes: (kind, word codes of normalised words)."""
    byte = stream(256, 101).tolist()
    code = lambda w: mixed((sum(byte[b] * (f | 1) for b, f in zip(w, stream(len(w), 977).tolist(), strict=True)) + len(w)) & M)
    low, normal = shaped(text)
    known = {}
    codes = [known.setdefault(w, code(w)) for w in low]
    packed = []
    for last, before_last, first, capitals, digit, repeat, again in normal:
        x = 0
        for bits, part in ((8, last), (1, before_last), (8, first), (2, capitals), (1, digit), (1, repeat), (1, again)):
            x = x << bits | int(part)
        packed.append(mixed(x + 99))
    out = []
    for kind, base, n in ((0, codes, 1), (1, codes, 2), (2, packed, 1), (3, packed, 2), (4, packed, 3))[: 5 if shapes else 2]:
        factors = [f | 1 for f in stream(n, 40 + kind).tolist()]
        for i in range(len(base) - n + 1):
            out.append(mixed((sum(c * f for c, f in zip(base[i : i + n], factors, strict=True)) + n) & M) >> (64 - quality.BITS))
    return out, len(low)


def shaped(text):
    """Lower-cased words, and normalised ones as the docstring of the operator has them, without arrays."""
    split = [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode()) if w]
    plain = lambda c: 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128
    low = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in split]
    seen, out = set(), []
    for i, w in enumerate(split):
        run = tuple(split[i : i + 4])
        again = len(run) == 4 and run in seen
        if len(run) == 4:
            seen.add(run)
        first, last = w[0], w[-1]
        out.append((0 if plain(last) else last, not plain(w[max(len(w) - 2, 0)]), 0 if plain(first) else first, min(sum(65 <= c <= 90 for c in w), 3), 48 <= first <= 57, i > 0 and split[i - 1] == w, again))
    return low, out


def quality_fit(found, y, alpha=1.0, beta=1.0, l1=0.02, l2=0.01, epochs=3):
    """Follow-the-regularised-leader, one feature after another: (weights, intercept) from quality_buckets of each text."""
    z, q = {}, {}
    weight = lambda b: 0.0 if abs(z.get(b, 0.0)) <= l1 else -math.copysign(abs(z[b]) - l1, z[b]) / ((beta + math.sqrt(q[b])) / alpha + l2)
    order = sorted(range(len(y)), key=mixed)
    values = [{b: c / max(1, n) for b, c in Counter(bs).items()} | {None: 1.0} for bs, n in found]
    for _ in range(epochs):
        for i in order:
            w = {b: weight(b) for b in values[i]}
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w[b] * x for b, x in values[i].items())))))
            for b, x in values[i].items():
                g, old = (p - y[i]) * x, q.get(b, 0.0)
                z[b] = z.get(b, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w[b]
                q[b] = old + g * g
    out = {b: weight(b) for b in z}
    return out, out.pop(None)


@pytest.mark.parametrize("shapes", [True, False])
def test_quality_fit(shapes):
    col, y = labelled(60)
    model = quality.train(col, y, shapes=shapes)
    weight, bias = quality_fit([quality_buckets(t, shapes) for t in col.to_pylist()], y.tolist())
    assert model["bias"] == pytest.approx(bias, abs=1e-9)
    assert set(np.flatnonzero(model["weight"]).tolist()) == {b for b, x in weight.items() if x}
    assert all(float(model["weight"][b]) == pytest.approx(x, abs=1e-6) for b, x in weight.items())


def quality_score(model, text):
    """Plain n-grams of lower-cased words."""
    byte = stream(256, 101).tolist()
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    split = [w for w in raw.replace(b"\t", b" ").replace(b"\n", b" ").split(b" ") if w]
    codes = [mixed((sum(byte[b] * (f | 1) for b, f in zip(w, stream(len(w), 977).tolist(), strict=True)) + len(w)) & M) for w in split]
    total = 0.0
    for kind, n in ((0, 1), (1, 2)):
        factors = [f | 1 for f in stream(n, 40 + kind).tolist()]
        for i in range(len(codes) - n + 1):
            h = mixed((sum(c * f for c, f in zip(codes[i : i + n], factors, strict=True)) + n) & M)
            total += float(model["weight"][h >> (64 - quality.BITS)])
    return 1 / (1 + math.exp(-(model["bias"] + total / max(1, len(split)))))


def test_quality_scores_of_plain_words():
    model = quality.train(*labelled(80), shapes=False)
    got = quality.score(model, pa.array(TEXTS))
    assert np.allclose(got, [quality_score(model, t) for t in TEXTS], atol=1e-5)


@pytest.mark.parametrize("shapes", [True, False])
def test_quality_scores_do_not_depend_on_the_batch(shapes):
    model = quality.train(*labelled(80), shapes=shapes)
    alone = [quality.score(model, pa.array([t], pa.string()))[0] for t in TEXTS]
    assert np.allclose(quality.score(model, pa.array(TEXTS)), alone)


def test_long_texts_and_clashing_columns(spark, make):
    import loomgraph.llm.quality as q
    import loomgraph.llm.toxicity as t

    docs = make([(i, "bad worse " * 30 if i % 2 else "alpha beta " * 30) for i in range(60)] + [(100, "alpha beta " * 200_000), (101, "bad worse " * 200_000)])
    labels = spark.createDataFrame([(i, i % 2, i % 2, "clash", 9.0) for i in range(60)], "doc_id long, quality int, toxic int, text string, score double")
    for f in (q.quality, t.toxicity):
        got = {r.doc_id: r for r in f(docs, labels, carry=("items", "mark")).collect()}
        assert len(got) == 62 and (got[100].predicted, got[101].predicted) == (0, 1)
        assert (got[100].items, got[100].mark) == ("y", "z")


@pytest.mark.parametrize("module, op, label", [(toxicity, "toxicity", "toxic"), (quality, "quality", "quality")])
def test_models_travel_without_their_empty_buckets(spark, make, monkeypatch, module, op, label):
    texts, y = labelled(80)
    docs = make(list(enumerate(texts.to_pylist())))
    labels = spark.createDataFrame([(i, int(k)) for i, k in enumerate(y)], f"doc_id long, {label} int")
    sent, whole = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(len(pickle.dumps(value))) or whole(self, value))
    got = {r.doc_id: r.score for r in getattr(module, op)(docs, labels).collect()}
    assert len(sent) == 1 and sent[0] < 200_000
    parts, held = (3, 1) if op == "toxicity" else (4, 2)
    ids = [i for i in range(80) if zlib.crc32(str(i).encode()) % parts != held]
    want = module.score(module.train(texts.take(pa.array(ids)), y[ids]), texts)
    assert [got[i] for i in range(80)] == want.tolist()
