"""Quality: logistic regression on hashed word n-grams, fitted by follow-the-regularised-leader updates.

Words are runs without white space. Features are hashed n-grams (n = 1, 2) of lower-cased words, and, where ``shapes`` is set, n-grams (n = 1, 2, 3) of
normalised words, which carry over to words never seen (README has the figures of both): a normalised word keeps its case pattern, its outer marks,
whether it repeats the word before, and whether its run of four words came before in the text.
A feature's value is its count over the text's words, so a score is one sparse dot product and needs no grouping.

Defined results: null, empty and wordless texts score by the intercept alone; a null doc_id is carried through, not
held out; repeated rows score alike; labels without both classes give every text their mean (0.5 if none); an empty
table gives no rows; very long texts are scored whole, one at a time; columns named in carry are returned (any but the outputs' own names), others, also of clashing names, are not read. Labels, lang, source and doc_id are not inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomgraph.llm.common import attach, table
from loomgraph.llm.labelled import LONGEST, ROWS, fit, prior, sample, scored, sigmoid
from loomgraph.llm.words import NOT_SPACE, U64, Words, grams, mix, words

BITS = 20
#: Whether n-grams of normalised words are features too.
SHAPES = True


def _normal(w: Words) -> np.ndarray:
    """A code for each word: lengths of outer marks (0 to 3), their byte, case pattern, digits, and both repeats."""
    code = np.zeros(len(w.hash), U64)
    if not len(code):
        return code
    d, s, e = w.data, w.starts, w.ends
    first, last, before_last = d[s], d[e - 1], d[np.maximum(e - 2, s)]
    mark = lambda b: ~(((b >= 48) & (b <= 57)) | ((b >= 65) & (b <= 90)) | ((b >= 97) & (b <= 122)) | (b >= 128))
    upper = lambda b: (b >= 65) & (b <= 90)
    total = np.concatenate([[0], np.cumsum(upper(d))])
    capitals = total[e] - total[s]
    repeat = np.zeros(len(code), bool)
    repeat[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    g, ok = grams(w, 4, seed=31)
    again = np.zeros(len(code), bool)
    at = np.flatnonzero(ok)
    with np.errstate(over="ignore"):
        keyed = mix(g[at] + w.doc[at].astype(U64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(keyed, kind="stable")
    again[at[order[1:]]] = keyed[order[1:]] == keyed[order[:-1]]
    for bits, x in ((8, np.where(mark(last), last, 0)), (1, mark(before_last)), (8, np.where(mark(first), first, 0)), (2, np.minimum(capitals, 3)), (1, (first >= 48) & (first <= 57)), (1, repeat), (1, again)):
        code = code << U64(bits) | x.astype(U64)
    return code


def _features(col: pa.Array, shapes: bool) -> tuple[Words, list[tuple[np.ndarray, np.ndarray]]]:
    """The words, and for each kind of n-gram the buckets and the texts that they are in."""
    w = words(col, NOT_SPACE, lower=False)
    low = words(col, NOT_SPACE)
    kinds, found = [(0, low, 1), (1, low, 2)], []
    if shapes:
        normal = Words(mix(_normal(w) + U64(99)), w.doc, w.starts, w.ends, w.first, w.data)
        kinds += [(2, normal, 1), (3, normal, 2), (4, normal, 3)]
    for kind, base, n in kinds:
        g, ok = grams(base, n, seed=40 + kind)
        found.append(((g[ok] >> U64(64 - BITS)).astype(np.int64), w.doc[ok]))
    return w, found


def _examples(col: pa.Array, shapes: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for i in range(len(col)):
        w, found = _features(col.slice(i, 1), shapes)
        index, count = np.unique(np.concatenate([f[0] for f in found]), return_counts=True)
        yield index, count / max(1, len(w.hash))


def train(col: pa.Array, y: np.ndarray, *, shapes: bool = SHAPES, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, epochs: int = 3) -> dict:
    """One update for each example: weights follow from summed gradients (z) and their squares (q)."""
    if len(np.unique(y)) < 2:
        return {"constant": prior(y)}
    size = (1 << BITS) + 1  # the last is the intercept
    z, q = np.zeros(size), np.zeros(size)
    order = np.argsort(mix(np.arange(len(y), dtype=U64)), kind="stable")
    held = list(_examples(col, shapes))
    for _ in range(epochs):
        for i in order.tolist():
            index, x = held[i]
            index, x = np.append(index, size - 1), np.append(x, 1.0)
            w = -np.sign(z[index]) * np.maximum(np.abs(z[index]) - l1, 0) / ((beta + np.sqrt(q[index])) / alpha + l2)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y[i]) * x
            step = (np.sqrt(q[index] + g * g) - np.sqrt(q[index])) / alpha
            z[index] += g - step * w
            q[index] += g * g
    w = -np.sign(z) * np.maximum(np.abs(z) - l1, 0) / ((beta + np.sqrt(q)) / alpha + l2)
    return {"weight": w[:-1].astype(np.float32), "bias": float(w[-1]), "shapes": shapes}


def score(model: dict, col: pa.Array) -> np.ndarray:
    if "constant" in model:
        return np.full(len(col), model["constant"])
    w, found = _features(col, model["shapes"])
    total = np.zeros(len(col))
    for buckets, doc in found:
        total += np.bincount(doc, weights=model["weight"][buckets], minlength=len(col))
    return sigmoid(model["bias"] + total / np.maximum(1, np.diff(w.first)))


def quality(docs: DataFrame, labels: DataFrame, *, rows: int = ROWS, longest: int = LONGEST, shapes: bool = SHAPES, threshold: float = 0.7, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, and the columns in carry; learned from documents whose crc32 mod 4 is not 2.

    rows, longest: bounds of the sample that the model is fitted on; shapes: whether n-grams of normalised words are features beside those of words.
    """
    attach(docs.sparkSession)
    model = fit(sample(docs, labels, "quality", 4, 2, rows, longest), partial(train, shapes=shapes))
    return scored(docs, model, score, threshold, 4, 2, carry)


def op8_quality(spark, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
