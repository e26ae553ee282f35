"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Texts are lower-cased (A-Z) bytes, white space as one kind; n-grams of 5, 7 and 9 bytes are hashed to 2**21 buckets and
count once for a text. Each bucket's scale is the log ratio of its smoothed shares in the two classes; the ``kept``
buckets whose counts differ most from chance, by ``least_surprise`` deviations at least, in ``least_count`` texts at least, are the model's features (parameters of the fit,
like the sample's), and a logistic regression with an L2 penalty is fitted on the scaled presences. Scoring touches every byte of every text once for each n and sums the weights of distinct kept buckets.

Defined results: null and empty texts have no n-gram and score by the intercept alone; a null doc_id is carried
through, not held out; repeated rows score alike; labels without both classes give every text their mean (0.5 if none);
an empty table gives no rows; very long texts are scored whole, one at a time; columns named in carry are returned (any but the outputs' own names), others, also of clashing names, are not read. Labels, lang, source and doc_id are not inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomgraph.llm.common import PIECE_BYTES, attach, table
from loomgraph.llm.labelled import LONGEST, fit, prior, sample, scored, sigmoid
from loomgraph.llm.words import U64, bytes_of, stream

GRAMS, BITS = (5, 7, 9), 21
#: Features at most; texts of the sample that a feature is in, and deviations from chance, at least.
KEPT, LEAST_COUNT, LEAST_SURPRISE = 6000, 4, 3.0
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
_BYTE = stream(256, 55)


def _buckets(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: the bucket of every n-gram, and where each text's n-grams begin and end in that array."""
    raw, at = bytes_of(col)
    letters = _BYTE[_FOLD[raw]]
    total = np.zeros(len(letters), U64)
    factors = stream(max(GRAMS), 56) | U64(1)
    with np.errstate(over="ignore"):
        for j in range(max(GRAMS)):
            total = total[: max(0, len(letters) - j)] + letters[j:] * factors[j]
            if j + 1 in GRAMS:
                mixed = (total + U64(j)) * U64(0x9E3779B97F4A7C15)
                yield (mixed >> U64(64 - BITS)).astype(np.int32), np.stack([at[:-1], np.maximum(at[:-1], at[1:] - j)])


def _present(col: pa.Array, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) pairs, each once, of buckets in kept."""
    pairs = []
    for buckets, (lo, hi) in _buckets(col):
        place = np.flatnonzero(kept[buckets])
        doc = np.searchsorted(lo, place, "right") - 1
        inside = place < hi[doc]
        pairs.append(doc[inside].astype(np.int64) << BITS | buckets[place[inside]])
    every = np.sort(np.concatenate(pairs))
    once = every[np.diff(every, prepend=-1) != 0]
    return once >> BITS, once & ((1 << BITS) - 1)


def _slices(col: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Cuts of a long column, each of about PIECE_BYTES."""
    _, at = bytes_of(col)
    start = 0
    while start < len(col):
        end = max(start + 1, int(np.searchsorted(at, at[start] + PIECE_BYTES, "right")) - 1)
        yield start, col.slice(start, end - start)
        start = end


def train(col: pa.Array, y: np.ndarray, *, kept: int = KEPT, least_count: int = LEAST_COUNT, least_surprise: float = LEAST_SURPRISE, penalty: float = 1e-4, steps: int = 400) -> dict:
    if len(np.unique(y)) < 2:
        return {"constant": prior(y)}
    every, counts = np.ones(1 << BITS, bool), np.zeros((2, 1 << BITS))
    for start, piece in _slices(col):
        doc, bucket = _present(piece, every)
        label = y[start : start + len(piece)][doc]
        for k in (0, 1):
            counts[k] += np.bincount(bucket[label == k], minlength=1 << BITS)
    n = np.array([(y == 0).sum(), (y == 1).sum()], float)
    share = (counts + 1) / (n + 2)[:, None]
    scale = np.log(share[1] / share[0])
    # Signed root of the likelihood ratio of each bucket's counts against one common share.
    both = counts.sum(axis=0)
    expected = both * (n[1] / n.sum())
    surprise = np.where(both >= least_count, (counts[1] - expected) / np.sqrt(np.maximum(expected * n[0] / n.sum(), 1e-9)), 0)
    top = np.argsort(-np.abs(surprise), kind="stable")[:kept]
    top = np.sort(top[np.abs(surprise[top]) >= least_surprise])
    chosen = np.zeros(1 << BITS, bool)
    chosen[top] = True
    rows, cols = [], []
    for start, piece in _slices(col):
        doc, bucket = _present(piece, chosen)
        rows.append(doc + start)
        cols.append(np.searchsorted(top, bucket))
    r, c = np.concatenate(rows), np.concatenate(cols)
    x, w, b = scale[top], np.zeros(len(top)), float(np.log(n[1] / n[0]))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        p = sigmoid(b + np.bincount(r, weights=(w * x)[c], minlength=len(y)))
        err = p - y
        g, gb = np.bincount(c, weights=err[r], minlength=len(top)) * x / len(y) + penalty * w, err.mean()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        fix, fix2 = 1 - 0.9**t, 1 - 0.99**t
        w -= 0.03 * (m / fix) / (np.sqrt(v / fix2) + 1e-8)
        b -= 0.03 * (mb / fix) / (np.sqrt(vb / fix2) + 1e-8)
    weight = np.zeros(1 << BITS, np.float32)
    weight[top] = w * x
    return {"kept": chosen, "weight": weight, "bias": b}


def score(model: dict, col: pa.Array) -> np.ndarray:
    if "constant" in model:
        return np.full(len(col), model["constant"])
    doc, bucket = _present(col, model["kept"])
    return sigmoid(model["bias"] + np.bincount(doc, weights=model["weight"][bucket], minlength=len(col)))


def toxicity(docs: DataFrame, labels: DataFrame, *, rows: int = 12_000, longest: int = LONGEST, kept: int = KEPT, least_count: int = LEAST_COUNT, least_surprise: float = LEAST_SURPRISE, threshold: float = 0.7, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, and the columns in carry; learned from documents whose crc32 mod 3 is not 1.

    rows, longest: bounds of the sample that the model is fitted on; kept, least_count, least_surprise: bounds of its features.
    """
    attach(docs.sparkSession)
    model = fit(sample(docs, labels, "toxic", 3, 1, rows, longest), partial(train, kept=kept, least_count=least_count, least_surprise=least_surprise))
    return scored(docs, model, score, threshold, 3, 1, carry)


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
