"""Fitting a text classifier on a bounded sample of labelled rows, and scoring every whole text with it.

The sample's ids are the ``rows`` labelled ones of least hash; only those ids (a bounded table) are broadcast to find their texts, of which those
of at most ``longest`` characters are learned from, whole, so one task can hold them and fit the model. Both bounds are parameters of the
classifiers; scoring has none. A model holds arrays of millions of buckets, whatever the input, few of which are in use: it travels as those (``packed``),
so that neither the driver nor a broadcast holds the rest.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import attach, pieces

#: Labelled rows that a model is fitted on at most, and the longest of them that is learned from, in characters.
ROWS, LONGEST = 6_000, 20_000


def part(parts: int) -> F.Column:
    """crc32(doc_id as text) mod parts."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, held: int, rows: int, longest: int) -> DataFrame:
    """doc_id, y, text of the rows to learn from, fewer than ``rows`` where texts are longer; a doc_id with several labels counts as 1 if any is 1."""
    ids = labels.where(f"doc_id is not null and {label} is not null").where(part(parts) != held)
    ids = ids.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    picked = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.where(F.length("text") <= longest).select("doc_id", "text")
    return texts.join(F.broadcast(picked), "doc_id").repartition(1)


def packed(model: dict) -> dict:
    """The model with each array as its type, length, places that are not zero, and their values."""
    return {k: (v.dtype.str, len(v), at := np.flatnonzero(v).astype(np.int32), v[at]) if isinstance(v, np.ndarray) else v for k, v in model.items()}


def unpacked(model: dict) -> dict:
    out = dict(model)
    for k, v in model.items():
        if isinstance(v, tuple):
            out[k] = np.zeros(v[1], v[0])
            out[k][v[2]] = v[3]
    return out


def fit(train: DataFrame, f: Callable[[pa.Array, np.ndarray], dict]) -> dict:
    """f(texts, labels), packed, from one task, in order of doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        t = pa.Table.from_batches(got).sort_by("doc_id").combine_chunks() if got else None
        text = t.column("text").chunk(0) if t is not None else pa.array([], pa.string())
        y = t.column("y").to_numpy() if t is not None else np.zeros(0, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(packed(f(text, y)))], pa.binary())], ["model"])

    made = train.select("doc_id", "y", "text").mapInArrow(run, "model binary").collect()  # one row; none if there is no task
    return pickle.loads(made[0].model) if made else packed(f(pa.array([], pa.string()), np.zeros(0, np.int32)))


def scored(docs: DataFrame, model: dict, f: Callable[[dict, pa.Array], np.ndarray], threshold: float = 0.7, parts: int = 1, held: int = 0, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, and the columns named in carry, by a packed model."""
    attach(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = {f"carried_{c}": docs.schema[c].dataType.simpleString() for c in carry}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = unpacked(sent.value)
        for b in pieces(batches, "text"):
            s = f(whole, b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32)), *(b.column(c) for c in kept)], ["doc_id", "held_out", "score", "predicted", *kept])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(part(parts) == held, F.lit(False)).alias("held_out"), "text", *(F.col(c).alias(k) for k, c in zip(kept, carry, strict=True)))
    schema = ", ".join(["doc_id long, held_out boolean, score double, predicted int", *(f"`{k}` {t}" for k, t in kept.items())])
    return rows.mapInArrow(run, schema).withColumnsRenamed({f"carried_{c}": c for c in carry})


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def prior(y: np.ndarray) -> float:
    """What every text scores where the labels do not hold both classes."""
    return float(y.mean()) if len(y) else 0.5
