"""Connected components of an edge table: contraction within tasks, and alternating stars over DataFrames between them.

A round deals the edges to tasks of about ``ROWS`` each (16 MB); each task settles what it holds and leaves one edge a node, to the least node of its part. If that
was one task, it tells every node's part and all is done, without a shuffle. Else every node's neighbours are joined to the least one, twice (large and small star), and the next
round sees a table of stars that few nodes still leave. Nothing is collected; each step is written to the shared folder, which also cuts the lineage, by tasks that
follow the number of edges; one job a round tells whether all is settled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import drop_stored, stored


#: Edges that one task contracts.
ROWS = 1_000_000


def _written(df: DataFrame, rows: int) -> DataFrame:
    return stored(df.coalesce(max(1, -(-rows // ROWS))), "edges")


def _least(pairs: DataFrame) -> DataFrame:
    """pairs(u, v) with the least v of each u. The least is pre-aggregated, and a hot u is split by the skewed join."""
    return pairs.join(pairs.groupBy("u").agg(F.min("v").alias("m")), "u")


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least node that each of n nodes reaches by edges (i, j)."""
    root = np.arange(n)
    while len(i):
        i, j = root[i], root[j]
        open_ = i != j
        i, j = i[open_], j[open_]
        np.minimum.at(root, np.maximum(i, j), np.minimum(i, j))
        while not np.array_equal(up := root[root], root):
            root = up
    return root


def _parts(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """Every node of a task's edges(u, v), and the least of its part."""
    held = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches if b.num_rows]
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids, code = np.unique(np.concatenate([x for pair in zip(*held, strict=True) for x in pair]), return_inverse=True)
    return ids, ids[_roots(len(ids), *np.split(code, 2))]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """u, v: every node of the task's edges, but the least of each part, with that one."""
    ids, least = _parts(batches)
    rest = ids != least
    yield pa.RecordBatch.from_arrays([pa.array(ids[rest]), pa.array(least[rest])], ["u", "v"])


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, component of every node of the task's edges."""
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in _parts(batches)], ["id", "component"])


def _open(stars: DataFrame) -> tuple[int, int]:
    """How many nodes lead to two, or lead somewhere and are led to; and the number of edges."""
    ends = stars.select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("leads")), F.struct(F.col("v").alias("id"), F.lit(0).alias("leads")))).alias("e")).select("e.*")
    nodes = ends.groupBy("id").agg(F.sum("leads").alias("n"), F.min("leads").alias("least"))
    r = nodes.agg(F.count_if(F.expr("n > 1 or (n = 1 and least = 0)")).alias("open"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    return r.open, r.rows


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """id, component (least id) of every id in edges(a, b); loops and repeats are allowed."""
    pick = lambda x, y: F.struct(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
    held = stored(edges.where("a <> b").select(pick("a", "b").alias("e")).select("e.*"), "edges")
    rows = held.count()
    for _ in range(rounds if rows else 0):
        tasks = -(-rows // ROWS)
        if tasks == 1:
            out = stored(held.coalesce(1).mapInArrow(_settled, "id long, component long"), "components")
            drop_stored(held)
            return out
        stars = stored(held.repartition(tasks).mapInArrow(_contracted, "u long, v long"), "edges")
        drop_stored(held)
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _written(_least(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")), rows)
        small = _least(large).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        held = _written(small, rows)
        drop_stored(stars)
        drop_stored(large)
        open_, rows = _open(held)
        if not open_:
            break
    else:
        if rows:
            raise RuntimeError("components did not settle")
    ids = held.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return held.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(ids)
