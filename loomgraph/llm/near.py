"""Near-duplicate documents: sets of 5-word shingles, linked at a Jaccard similarity of 0.85 (op3) or another threshold.

1. One pass over the texts: each document's set, its size, a 128-bit digest, and a SetSketch of 224 registers.
   Documents with equal sets are one class, known by its least doc_id; a group of copies of any size is one class.
2. Bands of registers, their rows as many as the threshold allows (``banding``): two sets at 0.85 share none of 32 bands
   of 7 with a probability of 5e-6, two at 0.80 none of 37 bands of 6 with 1.3e-5. Each bucket is
   aggregated to its least member, which every other member is tied to; no pairs are made within a bucket.
   A tie that rests on buckets of two alone is dropped if the likelihood estimate is 0.15 below the threshold (five deviations).
3. Ties make clusters (components). A cluster above ``BLOCK`` members is refined: members of its buckets are
   compared by likelihood in bounded blocks, which keep a spanning forest of pairs at that estimate or more.
4. The texts of cluster members are read again, and all pairs within a cluster are verified on their full sets in
   bounded blocks, by one product of incidence matrices each; again only a spanning forest leaves a block.
5. Components of the verified links, over classes, then documents.

Defined results: null, empty and wordless texts have an empty set and are linked with nothing; a null doc_id is
carried through and kept, linked with nothing; repeated rows fall into one class; an empty table gives no rows; other columns are not read.
Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import attach, map_groups, pieces, stored, table
from loomgraph.llm.components import components
from loomgraph.llm.sketch import jaccard, registers
from loomgraph.llm.words import NOT_SPACE, grams, mix, words

#: M: registers of a sketch. MISS: two sets at the threshold share no band with this probability at most.
SHINGLE, M, MISS = 5, 224, 2e-5
#: Estimates below the threshold by this much are not verified: five deviations of the estimate at 0.80 and 0.85.
SLACK = 0.15
#: Members and shingles in a block at most (a member with more shingles is a block of its own with each other).
BLOCK, BLOCK_SHINGLES = 1024, 1_500_000
#: Shared shingles in one product of incidence matrices at most.
COLUMNS = 1024


def shingle_sets(col: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and each text's size."""
    w = words(col, NOT_SPACE)
    g, ok = grams(w, k)
    counts = np.diff(w.first)
    sets = []
    for i in range(len(col)):
        lo, hi = w.first[i], w.first[i + 1]
        if counts[i] >= k:
            s = np.sort(g[lo : hi - k + 1])
            keep = np.ones(len(s), bool)
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            sets.append(s[keep])
        elif counts[i]:
            with np.errstate(over="ignore"):
                whole = mix(w.hash[lo:hi] * np.arange(3, 2 * (hi - lo) + 3, 2, dtype=np.uint64))
                sets.append(mix(np.array([whole.sum(dtype=np.uint64) + np.uint64(counts[i])], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.array([len(s) for s in sets], np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n (set size), digest (of the set; null if empty), sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            flat, n = shingle_sets(b.column("text"))
            regs = registers(flat, np.repeat(np.arange(len(n)), n), n, M)
            ends = np.cumsum(n)
            digest = [hashlib.blake2b(flat[e - k : e].tobytes(), digest_size=16).digest() if k else None for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), pa.array(digest, pa.binary()), pa.array([r.tobytes() for r in regs], pa.binary())], ["doc_id", "n", "digest", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, digest binary, sketch binary")


def banding(percent: int) -> tuple[int, int]:
    """Rows and bands of the sketch: the longest bands that miss a pair at the threshold with a probability of MISS at most."""
    fits = [r for r in range(1, M + 1) if (1 - (percent / 100) ** r) ** (M // r) <= MISS]
    rows = max(fits, default=1)
    return rows, M // rows


def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), "<u2").reshape(-1, M)


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """pairs(a, b, ...) with the estimate of each."""
    one = classes.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = classes.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                est = jaccard(_matrix(b.column("sa")), _matrix(b.column("sb")), *(b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("na", "nb")))
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), b.column("k"), pa.array(est)], ["a", "b", "k", "est"])

    return pairs.join(one, "a").join(two, "b").select("a", "b", "k", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long, k long, est double")


class _Forest:
    """A spanning forest of n nodes, grown by the links of one node after another: held are its edges and each node's root, never all links."""

    def __init__(self, n: int) -> None:
        self.root, self.ends = np.arange(n), []

    def link(self, x: int, to: np.ndarray) -> None:
        """Of the links from x, keep those that join trees."""
        roots, first = np.unique(self.root[to], return_index=True)
        first = first[roots != self.root[x]]
        if len(first):
            self.ends += [(x, y) for y in to[first].tolist()]
            joined = np.zeros(len(self.root), bool)
            joined[roots] = True
            self.root[joined[self.root]] = self.root[x]

    def rows(self, ids: np.ndarray) -> pa.RecordBatch | None:
        if not self.ends:
            return None
        i, j = np.array(self.ends).T
        return pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ids[j])], ["a", "b"])


def _blocks(members: DataFrame, key: str, parts: str) -> DataFrame:
    """Each member, once for every pair of parts of its group that it belongs to: column block, unique over groups, and side (its part)."""
    part = F.expr(f"pmod(xxhash64(id, 5), {parts})")
    split = members.withColumn("side", part).withColumn("other", F.explode(F.expr(f"sequence(0L, {parts} - 1)")))
    lo, hi = F.least("side", "other"), F.greatest("side", "other")
    return split.withColumn("block", F.concat_ws(":", F.col(key).cast("string"), lo.cast("string"), hi.cast("string")))


def _alike(t: pa.Table, at_least: float) -> pa.RecordBatch | None:
    """Links of one block by the estimates of its sketches, as a spanning forest."""
    ids, n, regs = t.column("id").to_numpy(), t.column("n").to_numpy().astype(float), _matrix(t.column("sketch"))
    forest = _Forest(len(ids))
    for x in range(len(ids) - 1):
        ratio = np.minimum(n[x + 1 :], n[x]) / np.maximum(n[x + 1 :], n[x])
        y = x + 1 + np.flatnonzero(ratio >= at_least)
        y = y[(regs[y] == regs[x]).mean(axis=1) >= at_least - 0.1]
        if len(y):
            est = jaccard(np.broadcast_to(regs[x], (len(y), M)), regs[y], np.full(len(y), n[x]), n[y])
            forest.link(x, y[est >= at_least])
    return forest.rows(ids)


def _refined(bands: DataFrame, sizes: DataFrame, members: DataFrame, classes: DataFrame, at_least: float) -> DataFrame:
    """Ties between members of large clusters whose estimate is high enough: a spanning forest for each bucket."""
    rows = bands.join(sizes.where("k > 2"), "key").join(members.select("id"), "id")
    rows = _blocks(rows.join(classes.select("id", "n", "sketch"), "id"), "key", f"cast(ceil(k / {BLOCK}) as bigint)")

    return map_groups(rows.select("block", "id", "n", "sketch"), "block", lambda t: _alike(t, at_least), "a long, b long")


def _verify(t: pa.Table, percent: int) -> pa.RecordBatch | None:
    """Links of one block, as a spanning forest: sizes of all intersections from a product of incidence matrices."""
    ids = t.column("id").to_numpy()
    parts = [shingle_sets(b.column("text")) for b in pieces(t.select(["text"]).to_batches(), "text")]
    flat, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    del parts
    order = np.argsort(flat, kind="stable")
    owner, flat = np.repeat(np.arange(len(n), dtype=np.int32), n)[order], flat[order]
    del order
    # Shingles of several members, numbered in order.
    again = flat[1:] == flat[:-1]
    shared = np.zeros(len(flat), bool)
    shared[1:] = again
    shared[:-1] |= again
    starts = shared.copy()
    starts[1:] &= ~again
    own, col = owner[shared], np.cumsum(starts[shared], dtype=np.int32) - 1
    del flat, owner, again, shared, starts
    width, both = int(col[-1]) + 1 if len(col) else 0, np.zeros((len(n), len(n)), np.float32)
    for lo in range(0, width, COLUMNS):
        a, b = np.searchsorted(col, [lo, lo + COLUMNS])
        grid = np.zeros((len(n), min(COLUMNS, width - lo)), np.float32)
        grid[own[a:b], col[a:b] - lo] = 1
        both += grid @ grid.T
    forest = _Forest(len(ids))
    for x in range(len(ids) - 1):
        inter = both[x, x + 1 :].astype(np.int64)
        forest.link(x, x + 1 + np.flatnonzero((inter > 0) & (100 * inter >= percent * (n[x] + n[x + 1 :] - inter))))
    return forest.rows(ids)


def _texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The members' texts; members is the smaller side, so it is the hashed one and texts are not sorted."""
    return docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(members.hint("shuffle_hash"), "id")


def _totals(weighed: DataFrame) -> DataFrame:
    """cluster, members, shingles of clusters(id, cluster, n)."""
    return weighed.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))


def near_duplicates(docs: DataFrame, *, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    attach(docs.sparkSession)
    at_least = percent / 100 - SLACK
    base = stored(sketches(docs), "sketches")
    keyed = base.where("n > 0 and doc_id is not null")
    classes = stored(keyed.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    rows, n_bands = banding(percent)
    width = 2 * rows
    band = lambda i: F.xxhash64(F.lit(i), F.substring("sketch", i * width + 1, width))
    bands = classes.select("id", F.explode(F.array(*(band(i) for i in range(n_bands)))).alias("key"))
    sizes = bands.groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("k")).where("k > 1")
    ties = bands.join(sizes, "key").where("id <> least").groupBy(F.col("id").alias("a"), F.col("least").alias("b")).agg(F.max("k").alias("k"))
    ties = stored(_estimated(ties, classes), "ties").where(f"k > 2 or est >= {at_least}")
    cluster = components(ties).withColumnsRenamed({"component": "cluster"})
    weighed = stored(cluster.join(classes.groupBy("id").agg(F.sum("n").alias("n")), "id"), "clusters")
    total = _totals(weighed)
    large = stored(weighed.join(total.where(f"members > {BLOCK} or shingles > {BLOCK_SHINGLES}"), "cluster"), "large")
    if not large.isEmpty():
        strong = ties.where(f"est >= {at_least}").join(large.select(F.col("id").alias("a")), "a", "left_semi").select("a", "b")
        finer = components(strong.unionByName(_refined(bands, sizes, large, classes, at_least))).withColumnsRenamed({"component": "cluster"})
        weighed = stored(weighed.join(large.select("id"), "id", "left_anti").unionByName(finer.join(large.select("id", "n"), "id")), "clusters")
        total = _totals(weighed)
    parts = F.expr(f"cast(greatest(ceil(members / {BLOCK}), ceil(shingles / {BLOCK_SHINGLES})) as bigint)").alias("parts")
    members = weighed.select("id", "cluster").join(total.select("cluster", parts), "cluster")
    blocks = _blocks(_texts(docs, members), "cluster", "parts")
    links = map_groups(blocks.select("block", "id", "text"), "block", lambda t: _verify(t, percent), "a long, b long")
    joined = components(links)
    classed = base.join(classes.select("digest", F.col("id").alias("class")), "digest", "left")
    out = classed.join(joined.withColumnRenamed("id", "class"), "class", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class", "doc_id"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op3_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN c ON c.node = w.doc_id
"""
