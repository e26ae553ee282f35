"""Exact top-k search by inner product, with pivot-table elimination.

Components become floor(64 * x), so scores are integers, exact in doubles (or in Python's integers, where 53 bits
do not suffice). With d the distance, <q, c> = (|q|^2 + |c|^2 - d(q, c)^2) / 2, and d(q, c) is at least
max over pivots p of |d(q, p) - d(c, p)|: that bounds the score from above. The distances of every row to all pivots
are computed once and kept as a column of the stored table; the origin is a pivot too, so no bound is above |q| |c|.

1. Copies of one vector beyond the k + 1 of least id are left out (no query can need them), and equal queries are searched once.
2. Rows lie in blocks of about ``BLOCK`` that share their two nearest pivots. Each query is answered in its own block first:
   candidates in order of its own bounds, best first, until no bound reaches the k-th score so far.
3. A block is known by the least and greatest distance of its rows to each pivot. A block whose bound for every
   query of a set lies below the scores found at home is dropped before any vector is sent to meet that set.
4. What is left meets in bounded tasks of one block and one set, again in order of bounds, starting from the known scores.

Bounds allow for rounding: a distance in the table has a relative error of ``SLACK`` at most (single precision), norms
and sums one of a few units in the last place for each dimension; where squares overflow, the bound is infinite.
Pivots are chosen far apart from a bounded sample of ``SAMPLE`` rows; they change the work, not the result (``work`` counts it).

Defined results: vectors that are null, or hold null or non-finite components (also after scaling), and null ids, take no part; an empty
vector scores 0; a shorter vector counts as padded with 0; rows with the query's own id are never its results; rows equal in id and vector count once; ties go to
smaller ids; scores beyond 64 bits are cut off at their range; an empty table gives no rows; other columns, also of clashing names, are not read;
a vector is held whole by a worker, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import attach, map_groups, stored, table

K, EVERY, SCALE = 20, 20, 64.0
PIVOTS, SAMPLE, BLOCK, QUERIES = 32, 1024, 4096, 2048
#: Queries that are bounded at a time; how many candidates of best bound are evaluated before floors are set again; blocks whose summaries meet a set at a time.
STEP, ROUNDS, CHUNK = 128, (64, 256, 1024), 512
#: Relative error of a distance in the table: twice the rounding to single precision.
SLACK = 2.0**-22
LEAST = np.iinfo(np.int64).min


def quantised(vectors: DataFrame, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """id, v (little-endian doubles) of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, lists = [], []
            for i, x in zip(b.column("id").to_pylist(), b.column("v"), strict=True):
                if i is None or not x.is_valid or x.values.null_count:
                    continue
                v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                with np.errstate(over="ignore"):
                    v = np.floor(SCALE * v) + 0.0  # no negative zeros, so equal vectors are equal bytes
                if np.isfinite(v).all():
                    ids.append(i)
                    lists.append(v.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lists, pa.binary())], ["id", "v"])

    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(col).alias("v")).mapInArrow(run, "id long, v binary")


def matrix(rows: list[bytes], dim: int = 0) -> np.ndarray:
    """Rows padded with 0 to one width."""
    dim = max([dim, *(len(r) // 8 for r in rows)])
    if rows and dim and all(len(r) == 8 * dim for r in rows):
        return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), dim)
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        out[i, : len(r) // 8] = np.frombuffer(r, "<f8")
    return out


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products as int64: doubles where exact, else Python's integers."""
    peak = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if peak < 2.0**53:
        return (q @ c.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(q).dot(whole(c).T) if q.size and c.size else np.zeros((len(q), len(c)), object)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Distances from each x to each pivot, by differences: nothing cancels, so errors stay relative. Not a number where squares overflow."""
    width = max(x.shape[1], p.shape[1])
    x, p = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, p))
    out = np.empty((len(x), len(p)), np.float32)
    with np.errstate(over="ignore", invalid="ignore"):
        for j in range(len(p)):
            gap = x - p[j]
            out[:, j] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    out[~np.isfinite(out)] = np.nan
    return out


def pivots_of(rows: np.ndarray, n: int) -> np.ndarray:
    """The origin, then n - 1 rows, each as far as can be from those before."""
    picked = [np.zeros((1, rows.shape[1]))]
    far = np.nan_to_num(distances(rows, picked[0])[:, 0], nan=-1.0)
    while len(picked) < n and len(rows) and far.max() > 0:
        picked.append(rows[[int(far.argmax())]])
        far = np.minimum(far, np.nan_to_num(distances(rows, picked[-1])[:, 0], nan=-1.0))
    return np.concatenate(picked)


def upper(nq: np.ndarray, nc: np.ndarray, gap: np.ndarray, far: np.ndarray, dim: int) -> np.ndarray:
    """Bounds of scores from squared norms, the greatest difference of distances to a pivot, and the greatest sum of both."""
    total = nq + nc
    near = np.maximum(gap - SLACK * far, 0)
    with np.errstate(invalid="ignore", over="ignore"):
        bound = (total - near * near) / 2 + (dim + 8) * 2.0**-50 * total
    return np.maximum(np.where(np.isfinite(bound) & np.isfinite(total), bound, np.inf), float(LEAST))


def _peak(d: np.ndarray) -> np.ndarray:
    return np.nan_to_num(np.fmax.reduce(d, axis=1, initial=0.0), nan=0.0).astype(np.float64)


def bounds(dq: np.ndarray, dc: np.ndarray, nq: np.ndarray, nc: np.ndarray, dim: int) -> np.ndarray:
    """(queries, candidates) bounds from rows of the pivot table."""
    gap, one = np.zeros((len(dq), len(dc)), np.float32), np.empty((len(dq), len(dc)), np.float32)
    for j in range(dq.shape[1]):
        np.subtract(dq[:, j, None], dc[None, :, j], out=one)
        np.fmax(gap, np.abs(one, out=one), out=gap)  # a distance that is no number says nothing
    return upper(nq[:, None], nc[None, :], gap.astype(np.float64), _peak(dq)[:, None] + _peak(dc)[None, :], dim)


def block_bounds(dq: np.ndarray, nq: np.ndarray, low: np.ndarray, high: np.ndarray, norm: np.ndarray, dim: int) -> np.ndarray:
    """(queries, blocks) bounds of the best score in a block, from its least and greatest distances and its greatest squared norm."""
    gap = np.zeros((len(dq), len(low)), np.float32)
    for j in range(dq.shape[1]):
        d = dq[:, j, None]
        np.fmax(gap, np.fmax(d - high[None, :, j], low[None, :, j] - d), out=gap)
    by_gap = upper(nq[:, None], norm[None, :], gap.astype(np.float64), _peak(dq)[:, None] + _peak(high)[None, :], dim)
    with np.errstate(over="ignore"):
        return np.maximum(np.minimum(by_gap, np.sqrt(nq)[:, None] * np.sqrt(norm)[None, :] * (1 + (dim + 8) * 2.0**-50)), float(LEAST))


def _floor(score: np.ndarray) -> np.ndarray:
    """A double that is not above an integer score."""
    f = score.astype(np.float64)
    return f - np.abs(f) * 2.0**-52


def _norms(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.einsum("ij,ij->i", x, x)


def best(q: np.ndarray, dq: np.ndarray, own: np.ndarray, known: np.ndarray, c: np.ndarray, dc: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(query's place, ids, scores, evaluated): its k best candidates that reach the score ``known`` (LEAST: none is). ids ascend; own: an id to leave out, or -1 places."""
    nq, nc, dim = _norms(q), _norms(c), q.shape[1]
    for lo in range(0, len(q), STEP):
        part = slice(lo, min(lo + STEP, len(q)))
        bound = bounds(dq[part], dc, nq[part], nc, dim)
        mine = own[part]
        at = np.searchsorted(ids, mine)
        hit = (at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == mine) & (mine != LEAST)
        for r in np.flatnonzero(hit).tolist():
            bound[r, ids == mine[r]] = -np.inf
        order = np.argsort(-bound.astype(np.float32), axis=1)
        floor = known[part].copy()
        top = [np.zeros(0, np.int64) for _ in floor]
        held: list[tuple[list, list]] = [([], []) for _ in floor]
        done = np.zeros(len(floor), np.int64)
        start = 0
        for size in (*ROUNDS, len(ids)):
            if start >= len(ids):
                break
            idx = order[:, start : start + size]
            start += idx.shape[1]
            wanted = np.take_along_axis(bound, idx, axis=1) >= np.maximum(_floor(floor), float(LEAST))[:, None]
            rows = np.flatnonzero(wanted.any(axis=1))
            whole = products(q[part][rows], c) if 4 * wanted.sum() > len(rows) * len(ids) else None
            for n, r in enumerate(rows.tolist()):
                some = idx[r][wanted[r]]
                s = whole[n, some] if whole is not None else products(q[part][[r]], c[some])[0]
                done[r] += len(some)
                fit = s >= floor[r]
                held[r][0].append(ids[some[fit]])
                held[r][1].append(s[fit])
                top[r] = np.concatenate([top[r], s[fit]])
                if len(top[r]) >= k:
                    top[r] = np.partition(top[r], len(top[r]) - k)[len(top[r]) - k :]
                    floor[r] = max(floor[r], top[r].min())
        for r in range(len(floor)):
            got = np.concatenate([*held[r][0], np.zeros(0, np.int64)]).astype(np.int64)
            s = np.concatenate([*held[r][1], np.zeros(0, np.int64)]).astype(np.int64)
            pick = np.lexsort((got, ~s))[:k]
            yield lo + r, got[pick], s[pick], int(done[r])


def _rows(t: pa.Table, at: np.ndarray, dim: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and distances of some rows of a table."""
    some, pivots = t.take(pa.array(at)), len(t.column("d")[0].as_py()) // 4
    return matrix(some.column("v").to_pylist(), dim), np.frombuffer(b"".join(some.column("d").to_pylist()), "<f4").reshape(len(at), pivots)


def _placed(vectors: DataFrame, k: int, every: int, id_col: str, col: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """The pivot table (block, id, v, d), the distinct queries (block, rep, own, v, d), which query has which (query_id, rep), and the number of blocks."""
    spark = attach(vectors.sparkSession)
    base = stored(quantised(vectors, id_col, col), "vectors")
    spread = [bytes(r.v) for r in base.orderBy(F.xxhash64("id"), "id", "v").limit(SAMPLE).collect()]  # SAMPLE rows at most
    p = pivots_of(matrix(spread), PIVOTS)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = distances(matrix(b.column("v").to_pylist(), p.shape[1]), p)
                near = np.argsort(np.where(np.isnan(d), np.inf, d), axis=1, kind="stable")[:, :2].astype(np.int32)
                cell = near[:, 0] * len(p) + near[:, -1]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array([x.tobytes() for x in d], pa.binary())], [*b.schema.names, "cell", "d"])

    # Copies: the window's group limit keeps k + 1 rows of a vector in each task before the shuffle.
    once = base.groupBy("v", "id").agg(F.lit(1).alias("one"))
    few = once.withColumn("n", F.expr("row_number() over (partition by v order by id)")).where(F.col("n") <= k + 1).select("id", "v")
    places = stored(few.mapInArrow(measured, "id long, v binary, cell int, d binary"), "pivots")
    # Blocks: neighbouring cells together up to BLOCK rows, larger cells cut by hash. At most PIVOTS^2 cells are counted.
    first, held, starts = 0, 0, []
    for r in sorted(places.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()):
        if held + r.n > BLOCK and held:
            first, held = first + 1, 0
        cut = -(-r.n // BLOCK)
        starts.append((r.cell, first, cut))
        first, held = (first + cut, 0) if cut > 1 else (first, held + r.n)
    blocks = max([s[1] + s[2] for s in starts], default=0)
    of_cell = F.broadcast(spark.createDataFrame(starts, "cell int, first long, cut long"))
    block = (F.col("first") + F.pmod(F.xxhash64("id"), "cut")).alias("block")
    candidates = places.join(of_cell, "cell").select(block, "id", "v", "d")
    asked = once.where(F.col("id") % every == 0)
    # An id that stands for one vector is taken out of its k + 1 best afterwards; other ids are left out while searching.
    asked = asked.withColumn("own", F.when(F.expr("count(1) over (partition by id)") > 1, F.col("id")))
    distinct = stored(asked.select("v", "own").distinct().withColumn("id", F.monotonically_increasing_id()), "distinct")
    whose = asked.join(distinct.select(F.col("v").alias("qv"), F.col("own").alias("qo"), F.col("id").alias("rep")), (F.col("v") == F.col("qv")) & F.col("own").eqNullSafe(F.col("qo"))).select(F.col("id").alias("query_id"), "rep")
    queries = distinct.mapInArrow(measured, "v binary, own long, id long, cell int, d binary").join(of_cell, "cell").select(block, "id", "own", "v", "d")
    return candidates, queries, whose, blocks


FOUND = "rep long, vec_id long, score long, evaluated long"


def _found(rows: list[tuple]) -> list[pa.Array]:
    """Columns of FOUND from (rep, ids, scores, evaluated): a row for each id, and one without an id that tells how many were evaluated."""
    rep = np.concatenate([np.full(len(got) + 1, r) for r, got, _, _ in rows])
    last = np.cumsum([len(got) + 1 for _, got, _, _ in rows]) - 1
    blank = np.zeros(len(rep), bool)
    blank[last] = True
    vec, score, n = (np.zeros(len(rep), np.int64) for _ in range(3))
    vec[~blank], score[~blank], n[last] = np.concatenate([x[1] for x in rows]), np.concatenate([x[2] for x in rows]), [x[3] for x in rows]
    return [pa.array(rep, pa.int64()), pa.array(vec, mask=blank), pa.array(score, mask=blank), pa.array(n, mask=~blank)]


def _searched(vectors: DataFrame, k: int, every: int, id_col: str, col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(FOUND of the distinct queries, which query has which, the candidates); k + 1 best of each distinct query, its own id among them."""
    candidates, queries, whose, blocks = _placed(vectors, k, every, id_col, col)
    more = k + 1

    def at_home(t: pa.Table) -> pa.RecordBatch | None:
        asks = t.column("own_kind").to_numpy() > 0
        ci, qi = np.flatnonzero(~asks), np.flatnonzero(asks)
        c, dc = _rows(t, ci)
        q, dq = _rows(t, qi, c.shape[1])
        c = np.pad(c, ((0, 0), (0, q.shape[1] - c.shape[1])))
        some = t.take(pa.array(qi))
        reps, own = some.column("id").to_numpy(), some.column("own").fill_null(LEAST).to_numpy()
        ids, known, rows = t.column("id").to_numpy()[ci], np.full(len(qi), LEAST), []
        if len(ci) and len(qi):
            for i, got, s, n in best(q, dq, own, known.copy(), c, dc, ids, more):
                rows.append((reps[i], got, s, n))
                if len(got) == more:
                    known[i] = s[-1]
        dim, block = max(c.shape[1], q.shape[1]), t.column("block")[0].as_py()
        parts = [pa.table({"kind": pa.array(np.ones(len(qi), np.int32)), "id": pa.array(reps), "own": some.column("own"), "v": some.column("v"), "d": some.column("d"), "norm": pa.array(_norms(q)), "score": pa.array(known)})]
        if len(ci):
            with np.errstate(invalid="ignore"):
                low, high = np.min(dc, axis=0), np.max(dc, axis=0)  # no number if any is none
            parts.append(pa.table({"kind": pa.array([0], pa.int32()), "d": pa.array([low.tobytes() + high.tobytes()], pa.binary()), "norm": pa.array([_norms(c).max()])}))
        if rows:
            parts.append(pa.table(dict(zip(("id", "own", "score", "evaluated"), _found(rows), strict=True))).append_column("kind", pa.array(np.full(sum(len(r[1]) + 1 for r in rows), 2, np.int32))))
        whole = pa.concat_tables(parts, promote_options="default")
        whole = whole.append_column("block", pa.array(np.full(len(whole), block))).append_column("dim", pa.array(np.full(len(whole), dim, np.int32)))
        kinds = {"kind": pa.int32(), "block": pa.int64(), "id": pa.int64(), "own": pa.int64(), "v": pa.binary(), "d": pa.binary(), "norm": pa.float64(), "score": pa.int64(), "dim": pa.int32(), "evaluated": pa.int64()}
        arrays = [whole.column(n).combine_chunks().cast(t) if n in whole.column_names else pa.nulls(len(whole), t) for n, t in kinds.items()]
        return pa.RecordBatch.from_arrays(arrays, list(kinds))

    none = F.lit(None).cast("long")
    both = candidates.select("block", "id", none.alias("own"), "v", "d", F.lit(0).alias("own_kind")).unionByName(queries.withColumn("own_kind", F.lit(1)))
    home = stored(map_groups(both, "block", at_home, "kind int, block long, id long, own long, v binary, d binary, norm double, score long, dim int, evaluated long", ("own_kind", "id")), "home")
    found = home.where("kind = 2").select(F.col("id").alias("rep"), F.col("own").alias("vec_id"), "score", "evaluated")
    if blocks < 2:
        return found, whose, candidates
    asked, blocked = home.where("kind = 1"), home.where("kind = 0")
    sets = max(1, -(-asked.count() // QUERIES))
    each = -(-sets // blocks)  # sets of one block, where there are more sets than blocks
    set_of = F.expr(f"block * {each} + pmod(xxhash64(id), {each})") if sets >= blocks else F.expr(f"block * {sets} div {blocks}")
    sets = blocks * each if sets >= blocks else sets
    asked = asked.withColumn("set", set_of)
    chunks = -(-blocks // CHUNK)
    narrow = asked.select("set", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "kind", "block", "d", "norm", "score", "dim")
    shapes = blocked.select(F.explode(F.sequence(F.lit(0), F.lit(sets - 1))).alias("set"), F.expr(f"block div {CHUNK}").alias("chunk"), "kind", "block", "d", "norm", "score", "dim")
    group = F.expr(f"cast(set as bigint) * {chunks} + chunk").alias("group")
    columns = [group, F.col("set").cast("long").alias("set"), "kind", "block", "d", "norm", "score", "dim"]

    def alive(t: pa.Table) -> pa.RecordBatch | None:
        """Blocks of a chunk that some query of a set may still need."""
        asks = t.column("kind").to_numpy() == 1
        qi, bi = pa.array(np.flatnonzero(asks)), pa.array(np.flatnonzero(~asks))
        if not len(qi) or not len(bi):
            return None
        q, b = t.take(qi), t.take(bi)
        shape = np.frombuffer(b"".join(b.column("d").to_pylist()), "<f4").reshape(len(bi), 2, -1)
        dq = np.frombuffer(b"".join(q.column("d").to_pylist()), "<f4").reshape(len(qi), -1)
        bound = block_bounds(dq, q.column("norm").to_numpy(), shape[:, 0], shape[:, 1], b.column("norm").to_numpy(), int(t.column("dim").to_numpy().max()))
        names = b.column("block").to_numpy()
        keep = ((bound >= _floor(q.column("score").to_numpy())[:, None]) & (q.column("block").to_numpy()[:, None] != names[None, :])).any(axis=0)
        names = names[keep]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(names), t.column("set")[0].as_py())), pa.array(names)], ["set", "block"]) if len(names) else None

    pairs = stored(map_groups(narrow.select(*columns).unionByName(shapes.select(*columns)), "group", alive, "set long, block long"), "pairs")
    pair = F.expr(f"set * {blocks} + block").alias("pair")
    ask = asked.withColumnRenamed("block", "home").withColumn("set", F.col("set").cast("long")).join(pairs, "set").where("home <> block").select(pair, "id", "own", "v", "d", "score", F.lit(1).alias("kind"))
    give = candidates.join(pairs, "block").select(pair, "id", none.alias("own"), "v", "d", none.alias("score"), F.lit(0).alias("kind"))

    def meet(t: pa.Table) -> pa.RecordBatch | None:
        asks = t.column("kind").to_numpy() > 0
        qi, ci = np.flatnonzero(asks), np.flatnonzero(~asks)
        if not len(qi) or not len(ci):
            return None
        c, dc = _rows(t, ci)
        q, dq = _rows(t, qi, c.shape[1])
        c = np.pad(c, ((0, 0), (0, q.shape[1] - c.shape[1])))
        some = t.take(pa.array(qi))
        reps, own, known = some.column("id").to_numpy(), some.column("own").fill_null(LEAST).to_numpy(), some.column("score").to_numpy()
        with np.errstate(invalid="ignore"):
            bound = block_bounds(dq, _norms(q), dc.min(axis=0)[None], dc.max(axis=0)[None], _norms(c).max()[None], q.shape[1])[:, 0]
        on = np.flatnonzero(bound >= _floor(known))
        rows = [(reps[on[i]], got, s, n) for i, got, s, n in best(q[on], dq[on], own[on], known[on], c, dc, t.column("id").to_numpy()[ci], more)]
        return pa.RecordBatch.from_arrays(_found(rows), ["rep", "vec_id", "score", "evaluated"]) if rows else None

    met = map_groups(ask.unionByName(give), "pair", meet, FOUND, ("kind", "id"))
    return found.unionByName(met), whose, candidates


def top_k(vectors: DataFrame, *, k: int = K, every: int = EVERY, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for rows whose id is divisible by ``every``, the k best of all other rows."""
    found, whose, _ = _searched(vectors, k, every, id_col, col)
    order = "order by score desc, vec_id"
    few = found.where("vec_id is not null").withColumn("n", F.expr(f"row_number() over (partition by rep {order})")).where(F.col("n") <= k + 1)
    each = whose.join(few.select("rep", "vec_id", "score"), "rep").where("vec_id <> query_id")
    rank = F.expr(f"row_number() over (partition by query_id {order})")
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def work(vectors: DataFrame, *, k: int = K, every: int = EVERY, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """rep, evaluated, candidates: how many scores were computed for each distinct query vector, of how many candidates."""
    found, _, candidates = _searched(vectors, k, every, id_col, col)
    return found.groupBy("rep").agg(F.coalesce(F.sum("evaluated"), F.lit(0)).alias("evaluated")).withColumn("candidates", F.lit(candidates.count()))


def op10_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.v, c.v)]) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 20
"""
