"""Vector codes: vectors cut into parts, each replaced by the number of its nearest codebook entry, with Yinyang Lloyd rounds.

Components become whole numbers, so distances are compared exactly. The entries of a codebook are put into groups of near
ones once. For each row and part a table keeps the code and, for each group, a lower bound of the distance to the
group's entries other than the row's own. After a round every bound is lowered by its group's largest drift; a group
whose bound still lies above the distance to the row's own entry (measured anew) is not scanned. Bounds are single precision, rounded
down; what is scanned is compared as integers, equal distances go to the lower index, and a group is left out only if all of its entries are strictly farther.

A round is one pass over that table: it writes the next one, and each task adds to it the counts and sums of the entries it assigned (rows
of kind 1), which Spark adds up. The driver holds the codebooks alone (``entries`` vectors at most). Tables are written to the shared folder and dropped when they are used up,
so a lost executor costs its tasks and no more.

Squared distances that might leave 53 bits are taken in Python's integers, without bounds (every group is scanned); sums travel as
digits of ``DIGIT`` bits, so they are exact for any size.

Defined results: rows whose vector is null, or holds null or non-finite components (also after scaling), are dropped; vectors are padded with 0 to the longest one's
length, and that to a multiple of ``parts``; equal ids are taken in order of their vectors, null ids last; repeated rows count each; fewer rows than
``entries`` make smaller codebooks; vectors of no components have code 0 and error 0; errors beyond 64 bits are cut off at their range; null labels are one label; an empty table gives no rows; other columns, also
of clashing names, are not read; a vector is held whole by a worker.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import attach, drop_stored, stored, table

PARTS, ENTRIES, ROUNDS, SCALE, GROUPS = 4, 256, 4, 1024.0, 16
#: Rows that are measured at a time, bits of a digit of a sum, and the relative slack of a bound (single precision is 2^-24).
STEP, DIGIT, SLACK = 8192, 40, 2.0**-20
FAR = 1e30
MOST = (1 << 63) - 1

ROW = "kind int, id long, label {label}, v binary, codes binary, lower binary, error long, part int, entry int, n long, sums array<long>, scanned long"


def whole_numbers(vectors: DataFrame, scale: float, id_col: str, col: str, label_col: str) -> DataFrame:
    """id, label, v (doubles that are whole numbers, see sortable), width and peak (their number, and the greatest without its sign) of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, lists, width, peak = [], [], [], []
            for i, x in enumerate(b.column("v")):
                if not x.is_valid or x.values.null_count:
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    v = np.floor(scale * x.values.to_numpy(zero_copy_only=False).astype(np.float64)) + 0.0  # no negative zeros
                if np.isfinite(v).all():
                    at.append(i)
                    lists.append(sortable(v))
                    width.append(len(v))
                    peak.append(float(np.abs(v).max(initial=0)))
            some = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([some.column("id"), some.column("label"), pa.array(lists, pa.binary()), pa.array(width, pa.int32()), pa.array(peak, pa.float64())], ["id", "label", "v", "width", "peak"])

    kind = vectors.schema[label_col].dataType.simpleString()
    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(col).alias("v")).mapInArrow(run, f"id long, label {kind}, v binary, width int, peak double")


@dataclass
class Books:
    """entries[part, index, place]: int64, or Python's integers where squares might leave 53 bits (wide)."""

    entries: np.ndarray
    groups: list[list[np.ndarray]]
    wide: bool

    def text(self) -> str:
        return ",".join(str(int(x)) for x in self.entries.ravel().tolist())


_SIGN = np.uint64(1 << 63)


def sortable(v: np.ndarray) -> bytes:
    """Doubles as bytes that sort as they do."""
    u = v.astype(np.float64).view(np.uint64)
    return np.where(u & _SIGN, ~u, u ^ _SIGN).astype(">u8").tobytes()


def padded(rows: list[bytes], width: int) -> np.ndarray:
    """Rows of sortable() bytes as doubles, with 0 up to one width."""
    if not all(len(r) == 8 * width for r in rows):
        zero = sortable(np.zeros(1))
        rows = [r + zero * (width - len(r) // 8) for r in rows]
    u = np.frombuffer(b"".join(rows), ">u8").astype(np.uint64).reshape(len(rows), width)
    return np.where(u & _SIGN, u ^ _SIGN, ~u).view(np.float64)


def integers(x: np.ndarray, wide: bool) -> np.ndarray:
    return np.vectorize(int, otypes=[object])(x) if wide and x.size else x.astype(object) if wide else x


def grouped(entries: np.ndarray, n: int) -> list[np.ndarray]:
    """Indexes of entries in at most n groups of near ones, by a few Lloyd rounds over the entries themselves. They change the work only."""
    with np.errstate(over="ignore", invalid="ignore"):
        c = np.nan_to_num(entries.astype(np.float64), posinf=0.0, neginf=0.0)
        c = c / max(1.0, float(np.abs(c).max(initial=0)))
        mid = c[np.linspace(0, len(c) - 1, min(n, len(c))).astype(int)]
        for _ in range(5):
            of = ((c[:, None] - mid[None]) ** 2).sum(2).argmin(1)
            mid = np.array([c[of == g].mean(0) if (of == g).any() else mid[g] for g in range(len(mid))])
        of = ((c[:, None] - mid[None]) ** 2).sum(2).argmin(1)
    return [np.flatnonzero(of == g) for g in range(len(mid)) if (of == g).any()]


def squares(x: np.ndarray, c: np.ndarray, wide: bool) -> np.ndarray:
    """Squared distances of every row of x to every row of c: whole numbers, exact."""
    if wide:
        return ((x[:, None] - c[None]) ** 2).sum(2) if x.size and c.size else np.zeros((len(x), len(c)), object)
    c = c.astype(np.float64)
    return np.einsum("ij,ij->i", x, x)[:, None] - 2 * (x @ c.T) + np.einsum("ij,ij->i", c, c)[None]


def _down(x: np.ndarray) -> np.ndarray:
    """In single precision, not above x (nor above FAR, which no distance reaches)."""
    x = np.minimum(x, FAR)
    return np.nextafter((x - np.abs(x) * SLACK).astype(np.float32), np.float32(-np.inf))


def assign(x: np.ndarray, c: np.ndarray, groups: list[np.ndarray], code: np.ndarray | None, lower: np.ndarray | None, wide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(code, squared distance, lower bounds by group, distances computed) of each row of a part.

    code: the row's entry so far (None: it has none yet, every group is scanned); lower: its bounds, lowered by the drift.
    """
    n, fresh = len(x), code is None or wide
    if wide:
        new, best = np.zeros(n, np.int64), np.zeros(n, object)
        for g, members in enumerate(groups):
            d = squares(x, c[members], True)
            low = d.argmin(1) if n else np.zeros(0, np.int64)
            for r in range(n):
                if not g or (d[r, low[r]], members[low[r]]) < (best[r], new[r]):
                    new[r], best[r] = members[low[r]], d[r, low[r]]
        return new, best, np.zeros((n, len(groups)), np.float32), n * len(c)
    if fresh:
        new, best, lower, done = np.full(n, len(c)), np.full(n, np.inf), np.full((n, len(groups)), -np.inf, np.float32), 0
    else:
        gap = x - c[code].astype(np.float64)
        new, best, lower, done = code.copy(), np.einsum("ij,ij->i", gap, gap), lower.copy(), n
    own, scanned = best.copy(), np.zeros(lower.shape, bool)
    first, second, index = np.zeros(lower.shape), np.full(lower.shape, np.inf), np.zeros(lower.shape, np.int64)
    for g, members in enumerate(groups):
        at = np.flatnonzero(lower[:, g] <= np.sqrt(best) * (1 + SLACK))
        d = squares(x[at], c[members], False)
        done += d.size
        low = d.argmin(1)
        least, nearest = d[np.arange(len(at)), low], members[low]
        scanned[at, g], first[at, g], index[at, g] = True, least, nearest
        if len(members) > 1:
            d[np.arange(len(at)), low] = np.inf
            second[at, g] = d.min(1)
        better = (least < best[at]) | ((least == best[at]) & (nearest < new[at]))
        new[at[better]], best[at[better]] = nearest[better], least[better]
    rest = np.sqrt(np.where(index == new[:, None], second, first))
    lower = np.where(scanned, _down(rest), lower)
    if not fresh:
        # The entry that was a row's own is one of its group's others now.
        of = np.zeros(len(c), np.int64)
        for g, members in enumerate(groups):
            of[members] = g
        r = np.flatnonzero(new != code)
        r = r[~scanned[r, of[code[r]]]]
        lower[r, of[code[r]]] = np.minimum(lower[r, of[code[r]]], _down(np.sqrt(own[r])))
    return new, best, lower, done


def _digits(total: list[int], n: int) -> list[int]:
    """Each number as n digits of DIGIT bits, least first; the last carries the sign."""
    out = []
    for x in total:
        for _ in range(n - 1):
            out.append(x & (1 << DIGIT) - 1)
            x >>= DIGIT
        out.append(x)
    return out


def _pass(rows: DataFrame, books: Books, drift: list[np.ndarray] | None, parts: int, digits: int, sums: bool, label_kind: str) -> DataFrame:
    """The rows with new codes, bounds and errors, and the counts and sums of each task (kind 1)."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast((books, drift))  # entries vectors at most
    part_width = books.entries.shape[2]
    schema = ROW.format(label=label_kind)
    first = drift is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, drifts = sent.value
        k = own.entries.shape[1]
        wide, width = own.wide, parts * part_width
        n_of = np.zeros((parts, k), np.int64)
        total = np.zeros((parts, k, part_width), object if wide else np.int64)
        groups = [len(g) for g in own.groups]
        cuts = np.concatenate([[0], np.cumsum(groups)])
        scanned = 0
        kinds = {"kind": pa.int32(), "id": pa.int64(), "label": pa.null(), "v": pa.binary(), "codes": pa.binary(), "lower": pa.binary(), "error": pa.int64(), "part": pa.int32(), "entry": pa.int32(), "n": pa.int64(), "sums": pa.list_(pa.int64()), "scanned": pa.int64()}

        def out(**have) -> pa.RecordBatch:
            size = len(next(iter(have.values())))
            return pa.RecordBatch.from_arrays([have[c] if c in have else pa.nulls(size, t) for c, t in kinds.items()], list(kinds))

        step = STEP // 64 if wide else STEP
        for whole in batches:
            kinds["label"] = whole.schema.field("label").type
            for lo in range(0, whole.num_rows, step):
                b = whole.slice(lo, step)
                x = integers(padded(b.column("v").to_pylist(), width), wide)
                codes, errors = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), object if wide else float)
                lower = np.zeros((len(x), cuts[-1]), np.float32)
                if not first:
                    before = np.frombuffer(b"".join(b.column("codes").to_pylist()), np.uint8).reshape(len(x), parts).astype(np.int64)
                    kept = np.frombuffer(b"".join(b.column("lower").to_pylist()), "<f4").reshape(len(x), cuts[-1])
                for p in range(parts):
                    some, span = x[:, p * part_width : (p + 1) * part_width], slice(cuts[p], cuts[p + 1])
                    was, bound = (None, None) if first else (before[:, p], _down(kept[:, span].astype(np.float64) - drifts[p][None]))
                    code, best, lower[:, span], done = assign(some, own.entries[p], own.groups[p], was, bound, wide)
                    scanned += done
                    codes[:, p] = code
                    errors = errors + best
                    if sums:
                        n_of[p] += np.bincount(code, minlength=k)
                        if wide:
                            for c, row in zip(code.tolist(), some, strict=True):
                                total[p, c] += row
                        else:
                            order = np.argsort(code, kind="stable")
                            edges = np.flatnonzero(np.diff(code[order], prepend=-1))
                            if len(order) and part_width:
                                total[p, code[order][edges]] += np.add.reduceat(some[order], edges, axis=0).astype(np.int64)
                errors = [min(int(e), MOST) for e in errors.tolist()]
                yield out(
                    kind=pa.array(np.zeros(len(x), np.int32)), id=b.column("id"), label=b.column("label"), v=b.column("v"), codes=pa.array([c.tobytes() for c in codes], pa.binary()),
                    lower=pa.array([r.tobytes() for r in lower.astype("<f4")], pa.binary()), error=pa.array(errors, pa.int64()),
                )
        used = [(p, e) for p in range(parts) for e in range(k) if n_of[p, e]]
        if used or scanned:
            rows_ = [(p, e, int(n_of[p, e]), _digits([int(t) for t in total[p, e].tolist()], digits)) for p, e in used] or [(0, 0, 0, [])]
            yield out(
                kind=pa.array(np.ones(len(rows_), np.int32)), part=pa.array([r[0] for r in rows_], pa.int32()), entry=pa.array([r[1] for r in rows_], pa.int32()), n=pa.array([r[2] for r in rows_], pa.int64()),
                sums=pa.array([r[3] for r in rows_], pa.list_(pa.int64())), scanned=pa.array([scanned] + [0] * (len(rows_) - 1), pa.int64()),
            )

    return rows.mapInArrow(run, schema)


def _moved(books: Books, sums: DataFrame, digits: int) -> tuple[Books, list[np.ndarray]]:
    """The codebooks after a round, and the largest drift in each group. sums: rows of kind 1."""
    flat = sums.where("n > 0").select("part", "entry", "n", F.posexplode_outer("sums").alias("place", "s"))
    totals = flat.groupBy("part", "entry", "place").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()  # entries * width * digits rows at most
    entries = books.entries.copy()
    held: dict[tuple[int, int], dict[int, int]] = {}
    count: dict[tuple[int, int], int] = {}
    for r in totals:
        held.setdefault((r.part, r.entry), {})[r.place or 0] = r.s or 0
        count[r.part, r.entry] = r.n
    for (p, e), digit in held.items():
        for place in range(entries.shape[2]):
            total = sum(digit[place * digits + j] << (DIGIT * j) for j in range(digits))
            entries[p, e, place] = total // count[p, e]
    drift = []
    for p, groups in enumerate(books.groups):
        with np.errstate(over="ignore"):
            far = np.zeros(entries.shape[1]) if books.wide else np.sqrt(((entries[p] - books.entries[p]).astype(np.float64) ** 2).sum(1)) * (1 + SLACK)
        drift.append(np.array([far[g].max(initial=0) for g in groups]))
    return Books(entries, books.groups, books.wide), drift


@dataclass
class Compressed:
    """rows: id, label, code (bytes, one a part), error; books: the final codebooks; scanned: distances computed in each pass, of ``all_`` that there are."""

    rows: DataFrame
    books: Books
    scanned: list[int]
    all_: int


def compress(vectors: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE, groups: int = GROUPS, id_col: str = "vec_id", col: str = "embedding", label_col: str = "label") -> Compressed:
    """Codebooks trained on all vectors, starting from those of least id, and the code of every vector."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    attach(vectors.sparkSession)
    label_kind = vectors.schema[label_col].dataType.simpleString()
    base = stored(whole_numbers(vectors, scale, id_col, col, label_col), "vectors")
    shape = base.agg(F.max("width").alias("width"), F.max("peak").alias("peak"), F.count(F.lit(1)).alias("n")).first()
    part_width, peak, n = -(-(shape.width or 0) // parts), shape.peak or 0.0, shape.n
    wide = 4 * peak * peak * max(1, part_width) >= 2.0**53
    digits = 1 if not wide else (int(peak).bit_length() + 48) // DIGIT + 2
    seeds = [bytes(r.v) for r in base.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()]  # entries vectors
    start = padded(seeds, parts * part_width).reshape(len(seeds), parts, part_width).transpose(1, 0, 2)
    start = integers(start, True) if wide else start.astype(np.int64)
    books = Books(start, [grouped(start[p], groups) for p in range(parts)] if seeds else [[] for _ in range(parts)], wide)
    rows, drift, scanned = base, None, []
    for turn in range(rounds + 1 if seeds else 0):
        last = turn == rounds
        after = stored(_pass(rows.select("id", "label", "v", *([] if drift is None else ["codes", "lower"])), books, drift, parts, digits, not last, label_kind), "codes")
        drop_stored(rows)
        tasks = after.where("kind = 1")
        scanned.append(int(tasks.agg(F.sum("scanned")).first()[0] or 0))
        if not last:
            books, drift = _moved(books, tasks, digits)
        rows = after.where("kind = 0")
    if not seeds:
        rows = rows.withColumn("codes", F.lit(None).cast("binary")).withColumn("error", F.lit(None).cast("long"))
    return Compressed(rows.select("id", "label", F.col("codes").alias("code"), "error"), books, scanned, n * parts * len(seeds))


def decompress(codes: DataFrame, books: Books) -> DataFrame:
    """id and vector (whole numbers as doubles, padding included) of rows with a code: the entries that it names."""
    sent = attach(codes.sparkSession).sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = sent.value.entries
        for b in batches:
            rows = [[float(x) for p, e in enumerate(c) for x in entries[p, e]] for c in b.column("code").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(rows, pa.list_(pa.float64()))], ["id", "vector"])

    return codes.where("code is not null").select("id", "code").mapInArrow(run, "id long, vector array<double>")


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    made = compress(table(spark, sf_dir, "embeddings"))
    by_label = made.rows.groupBy(F.col("label").alias("of")).agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST)).cast("long").alias("label_error"))
    digest = hashlib.sha256(made.books.text().encode()).hexdigest()
    # Labels may be as many as rows: a join, whose hot labels Spark splits.
    joined = made.rows.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


_NEAREST = """
a{i} AS MATERIALIZED (SELECT k, part, arg_min(entry, d * 256 + entry) AS entry, min(d) AS d FROM (
  SELECT x.k, x.part, c.entry, CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(x.v, c.v)]) AS BIGINT) AS d FROM p x JOIN c{i} c ON x.part = c.part) GROUP BY k, part)"""
_MOVED = """,
s{i} AS (SELECT part, entry, j, sum(y) AS s, count(*) AS n FROM (SELECT p.part, a{i}.entry, unnest(range(1, len(p.v) + 1)) AS j, unnest(p.v) AS y FROM p JOIN a{i} ON p.k = a{i}.k AND p.part = a{i}.part) GROUP BY ALL),
m{i} AS (SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM s{i} GROUP BY part, entry),
c{next} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m ON c.part = m.part AND c.entry = m.entry),"""

SQL = (
    """
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS k, vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS MATERIALIZED (SELECT k, part, v[part * (len(v) // 4) + 1 : (part + 1) * (len(v) // 4)] AS v FROM kept, (SELECT unnest(range(0, 4)) AS part)),
c0 AS MATERIALIZED (SELECT part, k - 1 AS entry, v FROM p WHERE k <= 256),"""
    + "".join(_NEAREST.format(i=i) + (_MOVED.format(i=i, next=i + 1) if i < ROUNDS else "") for i in range(ROUNDS + 1))
    + f""",
r AS (SELECT kept.vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM kept JOIN a{ROUNDS} a ON kept.k = a.k GROUP BY kept.k, kept.vec_id, label),
b AS (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY part, entry, j)) AS h FROM (SELECT part, entry, unnest(range(1, len(v) + 1)) AS j, unnest(v) AS y FROM c{ROUNDS}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, b.h AS codebooks_sha256 FROM r, b
"""
)
