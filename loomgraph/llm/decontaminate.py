"""Benchmark decontamination by winnowing.

Fingerprints are the least 5-gram hashes of every 6 consecutive 5-grams, so any two texts that share 10 words
in a row share a fingerprint at the same place of that run. Document fingerprints are joined with those of the
benchmark's windows, and each hit is extended to its whole window, whose hash must agree; so exactly the
occurrences of windows remain. Items of fewer than 10 words are one window each and are looked up by runs of
their own length.

The benchmark's index goes to every worker only while it takes at most ``max_local`` bytes (measured before anything is collected);
beyond, fingerprints are joined as DataFrames (``_joined``), with the same result. There, a filter of fixed size (8 MB, one bit for each
value of a fingerprint's leading bits) keeps what no window of the benchmark can meet from being shuffled, and windows are
repeated ``SALT`` times, so a window that a third of all documents hold is met in many tasks.

Defined results: a null or empty text has no words and no hits; a null doc_id is carried through; null or empty
items make no window; repeated items count by item_id (null ids are ignored in lists); repeated documents are judged row by row;
an empty table on either side gives no hits or no rows; texts of any length are cut into words whole, one at a time; columns named
in carry are returned (any but the outputs' own names), others, also of clashing names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import attach, pieces, stored, table
from loomgraph.llm.words import ALNUM, Words, grams, words

WINDOW, GRAM = 10, 5
#: Bytes of the benchmark's index that the driver and a worker may hold, and what a window takes of them beside its item_id.
MAX_LOCAL, WINDOW_BYTES = 48 << 20, 72
#: Leading bits of a fingerprint in the filter of the joined plan, and parts that one window is met in.
FILTER_BITS, SALT = 26, 8


def _least(w: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram hashes, hashes of the windows that begin at each word, which words begin one, and the place in it of its least gram, the leftmost if several are."""
    g, _ = grams(w, gram)
    full, ok = grams(w, window, seed=11)
    span, n = window - gram + 1, len(g)
    place = np.zeros(n, np.int32)
    if n >= window:
        least, where = g[: n - span + 1].copy(), place[: n - span + 1]
        for j in range(1, span):
            lower = g[j : n - span + 1 + j] < least
            least[lower] = g[j : n - span + 1 + j][lower]
            where[lower] = j
    return g, full, ok, place


def _item_windows(col: pa.Array, window: int, gram: int) -> list[tuple[int, int, int, int, int]]:
    """(row, length, fingerprint, place of the fingerprint in the window, window hash); short items have fingerprint = hash, place 0."""
    w = words(col, ALNUM)
    g, full, ok, place = _least(w, window, gram)
    counts = np.diff(w.first)
    at = np.flatnonzero(ok)
    out = list(zip(w.doc[at].tolist(), [window] * len(at), g[at + place[at]].tolist(), place[at].tolist(), full[at].tolist(), strict=True))
    for n in sorted({int(c) for c in counts if 0 < c < window}):
        h, _ = grams(w, n, seed=11)
        for row in np.flatnonzero(counts == n).tolist():
            x = int(h[w.first[row]])
            out.append((row, n, x, 0, x))
    return out


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """item_id, n (words), fp, place, win: one row for each window of an item and each fingerprint in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            if rows := _item_windows(b.column("text"), window, gram):
                r, n, fp, place, win = zip(*rows, strict=True)
                ids = b.column("item_id").take(pa.array(r, pa.int64()))
                signed = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (fp, win)]
                yield pa.RecordBatch.from_arrays([ids.cast(pa.string()), pa.array(n, pa.int32()), signed[0], pa.array(place, pa.int32()), signed[1]], ["item_id", "n", "fp", "place", "win"])

    return benchmark.select("item_id", "text").mapInArrow(run, "item_id string, n int, fp long, place int, win long").distinct()


class Index:
    """Windows of a benchmark, sorted by fingerprint, with the items of each window; arrays alone."""

    def __init__(self, rows: pa.Table, window: int, gram: int):
        self.window, self.gram = window, gram
        item, self.names = rows.column("item_id").combine_chunks(), pa.array([], pa.string())
        n, fp, place, win = (rows.column(c).to_numpy() for c in ("n", "fp", "place", "win"))
        code = np.zeros(0, np.int64)
        if len(rows):
            coded = item.dictionary_encode() if not isinstance(item, pa.ChunkedArray) else item.combine_chunks().dictionary_encode()
            self.names, code = coded.dictionary, coded.indices.fill_null(-1).to_numpy()
        self.by_length, self.items = {}, {}
        for k in np.unique(n).tolist():
            of = np.flatnonzero(n == k)
            keys = np.unique(np.rec.fromarrays([fp[of].view(np.uint64), place[of], win[of].view(np.uint64)], names="f,p,w"))
            seen = np.zeros(1 << 20, bool)
            seen[(keys.f & np.uint64(0xFFFFF)).astype(np.int64)] = True
            self.by_length[k] = (np.ascontiguousarray(keys.f), np.ascontiguousarray(keys.p).astype(np.int64), np.ascontiguousarray(keys.w), seen)
            known = of[code[of] >= 0]
            order = known[np.argsort(win[known], kind="stable")]
            self.items[k] = win[order], code[order]

    def items_of(self, n: int, win: int) -> list[int]:
        """Codes (places in names) of the items that hold a window."""
        wins, codes = self.items[n]
        return codes[np.searchsorted(wins, win, "left") : np.searchsorted(wins, win, "right")].tolist()

    def hits(self, w: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, first words, window hashes) of all windows that occur."""
        for n, (fp, place, win, seen) in self.by_length.items():
            if n == self.window:
                g, full, ok, least = _least(w, self.window, self.gram)
                start = np.flatnonzero(ok)
                own = g[start + least[start]]
            else:
                full, ok = grams(w, n, seed=11)
                start = np.flatnonzero(ok)
                own, least = full[start], np.zeros(len(full), np.int32)
            some = seen[(own & np.uint64(0xFFFFF)).astype(np.int64)]
            start, own = start[some], own[some]
            lo, hi = np.searchsorted(fp, own, "left"), np.searchsorted(fp, own, "right")
            many = hi - lo
            entry = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            start = np.repeat(start, many)
            same = (least[start] == place[entry]) & (full[start] == win[entry])  # the hit, extended to its whole window
            yield n, start[same], win[entry[same]]


SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>"


def _digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def _local(docs: DataFrame, index: Index, carry: tuple[str, ...]) -> DataFrame:
    kept = {f"carried_{c}": docs.schema[c].dataType.simpleString() for c in carry}
    sent = docs.sparkSession.sparkContext.broadcast(index)
    none = _digest([])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for b in pieces(batches, "text"):
            w = words(b.column("text"), ALNUM)
            hit, found = np.zeros(len(w.hash) + 1, np.int32), {}
            for n, start, win in own.hits(w):
                np.add.at(hit, start, 1)
                np.add.at(hit, start + n, -1)
                for row, x in set(zip(w.doc[start].tolist(), win.view(np.int64).tolist(), strict=True)):
                    found.setdefault(row, set()).update(own.items_of(n, x))
            covered = np.concatenate([[0], np.cumsum(np.cumsum(hit[:-1]) > 0)])
            n_hit = covered[w.first[1:]] - covered[w.first[:-1]]
            lists = [sorted(own.names.take(pa.array(list(found[i]), pa.int64())).to_pylist()) if found.get(i) else [] for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(w.first).astype(np.int64)), pa.array(n_hit.astype(np.int64)), pa.array([len(x) for x in lists], pa.int64()), pa.array([_digest(x) if x else none for x in lists]), pa.array(n_hit > 0), pa.array(lists, pa.list_(pa.string())), *(b.column(c) for c in kept)],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", *kept],
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text", *(F.col(c).alias(f"carried_{c}") for c in carry))
    return rows.mapInArrow(run, ", ".join([SCHEMA, *(f"`{k}` {t}" for k, t in kept.items())])).withColumnsRenamed({f"carried_{c}": c for c in carry})


def _filter(windows: DataFrame) -> np.ndarray:
    """A bit for each value of the leading FILTER_BITS bits of a fingerprint: of fixed size, whatever the benchmark's."""
    at = f"shiftrightunsigned(fp, {64 - FILTER_BITS})"
    parts = windows.selectExpr(f"cast(shiftright({at}, 6) as int) as word", f"shiftleft(1L, cast({at} & 63 as int)) as bit").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    out, rows = np.zeros(1 << (FILTER_BITS - 6), np.uint64), parts.toArrow()  # 2 ** 20 rows of 12 bytes at most
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def _joined(docs: DataFrame, windows: DataFrame, window: int, gram: int, carry: tuple[str, ...]) -> DataFrame:
    """For a benchmark of any size: fingerprints meet in a shuffled join; rows of a document are known by its id and a hash of its text."""
    short = [r.n for r in windows.where(F.col("n") < window).select("n").distinct().collect()]  # fewer than window values
    sent = docs.sparkSession.sparkContext.broadcast(_filter(windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for b in pieces(batches, "text"):
            w = words(b.column("text"), ALNUM)
            g, full, ok, place = _least(w, window, gram)
            start = np.flatnonzero(ok)
            parts = [(window, start, g[start + place[start]], place[start], full[start])]
            for n in short:
                h, fine = grams(w, n, seed=11)
                start = np.flatnonzero(fine)
                parts.append((n, start, h[start], np.zeros(len(start), np.int32), h[start]))
            for n, start, fp, at, win in parts:
                lead = fp >> np.uint64(64 - FILTER_BITS)
                some = (known[(lead >> np.uint64(6)).astype(np.int64)] >> (lead & np.uint64(63))) & np.uint64(1) > 0
                start, fp, at, win = start[some], fp[some], at[some], win[some]
                rows = pa.array(w.doc[start])
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(rows), b.column("mark").take(rows), pa.array((start - w.first[w.doc[start]]).astype(np.int64)), pa.array(np.full(len(start), n, np.int64)), pa.array(fp.view(np.int64)), pa.array(at.astype(np.int32)), pa.array(win.view(np.int64))], ["doc_id", "mark", "start", "n", "fp", "place", "win"])
            blank = [pa.nulls(b.num_rows, t) for t in (pa.int64(), pa.int32(), pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("mark"), pa.nulls(b.num_rows, pa.int64()), pa.array(np.diff(w.first).astype(np.int64)), *blank], ["doc_id", "mark", "start", "n", "fp", "place", "win"])

    marked = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), "text")
    # A row without a start tells a document's number of words, so texts are cut once.
    read = stored(marked.mapInArrow(run, "doc_id long, mark long, start long, n long, fp long, place int, win long"), "fingerprints")
    counted = read.where("start is null").select("doc_id", "mark", F.col("n").alias("n_words"))
    once = windows.select(F.col("n").cast("long").alias("n"), "fp", "place", "win").distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    met = read.where("start is not null").withColumn("salt", F.expr(f"cast(pmod(xxhash64(doc_id, start), {SALT}) as int)")).join(once, ["salt", "n", "fp", "place", "win"])
    hits = stored(met.select("doc_id", "mark", "start", "n", "win"), "hits")
    named = hits.select("doc_id", "mark", "n", "win").distinct().join(windows.select(F.col("n").cast("long").alias("n"), "win", "item_id").distinct(), ["n", "win"])
    items = named.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    # Each hit ends at start + n; a word counts once: what a hit adds lies beyond the furthest end before it.
    spans = hits.groupBy("doc_id", "mark", "start").agg(F.max(F.col("start") + F.col("n")).alias("end"))
    spans = spans.withColumn("reach", F.expr("coalesce(max(end) over (partition by doc_id, mark order by start rows between unbounded preceding and 1 preceding), 0)"))
    words_hit = spans.groupBy("doc_id", "mark").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reach"))).alias("n_hit"))
    keys = lambda a, b: F.col("doc_id").eqNullSafe(F.col(a)) & F.col("mark").eqNullSafe(F.col(b))
    both = items.withColumnsRenamed({"doc_id": "d", "mark": "m"}).join(words_hit, keys("d", "m")).drop("doc_id", "mark")
    out = counted.join(both, keys("d", "m"), "left").select("doc_id", "mark", "n_words", "n_hit", "items")
    none = F.array().cast("array<string>")
    if carry:
        own = docs.select(F.col("doc_id").cast("long").alias("own_id"), F.xxhash64("text").alias("own_mark"), *(F.col(c).alias(f"carried_{c}") for c in carry))
        out = own.join(out.dropDuplicates(["doc_id", "mark"]), keys("own_id", "own_mark"))
    more = [F.col(f"carried_{c}").alias(c) for c in carry]
    out = out.select("doc_id", *more, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "items", *carry)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, gram: int = GRAM, max_local: int = MAX_LOCAL, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items of every document, and the columns named in carry."""
    attach(docs.sparkSession)
    windows = stored(benchmark_windows(benchmark, window, gram), "windows")
    size = windows.agg(F.coalesce(F.sum(F.octet_length(F.coalesce("item_id", F.lit(""))) + WINDOW_BYTES), F.lit(0))).first()[0]
    if size <= max_local:
        return _local(docs, Index(windows.toArrow(), window, gram), carry)
    return _joined(docs, windows, window, gram, carry)


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


SQL = r"""
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
h AS (SELECT dw.doc_id, dw.p, dw.n, iw.item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.n = iw.n),
hw AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS k FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(k, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON d.doc_id = hw.doc_id LEFT JOIN hi ON d.doc_id = hi.doc_id
"""
