"""CSV files with quoted line breaks, read by many tasks each.

Whether a line break ends a record depends on the quotes before it. So quotes are counted first, for each of Spark's splits of the files: the sums before a split tell
whether it begins inside quotes. Then each task puts the lines of its splits together to records. What is cut by the end of a split, and the lines that
a split begins with inside quotes, are fragments (two for each split at most), which are joined in order; where no split begins inside quotes there are none, and the pass that
gathers them is left out. Records go through from_csv, with the options of the CSV source.

The driver holds one entry for each split that begins inside quotes. Blank lines outside quotes are no records, as for the CSV source; the first record of a file is its header.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = "file string, block long, n long, kind int, record string"
RECORD, HEAD, TAIL = 0, 1, 2


def _assembled(batches: Iterator[pa.RecordBatch], inside: set[tuple[str, int]], kinds: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """Rows of _SCHEMA of some kinds, from lines(value, file, block) in their order."""
    held: tuple[str, int] | None = None
    open_, lines, n, kind = 0, [], 0, RECORD
    rows: list[tuple] = []

    def end_of_split() -> None:
        if held is not None and lines and (k := TAIL if kind == RECORD else HEAD) in kinds:
            rows.append((*held, n, k, "\n".join(lines)))

    def taken() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["file", "block", "n", "kind", "record"])
        rows.clear()
        return out

    for b in batches:
        quotes = pc.count_substring(b.column("value"), '"').to_numpy(zero_copy_only=False).tolist()
        for value, file, block, q in zip(b.column("value").to_pylist(), b.column("file").to_pylist(), b.column("block").to_pylist(), quotes, strict=True):
            if (file, block) != held:
                end_of_split()
                held, n, lines = (file, block), 0, []
                open_ = int(held in inside)
                kind = HEAD if open_ else RECORD
            lines.append(value)
            open_ = (open_ + q) % 2
            if not open_:
                if kind in kinds:
                    rows.append((file, block, n, kind, lines[0] if len(lines) == 1 else "\n".join(lines)))
                lines, kind, n = [], RECORD, n + 1
        if rows:
            yield taken()
    end_of_split()
    if rows:
        yield taken()


def records(spark: SparkSession, files: list[str]) -> DataFrame:
    """file, block, n (which order the records of all files), record: headers and blank lines left out."""
    lines = spark.read.option("lineSep", "\n").text(files).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    counted = lines.groupBy("file", "block").agg((F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2).alias("odd"))
    before = counted.withColumn("inside", F.expr("sum(odd) over (partition by file order by block rows between unbounded preceding and 1 preceding) % 2"))
    inside = {(r.file, r.block) for r in before.where("inside = 1").select("file", "block").collect()}  # splits
    whole = lines.mapInArrow(lambda batches: _assembled(batches, inside, (RECORD,)), _SCHEMA).select("file", "block", "n", "record")
    if inside:
        cut = lines.mapInArrow(lambda batches: _assembled(batches, inside, (HEAD, TAIL)), _SCHEMA)
        begun = cut.withColumn("group", F.expr(f"count_if(kind = {TAIL}) over (partition by file order by block, kind)"))
        parts = F.array_sort(F.collect_list(F.struct("block", "kind", "n", "record"))).alias("parts")
        joined = begun.groupBy("file", "group").agg(parts).select("file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["n"].alias("n"), F.array_join("parts.record", "\n").alias("record"))
        whole = whole.unionByName(joined)
    return whole.where("not (block = 0 and n = 0) and record not in ('', '\r')")


def table(spark: SparkSession, files: list[str], schema: str, options: dict[str, str], *, placed: bool = False) -> DataFrame:
    """The columns of schema; placed: and place, which orders the rows of all files."""
    plain = F.regexp_replace("record", "\r\\z", "")
    rows = records(spark, files).select(F.struct("file", "block", "n").alias("place"), F.from_csv(plain, schema, options).alias("r"))
    return rows.select("r.*", *(["place"] if placed else []))
