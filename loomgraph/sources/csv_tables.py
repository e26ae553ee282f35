"""The eight CSV tables on disk: sharded export, layout, reading, merging and archiving.

Spark writes each shard as a folder; the driver then moves its one file to the name that consumers expect. Moves are
renames in the output folder (any Hadoop file system), so no data passes the driver. A session's limit on records of a file does not
apply here: a shard is one file, or the export fails.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomgraph.config import TABLES, UNIQUE
from loomgraph.functions.text import shard
from loomgraph.sources import csv_records

#: The values of an edge's third column (fixed values of the export format).
EDGE_TYPES = ("LINKS_TO", "SEE_ALSO")
_RFC = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}
_IDS = {"nodes": "id long, title string, label string", "edges": "src long, dst long, type string"}
_NODE, _REL = "id string, name string, label string", "src long, dst string, type string"


def schema_of(base: str) -> str:
    return _IDS.get(base) or (_NODE if base in UNIQUE else _REL)


class Folder:
    """A folder on any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.jvm = spark, path.rstrip("/"), spark._jvm
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._path(name))

    def names(self, name: str = "") -> list[str]:
        return sorted(f.getPath().getName() for f in self.fs.listStatus(self._path(name))) if self.exists(name) else []

    def move(self, old: str, new: str) -> None:
        self.fs.mkdirs(self._path(new).getParent())
        self.fs.delete(self._path(new), False)
        if not self.fs.rename(self._path(old), self._path(new)):
            raise OSError(f"cannot move {old} to {new}")

    def delete(self, name: str = "") -> None:
        self.fs.delete(self._path(name), True)

    def text(self, name: str) -> str | None:
        """A small file's text; None if there is none."""
        if not self.exists(name):
            return None
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        out = self.fs.create(self._path(name), True)
        out.write(bytearray(text.encode()))
        out.close()

    def size(self, name: str = "") -> int:
        return self.fs.getContentSummary(self._path(name)).getLength() if self.exists(name) else 0


#: Names of shards hold three digits.
MOST_SHARDS = 1000


def file_names(base: str, shards: int | None) -> list[str]:
    """shards: None for a single file."""
    if shards is not None and not 1 <= shards <= MOST_SHARDS:
        raise ValueError(f"1 to {MOST_SHARDS} shards can be named, not {shards}")
    return [f"{base}.csv"] if shards is None else [f"{base}_{i:03d}.csv" for i in range(shards)]


def layout(folder: Folder) -> int | None:
    """How many shards lie there, None for single files; shards win over single files."""
    if folder.exists("nodes_000.csv"):
        n = 0
        while folder.exists(f"nodes_{n:03d}.csv"):
            n += 1
        return n
    if folder.exists("nodes.csv"):
        return None
    raise FileNotFoundError(f"no CSV tables in {folder.path}: nodes.csv or nodes_000.csv expected")


def shown(shards: int | None) -> str:
    """A layout in words (fixed values)."""
    return "single-file" if shards is None else f"sharded ({shards} shards)"


def validate(folder: Folder, shards: int | None) -> None:
    for base in TABLES:
        for name in file_names(base, shards):
            if not folder.exists(name):
                raise FileNotFoundError(f"missing {folder.path}/{name}")


def _export(df: DataFrame, base: str, folder: Folder, shards: int) -> dict[str, int]:
    """df: key, then the three exported columns, and place, if rows are to lie in its order. Every shard gets a file with a header, also if it has no rows. Returns how many rows were written, by the third column for edges.

    They are counted where the files are written: a result task counts once, however often it, or a task before it, is run.
    """
    header, _ = TABLES[base]
    work = f".{base}-{uuid.uuid4().hex}"
    ordered = "place" in df.columns
    cols = [F.col(c).alias(h) for c, h in zip(df.columns[1:4], header, strict=True)]
    rows = df.select(shard(F.col("key"), shards).cast("int").alias("shard"), *cols, *(["place"] if ordered else []))
    names = file_names(base, shards if shards > 1 else None)
    seen, kind = Observation(work), F.col(f"`{header[2]}`")
    counts = [F.count(F.lit(1)).alias("rows")] + ([F.count_if(kind == t).alias(t) for t in EDGE_TYPES] if base == "edges" else [])
    dealt = rows.repartition(shards, "shard")
    if ordered:
        dealt = dealt.sortWithinPartitions("shard", "place").drop("place")
    dealt.observe(seen, *counts).write.partitionBy("shard").options(**_RFC, maxRecordsPerFile=0).csv(f"{folder.path}/{work}")
    parts = [[n for n in folder.names(f"{work}/shard={i}") if n.startswith("part-")] for i in range(len(names))]
    if any(len(p) > 1 for p in parts):
        raise RuntimeError(f"a shard of {base} came in several files")
    for i, name in enumerate(names):
        if parts[i]:
            folder.move(f"{work}/shard={i}/{parts[i][0]}", name)
        else:
            folder.put(name, ",".join(header) + "\n")
    folder.delete(work)
    return {k: v or 0 for k, v in seen.get.items()}


def export(tables: dict[str, DataFrame], path: str, shards: int, *, done: Callable[[str], bool] | None = None, commit: Callable[[str, dict[str, int]], None] | None = None) -> None:
    """Each table is written as a whole; done: tables to leave as they are; commit: is told of each that was written, and of its rows."""
    spark = next(iter(tables.values())).sparkSession
    folder = Folder(spark, path)
    folder.fs.mkdirs(folder._path(""))
    for base, df in tables.items():
        if not (done and done(base)):
            counts = _export(df, base, folder, shards)
            if commit:
                commit(base, counts)


def read(spark: SparkSession, path: str, base: str, shards: int | None = -1, *, placed: bool = False) -> DataFrame:
    """One table, each of its files read by many tasks; shards -1: as they lie there; placed: with the column place, which orders rows. A row of another width or a bad id is an error."""
    folder = Folder(spark, path)
    shards = layout(folder) if shards == -1 else shards
    files = [f"{folder.path}/{n}" for n in file_names(base, shards)]
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in _RFC.items() if k != "header"} | {"mode": "FAILFAST", "multiLine": "true"}
    return csv_records.table(spark, files, schema_of(base), options, placed=placed)


def merged(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of all shards: concatenated, and unique by first column, of the first shard that has it, where they must be; with key, and place, the order of the shards and their rows."""
    folder = Folder(spark, path)
    shards = layout(folder)
    if shards is None:
        raise FileNotFoundError(f"no shards in {path}")
    validate(folder, shards)
    out = {}
    for base in TABLES:
        df = read(spark, path, base, shards, placed=True)
        if base in UNIQUE:
            df = df.groupBy("id").agg(F.min_by(F.struct("name", "label", "place"), "place").alias("r")).select("id", "r.*")
        out[base] = df.select(F.lit(0).alias("key"), "*")
    return out


def merge(spark: SparkSession, path: str, *, archive: bool = False) -> None:
    """Shards to single files; archive: move the shards to shards/."""
    export_from = merged(spark, path)
    export(export_from, path, 1)
    folder = Folder(spark, path)
    if archive:
        for name in folder.names():
            if re.fullmatch(r".+_[0-9]{3}\.csv", name):
                folder.move(name, f"shards/{name}")
