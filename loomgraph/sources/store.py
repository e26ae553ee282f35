"""The graph store: Parquet tables article(id, title, pagerank, community, degree) and links_to(src, dst), and what lookups read:
near_out and near_in(id, part, near), the neighbours of a vertex as an array of ids and titles, for either direction. These lie in ranges of id, in small row groups, so a
lookup reads one or two of them; a hub's neighbours are cut into parts of about ``HUB``. Articles lie in ranges of title, with Bloom filters on title and id.

A load replaces or refuses to touch an existing store. A table lies in numbered versions; the current one is the highest whose
marker was written, after all its files. So a reader never sees half of a table, a crash leaves the version before it in
place, and the one before the current stays until the next write, for readers that hold it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.operators import graph
from loomgraph.sources import csv_tables
from loomgraph.sources.csv_tables import Folder

ARTICLE = "id long, title string, pagerank double, community long, degree long"
LINKS = "src long, dst long"
NEAR = "id long, part long, near array<struct<id:bigint,title:string>>"
#: Neighbours in one row of near_out and near_in, about, and bytes of a row group of theirs and of articles.
HUB, GROUP_BYTES = 10_000, 4 << 20


DONE = "_DONE"


def _versions(folder: Folder, table: str) -> list[str]:
    """Complete versions of a table, oldest first."""
    return [n for n in folder.names() if re.fullmatch(rf"{table}-[0-9]{{6}}", n) and folder.exists(f"{n}/{DONE}")]


def _current(spark: SparkSession, path: str, table: str) -> str:
    versions = _versions(Folder(spark, path), table)
    if not versions:
        raise FileNotFoundError(f"no table {table} in {path}")
    return f"{path}/{versions[-1]}"


_SMALL = {"parquet.block.size": GROUP_BYTES, "parquet.page.size": GROUP_BYTES // 8, "parquet.block.size.row.check.min": 100}
_LAYOUT = {"article": _SMALL | {f"parquet.bloom.filter.enabled#{c}": "true" for c in ("title", "id")}, "near_out": _SMALL, "near_in": _SMALL}


def _near(links: DataFrame, articles: DataFrame, end: str, other: str) -> DataFrame:
    """NEAR rows of one direction: each link to an article counts, by id of the neighbour."""
    known = articles.select(F.col("id").alias("nid"), "title")
    met = links.join(known, F.col(other) == F.col("nid")).select(F.col(end).alias("id"), F.struct(F.col("nid").alias("id"), "title").alias("one"))
    hubs = met.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HUB).select(F.col("id").alias("hub"), F.ceil(F.col("n") / HUB).cast("long").alias("parts"))
    part = F.coalesce(F.expr("pmod(xxhash64(one.id), parts)"), F.lit(0).cast("long"))
    rows = met.join(hubs, F.col("id") == F.col("hub"), "left").groupBy("id", part.alias("part")).agg(F.array_sort(F.collect_list("one")).alias("near"))
    return rows.repartitionByRange("id", "part").sortWithinPartitions("id", "part")


def _write(df: DataFrame, path: str, table: str, rows_a_file: int) -> None:
    """df as the next version; then versions but the last two, and what crashes left, go."""
    folder = Folder(df.sparkSession, path)
    there = [n for n in folder.names() if re.fullmatch(rf"{table}-[0-9]{{6}}", n)]
    name = f"{table}-{int(there[-1][-6:]) + 1 if there else 0:06d}"
    out = df.write.mode("overwrite").option("maxRecordsPerFile", rows_a_file)
    for k, v in _LAYOUT.get(table, {}).items():
        out = out.option(k, v)
    out.parquet(f"{path}/{name}")
    folder.put(f"{name}/{DONE}", "")
    keep = _versions(folder, table)[-2:]
    for old in there:
        if old not in keep:
            folder.delete(old)


def create(articles: DataFrame, links: DataFrame, path: str, *, clean: bool = False, rows_a_file: int = 0) -> None:
    """articles(id, title), links(src, dst). Articles lie in ranges of title, so a lookup by title reads few row groups. rows_a_file: 0 for no limit."""
    folder = Folder(articles.sparkSession, path)
    if not clean and (_versions(folder, "article") or _versions(folder, "links_to")):
        raise FileExistsError(f"a store already exists in {path}")
    blank = [F.lit(None).cast(t).alias(c) for c, t in (("pagerank", "double"), ("community", "long"), ("degree", "long"))]
    _write(links.select("src", "dst"), path, "links_to", rows_a_file)
    _write(_near(links, articles, "src", "dst"), path, "near_out", rows_a_file)
    _write(_near(links, articles, "dst", "src"), path, "near_in", rows_a_file)
    _write(articles.select("id", "title", *blank).repartitionByRange("title").sortWithinPartitions("title"), path, "article", rows_a_file)


def load(spark: SparkSession, output: str, path: str, *, clean: bool = False, rows_a_file: int = 0) -> tuple[int, int]:
    """Load the CSV tables in output, sharded or single; counts of articles and links stored."""
    create(csv_tables.read(spark, output, "nodes"), csv_tables.read(spark, output, "edges"), path, clean=clean, rows_a_file=rows_a_file)
    return article(spark, path).count(), links_to(spark, path).count()


def article(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ARTICLE).parquet(_current(spark, path, "article"))


def links_to(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LINKS).parquet(_current(spark, path, "links_to"))


def write_metrics(spark: SparkSession, path: str, metrics: DataFrame) -> None:
    """metrics(id, pagerank, community, degree); articles without a row there keep nulls."""
    new = article(spark, path).select("id", "title").join(metrics, "id", "left")
    new = new.select("id", "title", "pagerank", "community", F.col("degree").cast("long").alias("degree"))
    _write(new.repartitionByRange("title").sortWithinPartitions("title"), path, "article", 0)


def register(spark: SparkSession, path: str) -> None:
    """article and links_to as views for SQL."""
    article(spark, path).createOrReplaceTempView("article")
    links_to(spark, path).createOrReplaceTempView("links_to")


def top_by_rank(articles: DataFrame, n: int = 10) -> DataFrame:
    return articles.orderBy(F.col("pagerank").desc_nulls_last(), "id").limit(n)


def by_title(articles: DataFrame, title: str) -> DataFrame:
    return articles.where(F.col("title") == title)


def neighbours(spark: SparkSession, path: str, page_id: int, direction: str = "out") -> DataFrame:
    """id, title of the articles one link away ("out": that the page links to, "in": that link to it), one row for each link."""
    if direction not in ("out", "in"):
        raise ValueError("a direction is out or in")
    near = spark.read.schema(NEAR).parquet(_current(spark, path, f"near_{direction}"))
    return near.where(F.col("id") == page_id).select(F.explode("near").alias("n")).select("n.id", "n.title")
