"""The stages as a program: extract, load, analytics, merge, pipeline, stats.

What is committed (the staged pages, the title index, each table, the blobs, the counters) is noted in a manifest, so a run with ``resume``
goes on after the last of them. Every run is a job group, which ``cancel`` ends.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomgraph import config
from loomgraph.operators import extract as E
from loomgraph.operators import graph
from loomgraph.operators.titles import resolved_titles
from loomgraph.plans.manifest import Manifest
from loomgraph.sources import csv_tables, dump, store
from loomgraph.sources.csv_tables import Folder
from loomgraph.streaming.ingest import STAGING, stage_in_batches


@dataclass
class Extract:
    input: str
    output: str
    shards: int = config.CSV_SHARDS
    blob_shards: int = config.BLOB_SHARDS
    limit: int | None = None
    dry_run: bool = False
    resume: bool = False
    cache: bool = True
    clean: bool = False
    index: str | None = None
    after: int = 0
    interval: int | None = None

    def validate(self) -> None:
        if not self.input:
            raise ValueError("an input is needed")
        if not self.output:
            raise ValueError("an output folder is needed")
        if self.interval is not None and self.interval < 1:
            raise ValueError("a checkpoint interval is at least 1")
        if self.shards < 1 or self.blob_shards < 1 or (self.limit is not None and self.limit < 0):
            raise ValueError("shards must be at least 1, a limit at least 0")


GROUP = "loomgraph"


def grouped(spark: SparkSession, verb: str) -> None:
    """Put the jobs of this thread into the group that cancel() ends."""
    spark.sparkContext.setJobGroup(GROUP, verb, interruptOnCancel=True)


def cancel(spark: SparkSession) -> None:
    """End the running jobs of a program; its call fails, and what it committed stays."""
    for q in spark.streams.active:
        if q.name == STAGING:
            q.stop()
    spark.sparkContext.cancelJobGroup(GROUP)


def staged(spark: SparkSession, o: Extract) -> tuple[DataFrame, dict]:
    """The dump as a Parquet table beside the output, parsed once whatever the other options are, and how many pages, streams and index lines were left out.

    With an interval, parsing is committed in batches of about so many pages: a run that ended goes on after its last one.
    """
    manifest, path = Manifest(spark, o.output, o.input, {"index": o.index}), f"{o.output}/.pages"
    kept = manifest.done("pages") if o.cache and Folder(spark, o.output).exists(".pages") else None
    if kept is None and o.interval:
        begun = Manifest(spark, o.output, o.input, {"index": o.index, "interval": o.interval})
        if not (o.cache and begun.done("batches") is not None):
            for name in (".batches", ".pages"):
                begun.folder.delete(name)
            begun.record("batches", {})
        stage_in_batches(spark, o.input, o.index or dump.index_path(o.input), path, f"{o.output}/.batches", o.interval)
        begun.clear(["batches"])
    elif kept is None:
        dump.read_dump(spark, o.input, index=o.index, problems=True).write.mode("overwrite").parquet(path)
    pages = spark.read.schema(dump.PAGES + ", problem string").parquet(path).select(*dump.COLUMNS)
    if kept is None:
        n = {r.problem: r.n for r in pages.where("problem is not null").groupBy("problem").agg(F.count(F.lit(1)).alias("n")).collect()}  # three kinds
        kept = {"skipped_pages": n.get("page", 0), "skipped_streams": n.get("stream", 0), "skipped_index_lines": n.get("index line", 0)}
        manifest.record("pages", kept)
    return pages.where("problem is null").drop("problem"), kept


def titles_of(spark: SparkSession, o: Extract, pages: DataFrame) -> DataFrame:
    """The title index, kept like the pages."""
    manifest, path = Manifest(spark, o.output, o.input, {"index": o.index}), f"{o.output}/.titles"
    if not (o.cache and manifest.done("titles", f".titles/{SUCCESS}") is not None):
        resolved_titles(pages).write.mode("overwrite").parquet(path)
        manifest.record("titles", {})
    return spark.read.schema("title string, id long").parquet(path)


SUCCESS = "_SUCCESS"


def extract(spark: SparkSession, o: Extract) -> dict:
    """Tables and blobs of a dump; the counters. A dry run counts and writes nothing but the staged pages."""
    o.validate()
    grouped(spark, "extract")
    folder = Folder(spark, o.output)
    if o.clean:
        folder.delete()
    manifest = Manifest(spark, o.output, o.input, {"index": o.index, "limit": o.limit, "after": o.after})
    key = f"extract-{o.shards}-{o.blob_shards}-{'dry' if o.dry_run else 'full'}"
    if o.resume and (kept := manifest.done(key)):
        return kept
    began = time.time()
    parts = {base: f"{key}-{base}" for base in (*config.TABLES, "blobs", "counters")}
    if not o.resume:
        manifest.clear([key, *parts.values()])
    pages, skipped = staged(spark, o)
    titles = titles_of(spark, o, pages)
    if o.dry_run:
        result = E.stats(pages, after=o.after, limit=o.limit, titles=titles).first().asDict()
    else:
        result = _written(spark, o, manifest, parts, pages, titles)
    seconds = time.time() - began
    result = result | skipped | {"seconds": seconds, "articles_per_second": result["articles"] / max(seconds, 1e-9)}
    manifest.record(key, result)
    manifest.clear(list(parts.values()))  # the whole is recorded now
    return result


def _written(spark: SparkSession, o: Extract, manifest: Manifest, parts: dict[str, str], pages: DataFrame, titles: DataFrame) -> dict:
    """Write the tables and blobs that are not there yet. The counters come out of these writes (or, on resuming, from what they reported), so no text is parsed for them alone.

    Link occurrences, which also tell the invalid ones, are written once, counted by article and target, before edges are made of them.
    """
    arts, path = E.articles(pages, after=o.after, limit=o.limit), f"{o.output}/.links"
    if manifest.done(parts["counters"], f".links/{SUCCESS}") is None:
        E.resolved_links(arts, titles).write.mode("overwrite").parquet(path)
        manifest.record(parts["counters"], {})
    links = spark.read.schema("id long, type string, dst long, n long").parquet(path)
    first = {base: csv_tables.file_names(base, o.shards if o.shards > 1 else None)[0] for base in config.TABLES}
    tables = E.tables(pages, after=o.after, limit=o.limit, titles=titles, links=links)
    csv_tables.export(tables, o.output, o.shards, done=lambda b: manifest.done(parts[b], first[b]) is not None, commit=lambda b, counts: manifest.record(parts[b], counts))
    if manifest.done(parts["blobs"], f"blobs/{SUCCESS}") is None:
        seen, records = Observation("blobs"), E.blobs(arts)
        rows = E.blob_json(records.withColumn("boxes", F.size("infoboxes")), "boxes").withColumn("shard", F.format_string("%03d", F.pmod("id", F.lit(o.blob_shards)))).hint("rebalance", "shard")  # a large shard is written by several tasks
        rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("boxes"), F.lit(0)).alias("infoboxes")).drop("boxes").write.mode("overwrite").partitionBy("shard").parquet(f"{o.output}/blobs")
        manifest.record(parts["blobs"], {k: v or 0 for k, v in seen.get.items()})
    told = {base: manifest.done(parts[base]) for base in (*config.TABLES, "blobs")}
    invalid = links.where("dst is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    counters = {"articles": told["nodes"]["rows"], "blobs": told["blobs"]["rows"], "infoboxes": told["blobs"]["infoboxes"], "edges": told["edges"][E.LINKS_TO], "see_also_edges": told["edges"][E.SEE_ALSO], "invalid_links": invalid}
    for node, rel, name, each in (("categories", "article_categories", "categories", "category_edges"), ("image_nodes", "article_images", "images", "image_edges"), ("external_link_nodes", "article_external_links", "external_links", "external_link_edges")):
        counters |= {name: told[node]["rows"], each: told[rel]["rows"]}
    Folder(spark, o.output).delete(".links")
    return counters


def progress(spark: SparkSession) -> dict:
    """Of the stages that a program runs just now: tasks, how many are done, and the share in per cent (0 where none runs). A scan's tasks are ranges of its input."""
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(GROUP) if (job := tracker.getJobInfo(j)) and job.status == "RUNNING" for s in job.stageIds]
    live = [s for s in stages if s and s.numActiveTasks]
    tasks, done = sum(s.numTasks for s in live), sum(s.numCompletedTasks for s in live)
    return {"stages": len(live), "tasks": tasks, "done": done, "percent": round(100 * done / tasks, 1) if tasks else 0.0}


@contextmanager
def reporting(spark: SparkSession, tell: Callable[[dict], None], seconds: float = 5.0) -> Iterator[None]:
    """Tell the progress every so many seconds while a program runs."""
    over = threading.Event()

    def run() -> None:
        while not over.wait(seconds):
            tell(progress(spark))

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()


def blob_files(spark: SparkSession, output: str, target: str) -> None:
    """One file for each article, blobs/<shard>/<id>.json: for consumers that want them so; written by the executors."""
    from loomgraph.sources.dump import _opened

    def write(rows) -> None:
        fs, at = _opened(target)
        for r in rows:
            fs.create_dir(f"{at}/{r.shard:>03}", recursive=True)
            with fs.open_output_stream(f"{at}/{r.shard:>03}/{r.id}.json", compression=None) as f:
                f.write(r.json.encode())

    spark.read.parquet(f"{output}/blobs").select("id", "json", F.format_string("%03d", F.col("shard").cast("int")).alias("shard")).foreachPartition(write)


def load(spark: SparkSession, output: str, *, path: str = config.STORE_DIR, clean: bool = False, rows_a_file: int = 0) -> dict:
    grouped(spark, "load")
    at = path if "/" in path else f"{output}/{path}"
    articles, links = store.load(spark, output, at, clean=clean, rows_a_file=rows_a_file)
    return {"articles": articles, "links": links}


def analytics(spark: SparkSession, output: str, *, path: str = config.STORE_DIR, iterations: int = config.PAGERANK_ITERATIONS, damping: float = config.PAGERANK_DAMPING, epsilon: float = config.PAGERANK_EPSILON, label_rounds: int = config.LABEL_ROUNDS, label_mode: str = "rounds") -> dict:
    """PageRank, communities and degrees of the CSV graph, written to the store."""
    if not 0 <= damping <= 1 or iterations < 0:
        raise ValueError("damping must lie in 0 to 1, iterations be at least 0")
    grouped(spark, "analytics")
    at = path if "/" in path else f"{output}/{path}"
    began = time.time()
    vertices = csv_tables.read(spark, output, "nodes").select("id").distinct()
    edges = csv_tables.read(spark, output, "edges").select("src", "dst")
    with graph.metrics(vertices, edges, damping=damping, iterations=iterations, epsilon=epsilon, label_rounds=label_rounds, label_mode=label_mode) as m:
        store.write_metrics(spark, at, m.table)
        a = store.article(spark, at).agg(F.count(F.lit(1)).alias("nodes"), F.count_distinct("community").alias("communities")).first()
        return {"nodes": a.nodes, "edges": m.edges.count(), "iterations": m.iterations, "communities": a.communities, "seconds": time.time() - began}


def pipeline(spark: SparkSession, o: Extract, *, do_load: bool = True, do_analytics: bool = True, archive: bool = True) -> dict:
    """Extract, load, analytics, and last, if sharded, merge: the stages before read shards, one task each; single files are an export."""
    out = {"extract": extract(spark, o)}
    if o.dry_run:
        return out
    if do_load:
        out["load"] = load(spark, o.output, clean=True)
    if do_load and do_analytics:
        out["analytics"] = analytics(spark, o.output)
    if o.shards > 1:
        grouped(spark, "merge")
        csv_tables.merge(spark, o.output, archive=archive)
    return out


def stats(spark: SparkSession, output: str) -> dict:
    """Sizes of what lies in an output folder."""
    folder = Folder(spark, output)
    if not folder.exists():
        raise FileNotFoundError(output)
    blobs = spark.read.parquet(f"{output}/blobs").count() if folder.exists("blobs") else 0
    return {
        "csv": {n: folder.size(n) for n in folder.names() if n.endswith(".csv")},
        "blobs": blobs,
        "blob_bytes": folder.size("blobs"),
        "store_bytes": folder.size(config.STORE_DIR),
        "archived": len(folder.names("shards")),
        "total_bytes": folder.size(),
    }
