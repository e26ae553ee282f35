"""Command line: python -m loomgraph.plans.cli extract|load|analytics|merge-csvs|pipeline|stats ..."""

from __future__ import annotations

import argparse
import json
import sys
from contextlib import nullcontext

from pyspark.sql import SparkSession

from loomgraph import config
from loomgraph.plans import program
from loomgraph.sources import csv_tables


def _extract_flags(p: argparse.ArgumentParser) -> None:
    p.add_argument("-i", "--input", required=True)
    p.add_argument("-o", "--output", required=True)
    p.add_argument("--shard-count", type=int, default=config.BLOB_SHARDS)
    p.add_argument("--csv-shards", type=int, default=config.CSV_SHARDS)
    p.add_argument("--limit", type=int)
    p.add_argument("--multistream-index")
    p.add_argument("--after-id", type=int, default=0, help="only articles with a greater id")
    p.add_argument("--checkpoint-interval", type=int, help="pages after which the parsing of the dump is committed; a run that ended goes on from there")
    for flag in ("--dry-run", "--resume", "--no-cache", "--clean"):
        p.add_argument(flag, action="store_true")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="loomgraph")
    top.add_argument("--progress", type=float, metavar="SECONDS", help="tell on standard error, every so often, what share of the running stages' input is done")
    top.add_argument("-v", "--verbose", action="count", default=0)
    sub = top.add_subparsers(dest="verb", required=True)
    _extract_flags(sub.add_parser("extract"))
    p = sub.add_parser("pipeline")
    _extract_flags(p)
    for flag in ("--no-load", "--no-analytics", "--no-archive"):
        p.add_argument(flag, action="store_true")
    p = sub.add_parser("load")
    p.add_argument("-o", "--output", required=True)
    p.add_argument("--db-path", default=config.STORE_DIR)
    p.add_argument("--batch-size", type=int, default=0, help="rows in a file of the store at most (0: no limit)")
    p.add_argument("--clean", action="store_true")
    p = sub.add_parser("analytics")
    p.add_argument("-o", "--output", required=True)
    p.add_argument("--db-path", default=config.STORE_DIR)
    p.add_argument("--iterations", type=int, default=config.PAGERANK_ITERATIONS)
    p.add_argument("--damping", type=float, default=config.PAGERANK_DAMPING)
    p.add_argument("--epsilon", type=float, default=config.PAGERANK_EPSILON)
    p.add_argument("--label-rounds", type=int, default=config.LABEL_ROUNDS)
    p.add_argument("--label-mode", choices=["rounds", "in place"], default="rounds", help="communities: all vertices at once, or one colour after another")
    p = sub.add_parser("merge-csvs")
    p.add_argument("-o", "--output", required=True)
    p.add_argument("--archive", action="store_true")
    sub.add_parser("stats").add_argument("-o", "--output", required=True)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict | None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("loomgraph").getOrCreate()
    spark.sparkContext.setLogLevel(["ERROR", "INFO", "DEBUG", "TRACE"][min(a.verbose, 3)])
    told = program.reporting(spark, lambda p: print(json.dumps(p), file=sys.stderr, flush=True), a.progress) if a.progress else nullcontext()
    with told:
        out = _run(a, spark)
    print(json.dumps(out, default=str))
    return out


def _run(a: argparse.Namespace, spark: SparkSession) -> dict | None:
    if a.verb in ("extract", "pipeline"):
        o = program.Extract(a.input, a.output, a.csv_shards, a.shard_count, a.limit, a.dry_run, a.resume, not a.no_cache, a.clean, a.multistream_index, a.after_id, a.checkpoint_interval)
        out = program.extract(spark, o) if a.verb == "extract" else program.pipeline(spark, o, do_load=not a.no_load, do_analytics=not a.no_analytics, archive=not a.no_archive)
    elif a.verb == "load":
        out = program.load(spark, a.output, path=a.db_path, clean=a.clean, rows_a_file=a.batch_size)
    elif a.verb == "analytics":
        out = program.analytics(spark, a.output, path=a.db_path, iterations=a.iterations, damping=a.damping, epsilon=a.epsilon, label_rounds=a.label_rounds, label_mode=a.label_mode)
    elif a.verb == "merge-csvs":
        out = csv_tables.merge(spark, a.output, archive=a.archive)
    else:
        out = program.stats(spark, a.output)
    return out


if __name__ == "__main__":
    main()
