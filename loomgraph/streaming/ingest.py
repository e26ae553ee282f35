"""Incremental ingest: pages that arrive as Parquet files become link rows and counters, exactly once.

The dump's own order is not an event time, so nothing here needs a watermark: the checkpoint holds which files were taken,
and each micro-batch is written under its number, so a repeated batch replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from loomgraph.operators import extract as E
from loomgraph.sources.csv_tables import Folder
from loomgraph.sources.dump import PAGES, PLAN, batches_of, odd_lines, read_ranges


def stream_pages(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", max_files).parquet(folder)


def ingest(pages: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Link targets, categories, images and external links of articles as they arrive, one folder for each batch."""

    def batch(df: DataFrame, n: int) -> None:
        arts = E.articles(df)
        E.link_targets(arts).write.mode("overwrite").parquet(f"{out}/links/batch={n}")
        for kind in ("categories", "images", "external_links"):
            E.occurrences(arts, kind).write.mode("overwrite").parquet(f"{out}/{kind}/batch={n}")

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


STAGING = "loomgraph-staging"


def stage_in_batches(spark: SparkSession, dump: str, index: str | None, out: str, plan: str, pages: int) -> None:
    """The pages of a dump under out, as a stream of batches of about so many pages, each committed for itself.

    The plan is a table whose files are batches of byte ranges; the stream's checkpoint holds which of them were taken, so a run that ended goes on
    with the batch that it was in, and that batch replaces what it had written. A plan that is there is taken as it is. One bz2 stream is one batch.
    """
    if not Folder(spark, plan).exists("ranges/_SUCCESS"):
        batches_of(spark, dump, index, pages).repartition("batch").sortWithinPartitions("batch", "start").write.mode("overwrite").partitionBy("batch").parquet(f"{plan}/ranges")
        if index:
            odd_lines(spark, index).write.mode("overwrite").parquet(f"{out}/batch=-1")
    tasks = spark.sparkContext.defaultParallelism * 2

    def batch(df: DataFrame, n: int) -> None:
        read_ranges(df.repartition(tasks), exact=index is not None).write.mode("overwrite").parquet(f"{out}/batch={n}")

    arriving = spark.readStream.schema(PLAN).option("maxFilesPerTrigger", 1).parquet(f"{plan}/ranges")
    arriving.writeStream.queryName(STAGING).foreachBatch(batch).option("checkpointLocation", f"{plan}/checkpoint").trigger(availableNow=True).start().awaitTermination()
