"""Titles to page ids, through redirects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.config import REDIRECT_HOPS
from loomgraph.functions.text import page_type


def classified(pages: DataFrame) -> DataFrame:
    """pages with page_type."""
    return pages.withColumn("page_type", page_type(F.col("redirect_to"), F.col("ns"), F.col("title")))


def article_titles(pages: DataFrame) -> DataFrame:
    """title, id of articles; of pages with one title, the last in the dump (pos)."""
    return classified(pages).where("page_type = 'Article'").groupBy("title").agg(F.max_by("id", "pos").alias("id"))


def redirects(pages: DataFrame) -> DataFrame:
    return classified(pages).where("page_type = 'Redirect'").groupBy("title").agg(F.max_by("redirect_to", "pos").alias("target"))


def resolved_titles(pages: DataFrame, hops: int = REDIRECT_HOPS) -> DataFrame:
    """title, id of every title that leads to an article in at most ``hops`` redirects; an article's own title beats a redirect's."""
    return resolved(article_titles(pages), redirects(pages), hops)


def resolved(articles: DataFrame, moves: DataFrame, hops: int = REDIRECT_HOPS) -> DataFrame:
    """The same from articles(title, id) and redirects(title, target), one row for each title."""
    a = articles.withColumnsRenamed({"title": "at", "id": "aid"})
    m = moves.withColumnsRenamed({"title": "mt", "target": "next"})
    found = []
    open_ = moves.select("title", F.col("target").alias("here")).join(articles.select("title"), "title", "left_anti")
    for hop in range(hops):
        met = open_.join(a, F.col("here") == F.col("at"), "left")
        found.append(met.where("aid is not null").select("title", F.col("aid").alias("id")))
        if hop + 1 < hops:
            open_ = met.where("aid is null").select("title", "here").join(m, F.col("here") == F.col("mt")).select("title", F.col("next").alias("here"))
    out = articles
    for f in found:
        out = out.unionByName(f)
    return out
