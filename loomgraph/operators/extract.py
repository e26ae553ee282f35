"""The eight tables, the blobs and the counters of an extraction.

pages: pos, id, title, ns, redirect_to, timestamp, text. Each table is a scan of its own over the columns that it needs; all counters come
from one scan, which reads and parses each text once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.functions.templates import INFOBOXES, infoboxes_of, parts_of, strip_templates_of
from loomgraph.operators.graph import Rounds
from loomgraph.operators.titles import classified, resolved_titles

LINKS_TO, SEE_ALSO = "LINKS_TO", "SEE_ALSO"


def articles(pages: DataFrame, after: int = 0, limit: int | None = None) -> DataFrame:
    """Articles with id above ``after``, among the first ``limit`` pages of any type that are."""
    rest = pages.where(F.col("id") > after)
    if limit is not None:
        rest = rest.orderBy("pos").limit(limit)
    return classified(rest).where("page_type = 'Article'")


def link_targets(arts: DataFrame) -> DataFrame:
    """id, target, type of every link occurrence outside other namespaces, anchors cut."""
    text = F.col("text")
    found = arts.where(text.contains("[[")).select("id", T.links(text).alias("links"), T.links_before_see_also(text).alias("before"))
    one = found.select("id", "before", F.posexplode("links").alias("n", "raw"))
    one = one.select("id", T.without_anchor(F.col("raw")).alias("target"), F.when(F.col("n") >= F.col("before"), SEE_ALSO).otherwise(LINKS_TO).alias("type"))
    return one.where((F.col("target") != "") & ~T.is_namespace_link(F.col("target")))


def resolved_links(arts: DataFrame, titles: DataFrame) -> DataFrame:
    """id, type, dst (null: no such title), n: link occurrences, counted by target before they meet the titles."""
    return met(link_targets(arts).groupBy("id", "target", "type").agg(F.count(F.lit(1)).alias("n")), titles)


def met(counted: DataFrame, titles: DataFrame) -> DataFrame:
    """Links counted by id, target and type, with the articles that titles lead to."""
    return counted.join(titles.select(F.col("title").alias("target"), F.col("id").alias("dst")), "target", "left").select("id", "type", "dst", "n")


def edges(arts: DataFrame, titles: DataFrame) -> DataFrame:
    """src, dst, type: distinct links to articles."""
    return edges_of(resolved_links(arts, titles))


def edges_of(links: DataFrame) -> DataFrame:
    """src, dst, type of resolved links."""
    return links.where("dst is not null").select(F.col("id").alias("src"), "dst", "type").distinct()


def invalid_links(arts: DataFrame, titles: DataFrame) -> DataFrame:
    return resolved_links(arts, titles).where("dst is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("invalid_links"))


_ENTITIES = {"categories": (T.categories, "[[Category:"), "images": (T.images, "[["), "external_links": (T.external_links, "[http")}


def occurrences(arts: DataFrame, kind: str) -> DataFrame:
    """id, name of every category, image or external link, one row for each occurrence."""
    f, hint = _ENTITIES[kind]
    return arts.where(F.col("text").contains(hint)).select("id", F.explode(f(F.col("text"))).alias("name"))


def entities(arts: DataFrame, kind: str) -> DataFrame:
    """name, first_id: distinct, with the least article that names it (which sets its shard)."""
    return occurrences(arts, kind).groupBy("name").agg(F.min("id").alias("first_id"))


def abstracts(arts: DataFrame) -> DataFrame:
    """id, abstract_text of each article with text."""
    return arts.where("text is not null").select("id", T.lead(strip_templates_of(F.col("text"))).alias("abstract_text"))


def blobs(arts: DataFrame) -> DataFrame:
    """One record for each article with text."""
    text, parts = F.col("text"), F.col("parts")
    base = arts.where(text.isNotNull()).withColumn("parts", parts_of(text))
    return base.select("id", "title", T.lead(parts["stripped"]).alias("abstract_text"), T.categories(text).alias("categories"), parts["infoboxes"].alias("infoboxes"), T.sections(text).alias("sections"), "timestamp", T.is_disambiguation(text).alias("is_disambiguation"))


def blob_json(records: DataFrame, *carry: str) -> DataFrame:
    """id, json and the columns named in carry: empty lists, a missing timestamp and a false flag are left out; fields are pairs."""
    box = F.transform("infoboxes", lambda b: F.struct(b["infobox_type"].alias("infobox_type"), F.transform(b["fields"], lambda f: F.array(f["key"], f["value"])).alias("fields")))
    filled = lambda c: F.when(F.size(c) > 0, c)
    return records.select("id", F.to_json(F.struct("id", "title", "abstract_text", filled(F.col("categories")).alias("categories"), F.when(F.size("infoboxes") > 0, box).alias("infoboxes"), filled(F.col("sections")).alias("sections"), "timestamp", F.when(F.col("is_disambiguation"), F.lit(True)).alias("is_disambiguation"))).alias("json"), *carry)


BLOB = "id bigint, title string, abstract_text string, categories array<string>, infoboxes array<struct<infobox_type:string,fields:array<array<string>>>>, sections array<string>, timestamp string, is_disambiguation boolean"


def read_blobs(rows: DataFrame) -> DataFrame:
    """The records of a json column; what is left out is empty, null or false."""
    r = rows.select(F.from_json("json", BLOB).alias("r")).select("r.*")
    empty = lambda c: F.coalesce(F.col(c), F.array().cast(r.schema[c].dataType)).alias(c)
    return r.select("id", "title", "abstract_text", empty("categories"), empty("infoboxes"), empty("sections"), "timestamp", F.coalesce("is_disambiguation", F.lit(False)).alias("is_disambiguation"))


def tables(pages: DataFrame, after: int = 0, limit: int | None = None, titles: DataFrame | None = None, links: DataFrame | None = None) -> dict[str, DataFrame]:
    """The eight tables under the names of their columns here: shard key first, then what is exported. links: resolved_links of the same articles, where they are there already."""
    arts = articles(pages, after, limit)
    titles = titles if titles is not None else resolved_titles(pages)
    out = {
        "nodes": arts.select(F.col("id").alias("key"), "id", "title", F.lit("Page").alias("label")),
        "edges": edges_of(links if links is not None else resolved_links(arts, titles)).select(F.col("src").alias("key"), "src", "dst", "type"),
    }
    for kind, node, rel, label, edge in (("categories", "categories", "article_categories", "Category", "HAS_CATEGORY"), ("images", "image_nodes", "article_images", "Image", "HAS_IMAGE"), ("external_links", "external_link_nodes", "article_external_links", "ExternalLink", "HAS_LINK")):
        out[node] = entities(arts, kind).select(F.col("first_id").alias("key"), F.col("name").alias("id"), "name", F.lit(label).alias("label"))
        out[rel] = occurrences(arts, kind).select(F.col("id").alias("key"), F.col("id").alias("src"), F.col("name").alias("dst"), F.lit(edge).alias("type"))
    return out


MARKS = "array<struct<kind:string,id:bigint,name:string>>"


def marks(arts: DataFrame) -> DataFrame:
    """kind, id, name, n: all that articles hold, counted. Links by article and target; articles, texts and infoboxes without names; entities by name."""
    text, none = F.col("text"), F.lit(None).cast("long")
    one = lambda kind, name, id_=none: F.struct(F.lit(kind).alias("kind") if isinstance(kind, str) else kind.alias("kind"), id_.alias("id"), name.alias("name"))
    empty = F.array().cast(MARKS)
    link = lambda x, i: one(F.when(i >= F.col("before"), SEE_ALSO).otherwise(LINKS_TO), T.without_anchor(x), F.col("id"))
    held = [F.array(one("articles", F.lit(""))), F.when(text.isNotNull(), F.array(one("blobs", F.lit("")))), F.array_repeat(one("infoboxes", F.lit("")), F.size(F.coalesce(F.col("boxes"), F.array().cast(INFOBOXES.simpleString())))), F.transform(T.links(text), link)]
    entity = lambda kind: lambda x: one(kind, x)
    held += [F.transform(f(text), entity(kind)) for kind, (f, _) in _ENTITIES.items()]
    rows = arts.select("id", "text", T.links_before_see_also(text).alias("before"), infoboxes_of(text).alias("boxes"))
    rows = rows.select(F.explode(F.concat(*(F.coalesce(h.cast(MARKS), empty) for h in held))).alias("m")).select("m.*")
    kept = rows.where(F.col("id").isNull() | ((F.col("name") != "") & ~T.is_namespace_link(F.col("name"))))
    return kept.groupBy("kind", "id", "name").agg(F.count(F.lit(1)).alias("n"))


def stats(pages: DataFrame, after: int = 0, limit: int | None = None, titles: DataFrame | None = None) -> DataFrame:
    """One row of counters, from one pass over the texts, whose counts (marks) are written before links meet the titles."""
    titles = titles if titles is not None else resolved_titles(pages)
    held = Rounds(pages.sparkSession).put(marks(articles(pages, after, limit)), "marks")
    met = held.where(F.col("kind").isin(LINKS_TO, SEE_ALSO)).join(titles.select(F.col("title").alias("name"), F.col("id").alias("dst")), "name", "left")
    links = met.groupBy("kind", "id", "dst").agg(F.sum("n").alias("n")).groupBy("kind").agg(F.count_if(F.col("dst").isNotNull()).alias("names"), F.coalesce(F.sum(F.when(F.col("dst").isNull(), F.col("n"))), F.lit(0)).alias("n"))
    others = held.where("id is null").groupBy("kind").agg(F.count(F.lit(1)).alias("names"), F.sum("n").alias("n"))
    every = links.unionByName(others)
    total = lambda kind, of, name: F.coalesce(F.sum(F.when(F.col("kind").isin(*kind), F.col(of))), F.lit(0)).alias(name)
    entity = [c for k, each in (("categories", "category_edges"), ("images", "image_edges"), ("external_links", "external_link_edges")) for c in (total([k], "names", k), total([k], "n", each))]
    return every.agg(*(total([k], "n", k) for k in ("articles", "blobs", "infoboxes")), total([LINKS_TO], "names", "edges"), total([SEE_ALSO], "names", "see_also_edges"), total([LINKS_TO, SEE_ALSO], "n", "invalid_links"), *entity)
