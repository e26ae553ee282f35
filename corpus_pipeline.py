"""Stages that turn raw documents into a training mix.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept: toxic documents go, one document of
each group of near-duplicates stays, documents that hold benchmark passages go, personal data gets surrogates, and
a plan for mixing sources to their target weights is added (column taken), which the reader of run()'s rows carries out. All but the last return the columns of documents.

Defined results, in every stage: empty tables give no rows; other columns of documents than those named here, whatever their names, are neither read nor
returned; very long texts are taken whole; rows with equal values in all columns are judged alike, and only the near-duplicates stage
leaves one of them; null lang, source and n_chars are carried through. What each stage does with null ids and texts is said at the stage.

This module counts as part of loomgraph.llm, whose registry imports it, and cannot be imported without that subpackage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm.common import stored, table
from loomgraph.llm.decontaminate import decontaminate
from loomgraph.llm.mix import mix
from loomgraph.llm.near import near_duplicates
from loomgraph.llm.pii import replace, secret_of
from loomgraph.llm.toxicity import toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REST = COLUMNS[1:]
#: Similarity in percent, of sets of five words, from which the pipeline takes documents as near-duplicates (op3 has its own, 85).
NEAR_PERCENT = 80


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject.

    Null and empty texts score by the model's intercept; a null doc_id has no label. Without labels, or with labels of one class, every text scores their mean (0.5 if none).
    """
    return toxicity(docs, table(spark, sf_dir, "labels"), carry=REST).where("predicted = 0").select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (at 0.8 or more) the document of least doc_id, once.

    Where ids are null or repeated, rows are told apart by a number of their own: of each group the row of least doc_id
    stays (null last). Wordless documents are in no group; of those with the same doc_id one stays, those without all.
    """
    if docs.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty():
        kept = near_duplicates(docs, percent=NEAR_PERCENT).where("kept").select("doc_id")
        return docs.join(kept, "doc_id", "left_semi").select(*COLUMNS)
    told = stored(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "rows")
    groups = near_duplicates(told.select(F.col("row").alias("doc_id"), "text"), percent=NEAR_PERCENT).withColumnRenamed("doc_id", "row")
    alone = F.when(F.col("doc_id").isNotNull(), F.struct(F.lit(1).alias("kind"), F.col("doc_id").alias("of"))).otherwise(F.struct(F.lit(2).alias("kind"), F.col("row").alias("of")))
    group = F.when(F.col("n_shingles") > 0, F.struct(F.lit(0).alias("kind"), F.col("component_id").alias("of"))).otherwise(alone)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row"))
    kept = told.select("doc_id", "row").join(groups, "row").groupBy(group.alias("group")).agg(first.alias("first")).select("first.row")
    return told.join(kept, "row", "left_semi").select(*COLUMNS)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item. Null, empty and wordless texts share none and stay; null ids stay what they are; an empty benchmark keeps all."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), carry=REST).where("not contaminated").select(*COLUMNS)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets; n_chars is that of the new text. Null and empty texts and null ids stay as they are (n_chars null, 0)."""
    return replace(docs, key=secret_of(docs), carry=("lang", "source")).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A plan of the mix: all documents, whole, with the words to take of each (0: none; more than size: repeated). No row is cut or left out here.

    Null and empty texts have size 0 and give no words; a null source is a source, the last. Ties of the hash-random key are ordered by doc_id, then size.
    """
    return mix(docs, carry=REST).select(*COLUMNS, "size", "source_size", "target", "taken")


STAGES = [("toxicity", not_toxic), ("near-duplicates", distinct), ("decontamination", uncontaminated), ("pii", without_pii), ("mixing", mixed)]

#: The first stage is a fitted classifier, which SQL cannot express; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
