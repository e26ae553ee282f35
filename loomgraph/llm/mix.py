"""Mixing sources to target weights, on DataFrame functions alone.

A document's size is its words. Targets share the total by weight, none above ``most`` times its source's size
(water-filling over sources ordered by cap per weight). Documents get a hash-random key; its leading hex digits cut
each source into ``16 ** DIGITS`` ranges. Sizes are summed by range before any document row moves, ranges get their
prefix sums, and documents are sorted within a range only, so no source lands in one task. Each source is
cut at exactly its whole-word budget; a budget beyond the source's size repeats it in epochs.

Defined results: null, empty and wordless texts have size 0 and give 0 words; a null source is a source, the last; a null
doc_id has the key of an empty id; rows of equal key are ordered by doc_id, then size, so repeated rows are interchangeable; a
source of size 0 has target 0; an empty table gives no rows; very long texts are counted whole; clashing columns are not read unless carried (any but the outputs' own
names may be). Carried columns go through the windows only where ids repeat or are null, for then nothing else tells rows apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import attach, stored, table

WEIGHTS = (5, 2, 1)
DIGITS, SEED = 3, "mix-1"


def _targets(totals: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """totals(sk, source_size) with target: a table of one row for each source."""
    spark = totals.sparkSession
    choose = " ".join(f"when {i} then {w}" for i, w in enumerate(weights))
    return spark.sql(
        f"""
        with ranked as (select *, row_number() over (order by sk) - 1 as place from {{t}}),
        weighed as (select *, case place % {len(weights)} {choose} end as weight, {most} * source_size as cap from ranked),
        summed as (select *, sum(source_size) over () as all_size, sum(weight) over () as all_weight, cap / cast(weight as double) as ratio from weighed),
        before as (select *, coalesce(sum(cap) over (order by ratio, sk rows between unbounded preceding and 1 preceding), 0) as caps,
                   coalesce(sum(weight) over (order by ratio, sk rows between unbounded preceding and 1 preceding), 0) as weights from summed),
        leveled as (select *, cast(all_size - caps as double) / cast(all_weight - weights as double) as level from before)
        select sk, source_size, case when level > ratio then cast(cap as double)
               else weight * min(case when level > ratio then null else struct(ratio, sk, level) end) over ().level end as target
        from leveled
        """,
        t=totals,
    )


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, most: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document, and the columns named in carry."""
    attach(docs.sparkSession)
    if carry and docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("doc_id is null or n > 1").isEmpty():
        # Ids tell rows apart: windows run over narrow rows, which then meet the texts in one join that sorts nothing.
        narrow = mix(docs, weights=weights, most=most)
        wide = docs.select("doc_id", *(F.col(c).alias(f"carried_{c}") for c in carry))
        return wide.join(narrow.hint("shuffle_hash"), "doc_id").select(*narrow.columns, *(F.col(f"carried_{c}").alias(c) for c in carry))
    sized = docs.select(
        F.col("doc_id"),
        F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce("source", F.lit(""))).alias("sk"),
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{SEED}"))).alias("key"),
        *(F.col(c).alias(f"carried_{c}") for c in carry),
    ).withColumn("range", F.substring("key", 1, DIGITS))
    narrow = sized.select("sk", "range", "size") if carry else (sized := stored(sized, "sizes"))
    cells = narrow.groupBy("sk", "range").agg(F.sum("size").alias("cell"))
    cells = cells if carry else stored(cells, "ranges")
    targets = _targets(cells.groupBy("sk").agg(F.sum("cell").alias("source_size")), weights, most)
    cells = cells.withColumn("before", F.expr("sum(cell) over (partition by sk order by range rows unbounded preceding) - cell")).join(targets, "sk")
    placed = sized.join(cells, ["sk", "range"]).withColumn("start", F.expr("before + sum(size) over (partition by sk, range order by key, doc_id, size rows unbounded preceding) - size"))
    budget = F.expr("cast(floor(target) as bigint)")
    epochs, rest = F.expr("coalesce(budget div nullif(source_size, 0), 0)"), F.expr("coalesce(budget % nullif(source_size, 0), 0)")
    placed = placed.withColumn("budget", budget).withColumn("taken", epochs * F.col("size") + F.greatest(F.lit(0), F.least(rest - F.col("start"), F.col("size"))))
    return placed.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), *(F.col(f"carried_{c}").alias(c) for c in carry))


def op2_mix(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def mix_sql(documents: str = "documents") -> str:
    return rf"""
WITH z AS (SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS sk, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{SEED}') AS k,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM {documents}),
s AS (SELECT sk, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY sk) - 1 AS place FROM z GROUP BY sk),
w AS (SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap FROM s),
a AS (SELECT *, sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight, CAST(cap AS DOUBLE) / CAST(weight AS DOUBLE) AS ratio FROM w),
b AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY ratio, sk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps,
      coalesce(sum(weight) OVER (ORDER BY ratio, sk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weights FROM a),
l AS (SELECT *, CAST(all_size - caps AS DOUBLE) / CAST(all_weight - weights AS DOUBLE) AS level FROM b),
t AS (SELECT sk, source_size, CASE WHEN level > ratio THEN CAST(cap AS DOUBLE)
      ELSE weight * (SELECT level FROM l WHERE NOT level > ratio ORDER BY ratio, sk LIMIT 1) END AS target FROM l),
p AS (SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
      CAST(sum(size) OVER (PARTITION BY sk ORDER BY k, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start FROM z JOIN t USING (sk))
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0
       ELSE budget // source_size * size + greatest(0, least(budget % source_size - start, size)) END AS BIGINT) AS taken FROM p
"""


SQL = mix_sql()
