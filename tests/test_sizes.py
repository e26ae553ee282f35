"""Queries on tables whose ids or sizes leave what the small ones reach."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from helpers import SMALL, rows
from loomgraph.functions import text as T
from loomgraph.operators import graph
from loomgraph.plans import catalog, program
from loomgraph.sources import dump


def shifted(spark, path, by):
    """The documents of SMALL with larger ids."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs.withColumn("doc_id", F.col("doc_id") + by).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_sizes_above_a_gigabyte_are_shown_as_the_sql_does(spark, tmp_path):
    d = shifted(spark, tmp_path, 20_000)
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{d}/documents.parquet/*.parquet'")
    want = c.sql(catalog.SQL["format_sizes"]).fetchall()
    assert any(len(x) > 6 for _, x in want)
    assert sorted((r.id, r.shown) for r in catalog.format_sizes(spark, d).collect()) == sorted(want)


def test_format_size_up_to_a_unit(spark):
    n = 5 * 1024**3
    shown = spark.range(1).select(*(T.format_size(F.lit(n), unit).alias(unit) for unit in "KMG")).first()
    assert tuple(shown) == ("5242880.0K", "5120.0M", "5.0G")


@pytest.mark.parametrize(("name", "state"), [("streamed_edges", "claims"), ("streamed_links", "taken/links")])
def test_pages_arrive_in_as_many_files_as_their_tables_have_splits(spark, tmp_path, monkeypatch, name, state):
    spark.read.parquet(f"{SMALL}/documents.parquet").repartition(8).write.parquet(f"{tmp_path}/in/documents.parquet")
    monkeypatch.setattr(graph, "_folder", lambda _: f"{tmp_path}/out")
    got = catalog.QUERIES[name](spark, f"{tmp_path}/in")
    plain = {"streamed_edges": "links_typed_edges", "streamed_links": "links_all"}[name]
    assert rows(got) == rows(catalog.QUERIES[plain](spark, SMALL))
    assert sorted(p.name for p in (tmp_path / "out" / state).glob("batch=*")) == ["batch=0", "batch=1", "batch=2"]
    assert len(list((tmp_path / "out/arriving").glob("*/*.parquet"))) >= 3 * 4


def test_a_dump_of_more_pages_is_written_by_more_tasks(spark, tmp_path):
    pages = catalog.pages(spark, SMALL)
    files = dump.write_multistream(pages, f"{tmp_path}/dump", files=2, per_file=20)
    assert len(files) >= 8
    assert max(n for _, _, n in files) < 60
    got = dump.read_multistream(spark, [f[0] for f in files], [f[1] for f in files])
    assert [r.id for r in got.orderBy("pos").select("id").collect()] == [r.id for r in pages.orderBy("pos").select("id").collect()]


def test_a_large_shard_of_blobs_is_written_by_several_tasks(spark, tmp_path):
    dump.write_multistream(catalog.pages(spark, SMALL), f"{tmp_path}/dump", files=4)
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "32k")
    try:
        done = program.extract(spark, program.Extract(f"{tmp_path}/dump", f"{tmp_path}/out", shards=1, blob_shards=1))
    finally:
        spark.conf.unset(name)
    assert len(list((tmp_path / "out/blobs/shard=000").glob("*.parquet"))) > 1
    assert spark.read.parquet(f"{tmp_path}/out/blobs").select("id").distinct().count() == done["blobs"] > 0


def test_labels_that_swing_end_as_after_all_rounds(spark):
    """A star, a pair and a triangle: the star and the pair swap labels in each round."""
    edges = [(1, 2), (1, 3), (1, 4), (10, 11), (20, 21), (21, 22), (22, 20)]
    ids = sorted({i for e in edges for i in e})
    v, e = spark.createDataFrame([(i,) for i in ids], "id long"), spark.createDataFrame(edges, "src long, dst long")
    for rounds in (1, 2, 3, 20, 21):
        label = {i: i for i in ids}
        for _ in range(rounds):
            votes = {i: Counter(label[a if b == i else b] for a, b in edges if i in (a, b)) for i in ids}
            label = {i: max(votes[i], key=lambda c: (votes[i][c], c == label[i], -c)) for i in ids}
        jobs = []
        put = graph.Rounds.put
        with pytest.MonkeyPatch.context() as m:
            m.setattr(graph.Rounds, "put", lambda self, df, name="": jobs.append(name) or put(self, df, name))
            assert {r.id: r.community for r in graph.communities(v, e, max_rounds=rounds).collect()} == label
        assert len(jobs) < 12  # tables that were written
