"""Pages that arrive in any order, against one batch of all of them."""

import random

from helpers import rows
from loomgraph.operators import extract as E
from loomgraph.operators.titles import resolved_titles
from loomgraph.streaming import resolve
from loomgraph.streaming.ingest import stream_pages

PAGES = "pos long, id long, title string, ns int, redirect_to string, timestamp string, text string"


def corpus():
    """Links to pages that come later, redirects of 1 to 6 hops, loops, titles that several pages have, an article and a redirect of one title."""
    rng = random.Random(5)
    names = [f"A{i}" for i in range(25)] + [f"R{i}" for i in range(14)] + ["Loop1", "Loop2", "Nowhere"]
    pages = [(i, i, f"A{i % 22}", 0, None, None, " ".join(f"[[{rng.choice(names)}]]" for _ in range(6)) + f" [[Category:C{i % 4}]] == See also == [[{rng.choice(names)}]]") for i in range(1, 31)]
    pages += [(100 + i, 100 + i, f"R{i}", 0, f"R{i + 1}" if i % 7 != 6 else f"A{i}", None, None) for i in range(14)]
    pages += [(200, 200, "Loop1", 0, "Loop2", None, None), (201, 201, "Loop2", 0, "Loop1", None, None), (202, 202, "A3", 0, "A4", None, None), (203, 203, "R6", 0, "A1", None, None), (204, 204, "R9", 0, None, None, "now [[A1]] an article")]
    return pages


def test_any_order_of_batches_gives_the_tables_of_one(spark, tmp_path):
    pages = corpus()
    random.Random(2).shuffle(pages)
    whole = spark.createDataFrame(pages, PAGES)
    arts, titles = E.articles(whole), resolved_titles(whole)
    taken = []
    for n in range(5):
        spark.createDataFrame(pages[n::5], PAGES).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        if n in (2, 4):  # two runs, of three and two files; each goes on from the state of the last
            stream = stream_pages(spark, f"{tmp_path}/in/*", 1)
            resolve.ingest_edges(stream, f"{tmp_path}/out", f"{tmp_path}/cp", parts=2, partitions=2).awaitTermination()
            resolve.ingest_entities(stream, f"{tmp_path}/out", f"{tmp_path}/cp2", "categories", partitions=2).awaitTermination()
            so_far = spark.createDataFrame([p for m in range(n + 1) for p in pages[m::5]], PAGES)
            got = rows(resolve.edges(spark, f"{tmp_path}/out"))
            assert got == rows(E.edges(E.articles(so_far), resolved_titles(so_far)))
            taken.append(got)
    assert taken[0] != taken[1]
    assert rows(resolve.edges(spark, f"{tmp_path}/out")) == rows(E.edges(arts, titles))
    assert rows(resolve.entities(spark, f"{tmp_path}/out", "categories")) == rows(E.entities(arts, "categories"))
