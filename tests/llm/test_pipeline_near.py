"""The near-duplicates stage of the pipeline, at a similarity of 0.8."""

import pytest

import corpus_pipeline
import test_pipeline
from llm_help import duck, plain
from loomgraph.llm import near
from loomgraph.llm.common import table

SQL_80 = near.SQL.replace("100 * c >= 85 *", "100 * c >= 80 *")


def test_stage_links_from_80_percent(spark):
    """Some documents of the given table are linked at 0.80 to 0.85 only."""
    docs = table(spark, test_pipeline.SF, "documents")
    kept = [{r[0] for r in duck(sql, documents=docs)[1] if r[3]} for sql in (near.SQL, SQL_80)]
    got = [r.doc_id for r in corpus_pipeline.distinct(spark, docs, test_pipeline.SF).select("doc_id").collect()]
    assert sorted(got) == sorted(kept[1]) and kept[1] < kept[0]


@pytest.mark.parametrize("percent", [70, 80, 85, 90])
def test_bands_miss_few_pairs_at_the_threshold(percent):
    rows, bands = near.banding(percent)
    assert rows * bands <= near.M
    assert (1 - (percent / 100) ** rows) ** bands <= near.MISS


def test_bands_of_80_and_85():
    assert near.banding(85) == (7, 32)
    assert near.banding(80) == (6, 37)


def test_pairs_at_80_are_found(make):
    """Pairs of texts with 80 of 100 shingles in common."""
    items = []
    for i in range(60):
        words = [f"w{i}x{k}" for k in range(94)]
        other = [*words[:84], *(f"v{i}x{k}" for k in range(10))]
        items += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    got = near.near_duplicates(make(items), percent=80).collect()
    assert plain(near.near_duplicates(make(items), percent=81).where("kept").select("doc_id")) == sorted([(i,) for i in range(120)], key=str)
    assert sorted(r.doc_id for r in got if r.kept) == list(range(0, 120, 2))


@pytest.mark.parametrize("percent", [80, 85])
def test_recall_of_pairs_of_unequal_sizes(make, percent):
    """Sets inside larger ones, exactly at the threshold, of 80 to 2,000 shingles: every pair is linked."""
    items = []
    for i in range(150):
        n = 100 * (1 + i % 20)
        words = [f"w{i}x{k}" for k in range(n + 4)]
        items += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[: n * percent // 100 + 4]))]
    got = {r.doc_id: r.component_id for r in near.near_duplicates(make(items), percent=percent).collect()}
    assert sum(got[2 * i + 1] == 2 * i for i in range(150)) == 150
