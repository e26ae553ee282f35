"""The near-duplicates stage of the pipeline on tables with repeated and null ids."""

import corpus_pipeline


def test_stage_with_repeated_and_null_ids(spark, make):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    near_a = a.rsplit(" ", 1)[0] + " other"
    items = [(5, a), (5, b), (5, b), (9, near_a), (7, c), (None, c), (None, d), (None, d), (3, d + " more"), (None, "x y z"), (None, "x y z")]
    items += [(11, ""), (11, ""), (None, None), (None, "")]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.distinct(spark, make(items), "").collect()]
    want = [(5, a), (5, b), (7, c), (3, d + " more"), (None, "x y z"), (11, ""), (None, None), (None, "")]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_stage_with_plain_ids(spark, make):
    items = [(4, "one two three four five six"), (2, "one two three four five six"), (1, "else"), (3, None)]
    out = corpus_pipeline.distinct(spark, make(items), "")
    assert out.columns == list(corpus_pipeline.COLUMNS)
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 3]
