"""The pipeline against brute force: its fitted first stage is taken as it is, all others are done again by SQL and plain Python."""

import corpus_pipeline
from llm_help import duck
from loomgraph.llm import decontaminate, mix, near, pii
from loomgraph.llm.common import table

SF = "/root/testdata/sf0.001"


def redacted(text, key):
    out, at = [], 0
    for a, b, kind in pii.find(text):
        out += [text[at:a], pii.surrogate(kind, text[a:b], key)]
        at = b
    return "".join(out) + text[at:]


def test_pipeline_against_brute_force(spark):
    assert [s[0] for s in corpus_pipeline.STAGES] == ["toxicity", "near-duplicates", "decontamination", "pii", "mixing"]
    docs = table(spark, SF, "documents")
    first = corpus_pipeline.not_toxic(spark, docs, SF)
    assert first.columns == docs.columns
    _, rows = duck(near.SQL.replace("100 * c >= 85 *", f"100 * c >= {corpus_pipeline.NEAR_PERCENT} *"), documents=first)
    ids = {r[0] for r in rows if r[3]}
    second = first.where(first.doc_id.isin(list(ids)))
    _, rows = duck(decontaminate.SQL, documents=second, benchmark=table(spark, SF, "benchmark"))
    third = second.where(second.doc_id.isin([r[0] for r in rows if not r[-1]]))
    key = f"{pii.secret_of(third)}/0"
    fourth = [(r.doc_id, redacted(r.text, key), r.lang, r.source) for r in third.collect()]
    frame = spark.createDataFrame([(*r, len(r[1])) for r in fourth], docs.schema)
    names, rows = duck(mix.SQL, documents=frame)
    taken = {r[names.index("doc_id")]: r[names.index("taken")] for r in rows}
    want = sorted((*r, len(r[1]), taken[r[0]]) for r in fourth)
    got = corpus_pipeline.run(spark, SF)
    assert sorted(tuple(r) for r in got.select(*corpus_pipeline.COLUMNS, "taken").collect()) == want
    assert 0 < len(want) < docs.count()
