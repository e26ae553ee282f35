"""Kept token trees against full encodings, and license scans against exact containment."""

import random
import re

import pytest

from llm_help import plain
from loomgraph.llm import licenses, tokens
from loomgraph.llm.common import stored


@pytest.fixture(scope="module")
def counter():
    return tokens.Counter(tokens.ranks_of(tokens.VOCABULARY))


def edited(text, edits):
    for start, length, new in edits:
        start = min(max(0, start or 0), len(text))
        text = text[:start] + (new or "") + text[start + max(0, length or 0) :]
    return text


def test_batches_of_edits_on_kept_trees(spark, make, counter):
    rng = random.Random(2)
    vocabulary = ["the", " quick", " brown", "\n\n", " 12345", "!?", " naïve", " 日本", "  ", "'s", "x" * 400]
    texts = {i: "".join(rng.choices(vocabulary, k=rng.choice([0, 3, 200, 3000]))) for i in range(30)} | {40: None, 41: "", 42: "word " * 30_000}
    kept = stored(tokens.token_trees(make([*texts.items(), (None, "no id"), (7, texts[7])])), "trees")
    now, last = dict(texts), None
    for batch in range(3):
        rows = []
        for i in rng.sample(sorted(texts), 12) + [42, 41, 40]:
            for seq in range(rng.randrange(1, 4)):
                rows.append((i, seq, rng.randrange(-2, 500), rng.choice([0, 1, 7, 300, None]), rng.choice(["", "edited", " two words", None])))
        rows = sorted({(r[0], r[1]): r for r in rows}.values())
        touched = {r[0] for r in rows}
        for r in rows:
            now[r[0]] = edited(now[r[0]] or "", [r[2:]])
        batch_table = spark.createDataFrame([*rows, (None, 0, 0, 1, "z"), (999, 0, 0, 1, "z")], "doc_id long, seq long, start long, length long, replacement string")
        counts = {r.doc_id: r for r in tokens.edit_trees(kept, batch_table, counts_only=True).collect()}
        kept = stored(tokens.edit_trees(kept, batch_table).drop("reencoded"), "trees")
        got = kept.collect()
        assert len(got) == len(texts) + 2
        for r in got:
            want = "no id" if r.doc_id is None else now[r.doc_id]
            assert (r.text or "") == (want or "")
            assert r.tokens == len(counter.encode(want or ""))
            assert r.pretokens == len(counter.find(want or ""))
            c = counts[r.doc_id]
            assert (c.tokens_edited, c.chars_edited) == (r.tokens, len(want or ""))
            assert (c.reencoded > 0) <= (r.doc_id in touched)
        assert counts[42].reencoded < 200  # of 30,000 pre-tokens
        last = counts
    assert last[None].reencoded == 0


def test_query_counts_against_full_encodings(spark, counter):
    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = tokens.op5_tokens(spark, d).collect()
    assert len(got) == len(docs)
    for r in got:
        text = docs[r.doc_id]
        new = edited(text, [(len(text) // 2, 6, "edited"), (0, 3, ""), (len(text) * 3 // 4, 0, " some added words")])
        assert (r.tokens, r.pretokens, r.tokens_edited, r.chars_edited) == (len(counter.encode(text)), len(counter.find(text)), len(counter.encode(new)), len(new))


def test_equal_seq_and_expressions(make):
    trees = tokens.token_trees(make([(1, "abc def"), (2, "x")]))
    out = tokens.edit_trees(trees, "case when doc_id = 1 then array(named_struct('start', 0L, 'length', 3L, 'replacement', 'hello'), null) end").collect()
    assert sorted((r.doc_id, r.text) for r in out) == [(1, "hello def"), (2, "x")]


# --- licenses

CUT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    w = CUT.findall(text.lower())
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


@pytest.mark.parametrize("name", ["BSD-2-Clause", "BSD-3-Clause", "MIT", "MIT-0", "ISC", "0BSD", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "Apache-2.0"])
def test_likely_notices_are_told_apart(make, name):
    for _, t in [x for x in licenses.TEMPLATES if x[0] == name]:
        w = t.split()
        for k in range(4):  # whole, and with one word changed in several places
            changed = [("changed" if k and i == k * len(w) // 4 - 1 and len(w) > 60 else x) for i, x in enumerate(w)]
            (row,) = licenses.licenses(make([(1, f"intro words here {' '.join(changed)} and so on it goes")])).collect()
            assert [m.license for m in row.matches] == [name]
            (m,) = row.matches
            words = CUT.findall(f"intro words here {' '.join(changed)} and so on it goes".lower())
            inside = set(tuple(words[i : i + 5]) for i in range(m.start, m.start + m.words - 4))
            own = set(shingles(t))
            assert m.containment == pytest.approx(len(inside & own) / len(own))
            assert abs(m.start - 3) <= 1 and m.start + m.words <= 3 + len(CUT.findall(t.lower()))


def test_retrieval_of_passages_at_the_threshold(make):
    """Words changed until 0.8 to 0.9 of the shingles are left, in many places or few: how many passages are found."""
    rng = random.Random(4)
    docs, n = [], 0
    for name, t in licenses.TEMPLATES:
        own = set(shingles(t))
        if len(own) < 8:
            continue
        for _ in range(40):
            w = t.split()
            for at in rng.sample(range(len(w)), len(w)):
                tried = [*w[:at], f"zz{rng.randrange(10**6)}", *w[at + 1 :]]
                if len(own & set(shingles(" ".join(tried)))) < 0.8 * len(own):
                    break
                w = tried
            docs.append((n, " ".join(["lead"] * 9 + w + ["tail"] * 9)))
            n += 1
    found = sum(bool(r.matches) for r in licenses.licenses(make(docs)).collect())
    assert n > 500
    assert found >= 0.999 * n


def test_meeting():
    assert licenses.meeting(1.0) == 1.0
    assert licenses.meeting(3 / 5) > 0.97


def test_columns_of_clashing_names(make):
    docs = make([(1, "Released under the MIT License. " * 3), (1, "Released under the MIT License. " * 3)])
    assert plain(licenses.licenses(docs).selectExpr("size(matches)")) == [(3,), (3,)]


def test_every_pair_of_notices(make):
    """Each template after each other one, itself included: both are found, where they are, and nothing else."""
    texts = [(n, t) for n, t in licenses.TEMPLATES if len(CUT.findall(t.lower())) >= 5]
    size = [len(CUT.findall(t.lower())) for _, t in texts]
    docs = [(i * len(texts) + j, f"{a} {b}") for i, (_, a) in enumerate(texts) for j, (_, b) in enumerate(texts)]
    wrong = []
    for r in licenses.licenses(make(docs)).collect():
        i, j = divmod(r.doc_id, len(texts))
        want = [(texts[i][0], 0, size[i], 1.0), (texts[j][0], size[i], size[j], 1.0)]
        if [(m.license, m.start, m.words, m.containment) for m in r.matches] != want:
            wrong.append((texts[i], texts[j], r.matches))
    assert len(docs) > 1500 and not wrong, wrong[0]


def test_three_notices_with_words_between(make):
    names = ["MIT", "ISC", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause", "Zlib"]
    long = {n: max((t for m, t in licenses.TEMPLATES if m == n), key=len) for n in names}
    rng = random.Random(8)
    docs, want = [], {}
    for i in range(60):
        order = rng.choices(names, k=3)
        docs.append((i, " ".join(" ".join(["filler"] * rng.randrange(12)) + " " + long[n] for n in order)))
        want[i] = order
    for r in licenses.licenses(make(docs)).collect():
        assert [m.license for m in r.matches] == want[r.doc_id]


def test_tags(make):
    docs = [(1, "// SPDX-License-Identifier: MIT"), (2, "SPDX-License-Identifier: MIT-0 x"), (3, "SPDX-License-Identifier: Apache-2.0\nSPDX-License-Identifier: GPL-3.0"), (4, "SPDX-License-Identifier"), (5, "SPDX-License-Identifier: Unknown"), (6, "SPDX-License"), (7, "Identifier: MIT")]
    got = {r.doc_id: [(m.license, m.start, m.words) for m in r.matches] for r in licenses.licenses(make(docs).repartition(1)).collect()}
    assert got == {1: [("MIT", 0, 4)], 2: [("MIT-0", 0, 5)], 3: [("Apache-2.0", 0, 6), ("GPL-3.0", 6, 6)], 4: [], 5: [], 6: [], 7: []}


def test_templates_that_tie(make):
    same = "one two three four five six seven eight nine ten"
    (row,) = licenses.licenses(make([(1, f"a {same} b")]), [("B", same), ("A", same)]).collect()
    assert [(m.license, m.start, m.words, m.containment) for m in row.matches] == [("B", 1, 10, 1.0)]
