"""Byte-level BPE against the vocabulary's own library."""

import hashlib
import random
import struct

import pyarrow as pa
import pytest
import tiktoken

from loomgraph.llm import bpe
from loomgraph.llm.tokens import ranks_of


@pytest.fixture(scope="module")
def ranks():
    return ranks_of(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain_merge(ranks, piece):
    """The definition: the leftmost pair of least rank, again and again."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_merges_against_the_definition(ranks):
    own, rng = bpe.Encoder(ranks), random.Random(3)
    for n in [1, 2, 3, 5, 9, 17, 40, 90] * 40:
        piece = bytes(rng.choices(rng.choice([b"aab", b"the in on er", bytes(range(256)), "éñ日本".encode()]), k=n))
        if piece in ranks:
            continue
        assert own.merged(piece) == plain_merge(ranks, piece)
        assert not any(own.words)


def test_ranks_that_do_not_follow_length():
    """Later merges may have lower ranks than those that made them; a vocabulary needs not be trained."""
    letters = {bytes([b]): b for b in range(256)}
    for extra in ([b"bc", b"abc", b"ab"], [b"abab", b"ab", b"ba"], [b"aaaa", b"aa", b"aaa"]):
        own = letters | {t: 256 + i for i, t in enumerate(extra)}
        e = bpe.Encoder(own)
        for text in (b"abcab", b"ababab", b"aaaaaaa", b"aabbaabb", b"a"):
            if text not in own:
                assert e.merged(text) == plain_merge(own, text)


def test_cuts_every_character_as_the_library(library, ranks):
    cut, own = bpe.Cutter(bpe.PATTERN, bpe.stand_ins()), bpe._Packed(bpe.Encoder(ranks))
    chars = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x34000), *range(0xE0000, 0xE0200), 0x10FFFF]]
    odd = cut.maybe_odd(pa.array(chars))
    assert all(o or ord(c) not in cut.odd for c, o in zip(chars, odd.tolist()))
    for pattern in ("1{} ", "  {}a"):
        for i in range(0, len(chars), 65_536):
            text = "".join(pattern.replace("{}", c) for c in chars[i : i + 65_536])
            got = b"".join(own[p] for some in cut(text) for p in some)
            assert list(struct.unpack(f"<{len(got) // 4}I", got)) == library.encode_ordinary(text)


ODD = [
    "", None, " ", "\n\n\n  x", "don't we'll I'D 'S", "x" * 70_000, "ab" * 30_001, "日本語" * 5_000, "á" * 300, "퟿\U0010ffff",
    "<|endoftext|> is text", "tab\tand\r\nlines \x1c\x85  end", "\U000323e7\U0001e6e7 new  \U00010ee7a", "word " * 60_000, "١٢٣ 12345678901234567890 ½",
]


def test_encode_and_decode(make, library):
    docs = make([*enumerate(ODD), (None, "no id"), (4, ODD[4]), (4, ODD[4])])
    rows = bpe.encode(docs).collect()
    assert len(rows) == len(ODD) + 3
    for r in rows:
        text = "no id" if r.doc_id is None else ODD[r.doc_id] or ""
        assert r.ids == library.encode_ordinary(text) and r.n_tokens == len(r.ids)
    for form in (False, True):
        for r in bpe.decode(bpe.encode(docs, packed=form)).collect():
            assert bytes(r.decoded).decode() == ("no id" if r.doc_id is None else ODD[r.doc_id] or "")
    assert bpe.encode(docs.limit(0)).collect() == []
    assert bpe.decode(bpe.encode(docs.limit(0))).collect() == []


def test_ids_that_no_vocabulary_has(spark):
    ids = spark.createDataFrame([(1, [0, 1]), (2, None), (3, [50_256]), (4, [1, None]), (5, [-1]), (6, [])], "x int, ids array<int>")
    got = {r.x: r.decoded for r in bpe.decode(ids).collect()}
    assert got[1] is not None and got[6] == b"" and all(got[i] is None for i in (2, 3, 4, 5))


def test_query_against_the_library(spark, library):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = bpe.op12_bpe(spark, d).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
