"""Byte-level BPE encoding and decoding, with a rank queue over a hierarchical bitmap.

A text is cut into pre-tokens; each is merged on its own, always the pair of least rank, of equal ranks the leftmost.
Parts are a linked list over byte places. The queue has a bucket of places for each rank, and a bitmap of two levels
tells which buckets hold anything: finding the least rank is a find-first-set on each level, whatever the length of the pre-token.
A merge changes at most two pairs; their old entries stay where they are and are skipped when they come up, as the pair's
rank has changed. So a pre-token of n bytes takes O(n) queue operations, where a scan for the least pair takes O(n) for each merge.
Encodings of pre-tokens are remembered up to a bound.

Pre-tokens are those of the public pattern with the letters, numbers and white space that the vocabulary's library knows: where the
pattern engine here has a newer character table, such characters are replaced by ones of the right class for cutting only.

Defined results: null and empty texts have 0 tokens and no bytes; repeated rows are encoded each; a null doc_id is carried through; an empty
table gives no rows; a null list of ids decodes to null, as does one with an id that is null or not in the vocabulary; very long texts are held
whole, one at a time, and cut piece by piece; other columns, also of clashing names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice
from struct import pack

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from loomgraph.llm.common import attach, pieces, table
from loomgraph.llm.tokens import ranks_of
from loomgraph.llm.words import bytes_of

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Pre-tokens that a worker remembers, and their greatest length in characters; pre-tokens that are cut from a text at a time.
REMEMBERED, SHORT, CUT = 600_000, 64, 100_000


class Encoder:
    """ranks: bytes of a token to its id, which is its rank too. Not for several threads at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary has a token for every byte")
        self.ranks = ranks
        #: A word of the lower level has as many bits as the upper level has words, about.
        self.shift = (max(ranks.values()).bit_length() + 1) // 2
        self.words = [0] * ((max(ranks.values()) >> self.shift) + 1)

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        find = self.ranks.get
        if (whole := find(piece)) is not None:
            return [whole]
        n, words, shift = len(piece), self.words, self.shift
        mask, upper, buckets = (1 << shift) - 1, 0, {}
        after, before = list(range(1, n + 2)), list(range(-1, n))
        #: Rank of the pair that begins at a place, -1 where none does or the part was merged away.
        pair = [find(piece[i : i + 2], -1) for i in range(n - 1)]
        pair.append(-1)
        fresh = [i for i in range(n - 1) if pair[i] >= 0]
        while True:
            for i in fresh:  # places whose pair has a new rank
                rank = pair[i]
                if rank in buckets:
                    heappush(buckets[rank], i)
                else:
                    buckets[rank] = [i]
                    w = rank >> shift
                    words[w] |= 1 << (rank & mask)
                    upper |= 1 << w
            if not upper:
                break
            w = (upper & -upper).bit_length() - 1
            word = words[w]
            lowest = word & -word
            rank = (w << shift) + lowest.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                (i,) = buckets.pop(rank)
                words[w] = word ^ lowest
                if word == lowest:
                    upper ^= 1 << w
            if pair[i] != rank:
                fresh = ()
                continue  # stale
            gone = after[i]
            end = after[i] = after[gone]
            left = before[i]
            pair[gone] = -1
            if end < n:
                before[end] = i
                pair[i] = right = find(piece[i : after[end]], -1)
            else:
                pair[i] = right = -1
            if left >= 0 and (new := find(piece[left:end], -1)) >= 0:
                pair[left] = new
                fresh = (left, i) if right >= 0 else (left,)
            else:
                if left >= 0:
                    pair[left] = -1
                fresh = (i,) if right >= 0 else ()
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return out


def stand_ins() -> dict[int, str]:
    """Characters that the pattern engine here puts into another class than the vocabulary's library, each with one that both put into its class there."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    alone = {bytes([b]): b for b in range(256)}
    rest = set(every)
    there: dict[str, set[str]] = {}
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        found = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=alone, special_tokens={})
        there[kind] = set(found.decode_bytes(found.encode_ordinary(every)).decode())
        rest -= there[kind]
    there[r"[^\s\p{L}\p{N}]"] = rest
    odd = {}
    for (kind, chars), common in zip(there.items(), "ª² §", strict=True):
        odd |= {ord(c): common for c in chars - set(regex.findall(kind, every))}
    return odd


def _ranges(codes: list[int]) -> str:
    """Sorted characters as the ranges of a set: one of thousands of single ones would be searched one by one."""
    runs: list[list[int]] = []
    for c in codes:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in runs)


class Cutter:
    """Pre-tokens of a text."""

    def __init__(self, pattern: str, odd: dict[int, str]):
        self.pattern, self.odd = regex.compile(pattern), odd
        self.set = regex.compile(f"[{_ranges(sorted(odd))}]") if odd else None
        self.pairs = np.zeros(1 << 16, bool)
        self.pairs[[int.from_bytes(chr(c).encode()[:2]) for c in odd]] = True

    def maybe_odd(self, col: pa.Array) -> np.ndarray:
        """Which texts have two bytes in a row that begin such a character."""
        raw, at = bytes_of(col)
        hit = np.flatnonzero(self.pairs[raw[:-1].astype(np.uint16) << 8 | raw[1:]])
        return np.diff(np.searchsorted(hit, at)) > 0

    def __call__(self, text: str, maybe_odd: bool = True) -> Iterator[list[str]]:
        """Lists of at most CUT pre-tokens (short texts: one list)."""
        seen = text.translate(self.odd) if maybe_odd and self.set and self.set.search(text) else text
        if seen is text and len(text) <= CUT:
            yield self.pattern.findall(text)
            return
        found = self.pattern.finditer(seen)
        while some := [text[m.start() : m.end()] for m in islice(found, CUT)]:
            yield some


class _Packed(dict):
    """Ids of pre-tokens as little-endian bytes, remembered for short ones."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = self.encoder.merged(piece.encode())
        out = pack(f"<{len(ids)}I", *ids)
        if len(piece) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = out
        return out


_WORKER: dict[tuple, _Packed] = {}


def _remembered(key: tuple, ranks: dict[bytes, int]) -> _Packed:
    """What this worker process remembers of one vocabulary: it lasts for all tasks that it runs."""
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = _Packed(Encoder(ranks))
    return _WORKER[key]


def encode(docs: DataFrame, *, vocabulary: str = VOCABULARY, pattern: str = PATTERN, packed: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids of every document: an array<int>; packed: binary, each id as 4 bytes, least first."""
    spark = attach(docs.sparkSession)
    sent = spark.sparkContext.broadcast((ranks_of(vocabulary), stand_ins()))  # a vocabulary of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, odd = sent.value
        cut, of = Cutter(pattern, odd), _remembered((vocabulary, pattern), ranks).__getitem__
        for b in pieces(batches, "text"):
            texts = b.column("text")
            rows = [b"".join(b"".join(map(of, some)) for some in cut(text or "", odd_one)) for text, odd_one in zip(texts.to_pylist(), cut.maybe_odd(texts).tolist(), strict=True)]
            n = np.array([len(r) // 4 for r in rows], np.int64)
            ids = pa.array(rows, pa.binary()) if packed else pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(np.frombuffer(b"".join(rows), "<i4"), pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), ids], ["doc_id", "n_tokens", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids {'binary' if packed else 'array<int>'}")


def decode(encoded: DataFrame, *, vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns of ``encoded``, and ``decoded``: the bytes that its ids (array<int>, or packed) stand for."""
    spark = attach(encoded.sparkSession)
    sent = spark.sparkContext.broadcast(ranks_of(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {i: t for t, i in sent.value.items()}
        of = token.__getitem__

        def bytes_of(ids: list | bytes | None) -> bytes | None:
            if ids is None:
                return None
            whole = np.frombuffer(ids, "<u4") if isinstance(ids, bytes) else ids
            try:
                return b"".join(b"".join(map(of, part.tolist() if isinstance(part, np.ndarray) else part)) for part in (whole[i : i + CUT] for i in range(0, len(whole), CUT)))
            except KeyError:
                return None

        for b in batches:
            size = pc.binary_length(b.column("ids")) if pa.types.is_binary(b.schema.field("ids").type) else pc.list_value_length(b.column("ids"))
            for part in _slices(pc.fill_null(size, 0).to_numpy(zero_copy_only=False).tolist()):
                some = b.slice(part.start, part.stop - part.start)
                out = pa.array([bytes_of(x) for x in some.column("ids").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*some.columns, out], [*some.schema.names, "decoded"])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decoded", BinaryType())]))


def _slices(sizes: list[int], most: int = 4 << 20) -> Iterator[slice]:
    """Runs of rows whose sizes add up to ``most``, or of one row."""
    first, held = 0, 0
    for i, n in enumerate(sizes):
        if i > first and held + n > most:
            yield slice(first, i)
            first, held = i, 0
        held += n
    if first < len(sizes):
        yield slice(first, len(sizes))


def op12_bpe(spark, sf_dir: str) -> DataFrame:
    out = decode(encode(table(spark, sf_dir, "documents"), packed=True))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
