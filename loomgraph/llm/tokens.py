"""Token counts that follow edits: a segment tree over a document's pre-tokens, with sums of characters and tokens.

Byte-level BPE never merges across pre-tokens, so a text's count is the sum over its pre-tokens. A pre-token depends on
the characters from its start to one beyond its end; an edit therefore re-encodes from the first pre-token that sees
the edited place until a boundary of the new text falls on an old one, and updates the sums on the paths to the blocks
that it touched. Nothing else is read again.

Trees are kept as a table (``token_trees``: the text, lengths and counts of its pre-tokens, sizes of blocks, both arrays of sums), and a batch of edits
turns one such table into the next (``edit_trees``): what a batch does not touch is neither encoded nor cut into pre-tokens again, and
trees without edits pass by as they are. Edits come as a table (doc_id, seq, start, length, replacement) or as a column of the trees.

Defined results: null and empty texts have 0 tokens, and edits apply to them as to any text; starts and lengths beyond the text are cut to
it; a null replacement is empty, a null edit is none; edits of equal seq are taken in order of their other fields; edits of a doc_id that
several rows share apply to each, those of a null or unknown one to none; a null doc_id is carried through; repeated rows are counted each; an empty table gives no rows;
very long texts are held whole, one at a time; other columns, also of clashing names, are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import attach, pieces, stored, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The public pre-token pattern of this vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens in a block (a leaf of the tree), and counts that a worker remembers.
BLOCK, REMEMBERED = 64, 400_000


class Counter:
    """Tokens of a pre-token, remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.find = regex.compile(pattern).findall
        self.next = regex.compile(pattern).match
        self.encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, int] = {}

    def counts(self, pre: list[str]) -> list[int]:
        known = self.known
        try:
            return [known[p] for p in pre]
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for p in pre:
                if p not in known:
                    known[p] = len(self.encode(p))
            return [known[p] for p in pre]


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the greatest needs (1, 2 or 4)."""
    top = int(x.max(initial=0))
    return x.astype("<u1" if top < 256 else "<u2" if top < 65536 else "<u4").tobytes()


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


class Tree:
    """Blocks of pre-tokens under a binary tree of sums. ``reencoded`` counts the pre-tokens encoded since it was built or loaded.

    A loaded tree cuts a block into its pre-tokens only when an edit reaches it.
    """

    def __init__(self, text: str, counter: Counter):
        self.counter = counter
        self.reencoded = 0
        pre = counter.find(text)
        self._build(pre, counter.counts(pre))

    @classmethod
    def loaded(cls, row: dict, counter: Counter) -> Tree:
        """From the columns of a row of token_trees."""
        self = cls.__new__(cls)
        self.counter, self.reencoded = counter, 0
        sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
        self._kept = row["text"] or "", _unpacked(row["lengths"], row["pretokens"]), _unpacked(row["counts"], row["pretokens"])
        self.blocks = [None] * len(sizes)
        self.width = 1 << (len(sizes) - 1).bit_length()
        self.chars, self.sums = np.frombuffer(row["chars"], "<u8").tolist(), np.frombuffer(row["sums"], "<u8").tolist()
        self._places = np.concatenate([[0], np.cumsum(sizes)])
        self._starts = np.concatenate([[0], np.cumsum(self.chars[self.width : self.width + len(sizes)])]).astype(np.int64)
        return self

    def saved(self) -> dict:
        """The columns that loaded() reads, and the text."""
        parts = [self._span(i) for i in range(len(self.blocks))]
        lengths, counts = (np.concatenate([p[j] for p in parts]).astype(np.int64) for j in (0, 1))
        sizes = np.array([len(p[0]) for p in parts], "<u4")
        return {"text": self.text, "pretokens": len(lengths), "lengths": _packed(lengths), "counts": _packed(counts), "sizes": sizes.tobytes(), "chars": np.array(self.chars, "<u8").tobytes(), "sums": np.array(self.sums, "<u8").tobytes()}

    def _span(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and counts of a block's pre-tokens."""
        if self.blocks[i] is not None:
            return np.array([len(p) for p in self.blocks[i][0]], np.int64), np.array(self.blocks[i][1], np.int64)
        part = slice(self._places[i], self._places[i + 1])
        return self._kept[1][part], self._kept[2][part]

    def _open(self, i: int) -> tuple[list[str], list[int]]:
        """A block's pre-tokens and their counts."""
        if self.blocks[i] is None:
            lengths, counts = self._span(i)
            ends = (self._starts[i] + np.cumsum(lengths)).tolist()
            text, at = self._kept[0], [int(self._starts[i]), *ends[:-1]]
            self.blocks[i] = [text[a:b] for a, b in zip(at, ends, strict=True)] if ends else [], counts.tolist()
        return self.blocks[i]

    @property
    def pretokens(self) -> int:
        return sum(len(self._span(i)[0]) for i in range(len(self.blocks)))

    def _build(self, pre: list[str], counts: list[int]) -> None:
        self.blocks = [(pre[i : i + BLOCK], counts[i : i + BLOCK]) for i in range(0, len(pre), BLOCK)] or [([], [])]
        self.width = 1 << (len(self.blocks) - 1).bit_length()
        self.chars, self.sums = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (p, c) in enumerate(self.blocks):
            self.chars[self.width + i], self.sums[self.width + i] = sum(map(len, p)), sum(c)
        for i in reversed(range(1, self.width)):
            self._add(i)

    def _add(self, i: int) -> None:
        self.chars[i], self.sums[i] = self.chars[2 * i] + self.chars[2 * i + 1], self.sums[2 * i] + self.sums[2 * i + 1]

    @property
    def tokens(self) -> int:
        return self.sums[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    @property
    def text(self) -> str:
        return "".join("".join(x[0]) if x is not None else self._kept[0][self._starts[i] : self._starts[i + 1]] for i, x in enumerate(self.blocks))

    def _locate(self, at: int) -> tuple[int, int]:
        """The last block that begins at or before a character (and is not empty, or is the first), and where it begins."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if at >= start + self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self.width, start

    def edit(self, start: int, length: int, replacement: str) -> None:
        """Replace ``length`` characters from ``start``."""
        start = min(max(0, start), self.length)
        length = min(max(0, length), self.length - start)
        if not length and not replacement:
            return
        # The first pre-token that sees the edited place: its end lies less than 2 before it.
        block, at = self._locate(max(0, start - 2))
        pre = self._open(block)[0]
        first = 0
        while first < len(pre) and at + len(pre[first]) + 2 <= start:
            at += len(pre[first])
            first += 1
        if first == len(pre) and block + 1 < len(self.blocks):  # it begins the next block that has any
            block, first = block + 1, 0
            while not self._open(block)[0] and block + 1 < len(self.blocks):
                block += 1
        old_end, here = start + length, at
        # Old text is taken in, pre-token by pre-token, as the scan of the new text asks for it.
        last, place, taken, ends = block, first, [], here
        ahead: list[str] = []

        def take() -> bool:
            nonlocal last, place, ends
            while place >= len(self._open(last)[0]):
                if last + 1 >= len(self.blocks):
                    return False
                last, place = last + 1, 0
            p = self._open(last)[0][place]
            place += 1
            taken.append(len(p))
            ends += len(p)
            ahead.append(p)
            return True

        while ends < old_end and take():
            pass
        old = "".join(ahead)
        buffer = old[: start - here] + replacement + old[old_end - here :]
        shift, fresh, pos = len(replacement) - length, [], 0
        boundaries = {ends}
        while True:
            # A match is final if it ends 2 characters before what is known, or all is known.
            m = self.counter.next(buffer, pos)
            more = m is None or m.end() + 2 > len(buffer)
            if more:
                ahead.clear()
                if take():
                    buffer += ahead[0]
                    boundaries.add(ends)
                    continue
            if m is None:
                break
            fresh.append(m[0])
            pos = m.end()
            reached = here + pos - shift
            if reached >= old_end and here + pos >= start + len(replacement) and reached in boundaries:
                # The rest is as before: give back what was taken beyond.
                while ends > reached:
                    while place == 0:
                        last -= 1
                        place = len(self._open(last)[0])
                    place -= 1
                    ends -= taken.pop()
                break
        counts = self.counter.counts(fresh)
        self.reencoded += len(fresh)
        head, tail = self._open(block), self._open(last)
        joined = head[0][:first] + fresh, head[1][:first] + counts
        rest = tail[0][place:], tail[1][place:]
        if last == block:
            self.blocks[block] = joined[0] + rest[0], joined[1] + rest[1]
        else:
            self.blocks[block], self.blocks[last] = joined, rest
            for i in range(block + 1, last):
                self.blocks[i] = [], []
        if len(self.blocks[block][0]) > 4 * BLOCK:
            every = [self._open(i) for i in range(len(self.blocks))]
            self._build([p for b in every for p in b[0]], [c for b in every for c in b[1]])
            return
        touched = set()
        for i in range(block, last + 1):
            p, c = self.blocks[i]
            self.chars[self.width + i], self.sums[self.width + i] = sum(map(len, p)), sum(c)
            touched.add((self.width + i) // 2)
        while touched and touched != {0}:
            for i in touched:
                self._add(i)
            touched = {i // 2 for i in touched}


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


KEPT = "text string, tokens long, pretokens long, lengths binary, counts binary, sizes binary, chars binary, sums binary"
_KINDS = {"text": pa.string(), "tokens": pa.int64(), "pretokens": pa.int64(), "lengths": pa.binary(), "counts": pa.binary(), "sizes": pa.binary(), "chars": pa.binary(), "sums": pa.binary()}
EDIT = "array<struct<start:long,length:long,replacement:string>>"


def _batch(ids: pa.Array, rows: list[dict], kinds: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids, *(pa.array([r[c] for r in rows], t) for c, t in kinds.items())], ["doc_id", *kinds])


def token_trees(docs: DataFrame, *, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and KEPT: the tree of every document, to be stored."""
    spark = attach(docs.sparkSession)
    sent = spark.sparkContext.broadcast(ranks_of(vocabulary))  # a vocabulary of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(sent.value)
        for b in pieces(batches, "text"):
            rows = []
            for text in b.column("text").to_pylist():
                tree = Tree(text or "", counter)
                rows.append(tree.saved() | {"tokens": tree.tokens, "text": text})
            yield _batch(b.column("doc_id"), rows, _KINDS)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {KEPT}")


def _apply(tree: Tree, edits: Iterable[dict | None] | None) -> None:
    for e in edits or ():
        if e is not None:
            tree.edit(e["start"] or 0, e["length"] or 0, e["replacement"] or "")


def edit_trees(trees: DataFrame, edits: DataFrame | str, *, vocabulary: str = VOCABULARY, counts_only: bool = False) -> DataFrame:
    """The trees after a batch of edits: doc_id, KEPT, and reencoded (pre-tokens encoded for it); or, counts only: doc_id, tokens, pretokens, tokens_edited, chars_edited, reencoded.

    edits: a table (doc_id, seq, start, length, replacement), or an expression over the trees of type EDIT. The edits of one document are held with its tree.
    """
    spark = attach(trees.sparkSession)
    sent = spark.sparkContext.broadcast(ranks_of(vocabulary))
    id_kind = trees.schema["doc_id"].dataType.simpleString()
    columns = [c for c in _KINDS]
    if isinstance(edits, str):
        touched, rest = trees.select("doc_id", *columns, F.expr(edits).cast(EDIT).alias("edits")), None
    else:
        one = F.struct("seq", "start", "length", "replacement")
        batch = edits.where("doc_id is not null").groupBy("doc_id").agg(F.array_sort(F.collect_list(one)).alias("e"))
        batch = batch.select("doc_id", F.transform("e", lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"), x["replacement"].alias("replacement"))).cast(EDIT).alias("edits"))
        touched, rest = trees.join(batch, "doc_id").select("doc_id", *columns, "edits"), trees.join(batch.select("doc_id"), "doc_id", "left_anti")
    counts = {"tokens": pa.int64(), "pretokens": pa.int64(), "tokens_edited": pa.int64(), "chars_edited": pa.int64(), "reencoded": pa.int64()}
    kinds = counts if counts_only else _KINDS | {"reencoded": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(sent.value)
        for b in pieces(batches, "text"):
            rows = []
            for row in b.to_pylist():
                tree = Tree.loaded(row, counter)
                _apply(tree, row["edits"])
                if counts_only:
                    rows.append({"tokens": row["tokens"], "pretokens": row["pretokens"], "tokens_edited": tree.tokens, "chars_edited": tree.length, "reencoded": tree.reencoded})
                else:
                    rows.append(tree.saved() | {"tokens": tree.tokens, "reencoded": tree.reencoded})
            yield _batch(b.column("doc_id"), rows, kinds)

    schema = f"doc_id {id_kind}, " + ("tokens long, pretokens long, tokens_edited long, chars_edited long, reencoded long" if counts_only else f"{KEPT}, reencoded long")
    out = touched.mapInArrow(run, schema)
    if rest is None:
        return out
    same = [F.col("tokens").alias("tokens_edited"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars_edited")]
    still = rest.select("doc_id", "tokens", "pretokens", *same, F.lit(0).cast("long").alias("reencoded")) if counts_only else rest.select("doc_id", *columns, F.lit(0).cast("long").alias("reencoded"))
    return out.unionByName(still)


def token_counts(docs: DataFrame, *, vocabulary: str = VOCABULARY, edits: str | None = None) -> DataFrame:
    """doc_id, tokens, pretokens, tokens_edited, chars_edited, reencoded of documents whose trees are not kept. edits: as an expression."""
    return edit_trees(token_trees(docs, vocabulary=vocabulary), edits or "null", vocabulary=vocabulary, counts_only=True)


#: The edits of the query, to the trees that it kept: a replaced word in the middle, a deletion at the start, words added towards the end.
EDITS = """array(named_struct('start', cast(length(text) div 2 as bigint), 'length', 6L, 'replacement', 'edited'),
                 named_struct('start', 0L, 'length', 3L, 'replacement', ''),
                 named_struct('start', cast(length(text) * 3 div 4 as bigint), 'length', 0L, 'replacement', ' some added words'))"""


def op5_tokens(spark, sf_dir: str) -> DataFrame:
    trees = stored(token_trees(table(spark, sf_dir, "documents")), "trees", "zstd")
    return edit_trees(trees, EDITS, counts_only=True)
