"""Functions on balanced braces, which no regular expression counts: Arrow-batched, linear in the text.

An Arrow batch holds up to 10,000 texts; Python objects are made for a piece of it at a time, and each piece's results are sent before the next is taken.
"""

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

_BRACES = re.compile(r"\{\{|\}\}")
_START = re.compile(r"\{\{infobox(?=[ _\n\r|}]|\Z)", re.IGNORECASE | re.ASCII)
_SPLIT = re.compile(r"\{\{|\}\}|\|")


def strip_templates(text: str) -> str:
    """Text outside {{...}}; what an unclosed template would hold goes to the end of the text."""
    out, depth, at = [], 0, 0
    for m in _BRACES.finditer(text):
        if m[0] == "{{":
            if not depth:
                out.append(text[at : m.start()])
            depth += 1
        elif depth:
            depth -= 1
            if not depth:
                at = m.end()
    if not depth:
        out.append(text[at:])
    return "".join(out)


def _close(text: str, start: int) -> int:
    """Place of the }} that closes the {{ at start; -1 if none does."""
    depth = 0
    for m in _BRACES.finditer(text, start):
        depth += 1 if m[0] == "{{" else -1
        if not depth:
            return m.start()
    return -1


def infoboxes(text: str) -> list[dict]:
    """Type and fields, in order and with repeats, of every {{Infobox ...}} that is not inside another."""
    out, at = [], 0
    while m := _START.search(text, at):
        end = _close(text, m.start())
        if end < 0:
            at = m.start() + 2
            continue
        at = end + 2
        inner = text[m.start() + 2 : end]
        parts, depth, last = [], 0, 0
        for s in _SPLIT.finditer(inner):
            if s[0] == "|":
                if not depth:
                    parts.append(inner[last : s.start()])
                    last = s.end()
            else:
                depth += 1 if s[0] == "{{" else -1
        parts.append(inner[last:])
        name = parts[0].strip()
        if name:
            pairs = [p.split("=", 1) for p in parts[1:] if "=" in p]
            out.append({"infobox_type": name, "fields": [{"key": k.strip(), "value": v.strip()} for k, v in pairs if k.strip()]})
    return out


_PAIR = StructType([StructField("key", StringType()), StructField("value", StringType())])
INFOBOXES = ArrayType(StructType([StructField("infobox_type", StringType()), StructField("fields", ArrayType(_PAIR))]))


PARTS = StructType([StructField("stripped", StringType()), StructField("infoboxes", INFOBOXES)])


#: Bytes of text that are Python objects at a time; a longer text is taken alone and whole.
PIECE_BYTES = 1 << 20
_ARROW_PAIR = pa.struct([("key", pa.string()), ("value", pa.string())])
_ARROW_BOXES = pa.list_(pa.struct([("infobox_type", pa.string()), ("fields", pa.list_(_ARROW_PAIR))]))


def _pieces(texts: pa.Array) -> Iterator[list[str | None]]:
    at, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > at and held + n > PIECE_BYTES:
            yield texts.slice(at, i - at).to_pylist()
            at, held = i, 0
        held += n
    if at < len(texts):
        yield texts.slice(at).to_pylist()


def _by_pieces(f: Callable[[list[str | None]], pa.Array]) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for piece in _pieces(texts):
                yield f(piece)

    return run


def _strip(texts: list[str | None]) -> pa.Array:
    return pa.array([None if t is None else strip_templates(t) for t in texts], pa.string())


def _boxes(texts: list[str | None]) -> pa.Array:
    return pa.array([None if t is None else infoboxes(t) for t in texts], _ARROW_BOXES)


def _parts(texts: list[str | None]) -> pa.Array:
    return pa.StructArray.from_arrays([_strip(texts), _boxes(texts)], ["stripped", "infoboxes"])


strip_templates_of = F.arrow_udf(_by_pieces(_strip), StringType())
infoboxes_of = F.arrow_udf(_by_pieces(_boxes), INFOBOXES)
#: Both at once: each text goes to Python once.
parts_of = F.arrow_udf(_by_pieces(_parts), PARTS)
