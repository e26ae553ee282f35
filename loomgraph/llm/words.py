"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an arrow column.

All classes of separators here are ASCII, and every byte of a longer UTF-8 sequence is 0x80 or more,
so cutting bytes gives the same words as cutting characters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """n well-mixed 64-bit numbers, the same for the same seed, a prefix of any longer stream."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


_BYTE = stream(256, 101)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)

#: Bytes in words: all but white space (0x20, 0x09 to 0x0D).
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes in words: digits, letters and all beyond ASCII (after lower-casing).
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class Words:
    """hash[i] and doc[i] of word i; starts and ends are byte places in data; first has, for each text, its first word, and one entry more."""

    hash: np.ndarray
    doc: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    data: np.ndarray


def bytes_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each text begins, one entry more; null counts as empty."""
    if col.null_count:
        col = pc.fill_null(col, "")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def words(col: pa.Array, inside: np.ndarray, lower: bool = True) -> Words:
    raw, at = bytes_of(col)
    data = (_LOWER if lower else SAME)[raw]
    is_word = inside[data]
    before = np.empty_like(is_word)
    before[:1], before[1:] = False, is_word[:-1]
    edge = at[:-1][at[:-1] < len(data)]
    before[edge] = False
    starts = np.flatnonzero(is_word & ~before)
    after = np.empty_like(is_word)
    after[-1:], after[:-1] = False, is_word[1:]
    last = at[1:][at[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(is_word & ~after) + 1
    if len(starts):
        lengths = ends - starts
        place = np.cumsum(lengths) - lengths
        letters = data[is_word]
        pos = np.arange(len(letters)) - np.repeat(place, lengths)
        factor = stream(int(lengths.max()), 977) | U64(1)
        with np.errstate(over="ignore"):
            hashed = mix(np.add.reduceat(_BYTE[letters] * factor[pos], place) + lengths.astype(U64))
    else:
        hashed = np.zeros(0, U64)
    first = np.searchsorted(starts, at)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
    return Words(hashed, doc, starts, ends, first, data)


def grams(w: Words, k: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word runs that lie within one text, at every word that begins one, and whether one begins there."""
    n = len(w.hash)
    if n < k:
        return np.zeros(n, U64), np.zeros(n, bool)
    total = np.zeros(n - k + 1, U64)
    with np.errstate(over="ignore"):
        for j, c in enumerate((stream(k, seed) | U64(1)).tolist()):
            total += w.hash[j : n - k + 1 + j] * U64(c)
        total = mix(total + U64(k))
    out, ok = np.zeros(n, U64), np.zeros(n, bool)
    out[: n - k + 1] = total
    ok[: n - k + 1] = w.doc[: n - k + 1] == w.doc[k - 1 :]
    return out, ok
