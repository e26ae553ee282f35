"""SetSketch registers of many sets at once, and the joint likelihood of two sketches.

A set's elements each drive a Poisson process of points in [0, inf), every point falling on a random register; a
register keeps its least point, so it is exponential with the set's size as rate, and the registers of a union are
the minima of both. Points are cut off (truncated) beyond what any register of the set can need, and kept as
floor(offset - log_base x): exponentially spaced values. With the base near 1, two sets agree on a register with a
probability close to their Jaccard similarity.
"""

from __future__ import annotations

import numpy as np

from loomgraph.llm.words import U64, mix

BASE, OFFSET, TOP = 1.001, 4000.0, 65535


def registers(hashes: np.ndarray, owner: np.ndarray, sizes: np.ndarray, m: int) -> np.ndarray:
    """uint16 array (sets, m). hashes: distinct elements; owner: each one's set; sizes: elements in each set. Empty sets get zeros."""
    low = np.full(len(sizes) * m, np.inf)
    limit = (np.log(m) + 4) / np.maximum(sizes, 1)
    todo = np.flatnonzero(sizes > 0)
    while len(todo):
        wanted = np.zeros(len(sizes), bool)
        wanted[todo] = True
        low.reshape(-1, m)[todo] = np.inf
        live = np.flatnonzero(wanted[owner])
        seed, own, x, drawn, step = hashes[live], owner[live].astype(np.int64), np.zeros(len(live)), 0, 2
        while len(seed):
            with np.errstate(over="ignore"):
                lots = mix(seed[:, None] + np.arange(drawn + 1, drawn + step + 1, dtype=U64)[None, :] * U64(0x9E3779B97F4A7C15))
                slot = ((lots & U64(0xFFFFFF)) * U64(m)) >> U64(24)
            gaps = -np.log(((lots >> U64(24)).astype(np.float64) + 0.5) * 2.0**-40) / m
            points = x[:, None] + np.cumsum(gaps, axis=1)
            near = points < limit[own][:, None]
            np.minimum.at(low, (own[:, None] * m + slot.astype(np.int64))[near], points[near])
            on = near[:, -1]
            seed, own, x = seed[on], own[on], points[on, -1]
            drawn += step
            step = min(2 * step, 64) if drawn > 2 else 2
        # A set with an empty register had its points cut too early: once more, with a further limit.
        todo = todo[np.isinf(low.reshape(-1, m)[todo]).any(axis=1)]
        limit[todo] *= 2
    low[np.isinf(low)] = BASE**OFFSET
    return np.clip(np.floor(OFFSET - np.log(low) / np.log(BASE)), 0, TOP).astype("<u2").reshape(-1, m)


_GRID = np.linspace(0.0, 1.0, 101)


def jaccard(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The similarity of highest likelihood, given how many registers are above, below and equal, and both sizes."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - above - below
    u = (na / (na + nb))[:, None]
    v = 1 - u
    j = np.minimum(_GRID[None, :], np.minimum(u / v, v / u))

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    # The union's least point lies in a alone with probability u - v j, in b alone with v - u j.
    up, down = np.clip(p(np.maximum(u - v * j, 0)), 1e-12, 1), np.clip(p(np.maximum(v - u * j, 0)), 1e-12, 1)
    like = above[:, None] * np.log(up) + below[:, None] * np.log(down) + equal[:, None] * np.log(np.clip(1 - up - down, 1e-12, 1))
    return j[np.arange(len(j)), like.argmax(axis=1)]
