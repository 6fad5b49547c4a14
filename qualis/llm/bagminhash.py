"""BagMinHash signatures of weighted sets (multisets of word shingles).

Each shingle carries Poisson processes over (weight, time).  The weight axis
is cut at discrete levels 1, 2, 4, 8, ...; the stretch between two levels has
a process of its own, seeded by shingle and stretch alone, whose points come
at a rate equal to the stretch's width and lie anywhere within it.  A
document with weight w of the shingle sees the points below w: whole
stretches, and the points of the last stretch that lie below w.  Every
visible point goes to a random register; a register keeps the point that
comes first in time.  Two documents agree in a register with probability
equal to their weighted Jaccard similarity, since the first point of their
union is in both with that probability.

Points are drawn in rounds of exponential gaps, all shingles of a block at
once, and a stretch is followed only while its points come before the time
by which every register of its document is filled.
"""

from __future__ import annotations

import numpy as np

M1, M2, GOLD = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * M1
    x = (x ^ (x >> np.uint64(33))) * M2
    return x ^ (x >> np.uint64(33))


def _uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) / 2.0**53


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_docs: int, registers: int, seed: int = 7) -> np.ndarray:
    """uint64[n_docs, registers] for the rows (doc, shingle hash, integer weight), a shingle once a document.

    Documents without rows get the signature of nothing, all registers 0.
    """
    out = np.zeros((n_docs, registers), np.uint64)
    best = np.full((n_docs, registers), np.inf)
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    # registers are filled by about registers * ln(registers) points; the horizon doubles for those that are not
    horizon = np.where(total > 0, registers * (np.log(registers) + 2.0) / np.maximum(total, 1), 0.0)
    todo = total > 0
    while todo.any():
        rows = np.flatnonzero(todo[doc])
        _points(doc[rows], shingle[rows], weight[rows], horizon, registers, seed, best, out)
        todo &= np.isinf(best).any(axis=1)
        horizon[todo] *= 2
    return out


def _points(doc, shingle, weight, horizon, registers, seed, best, out) -> None:
    """Enter all points up to each document's horizon (earlier ones again, which changes nothing)."""
    levels = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)  # last stretch of each weight
    for level in range(int(levels.max(initial=0)) + 1):
        own = np.flatnonzero(levels >= level)
        if not len(own):
            break
        low, high = (0, 1) if level == 0 else (1 << (level - 1), 1 << level)
        width = float(high - low)
        state = mixed(shingle[own] ^ mixed(np.full(len(own), seed * 1_000_003 + level, np.uint64)))
        time = np.zeros(len(own))
        while len(own):
            state = mixed(state + GOLD)
            time = time - np.log(_uniform(state)) / width
            alive = time <= horizon[doc[own]]
            own, state, time = own[alive], state[alive], time[alive]
            if not len(own):
                break
            lies = low + _uniform(mixed(state ^ M1)) * width  # in (low, high]: below w if at most w
            seen = lies <= weight[own]
            at, t, mark = own[seen], time[seen], state[seen]
            register = (mixed(mark ^ M2) % np.uint64(registers)).astype(np.int64)
            _first(doc[at], register, t, mark, best, out)


def _first(doc, register, time, mark, best, out) -> None:
    """Keep in each register the point that is first in time."""
    at = doc * best.shape[1] + register
    times, marks = best.reshape(-1), out.reshape(-1)
    np.minimum.at(times, at, time)
    first = time == times[at]
    marks[at[first]] = mark[first]


def weighted_jaccard(a: dict, b: dict) -> float:
    """Sum of minima over sum of maxima; two empty bags are equal."""
    if len(a) > len(b):
        a, b = b, a
    low = sum(min(n, b.get(k, 0)) for k, n in a.items())
    high = sum(a.values()) + sum(b.values()) - low
    return low / high if high else 1.0
