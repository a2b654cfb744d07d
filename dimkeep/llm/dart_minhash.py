"""DartMinHash: signatures of weighted sets from darts thrown at their elements.

Every element owns a strip of the plane, weight upwards and rank to the right, cut
into regions that double in height: weights below 1, from 1 to 2, from 2 to 4, ... In
each region darts fall as a Poisson process of the same density for every set,
drawn from hashes, so the darts of an element are the same wherever it occurs. A
set is hit by the darts below its elements' weights; each dart belongs to one of
``k`` coordinates, and a set keeps for each coordinate the dart of lowest rank. Two
sets keep the same dart with the probability of their weighted Jaccard similarity.

A set needs only its darts of low rank, about ``k ln k + 2k`` in all whatever its
size. Within a region they come in order of rank, one hash each, until the rank
that is looked for is passed.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash

_GOLDEN, _ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Darts that are thrown together; bounds the memory of a long text.
_TOGETHER = 1 << 18
_WEIGHT_SEED = np.uint64(13)
#: First guess of the rank that darts are looked for up to, times the set's weight.
_REACH = 1.25


def _mix(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit numbers, in place."""
    x += _GOLDEN
    x ^= x >> np.uint64(30)
    x *= _ONE
    x ^= x >> np.uint64(27)
    x *= _TWO
    x ^= x >> np.uint64(31)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words in lower case: runs without white space, marks included."""
    words = text.lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(words: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of neighbouring words, ascending, and how often each occurs.

    A text of fewer words has one shingle, all of them; a text without any has none.
    """
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, np.uint64(size))
    for i in range(size):
        out ^= words[i : i + n]
        _mix(out)
    return np.unique(out, return_counts=True)


def similarity(a: np.ndarray, b: np.ndarray, weight_a: np.ndarray | None = None, weight_b: np.ndarray | None = None) -> float:
    """Jaccard similarity of two ascending sets, weighted if weights are given; of two empty sets 1."""
    if not len(a) and not len(b):
        return 1.0
    _, at, bt = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if weight_a is None:
        return len(at) / (len(a) + len(b) - len(at))
    low = np.minimum(weight_a[at], weight_b[bt]).sum()
    return float(low / (weight_a.sum() + weight_b.sum() - low))


def _region(elements: np.ndarray, weights: np.ndarray, height: tuple[float, float], number: int, t: float, rank: float):
    """Rank and name of the darts of one region up to a rank, for elements that reach into it."""
    rate = t * (height[1] - height[0])
    step = int(math.ceil(rate * rank)) + 1  # darts that are thrown together; mostly all there are
    state = _mix(elements ^ np.uint64((number * 0x632BE59BD9B4E019 + 1) % 2**64))
    begun = np.zeros(len(elements))
    thrown, ranks, names = 0, [], []
    while len(state):
        nth = np.arange(thrown + 1, thrown + step + 1, dtype=np.uint64) * _TWO
        name = _mix(state[:, None] + nth[None, :])
        place = np.cumsum(np.log1p(-_unit(name)) / -rate, axis=1) + begun[:, None]
        near = place < rank
        hit = near
        if weights.min() < height[1]:
            hit = near & (height[0] + _unit(_mix(name ^ _WEIGHT_SEED)) * (height[1] - height[0]) < weights[:, None])
        ranks.append(place[hit])
        names.append(name[hit])
        more = near[:, -1]
        state, weights, begun = state[more], weights[more], place[more, -1]
        thrown += step
    return np.concatenate(ranks), np.concatenate(names)


def _darts(elements: np.ndarray, weights: np.ndarray, t: float, rank: float) -> tuple[np.ndarray, np.ndarray]:
    """Rank and name of the darts below the weights, up to a rank."""
    out = []
    top, number, low, high = float(weights.max()), 0, 0.0, 1.0
    while low < top:
        # so many elements at a time that their darts stay few
        together = max(1, int(_TOGETHER / (1 + t * (high - low) * rank)))
        inside = slice(None) if low == 0 else weights > low
        some, weight = elements[inside], weights[inside]
        for at in range(0, len(some), together):
            out.append(_region(some[at : at + together], weight[at : at + together], (low, high), number, t, rank))
        number, low, high = number + 1, high, 2 * high
    return tuple(np.concatenate(x) for x in zip(*out))


def signature(elements: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """The name of the lowest-ranked dart of each of ``k`` coordinates, for distinct hashed elements of positive weight."""
    t = k * math.log(k) + 2 * k
    weights = np.asarray(weights, np.float64)
    total = float(weights.sum())
    reach = _REACH
    while True:
        ranks, names = _darts(elements, weights, t, reach / total)
        far_first = np.argsort(-ranks, kind="stable")
        coordinate = (names[far_first] % np.uint64(k)).astype(np.int64)
        out, met = np.zeros(k, np.uint64), np.zeros(k, bool)
        out[coordinate] = names[far_first]  # the last one written is the nearest
        met[coordinate] = True
        if met.all():
            return out
        reach *= 1.5  # a coordinate got no dart yet: look further right; nearer darts stay the same


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One signed 64-bit key for each run of ``rows`` coordinates; equal runs of different bands differ."""
    bands = sig.reshape(-1, rows)
    key = _mix(np.arange(len(bands), dtype=np.uint64))
    for i in range(rows):
        key = _mix(key ^ bands[:, i])
    return key.view(np.int64)
