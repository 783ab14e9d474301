"""Similarities of many pairs of texts at once, in numpy: the texts of two lists, the pairs by their places in them."""

from __future__ import annotations

import numpy as np

from cadastra.functions.similarity import _jaro_winkler

#: Letters of the second text that Jaro-Winkler can hold as bits; longer ones are compared one by one.
BITS = 64
_BELOW = np.array([(1 << k) - 1 for k in range(BITS + 1)], dtype=np.uint64)


def _letters(*lists: list[str]) -> tuple[list[np.ndarray], int]:
    """One row of letter numbers a text, 0 behind its end, over one alphabet; and the alphabet's size with the 0."""
    wide = max([1, *(len(t) for texts in lists for t in texts)])
    points = [np.array(texts, dtype=f"U{wide}").view(np.uint32).reshape(len(texts), wide) for texts in lists]
    known = np.unique(np.concatenate([np.zeros(1, np.uint32), *[p.ravel() for p in points]]))
    return [np.searchsorted(known, p) for p in points], len(known)


def _lengths(texts: list[str]) -> np.ndarray:
    return np.array([len(t) for t in texts], dtype=np.int64)


def jaro_winkler_of(a: list[str], b: list[str], ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """jaro_winkler of a[ia] and b[ib]: the places of each letter in `b` are bits, and the first free one in reach the lowest."""
    (x, y), size = _letters(a, b)
    la, lb = _lengths(a), _lengths(b)
    places = np.zeros((len(b), size), dtype=np.uint64)
    for j in range(min(y.shape[1], BITS)):
        places[np.arange(len(b)), y[:, j]] |= np.uint64(1 << j)
    places[:, 0] = 0
    places, row = places.ravel(), ib * size
    na, nb = la[ia], lb[ib]
    reach = np.maximum(np.maximum(na, nb) // 2 - 1, 0)
    taken = np.zeros(len(ia), dtype=np.uint64)
    found, zero = [], np.uint64(0)
    steps = int(na.max(initial=0))
    for i in range(steps):
        at = places[row + x[ia, i]]
        free = at & ~taken & _BELOW[np.minimum(i + reach + 1, BITS)] & ~_BELOW[np.clip(i - reach, 0, BITS)]
        first = free & (~free + np.uint64(1))
        taken |= first
        found.append(first != zero)
    m = np.bitwise_count(taken).astype(np.float64)
    rest, off = taken, np.zeros(len(ia), dtype=np.int64)
    for i in range(steps):
        low = np.where(found[i], rest & (~rest + np.uint64(1)), zero)
        rest = rest ^ low
        off += found[i] & ((places[row + x[ia, i]] & low) == zero)
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / na + m / nb + (m - off // 2) / m) / 3, 0.0)
    same, prefix = np.ones(len(ia), dtype=bool), np.zeros(len(ia))
    for k in range(min(4, x.shape[1])):
        same &= (x[ia, k] == y[ib, k]) & (x[ia, k] > 0)
        prefix += same
    out = np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro)
    for k in np.flatnonzero(nb > BITS):
        out[k] = _jaro_winkler(a[ia[k]], b[ib[k]])
    return out


def _counted_grams(x: np.ndarray, size: int) -> np.ndarray:
    """A row's trigrams, each with how often it stood before, as numbers; -1 for none. So what two rows share is what they have in common as sets."""
    if x.shape[1] < 3:
        return np.full((len(x), 1), -1, dtype=np.int64)
    g = (x[:, :-2].astype(np.int64) * size + x[:, 1:-1]) * size + x[:, 2:]
    g = np.sort(np.where(x[:, 2:] > 0, g, -1), axis=1)
    place = np.arange(g.shape[1])
    new = np.concatenate([np.ones((len(g), 1), dtype=bool), g[:, 1:] != g[:, :-1]], axis=1)
    before = place - np.maximum.accumulate(np.where(new, place, 0), axis=1)
    return np.where(g < 0, -1, g * g.shape[1] + before)


def trigrams_of(a: list[str], b: list[str], ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """trigram_similarity of a[ia] and b[ib]: each trigram of `a` is looked up in a table of those of each `b`."""
    (x, y), size = _letters(a, b)
    ga, gb = _counted_grams(x, size), _counted_grams(y, size)
    known = np.unique(ga[ga >= 0])
    none = len(known)
    has = np.zeros((len(b), none + 1), dtype=np.uint8)
    if none:
        at = np.minimum(np.searchsorted(known, gb), none - 1)
        r, c = np.nonzero(known[at] == gb)
        has[r, at[r, c]] = 1
    mine = np.where(ga >= 0, np.searchsorted(known, ga), none)
    has, row = has.ravel(), ib * (none + 1)
    shared = np.zeros(len(ia), dtype=np.int64)
    for i in range(mine.shape[1]):
        shared += has[row + mine[ia, i]]
    na, nb = _lengths(a)[ia] - 2, _lengths(b)[ib] - 2
    return np.where((na < 1) | (nb < 1), 0.0, shared / np.maximum(np.maximum(na, nb), 1))


def compound_of(a: list[str], b: list[str], ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """compound_name_similarity of a[ia] and b[ib]."""
    return 0.6 * jaro_winkler_of(a, b, ia, ib) + 0.4 * trigrams_of(a, b, ia, ib)
