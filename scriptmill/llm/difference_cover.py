"""Suffix arrays by the difference cover modulo 3, in numpy: sort the triples at positions not divisible by 3, name them, recurse on the names where they repeat, order the remaining suffixes by one symbol and the rank behind it, and merge."""

from __future__ import annotations

import numpy as np

#: Triples of symbols are sorted as one 63-bit number.
MAX_SYMBOLS = 2_000_000


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of an integer array in lexicographic order; a shorter suffix sorts before its extensions."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    t = np.zeros(n + 3, np.int64)
    t[:n] = np.asarray(text, np.int64) - int(text.min()) + 1
    k = int(t.max()) + 1
    if k > MAX_SYMBOLS or n > MAX_SYMBOLS:
        raise ValueError("text too long for packed triples")
    return _sort(t, n, k)


def _sort(t: np.ndarray, n: int, k: int) -> np.ndarray:
    # a dummy position n stands in where the last triple of class 1 would be missing
    ones = np.arange(1, n + (n % 3 == 1), 3)
    sample = np.concatenate([ones, np.arange(2, n, 3)])
    triples = (t[sample] * k + t[sample + 1]) * k + t[sample + 2]
    order = np.argsort(triples, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = np.diff(triples[order]) != 0
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(new)
    if not new.all():
        m = len(names)
        r = np.zeros(m + 3, np.int64)
        r[:m] = names
        order = _sort(r, m, int(names.max()) + 1) if m > 2 else np.lexsort((np.arange(m)[::-1], names))
    first = sample[order]
    rank = np.zeros(n + 3, np.int64)
    rank[first] = np.arange(1, len(first) + 1)
    first = first[first < n]
    # the rest: one symbol, then the rank of the sampled suffix behind it
    size = len(sample) + 2
    rest = np.arange(0, n, 3)
    key = t[rest] * size + rank[rest + 1]
    by = np.argsort(key, kind="stable")
    rest, key = rest[by], key[by]
    # merge: a suffix of the rest comes after all sampled suffixes with a smaller key of their own kind
    one, two = first[first % 3 == 1], first[first % 3 == 2]
    wide = (t[rest] * k + t[rest + 1]) * size + rank[rest + 2]
    at = np.arange(len(rest)) + np.searchsorted(t[one] * size + rank[one + 1], key) + np.searchsorted((t[two] * k + t[two + 1]) * size + rank[two + 2], wide)
    out = np.empty(n, np.int64)
    sampled = np.ones(n, bool)
    sampled[at] = False
    out[at], out[sampled] = rest, first
    return out
