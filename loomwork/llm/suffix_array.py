"""Suffix arrays by the difference cover of three."""

from __future__ import annotations

import numpy as np


def _padded(t: np.ndarray) -> np.ndarray:
    return np.concatenate([t, np.zeros(3, dtype=t.dtype)])


def suffix_array(t: np.ndarray, enough: int) -> np.ndarray:
    """The starts of all suffixes of ``t`` in the order of their first ``enough`` symbols.

    ``t`` holds numbers from 1 to below 2^21 less than its length allows for; the end of
    ``t`` counts as zeros. Suffixes that agree in ``enough`` symbols are next to each other
    in any order.

    Suffixes that start at 1 or 2 modulo 3 are the sample. Their first three symbols are
    sorted and named; as long as names repeat and do not cover enough symbols, the order of
    the sample comes from the suffix array of its names. The other suffixes are sorted by
    their first symbol and the rank of the sampled suffix behind it, and merged in.
    """
    n = len(t)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    s = _padded(t.astype(np.int64, copy=False))
    # class k of n_k starts is k, k + 3, ...; with one more start at the end of the first
    # class, so that a name of it never runs into the second
    n_0, n_1, n_2 = (n + 2) // 3, (n + 1) // 3 + (n % 3 == 1), n // 3
    if n_1 + n_2 == 0:
        return np.zeros(1, dtype=np.int64)

    def of(values: np.ndarray, start: int, count: int) -> np.ndarray:
        return values[start : start + 3 * count : 3]

    # sort the sampled triples and name them
    bits = max(1, int(s.max()).bit_length())
    a, b, c = (np.concatenate([of(s, 1 + k, n_1), of(s, 2 + k, n_2)]) for k in range(3))
    if 3 * bits <= 63:
        triple = (a << (2 * bits)) | (b << bits) | c
        order = np.argsort(triple)
        named = triple[order]
        fresh = np.concatenate([[True], named[1:] != named[:-1]])
    else:
        order = np.lexsort((c, b, a))
        a, b, c = a[order], b[order], c[order]
        fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])])
    name = np.empty(len(order), dtype=np.int64)
    name[order] = np.cumsum(fresh)

    # recurse on the names: the first class, then the second
    if not fresh.all() and enough > 3:
        order = suffix_array(name, -(-enough // 3))
        rank_of = np.empty(len(order), dtype=np.int64)
        rank_of[order] = np.arange(1, len(order) + 1)
    else:
        rank_of = name
    rank = np.zeros(n + 3, dtype=np.int64)
    of(rank, 1, n_1)[:] = rank_of[:n_1]
    of(rank, 2, n_2)[:] = rank_of[n_1:]
    in_first = order < n_1
    sorted_sample = np.where(in_first, 3 * order + 1, 3 * (order - n_1) + 2)
    inside = sorted_sample < n
    order, in_first, sorted_sample = order[inside], in_first[inside], sorted_sample[inside]

    # the remaining suffixes, by first symbol and the rank behind it
    size = np.int64(len(rank_of) + 2)
    by_one = of(s, 0, n_0) * size + of(rank, 1, n_0)
    rest = np.argsort(by_one)

    # merge: a remaining suffix and one of either class compare by symbols and the sampled rank behind
    first, second = order[in_first], order[~in_first] - n_1
    key_one = (of(s, 1, n_1) * size + of(rank, 2, n_1))[first]
    ahead = np.searchsorted(key_one, by_one[rest])
    if int(s.max()) ** 2 * int(size) < 1 << 62:
        top = np.int64(int(s.max()) + 1)
        key_two = ((of(s, 2, n_2) * top + of(s, 3, n_2)) * size + of(rank, 4, n_2))[second]
        mine = ((of(s, 0, n_0) * top + of(s, 1, n_0)) * size + of(rank, 2, n_0))[rest]
    else:
        # pairs of symbols named together, so that a key fits into 64 bits
        both = np.concatenate([3 * second + 2, 3 * rest])
        wide = np.stack([s[both], s[both + 1]], axis=1)
        _, pair = np.unique(wide, axis=0, return_inverse=True)
        keys = pair.ravel().astype(np.int64) * size + rank[both + 2]
        key_two, mine = keys[: len(second)], keys[len(second) :]
    # with ranks cut short, equal prefixes may tie; running maxima keep the keys ascending
    ahead += np.searchsorted(np.maximum.accumulate(key_two) if len(key_two) else key_two, mine)
    place = np.arange(len(rest)) + np.maximum.accumulate(ahead)
    out = np.empty(n, dtype=np.int64)
    taken = np.zeros(n, dtype=bool)
    taken[place] = True
    out[place] = 3 * rest
    out[~taken] = sorted_sample
    return out
