"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays."""

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_WIDE = 4096


def _spread(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by character, and the place of each element of that order among its equals."""
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    first = np.r_[True, c[1:] != c[:-1]]
    at = np.arange(len(c))
    return order, at - np.maximum.accumulate(np.where(first, at, 0))


def _induce(s, is_s, seeds, count, present):
    """Array induced from the leftmost-smaller suffixes in the given order: first the larger types, then the smaller.

    A bucket is worked off as whole slices: what stands in it induces the suffixes one place to the left, those
    that fall into the same bucket form its next slice.
    """
    sa = np.full(len(s), -1, np.int64)
    tails = np.cumsum(count)
    heads = tails - count
    order, among = _spread(s[seeds])
    placed = seeds[order]
    n_seeds = np.bincount(s[seeds], minlength=len(count))
    sa[(tails - n_seeds)[s[placed]] + among] = placed

    free = heads.copy()

    def to_left(items):
        j = items - 1
        j = j[(items > 0) & ~is_s[j]]
        if len(j):
            order, among = _spread(s[j])
            j = j[order]
            c = s[j]
            sa[free[c] + among] = j
            free[:] += np.bincount(c, minlength=len(free))

    for c in present:
        start = heads[c]
        while start < free[c]:
            end = free[c]
            to_left(sa[start:end])
            start = end
        if n_seeds[c]:
            to_left(sa[tails[c] - n_seeds[c]:tails[c]])

    large = free.copy()
    free = tails.copy()

    def to_right(items):
        # From the largest to the smallest.
        j = items[::-1] - 1
        j = j[(items[::-1] > 0) & is_s[j]]
        if len(j):
            order, among = _spread(s[j])
            j = j[order]
            c = s[j]
            sa[free[c] - 1 - among] = j
            free[:] -= np.bincount(c, minlength=len(free))

    for c in present[::-1]:
        if c == 0:
            break  # the end mark stands first and induces nothing smaller
        end = tails[c]
        while free[c] < end:
            start = free[c]
            to_right(sa[start:end])
            end = start
        if heads[c] < large[c]:
            to_right(sa[heads[c]:large[c]])
    sa[0] = len(s) - 1
    return sa


def _doubled(names: np.ndarray) -> np.ndarray:
    """Suffix array of a string over a large alphabet by doubling of ranks."""
    n, rank, step = len(names), names.astype(np.int64), 1
    while True:
        key = rank * (n + 1)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        sorted_keys = key[order]
        ranks = np.cumsum(np.r_[False, sorted_keys[1:] != sorted_keys[:-1]])
        if ranks[-1] == n - 1:
            return order
        rank[order] = ranks
        step *= 2
        if step >= n:
            return order


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order.  ``s`` holds small whole numbers and ends with its only 0.

    Suffixes are larger or smaller than the one to their right; the leftmost smaller ones are sorted by the pieces
    between them, named, and, where names repeat, by the suffix array of the names; all others are induced.  Strings of
    names have large alphabets, whose buckets are too narrow for work in slices: beyond a few thousand names their
    order comes from doubling of ranks.
    """
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    step = np.sign(np.diff(s.astype(np.int64)))
    # Equal neighbours have the type of what follows them.
    at = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(at[::-1])[::-1]
    is_s = np.r_[step[np.minimum(following, n - 2)] > 0, True]
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    count = np.bincount(s)
    present = np.flatnonzero(count)
    if len(lms) > 1:
        first = _induce(s, is_s, lms, count, present)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        order = first[is_lms[first]]
        # Pieces reach to the next leftmost smaller suffix, that one's first character included.
        length = np.zeros(n, np.int64)
        length[lms] = np.diff(np.r_[lms, n - 1]) + 1
        a, b = order[:-1], order[1:]
        equal = length[a] == length[b]
        live, offset = np.flatnonzero(equal), 0
        while len(live):
            same = s[a[live] + offset] == s[b[live] + offset]
            equal[live[~same]] = False
            offset += 1
            live = live[same]
            live = live[length[a[live]] > offset]
        name = np.zeros(n, np.int64)
        name[order] = np.cumsum(np.r_[False, ~equal])
        names = name[lms]
        if names.max() + 1 == len(lms):
            lms = order
        elif names.max() < _WIDE:
            lms = lms[suffix_array(names)]
        else:
            lms = lms[_doubled(names)]
    return _induce(s, is_s, lms, count, present)


def permuted_common_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each place of the bytes ``s``, what its suffix has in common with the one before it in the array.

    Where the characters before the two are equal, the length is that of the place before less one.  Only the
    other places are compared, eight characters at a time.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    place = np.arange(n)
    known = (place > 0) & (before > 0)
    known[1:] &= before[:-1] >= 0
    known &= s[place - 1] == s[before - 1]
    padded = np.concatenate([s, np.zeros(16, np.uint8)])
    words = np.ndarray((n + 8,), "<u8", padded, strides=(1,))
    out = np.zeros(n, np.int64)
    live = np.flatnonzero(~known & (before >= 0))
    while len(live):
        a, b = live + out[live], before[live] + out[live]
        differ = words[np.minimum(a, n + 7)] ^ words[np.minimum(b, n + 7)]
        done = differ != 0
        low = differ[done]
        low &= (~low) + np.uint64(1)
        out[live[done]] += (np.frexp(low.astype(np.float64))[1] - 1) // 8
        live = live[~done]
        out[live] += 8
    # Places after a compared one lose one each.
    head = np.maximum.accumulate(np.where(known, 0, place))
    return np.maximum(out[head] - (place - head), 0)
