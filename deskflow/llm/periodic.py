"""Runs of a repeating period in the words of a text (operator 13).

A run is a stretch of words with smallest period q, of at least ``least`` words and ``times`` periods, that no
neighbouring word extends.  The words of several texts stand in one row of numbers, a mark of its own between two texts.

Blocks.  Ranks of the stretches of 8, 16, 32 ... words come from doubling, and with them the suffix array.  A run of period
q in [m, 2m) that is three periods long holds a whole block u of m words (a multiple of m from the start), and u stands
again q words further, in the window next to it.  For the smallest blocks the window begins right after the start of u, so
that periods below their size are met as well.

Queries.  All places of u are an interval of the suffix array.  A wavelet tree over the array gives the first place of the
interval at or after a word number, so places in a window are found one by one without the places elsewhere.

Progressions.  Three places of u in a window are a progression, whose difference is the period of u: two stretches of that
period meet the run, and the run shifts one onto the other, begin onto begin or end onto end.  So a block has two
candidates at most.  A candidate is extended as far as words agree, by ranks of stretches of falling size.
"""

import re
import sys
from itertools import chain

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from deskflow.llm.common import per_text, texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST, TIMES = 24, 3
_SMALLEST = 3
_AT_ONCE = 1 << 16
_KIND = "n long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def dyadic_ranks(row: np.ndarray, top: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks of the stretches of 1, 2, 4 ... 2**top words at every place, and the suffix array by the last of them.

    ``row`` holds dense numbers from 0 on.  A stretch that the end cuts off is smaller than its continuations.
    """
    n = len(row)
    ranks, order = [row.astype(np.int32)], np.argsort(row, kind="stable")
    for k in range(top):
        half = 1 << k
        key = ranks[-1].astype(np.int64) * (n + 1)
        key[:max(n - half, 0)] += ranks[-1][half:] + 1
        order = np.argsort(key)
        key = key[order]
        rank = np.empty(n, np.int32)
        rank[order] = np.cumsum(np.r_[False, key[1:] != key[:-1]])
        ranks.append(rank)
    return ranks, order


class Wavelet:
    """Wavelet tree of a permutation of 0 ... n-1, level by level, with bits packed in words of 64."""

    def __init__(self, values: np.ndarray):
        self.n, self.bits = len(values), max(1, int(len(values) - 1).bit_length())
        self.levels = []
        for shift in range(self.bits - 1, -1, -1):
            bit = (values >> shift) & 1 == 1
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(self.n // 64 + 1, np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            before = np.r_[0, np.cumsum(np.bitwise_count(words).astype(np.int64))]
            self.levels.append((words, before, self.n - int(before[-1]), shift))
            values = np.concatenate([values[~bit], values[bit]])

    @staticmethod
    def _ones(level, at):
        words, before, _, _ = level
        word = at >> 6
        inside = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(words[word] & inside).astype(np.int64)

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Smallest value at places [low, high) that is ``least`` or more; n where there is none."""
        a, b, smaller = low.copy(), high.copy(), np.zeros(len(low), np.int64)
        aim = np.minimum(least, self.n)
        beyond = aim >= self.n
        for level in self.levels:
            one_a, one_b = self._ones(level, a), self._ones(level, b)
            up = (aim >> level[3]) & 1 == 1
            smaller += np.where(up, (b - one_b) - (a - one_a), 0)
            a, b = np.where(up, level[2] + one_a, a - one_a), np.where(up, level[2] + one_b, b - one_b)
        # Values below the aim are counted; the next one is the value of that rank.
        none = beyond | (smaller >= high - low)
        a, b, k, value = low.copy(), high.copy(), np.where(none, 0, smaller), np.zeros(len(low), np.int64)
        for level in self.levels:
            one_a, one_b = self._ones(level, a), self._ones(level, b)
            zeros = (b - one_b) - (a - one_a)
            up = k >= zeros
            k = np.where(up, k - zeros, k)
            value |= up.astype(np.int64) << level[3]
            a, b = np.where(up, level[2] + one_a, a - one_a), np.where(up, level[2] + one_b, b - one_b)
        return np.where(none, self.n, value)


def _ahead(ranks, i, j):
    """How many words from i on equal those from j on."""
    n, far = len(ranks[0]), np.zeros(len(i), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        live = np.arange(len(i))
        while len(live):
            a, b = i[live] + far[live], j[live] + far[live]
            live = live[(np.maximum(a, b) < n) & (ranks[k][np.minimum(a, n - 1)] == ranks[k][np.minimum(b, n - 1)])]
            far[live] += 1 << k
            if k < len(ranks) - 1:
                break
    return far


def _behind(ranks, i, j):
    """How many words before i equal those before j."""
    far = np.zeros(len(i), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        live = np.arange(len(i))
        while len(live):
            a, b = i[live] - far[live] - (1 << k), j[live] - far[live] - (1 << k)
            live = live[(np.minimum(a, b) >= 0) & (ranks[k][np.maximum(a, 0)] == ranks[k][np.maximum(b, 0)])]
            far[live] += 1 << k
            if k < len(ranks) - 1:
                break
    return far


def _extent(ranks, i, q):
    """Begin and end of the stretch of period q around places i and i + q."""
    return i - _behind(ranks, i, i + q), i + q + _ahead(ranks, i, i + q)


def periodic_runs(row: np.ndarray, ends: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (begin, end, period) of all runs, by begin, then period.

    ``row`` holds texts one after another, each followed by a number that stands nowhere else; ``ends`` are the places of
    these marks.  ``least`` is at least three times the smallest block, ``times`` at least three.
    """
    if least < 3 << _SMALLEST or times < 3:
        raise ValueError("Blocks meet runs of 24 words and three periods or more only.")
    longest = int(np.diff(np.r_[-1, ends]).max(initial=1)) - 1
    if longest < least:
        return np.zeros((0, 3), np.int64)
    top = max(_SMALLEST, int(longest // times).bit_length() - 1)
    ranks, order = dyadic_ranks(row, top)
    tree = Wavelet(order)
    n = len(row)
    found = [np.zeros((2, 0), np.int64)]
    for k in range(_SMALLEST, top + 1):
        m = 1 << k
        count = np.bincount(ranks[k])
        high = np.cumsum(count)
        # Blocks whole inside a text that stand somewhere else too.
        b = np.arange(0, n - m + 1, m)
        b = b[count[ranks[k][b]] > 1]
        end = ends[np.searchsorted(ends, b)]
        inside = b + m < end
        b, end = b[inside], end[inside]
        if not len(b):
            continue
        top_of = high[ranks[k][b]]
        low_of = top_of - count[ranks[k][b]]

        def place(which, at_least, last):
            """First place at or after a number, in the window and the text, else n."""
            p = tree.successor(low_of[which], top_of[which], at_least)
            return np.where((p < last) & (p + m <= end[which]), p, n)

        every = np.arange(len(b))
        if k == _SMALLEST:
            p = place(every, b + 1, b + m)
            hit = p < n
            found.append(np.stack([b[hit], (p - b)[hit]]))
        first = place(every, b + m, b + 2 * m)
        which = np.flatnonzero(first < n)
        first = first[which]
        second = place(which, first + 1, b[which] + 2 * m)
        third = np.full(len(which), n)
        two = np.flatnonzero(second < n)
        third[two] = place(which[two], second[two] + 1, b[which[two]] + 2 * m)
        few, many = third == n, third < n
        found.append(np.stack([b[which[few]], (first - b[which])[few]]))
        pair = few & (second < n)
        found.append(np.stack([b[which[pair]], (second - b[which])[pair]]))
        if many.any():
            at, other, step = b[which[many]], first[many], (second - first)[many]
            own, next_ = _extent(ranks, at, step), _extent(ranks, other, step)
            for mine, its in zip(own, next_):
                q = its - mine
                fits = (q >= m) & (q < 2 * m)
                found.append(np.stack([at[fits], q[fits]]))
    at, q = np.unique(np.concatenate(found, axis=1), axis=1)
    begin, end = _extent(ranks, at, q)
    kept = end - begin >= np.maximum(least, times * q)
    runs = np.unique(np.stack([begin, end, q], axis=1)[kept], axis=0)
    # Of the periods of one stretch, the smallest.
    return runs[np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)][:len(runs)]]


def _found(least: int, times: int):
    cut = re.compile("[^\x20\x09-\x0d]+").findall

    def work(texts):
        n, runs, collapsed = [0] * len(texts), [[] for _ in texts], [""] * len(texts)
        waiting: dict[str, list[int]] = {}
        size = 0

        def flush():
            nonlocal waiting, size
            words = [cut(t) for t in waiting]
            number = {x: i for i, x in enumerate(dict.fromkeys(chain.from_iterable(words)))}
            if words:
                length = np.array([len(w) for w in words])
                ends = np.cumsum(length + 1) - 1
                flat = np.zeros(ends[-1] + 1, np.int64)
                inside = np.ones(len(flat), bool)
                inside[ends] = False
                flat[inside] = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, length.sum())
                # A number of its own ends each text.
                flat[ends] = len(number) + np.arange(len(ends))
                all_runs = periodic_runs(flat, ends, least, times)
                of = np.searchsorted(ends, all_runs[:, 0])
                for j, (w, same) in enumerate(zip(words, waiting.values())):
                    mine = all_runs[of == j] if len(all_runs) else all_runs
                    mine = mine - np.array([[1, 1, 0]]) * (ends[j] - len(w))
                    gone = np.zeros(len(w) + 1, np.int64)
                    np.add.at(gone, mine[:, 0] + mine[:, 2], 1)
                    np.add.at(gone, mine[:, 1], -1)
                    left = w if not len(mine) else [x for x, g in zip(w, np.cumsum(gone).tolist()) if not g]
                    told = [{"start": s, "length": e - s, "period": q} for s, e, q in mine.tolist()]
                    text = " ".join(left)
                    for i in same:
                        n[i], runs[i], collapsed[i] = len(w), told, text
            waiting, size = {}, 0

        for i, text in enumerate(texts):
            if text:
                waiting.setdefault(text, []).append(i)
                size += len(text)
                if size > 6 * _AT_ONCE:
                    flush()
        flush()
        return {"n": n, "runs": runs, "collapsed": collapsed}

    return work


def repeated_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
                     times: int = TIMES) -> DataFrame:
    """(id, n, runs, collapsed) of every row: words, runs by start, then period, and the words left joined by a space.

    Of each run its first period stays.  Null and empty texts have no words and an empty collapsed text.  Repeated rows give
    equal results, an empty table none; other columns are not read.  A text is worked on whole, in memory of about
    4 log2(n) bytes a word.
    """
    rows = texts_of(docs, id_col, text_col)
    made = rows.select("id", per_text(lambda: _found(least, times), _KIND, F.col("text")).alias("r"))
    return made.select("id", "r.*")
