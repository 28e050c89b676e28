"""Counts of words and neighbouring word pairs over Arrow batches; runs inside tasks."""

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Sent to the tasks with the code that uses it, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS_AT_ONCE = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _ODD[1]
    return h ^ (h >> np.uint64(32))


class Terms:
    """The occurrences of words, then of pairs, in some texts given as lists of words.

    ``key`` numbers the terms of these texts: a word by its place among the distinct words, a pair by both places.
    """

    def __init__(self, lists: pa.Array):
        size = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        self.words = coded.dictionary
        word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.repeat(np.arange(len(size)), size)
        beside = np.flatnonzero(text[1:] == text[:-1])
        self.n = len(self.words)
        self.key = np.r_[word, self.n + word[beside] * self.n + word[beside + 1]]
        self.text, self.texts = np.r_[text, text[beside]], len(size)
        h = pd.util.hash_array(self.words.to_numpy(zero_copy_only=False).astype(object), categorize=False)
        self.hash = np.r_[_mixed(h)[word], _mixed(_mixed(h * _ODD[0])[word[beside]] + h[word[beside + 1]])]

    def buckets(self, buckets: int) -> np.ndarray:
        return (self.hash % np.uint64(buckets)).astype(np.int64)

    def counted(self, chosen: np.ndarray) -> pa.RecordBatch:
        """Each different term of the chosen occurrences, how often it occurs, and in how many of the texts."""
        key, place = np.unique(self.key[chosen], return_inverse=True)
        once = np.unique(place * self.texts + self.text[chosen]) // max(self.texts, 1)
        is_word = key < self.n
        left, right = np.divmod(key[~is_word] - self.n, max(self.n, 1))
        pairs = pc.binary_join_element_wise(self.words.take(pa.array(left)), self.words.take(pa.array(right)), " ")
        names = pa.concat_arrays([self.words.take(pa.array(key[is_word])).cast(pa.string()), pairs.cast(pa.string())])
        tf, df = (np.bincount(x, minlength=len(key)) for x in (place, once))
        return pa.RecordBatch.from_arrays([names, pa.array(tf, pa.int64()), pa.array(df, pa.int64())], ["term", "tf", "df"])


def pieces(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[Terms]:
    """Whole texts, about ``at_once`` words at a time."""
    for batch in batches:
        lists = batch.column(0)
        ends = np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(lists):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + at_once, side="right")))
            yield Terms(lists.slice(start, stop - start))
            start = stop


def bucket_totals(buckets: int, at_once: int = WORDS_AT_ONCE):
    """Function from lists of words to the occurrences in each hash bucket of terms: one row a bucket and task."""
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for found in pieces(batches, at_once):
            place, n = np.unique(found.buckets(buckets), return_counts=True)
            sums[place] += n
        filled = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(sums[filled])], ["bucket", "total"])

    return totals


def chosen_terms(shared, buckets: int, at_once: int = WORDS_AT_ONCE):
    """Function from lists of words to the counts of the terms in the buckets of a broadcast array."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(buckets, bool)
        wanted[shared.value] = True
        for found in pieces(batches, at_once):
            yield found.counted(wanted[found.buckets(buckets)])

    return counts
