"""Benchmark decontamination with suffix arrays of the training texts (operator 1).

Words are lower-cased (A-Z) runs of digits, letters and characters beyond ASCII.  A window is ``window`` consecutive words
of a benchmark item, or the whole of a shorter item.  Each task cuts its texts into shards (the texts that are worked on at
once, at most about a million words unless one text has more) and sorts the word suffixes of a shard (those that begin with
a word pair of the benchmark: no other can match).  Every test suffix is binary-searched in every shard; the range it matches
gives the locations.  From each place where a match cannot be longer to the left, it is followed to its full length
over all places of the benchmark: the suffixes of the benchmark are sorted too, and the range of those that agree is narrowed
word by word.

The benchmark is sent to the tasks in blocks of about ``block_bytes`` bytes, one after another; the driver holds one.
"""

import sys
from itertools import repeat

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from deskflow.functions.columns import compute_once
from deskflow.llm.common import per_text, texts_of
from deskflow.llm.licence import words_of
from deskflow.sources.stage import new_path, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SHARD = 1 << 20
# Words before lower-casing: the same places.
_RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Benchmark:
    """A block of items as word numbers, and its windows in order."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        vocab: dict[bytes, int] = {}
        flat, owners, starts = [], [], []
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            for s in range(max(1, len(words) - window + 1)):
                starts.append((len(flat) + s, min(window, len(words))))
                owners.append(item)
            flat.extend(vocab.setdefault(w, len(vocab) + 1) for w in words)
            flat.append(0)
        self.vocab, self.window = vocab, window
        self.flat = np.array(flat + [0] * window, np.int32)
        at = np.array([s for s, _ in starts], np.int64)
        size = np.array([n for _, n in starts], np.int64)
        keys = self.keys(self.flat, at) if len(at) else np.zeros(0, f"S{4 * window}")
        # Equal windows are searched once; the first of them in the benchmark stands for all.
        self.key, first, back = np.unique(keys, return_index=True, return_inverse=True)
        self.at, self.size = at[first], size[first]
        self.items: list[list[str]] = [[] for _ in first]
        for k, item in sorted(set(zip(back.tolist(), owners)), key=lambda x: (x[0], x[1] is not None, x[1])):
            if item is not None:
                self.items[k].append(item)
        self.upper = np.array([k.ljust(4 * n, b"\0") + b"\xff" * (4 * (window - n))
                               for k, n in zip(self.key.tolist(), self.size.tolist())], f"S{4 * window}")
        self._sort_whole(at[size == window], keys[size == window])
        span = np.int64(len(vocab) + 2)
        self.span = span
        self.pairs = np.unique(self.flat[at].astype(np.int64) * span + self.flat[at + 1])
        self.alone = np.zeros(span, bool)
        self.alone[self.flat[self.at[self.size == 1]]] = True
        # A cheap test before the exact one: pairs by a hash of 22 bits.
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[self._slot(self.pairs)] = True

    def _sort_whole(self, at, keys):
        """Places of whole windows in the order of all that follows in their items; per window its range of them, and the
        one word that stands before all of them (-1 when they differ)."""
        flat = self.flat
        ends = np.flatnonzero(flat == 0)
        places = np.flatnonzero(flat)
        left = ends[np.searchsorted(ends, places)] - places
        rank = np.zeros(len(flat), np.int64)
        first = self.keys(flat, places) if len(places) else np.zeros(0, keys.dtype)
        kinds, got = np.unique(first, return_inverse=True)
        rank[places], n, width = got + 1, len(kinds), self.window
        # Ranks of twice as many words, until no two places of more words are told apart any longer.
        while len(places):
            then = np.where(left > width, rank[np.minimum(places + width, len(flat) - 1)], 0)
            kinds, got = np.unique(rank[places] * np.int64(len(flat) + 1) + then, return_inverse=True)
            if len(kinds) == n:
                break
            rank[places], n, width = got + 1, len(kinds), 2 * width
        order = np.argsort(rank[at], kind="stable")
        self.array, keys = at[order], keys[order]
        self.low = np.searchsorted(keys, self.key, "left")
        self.high = np.searchsorted(keys, self.key, "right")
        before = flat[np.maximum(self.array - 1, 0)] * (self.array > 0)
        self.before = np.full(len(self.key), -1, np.int64)
        whole = self.high > self.low
        if whole.any():
            cut = self.low[whole]
            least, most = np.minimum.reduceat(before, cut), np.maximum.reduceat(before, cut)
            # Without a word before it a match cannot be longer to the left.
            self.before[whole] = np.where((least == most) & (least > 0), least, -1)

    def _bound(self, low, high, word, depth, after):
        """First place of each range whose word at ``depth`` is not smaller (``after``: larger) than ``word``."""
        low, high = low.copy(), high.copy()
        while (going := np.flatnonzero(low < high)).size:
            middle = (low[going] + high[going]) // 2
            there = self.flat[self.array[middle] + depth[going]]
            up = there <= word[going] if after else there < word[going]
            low[going[up]] = middle[up] + 1
            high[going[~up]] = middle[~up]
        return low

    def follow(self, numbers, place, which):
        """Words that agree from each place of a whole window on, with any place of the benchmark."""
        words = np.full(len(place), self.window, np.int64)
        low, high = self.low[which].copy(), self.high[which].copy()
        going = np.arange(len(place))
        while len(going):
            depth = words[going]
            word = numbers[place[going] + depth]
            going, depth, word = going[word > 0], depth[word > 0], word[word > 0]
            a = self._bound(low[going], high[going], word, depth, False)
            b = self._bound(a, high[going], word, depth, True)
            on = b > a
            going = going[on]
            low[going], high[going] = a[on], b[on]
            words[going] += 1
        return words

    @staticmethod
    def _slot(pairs):
        return (pairs * np.int64(0x9E3779B1)) >> np.int64(7) & np.int64((1 << 22) - 1)

    def keys(self, numbers, at):
        """The ``window`` words from each place as byte strings in the order of the word numbers."""
        rows = numbers[at[:, None] + np.arange(self.window)]
        # Nothing is compared beyond the end of a text.
        ended = np.cumsum(rows == 0, axis=1) > 0
        return np.where(ended, 0, rows).astype(">i4").view(f"S{4 * self.window}").ravel()

    def search(self, numbers: np.ndarray):
        """Matches (place, window number) and maximal matches (place, words) in a shard, these by place.

        ``numbers`` are the word numbers of the shard, each text ended by 0, and ``window`` more zeros.
        """
        live = np.flatnonzero(numbers[:-1])
        pair = numbers[live].astype(np.int64) * self.span + numbers[live + 1]
        kept = self.sieve[self._slot(pair)]
        alone = self.alone[numbers[live]]
        live, pair = live[kept | alone], pair[kept | alone]
        spot = np.minimum(np.searchsorted(self.pairs, pair), max(0, len(self.pairs) - 1))
        live = live[(self.pairs[spot] == pair) | self.alone[numbers[live]]] if len(live) else live
        keys = self.keys(numbers, live)
        order = np.argsort(keys, kind="stable")
        array, keys = live[order], keys[order]
        low = np.searchsorted(keys, self.key, "left")
        high = np.searchsorted(keys, self.upper, "right")
        n = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(n)), n)
        place = array[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        # A match of which every place in the benchmark has the word before it is longer from there.
        head = (self.size[which] < self.window) | (self.before[which] < 0) | (place == 0)
        head |= numbers[np.maximum(place - 1, 0)] != self.before[which]
        p, w = place[head], which[head]
        words = self.size[w].copy()
        whole = np.flatnonzero(words == self.window)
        words[whole] = self.follow(numbers, p[whole], w[whole])
        by_place = np.argsort(p, kind="stable")
        return place, which, p[by_place], words[by_place]


def _searches(bench: Benchmark):
    get = bench.vocab.get

    def shard(parts: list[np.ndarray], out: list):
        if not parts:
            return
        length = np.array([len(x) for x in parts])
        gap = np.zeros(1, np.int32)
        numbers = np.concatenate([y for x in parts for y in (x, gap)] + [np.zeros(bench.window + 1, np.int32)])
        base = np.cumsum(length + 1) - length - 1
        owner = np.repeat(np.arange(len(parts)), length + 1)
        place, which, p, words = bench.search(numbers)
        results = [{"n_words": int(n), "spans": [], "items": [], "longest": 0, "longest_at": None} for n in length]
        if len(place):
            hit = np.zeros(len(numbers) + 1, np.int64)
            np.add.at(hit, place, 1)
            np.add.at(hit, place + bench.size[which], -1)
            on = np.diff(np.r_[0, (np.cumsum(hit) > 0).astype(np.int8), 0])
            for a, b in zip(np.flatnonzero(on == 1).tolist(), np.flatnonzero(on == -1).tolist()):
                k = owner[a]
                results[k]["spans"].append({"first": int(a - base[k]), "words": int(b - a)})
            met = np.unique(owner[place].astype(np.int64) * len(bench.key) + which)
            for k, w in zip((met // len(bench.key)).tolist(), (met % len(bench.key)).tolist()):
                results[k]["items"].extend(bench.items[w])
            for a, n in zip(p.tolist(), words.tolist()):
                k = owner[a]
                if n > results[k]["longest"]:
                    results[k].update(longest=n, longest_at=int(a - base[k]))
        for r in results:
            r["items"] = sorted(set(r["items"]))
        out.extend(results)

    def work(texts):
        out, parts, size = [], [], 0
        for text in texts:
            words = words_of(text)
            parts.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
            # A word that no item has must not look like the end of a text to a match; it never matches either way.
            size += len(words)
            if size >= _SHARD:
                shard(parts, out)
                parts, size = [], 0
        shard(parts, out)
        return {name: [r[name] for r in out] for name in ("n_words", "spans", "items", "longest", "longest_at")}

    return work


KIND = ("n_words long, spans array<struct<first:long,words:long>>, items array<string>, longest long, "
        "longest_at long")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", window: int = 10, block_bytes: int = 1 << 23) -> DataFrame:
    """(id, n_words, spans, items, longest, longest_at) of every row.

    ``spans``: maximal runs of words that stand in an occurrence of a window; ``items``: ids of items with occurring
    windows, as sorted strings; ``longest`` and ``longest_at``: words and (smallest) first word of the longest verbatim match
    of a text with an item, of those that begin with a window.  Null and empty texts have no words.  An item
    without words has no window; one without an id marks words but is not listed.  Repeated rows stay repeated; a table
    without rows gives none, and without items nothing is marked.

    With one block the texts are read once and not shuffled.  With more they are read once a block, and what is found in a
    text joins its rows by a digest.
    """
    rows = texts_of(docs, id_col, text_col)
    items, blocks = _blocks(benchmark, text_col, item_col, block_bytes)
    if blocks == 1:
        return rows.select("id", _found(F.col("text"), items, 0, 1, window).alias("x")).select("id", "x.*")
    hits = _hits(rows, items, blocks, window).groupBy("_key").agg(F.collect_list(F.struct(
        "spans", "items", "longest", "longest_at")).alias("_h"))
    # Words marked by several blocks, as runs again.
    marked = compute_once(hits, m=F.array_sort(F.array_distinct(F.flatten(F.transform("_h", lambda h: F.flatten(F.transform(
        h["spans"], lambda s: F.sequence(s["first"], s["first"] + s["words"] - 1))))))))
    m = F.col("m")
    begins = F.filter("m", lambda w, i: (i == 0) | (F.get(m, i - 1) < w - 1))
    ends = F.filter("m", lambda w, i: (i == F.size(m) - 1) | (F.get(m, i + 1) > w + 1))
    runs = F.zip_with(begins, ends, lambda a, b: F.struct(a.alias("first"), (b - a + 1).alias("words")))
    # Of the longest matches the one that begins first.
    best = F.array_max(F.transform("_h", lambda h: F.struct(h["longest"].alias("n"), (-h["longest_at"]).alias("at"))))
    merged = marked.select(
        "_key", runs.alias("_spans"), F.array_sort(F.array_distinct(F.flatten(F.col("_h.items")))).alias("_items"),
        best.alias("_best"))
    counted = rows.select("id", F.coalesce(F.regexp_count("text", F.lit(_RAW_WORD)), F.lit(0)).cast("long").alias("n_words"),
                          F.sha2("text", 256).alias("_key"))
    spans = "array<struct<first:long,words:long>>"
    return counted.join(merged, "_key", "left").select(
        "id", "n_words", F.coalesce("_spans", F.array().cast(spans)).alias("spans"),
        F.coalesce("_items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("_best.n", F.lit(0).cast("long")).alias("longest"), (-F.col("_best.at")).alias("longest_at"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                         window: int = 10, block_bytes: int = 1 << 23) -> DataFrame:
    """Rows of ``docs`` whose text has no occurrence of a window; a null text has none.  Repeated rows stay repeated."""
    items, blocks = _blocks(benchmark, text_col, item_col, block_bytes)
    text = F.col(f"`{text_col}`").cast("string")
    if blocks == 1:
        return docs.where(F.size(_found(text, items, 0, 1, window)["spans"]) == 0)
    hits = _hits(docs.select(text.alias("text")), items, blocks, window).select("_key").distinct()
    # A null digest equals none, so rows without a text stay.
    return docs.join(hits, F.sha2(text, 256) == F.col("_key"), "left_anti")


def _blocks(benchmark: DataFrame, text_col: str, item_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """Different (id, text) of the benchmark, and into how many blocks their bytes go."""
    items = texts_of(benchmark, item_col, text_col).select(F.col("id").cast("string").alias("id"), "text").where(
        "text IS NOT NULL").distinct()
    size = F.octet_length("text") + F.coalesce(F.octet_length("id"), F.lit(0))
    total = items.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return items, int(total // block_bytes) + 1


def _found(text, items: DataFrame, block: int, blocks: int, window: int):
    """Struct of what one block of the items finds in a text.  Items are dealt by id and text: copies under many ids spread."""
    part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
    bench = Benchmark([(r[0], r[1]) for r in part.collect()], window)
    return per_text(lambda: _searches(bench), KIND, text)


def _hits(rows: DataFrame, items: DataFrame, blocks: int, window: int) -> DataFrame:
    """(_key, spans, items, longest, longest_at) of every different text and block that finds something in it.

    Each block is written before the next one is collected, so that one is in the driver and the tasks at a time."""
    items = stage(items, "items")
    path = new_path(rows.sparkSession, "hits")
    for block in range(blocks):
        found = rows.select(F.sha2("text", 256).alias("_key"), _found(F.col("text"), items, block, blocks, window).alias("x"))
        found.where(F.size("x.spans") > 0).select("_key", "x.spans", "x.items", "x.longest", "x.longest_at").dropDuplicates(
            ["_key"]).write.mode("append").parquet(path)
    return rows.sparkSession.read.parquet(path)
