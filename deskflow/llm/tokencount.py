"""Token counts of a BPE vocabulary with byte fallback, by rank-synchronous array merging (operator 6).

A text is cut into pre-tokens (spaces and what follows them), which no vocabulary string crosses.  The distinct
pre-tokens of a batch lie as ragged numpy arrays of symbols side by side.  In every round each of them merges its
lowest-rank pair, all at the same time, until none has a pair left; then the surviving symbols are counted.  A symbol
that is no vocabulary string counts its UTF-8 bytes.
"""

import hashlib
import sys
from itertools import chain

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from deskflow.llm.common import per_text, texts_of, worker_memory

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACE = "▁"
_NONE = np.int64(1 << 40)


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Vocabulary strings that texts can contain, with their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class Merger:
    """The merge table of a vocabulary and the counting of pre-tokens.

    Ranks order the scores downwards; equal scores have equal ranks, and the leftmost pair goes first.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        if any(SPACE in p.lstrip(SPACE) for p, _ in pieces):
            raise ValueError("A vocabulary string crosses the start of a word.")
        chars = sorted({c for p, _ in pieces for c in p})
        known = {p for p, _ in pieces}
        # Symbols: every vocabulary string, then characters of them that are none, then 4 classes of other characters.
        names = [p for p, _ in pieces] + [c for c in chars if c not in known]
        ident = {p: i for i, p in enumerate(names)}
        self.size = len(names) + 5
        self.cost = np.ones(self.size, np.int64)
        for i in range(len(pieces), len(names)):
            self.cost[i] = len(names[i].encode())
        self.cost[len(names):] = np.arange(5)
        by_char = np.full(0x110000, len(names) + 4, np.int32)
        for limit, width in ((0x10000, 3), (0x800, 2), (0x80, 1)):
            by_char[:limit] = len(names) + width
        by_char[[ord(c) for c in chars]] = [ident[c] for c in chars]
        self.by_char = by_char
        order = {s: r for r, s in enumerate(sorted({s for _, s in pieces}, reverse=True))}
        pairs = {}
        for p, score in pieces:
            for cut in range(1, len(p)):
                left, right = ident.get(p[:cut]), ident.get(p[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = (order[score], ident[p])
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int64)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], np.int64)

    def _look(self, left, right):
        """Position in the merge table and rank of pairs; no pair has rank _NONE."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return at, np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def count(self, words: list[str]) -> np.ndarray:
        """Symbols that survive in each (non-empty) pre-token."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.by_char[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)].astype(np.int64)
        out = np.zeros(len(words), np.int64)
        who = np.arange(len(words))
        rank = np.full(len(sym), _NONE)
        if len(sym) > 1 and len(self.keys):
            rank[:-1] = self._look(sym[:-1], sym[1:])[1]
        rank[np.cumsum(length) - 1] = _NONE
        while len(who):
            start = np.cumsum(length) - length
            best = np.minimum.reduceat(rank, start)
            done = best == _NONE
            if done.any():
                out[who[done]] = np.add.reduceat(self.cost[sym], start)[done]
                stay = np.repeat(~done, length)
                sym, rank, length, who, best = sym[stay], rank[stay], length[~done], who[~done], best[~done]
                if not len(who):
                    break
            sym, rank, length = self._round(sym, rank, length, best)
        return out

    def _round(self, sym, rank, length, best):
        """Merge the lowest-rank pair of every sequence, at all its places from left to right.

        A merge may make a pair of no higher rank, whose turn comes before the places to the right of it: these wait for
        the next round.
        """
        owner = np.repeat(np.arange(len(length)), length)
        place = np.flatnonzero(rank == best[owner])
        # Places that overlap ("aaa"): every second one of a run.
        fresh = np.r_[True, np.diff(place) > 1]
        head = np.maximum.accumulate(np.where(fresh, np.arange(len(place)), 0))
        place = place[(np.arange(len(place)) - head) % 2 == 0]
        of = owner[place]
        new = self.merged[self._look(sym[place], sym[place + 1])[0]]
        # The symbol on the left may be the place merged just before; the one on the right is not merged yet.
        n = len(sym)
        inside_left = (place > 0) & (owner[place - 1] == of)
        after = np.minimum(place + 2, n - 1)
        inside_right = (place + 2 < n) & (owner[after] == of)
        before = np.r_[-9, place[:-1]] == place - 2
        left = np.where(before, np.r_[0, new[:-1]], sym[place - 1])
        rank_left = np.where(inside_left, self._look(left, new)[1], _NONE)
        rank_right = np.where(inside_right, self._look(new, sym[after])[1], _NONE)
        early = np.minimum(rank_left, rank_right) <= best[of]
        if early.any():
            first = np.full(len(length), n)
            np.minimum.at(first, of[early], place[early])
            take = place <= first[of]
            place, of, new = place[take], of[take], new[take]
            rank_left, rank_right = rank_left[take], rank_right[take]
            inside_left = inside_left[take]
        sym[place] = new
        rank[place] = rank_right
        near = inside_left
        # A place two to the left was merged too: the pair now starts there.
        prior = np.r_[-9, place[:-1]] == place - 2
        rank[np.where(prior, place - 2, place - 1)[near]] = rank_left[near]
        keep = np.ones(n, bool)
        keep[place + 1] = False
        return sym[keep], rank[keep], length - np.bincount(of, minlength=len(length))


def _counts(pieces, cache_rows):
    import re

    memory = worker_memory(f"counts-{hashlib.sha256(repr(pieces).encode()).hexdigest()}")
    if not memory:
        memory.update(merger=Merger(pieces), seen={})
    merger, seen = memory["merger"], memory["seen"]
    cut = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall

    def learn(words):
        """Count the pre-tokens that were not seen before."""
        new = list(words.difference(seen))
        if len(seen) + len(new) > cache_rows:
            seen.clear()
            new = list(words)
        if new:
            seen.update(zip(new, merger.count(new).tolist()))

    def total(words):
        return sum(map(seen.__getitem__, words))

    def work(texts):
        # All short texts of a batch meet the merger together; a long one comes alone.
        out = [0] * len(texts)
        waiting, size = [], 0

        def flush():
            nonlocal size
            learn(set(chain.from_iterable(w for _, w in waiting)))
            for i, w in waiting:
                out[i] = total(w)
            waiting.clear()
            size = 0

        for i, text in enumerate(texts):
            if text:
                words = cut(SPACE + text.replace(" ", SPACE))
                if len(words) > 1 << 17:
                    for k in range(0, len(words), 1 << 17):
                        learn(set(words[k:k + (1 << 17)]))
                        out[i] += total(words[k:k + (1 << 17)])
                    continue
                waiting.append((i, words))
                size += len(words)
                if size > 1 << 17:
                    flush()
        flush()
        return {"n": out}

    return work


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096, cache_rows: int = 1 << 19) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.

    ``vocabulary`` is the path of the vocabulary file, read once by the driver; its strings go to the tasks with
    the code.  Null and empty texts have no tokens.  ``cache_rows`` bounds the pre-tokens a task remembers; no count
    depends on it.
    """
    pieces = read_pieces(vocabulary)
    rows = texts_of(docs, id_col, text_col)
    n = per_text(lambda: _counts(pieces, cache_rows), "n long", F.col("text"))["n"]
    return rows.select(
        "id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), n.alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
