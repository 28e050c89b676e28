"""BPE encoding and decoding with a priority queue of merge ranks (operator 9).

Texts are normalised and cut into words as the vocabulary file says (NFC, white space to a space, lower case; letters,
single digits, other signs).  A word's bytes become a doubly linked list of symbols, the last one with the word-end mark.
A queue holds the mergeable neighbours by (rank, place); entries whose symbols have changed meanwhile are skipped.
Decoding joins the vocabulary strings of the ids.
"""

import hashlib
import heapq
import json
import re
import struct
import sys
import unicodedata

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from deskflow.llm.common import per_text, texts_of, worker_memory

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def read_vocabulary(path: str) -> dict:
    """Symbols, merges, word end, split pattern and special strings of a vocabulary file."""
    with open(path, "rb") as f:
        data = f.read()
    whole = json.loads(data)
    model = whole["model"]
    vocab = dict(model["vocab"])
    special = {t["content"]: t["id"] for t in whole["added_tokens"]}
    pattern = next(p for p in whole["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    size = max(vocab.values()) + 1
    return {"vocab": vocab, "end": model["end_of_word_suffix"] or "", "special": special, "pattern": pattern,
            "digest": hashlib.sha256(data).hexdigest(), "size": size, "ranks": {vocab[a] * size + vocab[b]: r for r, (a, b) in enumerate(merges)},
            "made": [vocab[a + b] for a, b in merges]}


def merge_word(symbols: list[int], ranks: dict[int, int], made: list[int], size: int) -> list[int]:
    """The symbols after all merges, lowest rank first, then leftmost.

    ``ranks`` has the rank of a pair (a, b) at a * size + b, ``made`` what a rank makes.  A queue entry is
    rank * 2**40 + place, and is stale when the pair at its place has another rank by now.
    """
    n, rank_of = len(symbols), ranks.get
    now = [rank_of(a * size + b, -1) for a, b in zip(symbols, symbols[1:])]
    queue = [r << 40 | i for i, r in enumerate(now) if r >= 0]
    if not queue:
        return symbols
    now.append(-1)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heapq.heapify(queue)
    pop, push = heapq.heappop, heapq.heappush
    while queue:
        entry = pop(queue)
        i, r = entry & 0xffffffffff, entry >> 40
        if now[i] != r:
            continue
        j = after[i]
        after[i] = k = after[j]
        symbols[i] = new = made[r]
        symbols[j] = now[j] = -1
        if k < n:
            before[k] = i
            now[i] = r = rank_of(new * size + symbols[k], -1)
            if r >= 0:
                push(queue, r << 40 | i)
        else:
            now[i] = -1
        h = before[i]
        if h >= 0:
            now[h] = r = rank_of(symbols[h] * size + new, -1)
            if r >= 0:
                push(queue, r << 40 | h)
    return [s for s in symbols if s >= 0]


# Fixed value: the split pattern of the vocabulary file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Separators of information, which one pattern library takes for white space and the other does not.
_CONTROLS = re.compile("[\x1c-\x1f]").search


class Codec:
    """Encodes and decodes single texts; remembers at most ``cache_rows`` words."""

    def __init__(self, vocabulary: dict, cache_rows: int = 1 << 19):
        import regex

        self.ranks, self.made, self.size = vocabulary["ranks"], vocabulary["made"], vocabulary["size"]
        self.cache_rows, self.seen = cache_rows, worker_memory(f"bpe-{vocabulary['digest']}")
        signs, vocab, end = byte_alphabet(), vocabulary["vocab"], vocabulary["end"]
        self.inner = [vocab[c] for c in signs]
        self.last = [vocab[c + end] for c in signs]
        self.words = regex.compile(vocabulary["pattern"]).findall
        # White space only separates words, so it need not become a space first.
        plain = "a-zà-öø-ÿ"
        self.foreign = re.compile(f"[^\x00-\x7f{plain}]").search
        self.latin = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{plain}]+|[0-9]|[^\\s{plain}0-9]+").findall \
            if vocabulary["pattern"] == PATTERN else self.words
        self.special = vocabulary["special"]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.strings = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for s, i in [*vocab.items(), *self.special.items()]:
            self.strings[i] = s

    def _word(self, word: str) -> bytes:
        data = word.encode()
        symbols = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        symbols = merge_word(symbols, self.ranks, self.made, self.size)
        return struct.pack(f"<{len(symbols)}I", *symbols)

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            # Lower case character by character: a capital sigma has one small form wherever it stands.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text, seen = text.lower(), self.seen
        # A faster pattern that finds the same words in texts of Latin letters only.
        words = (self.words if self.foreign(text) or _CONTROLS(text) else self.latin)(text)
        if len(seen) > self.cache_rows:
            seen.clear()
        for w in set(words).difference(seen):
            seen[w] = self._word(w)
        out = b"".join(map(seen.__getitem__, words))
        if len(seen) > self.cache_rows:
            seen.clear()
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.cut is None:
            return self._plain(text)
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._plain(p)
                        for p in self.cut.split(text) if p)

    def decode(self, ids: bytes) -> str:
        """Vocabulary strings, special ones included, joined by a space (the file names no decoder)."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _codes(vocabulary, cache_rows):
    codec = Codec(vocabulary, cache_rows)

    def work(texts):
        ids = [codec.encode(t or "") for t in texts]
        return {"ids": ids, "decoded": [codec.decode(i) for i in ids]}

    return work


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                  cache_rows: int = 1 << 19) -> DataFrame:
    """(id, n_tokens, ids, decoded) of every row; ids are packed as little-endian unsigned 32-bit integers.

    ``vocabulary`` is the path of the vocabulary file, read once by the driver.  Null and empty texts have no ids and
    decode to an empty text.  Special strings inside texts become their special ids.
    """
    parts = read_vocabulary(vocabulary)
    rows = texts_of(docs, id_col, text_col)
    coded = rows.select("id", per_text(lambda: _codes(parts, cache_rows), "ids binary, decoded string",
                                       F.col("text")).alias("c"))
    return coded.select("id", F.expr("octet_length(c.ids) div 4").alias("n_tokens"), "c.ids", "c.decoded")
