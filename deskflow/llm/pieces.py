"""Encoding and decoding with a scored BPE vocabulary, by vectorised merge rounds (operator 11).

A text gets a leading space, its spaces become the word mark, and it is cut into words (marks and what follows them), which
no vocabulary string crosses.  The new words of a group of texts lie one after another in flat numpy arrays of symbols, cut
further wherever two characters stand side by side in no vocabulary string.  A round takes the minimum rank of each
segment, merges the leftmost places of that rank in all segments at the same time, and compacts the arrays; segments
without a pair leave them.  What is no vocabulary string at the end becomes the byte strings of its UTF-8.  Decoding joins
the vocabulary strings of the ids.
"""

import codecs
import re
import struct
import sys
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from deskflow.llm.common import per_text, texts_of, worker_memory

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARK = "▁"
_NONE = np.int64(1 << 40)
_AT_ONCE = 1 << 17
# Fixed values of the file format: kinds of vocabulary strings, and the model type of merges.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_MERGES = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of one message of the file."""
    at = 0

    def whole() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = whole()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, whole()
            continue
        size = {1: 8, 5: 4}[kind] if kind != 2 else whole()
        yield tag >> 3, data[at:at + size]
        at += size


def read_model(path: str) -> dict:
    """Vocabulary of a model file: normal strings with scores and ids, byte ids, begin and end ids.

    A file that asks for anything else than plain merges with byte fallback, a leading space and texts as they are is
    refused, since ids would differ without a sign.
    """
    with open(path, "rb") as f:
        data = f.read()
    pieces, trainer, normalizer = [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            part = dict(_fields(value))
            pieces.append((part[1].decode(), struct.unpack("<f", part.get(2, bytes(4)))[0], part.get(3, _NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normalizer = dict(_fields(value))
    kinds = {k for _, _, k in pieces}
    # Fields of the file: 3 model type, 24 marks as suffixes, 35 byte fallback; 2 character map, 3 to 5 spaces, 6 rules.
    if (trainer.get(3) != _MERGES or not trainer.get(35) or trainer.get(24) or not kinds <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
            or normalizer.get(2) or normalizer.get(6) or not normalizer.get(3, 1) or normalizer.get(4, 1) or not normalizer.get(5, 1)):
        raise ValueError("The model file asks for more than merges with byte fallback over texts as they are.")
    number_of = {p: i for i, (p, _, _) in enumerate(pieces)}
    by_byte = [number_of[f"<0x{b:02X}>"] for b in range(256)]
    # Fixed value: what an unknown id decodes to.
    shown = {_UNKNOWN: " \u2047 ", _CONTROL: ""}
    strings = [shown.get(k, p).encode().replace(MARK.encode(), b" ") for p, _, k in pieces]
    for b, i in enumerate(by_byte):
        strings[i] = bytes([b])
    return {"pieces": [(p, s, i) for i, (p, s, k) in enumerate(pieces) if k == _NORMAL], "bytes": by_byte, "strings": strings,
            "quiet": [i for i, (_, _, k) in enumerate(pieces) if k == _CONTROL], "begin": number_of["<s>"], "end": number_of["</s>"]}


class Rounds:
    """Merge table of a vocabulary.  A symbol is the id of its string; beyond the ids come characters that are none."""

    def __init__(self, model: dict):
        pieces = model["pieces"]
        if any(MARK in p.lstrip(MARK) for p, _, _ in pieces):
            raise ValueError("A vocabulary string crosses the start of a word.")
        self.n_ids = len(model["strings"])
        symbol = {p: i for p, _, i in pieces}
        self.by_char = np.arange(self.n_ids, self.n_ids + 0x110000, dtype=np.int64)
        for c in {c for p in symbol for c in p}:
            symbol.setdefault(c, self.n_ids + ord(c))
            self.by_char[ord(c)] = symbol[c]
        self.size = self.n_ids + 0x110000
        order = {s: r for r, s in enumerate(sorted({s for _, s, _ in pieces}, reverse=True))}
        pairs, beside = {}, set()
        for p, score, i in pieces:
            beside.update(symbol[a] * self.size + symbol[b] for a, b in zip(p, p[1:]))
            for cut in range(1, len(p)):
                left, right = symbol.get(p[:cut]), symbol.get(p[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = (order[score], i)
        self.keys = np.array(sorted(pairs), np.int64)
        self.rank = np.array([pairs[k][0] for k in self.keys.tolist()], np.int64)
        self.made = np.array([pairs[k][1] for k in self.keys.tolist()], np.int64)
        self.beside = np.array(sorted(beside), np.int64)

    def _pair(self, left, right):
        """Rank of pairs of symbols, and what they make; no pair has rank _NONE."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], _NONE), self.made[at]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the (non-empty) words one after another, and how many each word has."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.by_char[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        out, place = np.full(len(sym), -1), np.arange(len(sym))
        # A segment ends with its word, or where no vocabulary string has the two characters side by side.
        key = sym[:-1] * self.size + sym[1:]
        meet = np.zeros(len(sym), bool)
        if len(self.beside):
            meet[:-1] = self.beside[np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)] == key
        meet[np.cumsum(length) - 1] = False
        first = np.r_[True, ~meet[:-1]]
        rank, made = np.full(len(sym), _NONE), np.zeros(len(sym), np.int64)
        joined = np.flatnonzero(meet)
        rank[joined], made[joined] = self._pair(sym[joined], sym[joined + 1])
        while len(sym):
            start = np.flatnonzero(first)
            segment = np.cumsum(first) - 1
            lowest = np.minimum.reduceat(rank, start)[segment]
            # Segments without a pair are ready.
            live = lowest < _NONE
            if not live.all():
                out[place[~live]] = sym[~live]
                sym, place, rank, made, first, lowest, segment = (
                    x[live] for x in (sym, place, rank, made, first, lowest, segment))
                if not len(sym):
                    break
            left = self._leftmost(np.flatnonzero(rank == lowest), sym, rank, made, first, lowest, segment)
            keep = np.ones(len(sym), bool)
            keep[left + 1] = False
            sym, place, rank, made, first = (x[keep] for x in (sym, place, rank, made, first))
        ready = out >= 0
        ends = np.cumsum(length)
        return out[ready], np.diff(np.r_[0, np.cumsum(ready)[ends - 1]])

    def _leftmost(self, at, sym, rank, made, first, lowest, segment) -> np.ndarray:
        """Merge places ``at`` of the lowest rank as far as one after another from the left would; gives those merged.

        Of places that overlap every second one is merged.  Where a merge makes a pair of no higher rank, that pair goes
        before the places to its right, so these wait for the next round.
        """
        chain = np.r_[True, np.diff(at) > 1]
        at = at[(np.arange(len(at)) - np.maximum.accumulate(np.where(chain, np.arange(len(at)), 0))) % 2 == 0]
        new, seg = made[at], segment[at]
        n = len(sym)
        # To the left may stand what the place before has just made; to the right nothing is merged yet.
        next_to = np.r_[False, at[:-1] == at[1:] - 2]
        has_left = ~first[at]
        before = np.where(next_to, np.r_[0, new[:-1]], sym[at - 1])
        has_right = (at + 2 < n) & ~first[np.minimum(at + 2, n - 1)]
        rank_left, made_left = self._pair(before, new)
        rank_left[~has_left] = _NONE
        rank_right, made_right = self._pair(new, sym[np.minimum(at + 2, n - 1)])
        rank_right[~has_right] = _NONE
        stop = np.flatnonzero(np.minimum(rank_left, rank_right) <= lowest[at])
        if len(stop):
            limit = np.full(segment[-1] + 1, n)
            np.minimum.at(limit, seg[stop], at[stop])
            go = at <= limit[seg]
            at, new, next_to, has_left, rank_left, made_left, rank_right, made_right = (
                x[go] for x in (at, new, next_to, has_left, rank_left, made_left, rank_right, made_right))
        sym[at] = new
        rank[at], made[at] = rank_right, made_right
        # The pair to the left starts at the place before, or at the one merged before that.
        owner = np.where(next_to, at - 2, at - 1)[has_left]
        rank[owner], made[owner] = rank_left[has_left], made_left[has_left]
        return at


def _one_each(e: UnicodeError) -> tuple[str, int]:
    return "�" * (e.end - e.start), e.end


class Codec:
    """Encodes and decodes texts; remembers words of at most ``memory`` bytes in all."""

    def __init__(self, model: dict, memory: int = 1 << 26):
        kept = worker_memory(f"pieces-{hash((tuple(model['pieces']), tuple(model['bytes'])))}")
        if not kept:
            kept.update(rounds=Rounds(model), seen={}, bytes=0)
        self.kept, self.rounds, self.model, self.memory = kept, kept["rounds"], model, memory
        self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.begin, self.end = (struct.pack("<I", model[x]) for x in ("begin", "end"))
        self.spaced = {i for _, _, i in model["pieces"] if model["strings"][i][:1] == b" "}
        codecs.register_error("one_each", _one_each)

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of at least these words."""
        seen = self.kept["seen"]
        new = words.difference(seen)
        # A dict entry, a str and a bytes object take some 200 bytes besides their content.
        size = sum(200 + 8 * len(w) for w in new)
        if self.kept["bytes"] + size > self.memory and seen:
            seen.clear()
            self.kept["bytes"], new = 0, words
            size = sum(200 + 8 * len(w) for w in new)
        if new:
            listed = list(new)
            symbols, count = self.rounds.encode(listed)
            strange = np.flatnonzero(symbols >= self.rounds.n_ids)
            if len(strange):
                symbols, count = self._fall_back(symbols, count, strange)
            ids, at = symbols.astype("<u4").tobytes(), 0
            for w, n in zip(listed, (4 * count).tolist()):
                seen[w] = ids[at:at + n]
                at += n
            self.kept["bytes"] += size
        return seen

    def _fall_back(self, symbols, count, strange):
        """Bytes in place of the characters that are no vocabulary strings."""
        data = [chr(c).encode() for c in (symbols[strange] - self.rounds.n_ids).tolist()]
        width = np.ones(len(symbols), np.int64)
        width[strange] = [len(d) for d in data]
        out = np.repeat(symbols, width)
        out[np.repeat(symbols >= self.rounds.n_ids, width)] = np.array(self.model["bytes"])[np.frombuffer(b"".join(data), np.uint8)]
        of = np.repeat(np.arange(len(count)), count)
        return out, np.bincount(of, width, len(count)).astype(np.int64)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text with begin and end, as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[self.begin] for _ in texts]
        waiting, size = [], 0

        def flush():
            nonlocal waiting, size
            known = self._learn({w for _, words in waiting for w in words})
            for i, words in waiting:
                out[i].append(b"".join(map(known.__getitem__, words)))
            waiting, size = [], 0

        for i, text in enumerate(texts):
            words = self.words(MARK + text.replace(" ", MARK)) if text else []
            for k in range(0, len(words), _AT_ONCE):
                part = words[k:k + _AT_ONCE]
                waiting.append((i, part))
                size += len(part)
                if size >= _AT_ONCE:
                    flush()
        flush()
        return [b"".join([*parts, self.end]) for parts in out]

    def decode(self, ids: bytes) -> str:
        """The strings of the ids, without the leading space; every byte that is no UTF-8 gives a replacement mark."""
        numbers, strings = np.frombuffer(ids, "<u4"), self.model["strings"]
        quiet = np.flatnonzero(np.isin(numbers, self.model["quiet"]))
        # Bytes on two sides of a control id are no character.
        at, head, parts = 0, -1, []
        for stop in [*quiet.tolist(), len(numbers)]:
            if stop > at:
                parts.append(b"".join(map(strings.__getitem__, numbers[at:stop].tolist())).decode("utf-8", "one_each"))
                head = int(numbers[at]) if len(parts) == 1 else head
            at = stop + 1
        text = "".join(parts)
        # Only a vocabulary string has the added space, not a byte.
        return text[1:] if text[:1] == " " and head in self.spaced else text


def _codes(model, memory):
    codec = Codec(model, memory)

    def work(texts):
        ids = codec.encode(texts)
        return {"ids": ids, "decoded": [codec.decode(i) for i in ids]}

    return work


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                  memory: int = 1 << 26) -> DataFrame:
    """(id, n_tokens, ids, decoded) of every row; ids are packed as little-endian unsigned 32-bit integers.

    ``vocabulary`` is the path of the model file, read once by the driver; its strings go to the tasks with the code.  Null
    and empty texts have the begin and end ids only and decode to an empty text.  Repeated rows are coded one by one, an
    empty table gives no rows, and other columns are not read.  ``memory`` bounds the bytes of the words a Python worker
    remembers; no id depends on it.
    """
    model = read_model(vocabulary)
    rows = texts_of(docs, id_col, text_col)
    coded = rows.select("id", per_text(lambda: _codes(model, memory), "ids binary, decoded string", F.col("text")).alias("c"))
    return coded.select("id", F.expr("octet_length(c.ids) div 4").alias("n_tokens"), "c.ids", "c.decoded")
