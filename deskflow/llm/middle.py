"""Fill-in-the-middle transformation of texts (operator 12).

A text is a row of units: white space and the word after it; white space that ends the text is one of its own.  The UTF-8
bytes of a text are cut into blocks of fixed size, and a Fenwick tree over the blocks holds how many units end and how
many code points begin in each.  A cut after so many units is found by a binary-lifting descent to its block, which
brings the code points before the block with it; only inside that block bytes are looked at.

The draws come from the SHA-256 of seed and id, so they are the same at any partitioning and after any retry.
"""

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from deskflow.llm.common import AT_ONCE

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLOCK = 1024
_BYTES_AT_ONCE = 1 << 22
_KIND = "n long, form string, prefix_chars long, middle_chars long, output string"


class Fenwick:
    """One Fenwick tree per text over its blocks, all in flat arrays; several counts a block."""

    def __init__(self, counts: list[np.ndarray], blocks: np.ndarray):
        self.blocks = blocks
        self.first = np.cumsum(blocks) - blocks
        place = np.arange(int(blocks.sum())) - np.repeat(self.first, blocks) + 1
        low = place & -place
        at = np.arange(len(place))
        self.trees = []
        for c in counts:
            before = np.r_[0, np.cumsum(c)]
            self.trees.append(before[at + 1] - before[at + 1 - low])

    def descend(self, who: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Block where the ``wanted``-th unit (from 1) of each text ends, what is wanted of it, and other counts before it."""
        at, others = np.zeros(len(who), np.int64), [np.zeros(len(who), np.int64) for _ in self.trees[1:]]
        step = 1 << int(self.blocks[who].max(initial=1)).bit_length()
        while step:
            ahead = at + step
            inside = ahead <= self.blocks[who]
            node = self.first[who] + np.where(inside, ahead, 1) - 1
            go = inside & (self.trees[0][node] < wanted)
            wanted = wanted - np.where(go, self.trees[0][node], 0)
            for other, tree in zip(others, self.trees[1:]):
                other += np.where(go, tree[node], 0)
            at = np.where(go, ahead, at)
            step >>= 1
        return at, wanted, others


class Units:
    """Units and code points of texts that lie one after another in ``data``."""

    def __init__(self, data: np.ndarray, low: np.ndarray, high: np.ndarray, block: int):
        self.low, self.high, self.block = low, high, block
        white = (data == 32) | ((data >= 9) & (data <= 13))
        self.ends = ~white
        self.ends[:-1] &= white[1:]
        # The last unit ends with the text, whatever stands there.
        self.ends[high[high > low] - 1] = True
        self.heads = (data & 0xC0) != 0x80
        blocks = -(-(high - low) // block)
        first = np.cumsum(blocks) - blocks
        start = np.repeat(low - first * block, blocks) + np.arange(int(blocks.sum())) * block
        if len(start):
            units, points = (np.add.reduceat(x.astype(np.int64), start) for x in (self.ends, self.heads))
        else:
            units = points = np.zeros(0, np.int64)
        self.tree = Fenwick([units, points], blocks)
        self.n = np.zeros(len(low), np.int64)
        np.add.at(self.n, np.repeat(np.arange(len(low)), blocks), units)

    def cut(self, who: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and code points of the first ``units`` units of texts."""
        size, points = np.zeros(len(who), np.int64), np.zeros(len(who), np.int64)
        some = np.flatnonzero(units > 0)
        block, rest, (before,) = self.tree.descend(who[some], units[some])
        for i, t, b, r, p in zip(some.tolist(), who[some].tolist(), block.tolist(), rest.tolist(), before.tolist()):
            a = self.low[t] + b * self.block
            stop = a + int(np.flatnonzero(self.ends[a:min(a + self.block, self.high[t])])[r - 1]) + 1
            size[i], points[i] = stop - self.low[t], p + int(np.count_nonzero(self.heads[a:stop]))
        return size, points


def _parts(texts: pa.Array, at_once: int) -> Iterator[slice]:
    """Stretches of a batch of so many bytes, or of one longer text, and at most AT_ONCE texts."""
    size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), np.int64)
    start = total = 0
    for i, n in enumerate(size.tolist()):
        if i > start and (total + n > at_once or i - start >= AT_ONCE):
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(size):
        yield slice(start, len(size))


def _transformed(texts: list[bytes], draws: np.ndarray, rate: int, spm: int, block: int) -> pa.Array:
    length = np.array([len(t) for t in texts], np.int64)
    high = np.cumsum(length)
    low = high - length
    units = Units(np.frombuffer(b"".join(texts), np.uint8), low, high, block)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    plain = (draws[2] % 100 >= rate) | np.array([not t or any(m in t for m in marks) for t in texts], bool)
    cut_a, cut_b = draws[0] % (units.n + 1), draws[1] % (units.n + 1)
    who = np.flatnonzero(~plain)
    (a, a_points), (b, b_points) = (units.cut(who, f(cut_a, cut_b)[who]) for f in (np.minimum, np.maximum))
    out, form = list(texts), np.where(plain, "plain", np.where(draws[3] % 100 < spm, "spm", "psm"))
    for t, i, j in zip(who.tolist(), a.tolist(), b.tolist()):
        text = texts[t]
        prefix, middle, suffix = text[:i], text[i:j], text[j:]
        out[t] = b"".join([marks[1], suffix, marks[0], prefix, marks[2], middle] if form[t] == "spm" else
                          [marks[0], prefix, marks[1], suffix, marks[2], middle])
    chars = np.zeros((2, len(texts)), np.int64)
    chars[0, who], chars[1, who] = a_points, b_points - a_points
    return pa.StructArray.from_arrays(
        [pa.array(units.n), pa.array(form, pa.string()), pa.array(chars[0], mask=plain), pa.array(chars[1], mask=plain),
         pa.array(out, pa.binary()).cast(pa.string())], ["n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50,
                   spm: int = 80, block: int = BLOCK) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row.

    ``rate`` of a hundred texts are cut into prefix, middle and suffix at two drawn units; of those ``spm`` of a hundred
    have the suffix first.  A text that is empty or holds a mark stays plain, without counts.  Null text: empty.  Null
    id: drawn as an empty one.  Repeated rows give equal results, an empty table none; other columns are not read.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    draws = F.array(*[F.conv(F.substring(key, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, drawn in batches:
            for part in _parts(texts, _BYTES_AT_ONCE):
                n = part.stop - part.start
                whole = texts.slice(part.start, n).cast(pa.binary()).to_pylist()
                numbers = np.asarray(drawn.slice(part.start, n).flatten(), np.int64).reshape(n, 4).T
                yield _transformed([t or b"" for t in whole], numbers, rate, spm, block)

    made = docs.select(F.col(f"`{id_col}`").alias("id"), F.arrow_udf(run, _KIND)(
        F.col(f"`{text_col}`").cast("string"), draws).alias("m"))
    return made.select("id", "m.*")


def restored(form: Column, output: Column) -> Column:
    """The text an output was made from."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return F.when(form == "plain", output).when(form == "psm", F.concat(part[1], part[3], part[2])).when(
        form == "spm", F.concat(part[2], part[3], part[1]))
