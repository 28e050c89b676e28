"""A Bloom filter of keys, for rows that most likely match nothing.

Each key sets four bits of one 64-bit word.  The words are made by an aggregate that combines in each task, and come to
the tasks as arrays from scalar subqueries, so a row is tested where it is read, by native expressions.  A key that
was put in is always found; others are found at times, so what is found has to be verified.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from deskflow.sources.stage import stage

BITS_PER_KEY = 16
# Words of one array (8 MB), and arrays at most: 64 MB, which 33 million keys fill.  More keys only raise the share of
# rows that are verified in vain.
PART_WORDS = 1 << 20
MAX_PARTS = 8


def _spots(key: Column, words: int, part_words: int) -> tuple[Column, Column, Column]:
    """Number of the array, place in it, and the four bits of a key."""
    place = F.pmod(F.xxhash64(key), F.lit(words))
    bits = F.xxhash64(key, F.lit(1))
    # Four groups of 6 bits.
    masks = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(bits, 6 * i).bitwiseAND(
        F.lit(63)).cast("int")) for i in range(4)]
    mask = reduce(Column.bitwiseOR, masks)
    return F.floor(place / F.lit(part_words)).cast("int"), (place % part_words).cast("int"), mask


class Seen:
    """Filter of the keys of a frame (one column; null is no key), sized by their number, repeated ones included.

    An empty frame gives a filter that finds nothing.  The filter lives in a stage table of at most
    ``max_parts * part_words`` rows.
    """

    def __init__(self, keys: DataFrame, bits_per_key: int = BITS_PER_KEY, part_words: int = PART_WORDS,
                 max_parts: int = MAX_PARTS):
        spark = keys.sparkSession
        key = F.col(keys.columns[0])
        keys = keys.filter(key.isNotNull())
        self.n_keys = keys.count()
        wanted = max(1, -(-self.n_keys * bits_per_key // 64))
        self.words = min(wanted, part_words * max_parts)
        self.part_words = min(part_words, self.words)
        self.parts = -(-self.words // self.part_words)
        part, place, mask = _spots(key, self.words, self.part_words)
        set_bits = keys.select(part.alias("part"), place.alias("place"), mask.alias("bits"))
        number = F.col("id")
        empty = spark.range(self.words).select(
            F.floor(number / self.part_words).cast("int").alias("part"), (number % self.part_words).cast("int").alias("place"),
            F.lit(0).cast("long").alias("bits"))
        rows = set_bits.unionByName(empty).groupBy("part", "place").agg(F.bit_or("bits").alias("bits"))
        self.table = stage(rows, "seen")

    def _array(self, part: int) -> Column:
        ordered = F.sort_array(F.collect_list(F.struct("place", "bits")))
        return self.table.filter(F.col("part") == part).agg(ordered["bits"].alias("bits")).scalar()

    def may_hold(self, key: Column) -> Column:
        """False only for keys that were not put in; false for null."""
        part, place, mask = _spots(key, self.words, self.part_words)
        word = F.get(self._array(0), place)
        for p in range(1, self.parts):
            word = F.when(part == p, F.get(self._array(p), place)).otherwise(word)
        return key.isNotNull() & (word.bitwiseAND(mask) == mask)
