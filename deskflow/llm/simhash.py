"""Near-duplicate documents by SimHash and multi-index hashing (operator 4).

Fingerprint: lower-cased words (A-Z only, split at ASCII white space), shingles of ``width`` words with repeats, XXH64
of each with seed 42; a bit is set when it is set in more than half of the hashes.  A text of fewer words is one
shingle; one of none has fingerprint zero.

Links: two fingerprints that differ in at most two bits.  The fingerprint is cut into two segments of 32 bits.  If
the upper ones differ in two bits, the lower ones are equal; otherwise the upper ones lie within a ball of radius one.
So each fingerprint looks up its lower segment and the ball of its upper segment in tables of all fingerprints, and
the complete distance of what it meets is checked.  Of the ball, only the variants with a further bit set are looked
up: the other side of the pair looks up the rest.

A bucket of more than ``bucket`` fingerprints would give a square of pairs.  Those who meet such a bucket are linked
exactly and in linear time instead: each looks up the ball of radius one of its *whole* fingerprint; two that meet in a
point are within two bits, and two within two bits meet in a point.  A point has at most 65 fingerprints around it.
"""

import sys

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from deskflow.llm.common import components, per_text, texts_of
from deskflow.sources.stage import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_AT_ONCE = 1 << 17


def fingerprint_of(text: str | None, width: int = 3, seed: int = 42) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashed = xxhash.xxh64_intdigest
    if len(words) < width:
        return hashed(b" ".join(words), seed)
    total, ones = len(words) - width + 1, np.zeros(64, np.int64)
    for start in range(0, total, _AT_ONCE):
        part = words[start:start + _AT_ONCE + width - 1]
        h = [hashed(b" ".join(s), seed) for s in zip(*[part[i:] for i in range(width)])]
        ones += np.unpackbits(np.array(h, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def _fingerprints(width: int, seed: int):
    def work(texts):
        values = np.array([fingerprint_of(t, width, seed) for t in texts], np.uint64)
        return {"f": values.view(np.int64)}

    return work


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                 seed: int = 42) -> DataFrame:
    """(id, key, f): the fingerprint of every row as a signed 64-bit number; ``key`` is a digest of id and text."""
    rows = texts_of(docs, id_col, text_col)
    f = per_text(lambda: _fingerprints(width, seed), "f long", F.col("text"))["f"]
    return rows.select("id", _key(F.col("id"), F.col("text")).alias("key"), f.alias("f"))


def _key(row_id: Column, text: Column) -> Column:
    digest = F.md5(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))
    return F.md5(F.concat(F.coalesce(row_id.cast("string"), F.lit("-")), F.lit(":"), digest).cast("binary"))


def links(distinct: DataFrame, bucket: int = 256) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints (f) just as all pairs within two bits do."""
    low, high = F.expr("f & 4294967295L"), F.expr("shiftrightunsigned(f, 32)")
    # The lower segment has keys of its own, beyond those of the upper one.
    low_key = low + F.lit(1 << 32)
    index = distinct.select("f", F.explode(F.array(high, low_key)).alias("key"))
    ball = F.filter(F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.call_function(
        "shiftleft", F.lit(1).cast("long"), i)), lambda bit: high.bitwiseAND(bit) == 0)
    probes = distinct.select("f", F.explode(F.concat(
        F.array(high, low_key), F.transform(ball, lambda bit: high.bitwiseOR(bit)))).alias("key"))
    full = index.groupBy("key").count().where(F.col("count") > bucket).select("key")

    met = probes.join(full, "key", "left_anti").join(index.withColumnRenamed("f", "g"), "key")
    close = met.where((F.col("f") != F.col("g")) & (F.bit_count(F.col("f").bitwiseXOR(F.col("g"))) <= 2))
    pairs = close.select(F.greatest("f", "g").alias("a"), F.least("f", "g").alias("b"))

    # Both sides of a pair that meets in a full bucket look up its key.
    crowd = probes.join(full, "key", "left_semi").select("f").distinct()
    points = crowd.select("f", F.explode(F.concat(F.array(F.col("f")), F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("f").bitwiseXOR(F.call_function(
            "shiftleft", F.lit(1).cast("long"), i))))).alias("point"))
    stars = points.groupBy("point").agg(F.collect_list("f").alias("all"), F.min("f").alias("b")).where(
        F.size("all") > 1).select(F.explode("all").alias("a"), "b").where("a <> b")
    return pairs.union(stars.select("a", "b"))


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
            bucket: int = 256) -> tuple[DataFrame, DataFrame]:
    """Rows (id, key, f), and (f, least, root) of each distinct fingerprint, the root being the same in a component."""
    rows = stage(fingerprints(docs, id_col, text_col, width), "fingerprints")
    # A hot group of copies is one row per task before the shuffle.
    distinct = stage(rows.groupBy("f").agg(F.min("id").alias("least")), "distinct")
    found = components(links(distinct.select("f"), bucket)).withColumnRenamed("node", "f")
    return rows, stage(distinct.join(found, "f", "left").withColumn("root", F.coalesce("root", "f")), "roots")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    bucket: int = 256) -> DataFrame:
    """(id, f, component): every row with its fingerprint and the smallest id of its component.

    Null text: fingerprint zero, linked like any other.  A null id never names a component, unless all ids of
    it are null.  Repeated rows stay repeated.  An empty table gives no rows.
    """
    rows, roots = grouped(docs, id_col, text_col, width, bucket)
    named = roots.groupBy("root").agg(F.min("least").alias("component"))
    return rows.join(roots.join(named, "root").select("f", "component"), "f").select("id", "f", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = 256) -> DataFrame:
    """One row of ``docs`` per component: that with the smallest id (null ids last), of equal ids that of the smallest
    digest, of repeated rows any."""
    rows, roots = grouped(docs, id_col, text_col, bucket=bucket)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("key")))
    # First per fingerprint, so that copies are united before components are.
    best = rows.groupBy("f").agg(first.alias("best")).join(roots, "f").groupBy("root").agg(F.min("best").alias("best"))
    keep = best.select(F.col("best.key").alias("_key"))
    # The columns travel as one, so that none can clash with the key.
    keyed = docs.select(F.struct("*").alias("_row"), _key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")).alias(
        "_key"))
    return keyed.join(keep, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")
