"""Keeping data sets apart."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from deskflow.functions.columns import compute_once
from deskflow.functions.text import text_key
from deskflow.operators.seen import Seen
from deskflow.sources.stage import stage


def used_keys(*frames: DataFrame, column: str = "tweet") -> DataFrame:
    """Digests of the texts of the given frames, repeated ones included: an anti-join needs no distinct."""
    keys = [f.filter(F.col(column).isNotNull()).select(text_key(F.col(column)).alias("_key")) for f in frames]
    return reduce(DataFrame.unionByName, keys)


def used_texts(*frames: DataFrame, column: str = "tweet") -> DataFrame:
    """Distinct non-null texts of the given frames."""
    texts = [f.select(column).filter(F.col(column).isNotNull()) for f in frames]
    return reduce(DataFrame.unionByName, texts).distinct()


def without_used(pool: DataFrame, used: DataFrame, column: str = "tweet") -> DataFrame:
    """Rows of the pool whose text is not in ``used`` (texts, or keys of ``used_keys``); a null text is kept.

    Joined on a digest: ``used`` is 32 bytes a row, and pool texts nobody reads later are not shuffled.  No
    broadcast hint: Spark broadcasts ``used`` when its measured size allows, and otherwise joins by sort-merge
    with skew handling on the pool side.
    """
    keys = used if used.columns == ["_key"] else used.select(text_key(F.col(column)).alias("_key"))
    return pool.withColumn("_key", text_key(F.col(column))).join(keys, "_key", "left_anti").drop("_key")


def without_used_filtered(pool: DataFrame, used: DataFrame, column: str = "tweet", **size: int) -> DataFrame:
    """The rows of ``without_used``, for a pool and a ``used`` that are both beyond any broadcast.

    The pool is tested where it is read against a Bloom filter of the digests of ``used`` (``size``: parameters of
    ``Seen``).  Rows that cannot match go on without a shuffle; only those that may match are shuffled to be verified.
    The pool is read twice, once for each, so columns that are dear to compute belong in a stage before it.
    """
    keys = used if used.columns == ["_key"] else used.select(text_key(F.col(column)).alias("_key"))
    keys = stage(keys.filter("_key IS NOT NULL"), "used")
    seen = Seen(keys, **size)
    # One digest a row serves the test and the join.
    tested = compute_once(pool, _key=text_key(F.col(column)))
    may = seen.may_hold(F.col("_key"))
    verified = tested.filter(may).join(keys, "_key", "left_anti")
    return tested.filter(~may).unionByName(verified).drop("_key")


def split_overlap(splits: dict[str, DataFrame], column: str = "tweet", large: str | None = None, **size: int) -> DataFrame:
    """Number of distinct texts shared by each pair of splits, zero included.

    The split named ``large`` is tested where it is read against a Bloom filter of all others (``size``: parameters of
    ``Seen``), and only texts that may be in one of them are shuffled.
    """
    names = list(splits)
    keyed = {n: f.filter(F.col(column).isNotNull()).select(text_key(F.col(column)).alias("_key"))
             for n, f in splits.items()}
    if large is not None:
        others = stage(reduce(DataFrame.unionByName, [
            f.withColumn("split", F.lit(n)) for n, f in keyed.items() if n != large]), "used")
        seen = Seen(others.select("_key"), **size)
        tested = compute_once(splits[large].select(column), _key=text_key(F.col(column))).select("_key")
        tagged = others.unionByName(tested.filter(seen.may_hold(F.col("_key"))).withColumn("split", F.lit(large)))
    else:
        tagged = reduce(DataFrame.unionByName, [f.withColumn("split", F.lit(n)) for n, f in keyed.items()])
    flags = tagged.groupBy("_key").agg(*[F.max((F.col("split") == n).cast("int")).alias(n) for n in names])
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    totals = flags.agg(*[
        F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0)).alias(f"_{i}") for i, (a, b) in enumerate(pairs)
    ])
    rows = [F.struct(F.lit(a).alias("split_a"), F.lit(b).alias("split_b"), F.col(f"_{i}").alias("shared"))
            for i, (a, b) in enumerate(pairs)]
    return totals.select(F.inline(F.array(*rows)))
