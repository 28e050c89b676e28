"""Deterministic splits and samples.

The random order of a row is md5(seed:id), then the id: the same at any partitioning.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from deskflow import fixed
from deskflow.sources.stage import stage

# 4 hex digits: at most 65,536 histogram rows per class.
_PREFIX_DIGITS = 4


def shuffle_key(id_column: str, seed: int | str = fixed.SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))


def _group_limit(df: DataFrame) -> int:
    """Largest rank bound for which Spark keeps only the first rows of a group before the shuffle."""
    return int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def _ranked(df: DataFrame, class_column: str, id_column: str) -> DataFrame:
    return df.withColumn(
        "_rank", F.row_number().over(W.partitionBy(class_column).orderBy("_key", id_column))
    )


def _cut_by_histogram(df: DataFrame, class_column: str, needed: Column) -> DataFrame:
    """Rows that can be among the first ``needed`` of their class, plus the class size ``_n``.

    A histogram of key prefixes (combined on the map side) tells the prefix at which each class has enough
    rows.  Everything beyond it is dropped where it is read, so no class is ever shuffled or sorted whole.
    """
    prefixed = df.withColumn("_prefix", F.substring("_key", 1, _PREFIX_DIGITS))
    histogram = prefixed.groupBy(class_column, "_prefix").agg(F.count("*").alias("_rows"))
    per_class = W.partitionBy(class_column)
    running = (
        histogram
        .withColumn("_n", F.sum("_rows").over(per_class))
        .withColumn("_before", F.sum("_rows").over(per_class.orderBy("_prefix")) - F.col("_rows"))
    )
    cuts = running.filter(F.col("_before") < needed).groupBy(class_column).agg(
        F.max("_prefix").alias("_cut"), F.first("_n").alias("_n")
    )
    # One row per class; Spark broadcasts it by its measured size.
    return prefixed.join(cuts, class_column).filter(F.col("_prefix") <= F.col("_cut")).drop("_prefix", "_cut")


def split_sizes(n: Column, fractions: Sequence[float], caps: Sequence[int]) -> list[Column]:
    return [F.least(F.floor(n * F.lit(float(f))), F.lit(cap)) for f, cap in zip(fractions, caps)]


def stratified_split(
    df: DataFrame,
    id_column: str = "tweet_id",
    class_column: str = "intent",
    names: Sequence[str] = fixed.SPLITS,
    fractions: Sequence[float] = fixed.SPLIT_FRACTIONS,
    caps: Sequence[int] = fixed.SPLIT_CLASS_CAPS,
    seed: int = fixed.SEED,
) -> DataFrame:
    """Adds ``split``: per class, whatever the classes are, shuffled, a capped fraction for each name; the rest is
    dropped."""
    needed = sum(split_sizes(F.col("_n"), fractions, caps), F.lit(0))
    keyed = df.filter(F.col(class_column).isNotNull()).withColumn("_key", shuffle_key(id_column, seed))
    ranked = _ranked(_cut_by_histogram(keyed, class_column, needed), class_column, id_column)
    upper, split = F.lit(0), F.lit(None).cast("string")
    bounds = []
    for size in split_sizes(F.col("_n"), fractions, caps):
        upper = upper + size
        bounds.append(upper)
    for name, bound in reversed(list(zip(names, bounds))):
        split = F.when(F.col("_rank") <= bound, F.lit(name)).otherwise(split)
    return ranked.withColumn("split", split).filter(F.col("split").isNotNull()).drop("_key", "_rank", "_n")


def cap_splits(
    splits: DataFrame,
    id_column: str = "tweet_id",
    totals: dict[str, int] | None = None,
    seed: int = fixed.SEED,
) -> DataFrame:
    """Shuffle each split as a whole and keep its total; a split without a total stays whole.

    Input: the output of ``stratified_split``, at most classes x class cap rows per split."""
    totals = dict(zip(fixed.SPLITS, fixed.SPLIT_TOTALS)) if totals is None else totals
    keyed = splits.withColumn("_key", shuffle_key(id_column, f"{seed}:total"))
    limit = F.lit(None).cast("int")
    for name, total in totals.items():
        limit = F.when(F.col("split") == name, F.lit(total)).otherwise(limit)
    return _ranked(keyed, "split", id_column).filter(limit.isNull() | (F.col("_rank") <= limit)).drop("_key", "_rank")


def concat_groups(*groups: DataFrame) -> DataFrame:
    """Rows of several groups one after another, columns matched by name; a column that a group lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)


def first_per_class(
    df: DataFrame,
    per_class: int,
    id_column: str = "tweet_id",
    class_column: str = "intent",
    seed: int = fixed.SEED,
) -> DataFrame:
    """At most ``per_class`` random rows of each class."""
    keyed = df.filter(F.col(class_column).isNotNull()).withColumn("_key", shuffle_key(id_column, seed))
    if per_class >= _group_limit(df):
        keyed = _cut_by_histogram(keyed, class_column, F.lit(per_class)).drop("_n")
    return _ranked(keyed, class_column, id_column).filter(F.col("_rank") <= per_class).drop("_key", "_rank")


def random_rows(df: DataFrame, n: int, id_column: str = "tweet_id", seed: int | str = fixed.SEED,
                bounded: bool = False) -> DataFrame:
    """``n`` random rows: each task keeps its first n, then one merge.

    For a large ``n``, rows beyond the key prefix at which n rows are reached go where they are read, so the
    merge gets little more than n rows.  That takes a second pass over ``df``; rows that are ``bounded`` already, as a
    sample by class is, are sorted as they are.
    """
    keyed = df.withColumn("_key", shuffle_key(id_column, seed))
    if n >= _group_limit(df) and not bounded:
        prefix = F.substring("_key", 1, _PREFIX_DIGITS)
        histogram = keyed.groupBy(prefix.alias("_prefix")).agg(F.count("*").alias("_rows"))
        before = F.sum("_rows").over(W.orderBy("_prefix")) - F.col("_rows")
        cut = histogram.withColumn("_before", before).filter(F.col("_before") < n).agg(F.max("_prefix"))
        keyed = keyed.filter(prefix <= cut.scalar())
    return keyed.orderBy("_key", id_column).limit(n).drop("_key")


def stratified_sample(
    df: DataFrame,
    per_class: int,
    total: int,
    id_column: str = "tweet_id",
    class_column: str = "intent",
    seed: int = fixed.SEED,
) -> DataFrame:
    """At most ``per_class`` rows of each class, shuffled and cut to ``total``."""
    sampled = first_per_class(df, per_class, id_column, class_column, seed=seed)
    return random_rows(sampled, total, id_column, f"{seed}:total", bounded=True)


def topped_up_sample(
    df: DataFrame,
    per_class: int,
    total: int,
    id_column: str = "tweet_id",
    class_column: str = "intent",
    seed: int = fixed.SEED,
) -> DataFrame:
    """``stratified_sample``, filled up with random other rows when the classes give fewer than ``total``."""
    sampled = stage(first_per_class(df, per_class, id_column, class_column, seed=seed), "sampled")
    # Of the first rows in the order of the filler, no more can be sampled already than there are samples.
    enough = total + sampled.count()
    others = random_rows(df.filter(F.col(class_column).isNotNull()), enough, id_column, f"{seed}:more")
    filler = others.join(sampled.select(id_column), id_column, "left_anti")
    both = sampled.withColumn("_late", F.lit(0)).unionByName(filler.withColumn("_late", F.lit(1)))
    # Sampled rows come first in one order, the filler behind them in its own.
    key = F.when(F.col("_late") == 0, shuffle_key(id_column, f"{seed}:total")).otherwise(
        shuffle_key(id_column, f"{seed}:more"))
    return both.orderBy("_late", key, id_column).limit(total).drop("_late")
