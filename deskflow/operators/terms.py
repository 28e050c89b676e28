"""Corpus statistics of words and word pairs."""

from pyspark.sql import Column, DataFrame, functions as F

from deskflow.functions.columns import compute_once
from deskflow.functions.counting import bucket_totals, chosen_terms
from deskflow.functions.text import tokens
from deskflow.sources.stage import stage


def terms(c: Column, pairs: bool = True) -> Column:
    """Words, then neighbouring word pairs, of a text."""
    found = tokens(c)
    if not pairs:
        return found
    following = F.slice(found, F.lit(2), F.greatest(F.size(found) - 1, F.lit(0)))
    bigrams = F.zip_with(F.slice(found, F.lit(1), F.size(following)), following, lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(found, bigrams)


def occurrences(df: DataFrame, text: str) -> DataFrame:
    """Every occurrence of a term, and whether it is the first of its term in the text.

    The terms of a text are sorted, so an occurrence that differs from the one before it is the first.
    """
    found = compute_once(df.select(text), _terms=F.sort_array(terms(F.col(text))))
    beside = F.arrays_zip(F.col("_terms").alias("term"), F.concat(F.array(F.lit(None)), "_terms").alias("before"))
    # The second list is one longer: its last pair has no term.
    pairs = found.select(F.inline(beside).alias("term", "before")).filter(F.col("term").isNotNull())
    is_first = F.col("before").isNull() | (F.col("before") != F.col("term"))
    return pairs.select("term", is_first.cast("int").alias("is_first"))


def _frequencies() -> list[Column]:
    return [F.count("*").alias("tf"), F.sum("is_first").alias("df")]


def term_stats(df: DataFrame, text: str, top: int = 5000) -> DataFrame:
    """Corpus and document frequency of the ``top`` most frequent terms.

    One shuffle of map-side counts gives both frequencies.
    """
    counted = occurrences(df, text).groupBy("term").agg(*_frequencies())
    return counted.orderBy(F.desc("tf"), "term").limit(top)


def term_stats_large(df: DataFrame, text: str, top: int = 5000, buckets: int = 1 << 20) -> DataFrame:
    """The rows of ``term_stats``, without a shuffle of every distinct term.

    Texts are cut into words by Spark, and counted over Arrow batches; no row is made for an occurrence.

    1. All occurrences are counted by ``buckets`` hash buckets of their terms: numbers, at most ``buckets`` a task.
    2. The terms of the ``2 * top`` fullest buckets are counted one by one.  The ``top``-th of these counts is a bound: a
       bucket whose total is below it holds no term of the result.
    3. Only the terms of other buckets that reach the bound are counted as well.  When there is none, no text is read.

    So the result is exact; what the shuffles carry depends on the buckets, and on how many reach the bound.  In
    texts whose terms are all about as rare, that is most of them.  A null text has no term.
    """
    spark = df.sparkSession
    words = df.select(tokens(F.col(text)).alias("words"))
    totals = stage(words.mapInArrow(bucket_totals(buckets), "bucket long, total long").groupBy("bucket").agg(
        F.sum("total").alias("total")), "buckets")

    def counted(chosen: DataFrame) -> DataFrame | None:
        # Numbers of buckets are broadcast, at most ``buckets``.
        numbers = chosen.select("bucket").toArrow().column("bucket").to_numpy()
        if not len(numbers):
            return None
        found = words.mapInArrow(chosen_terms(spark.sparkContext.broadcast(numbers), buckets), "term string, tf long, df long")
        return found.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))

    # The order is total, so each reading chooses the same buckets.
    fullest = totals.orderBy(F.desc("total"), "bucket").limit(2 * top)
    first = counted(fullest)
    if first is None:
        return spark.createDataFrame([], "term string, tf long, df long")
    known = stage(first, "counted")
    best = known.orderBy(F.desc("tf"), "term").limit(top).agg(F.count("*").alias("n"), F.min("tf").alias("least")).first()
    # Every bucket has a term, so with fewer terms than ``top`` all buckets were among the fullest.
    bound = best["least"] if best["n"] == top else 0
    others = counted(totals.filter(F.col("total") >= bound).join(F.broadcast(fullest.select("bucket")), "bucket", "left_anti"))
    found = known if others is None else known.unionByName(others)
    return found.orderBy(F.desc("tf"), "term").limit(top)
