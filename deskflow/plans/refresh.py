"""The thread table kept up to date as parts of the posts arrive.

A manifest knows every part (file) of the posts by path, size and time, and by a hash of its rows.  A run reads the parts it
does not know and merges them into state tables:

* ``asked``: customer posts that can be questions, answered or not, for replies still to come;
* ``replies``: per post the first reply so far; a new row is written only when an earlier reply has arrived;
* ``pairs``: cleaned questions with the reply that was first at the time;
* ``threads``: the thread table, one row per text.

The first three only grow, by one folder per run (a generation), and are folded into one from time to time.  They are met with
what is new by its keys, so as long as that is small Spark sends it to where the state is read and shuffles no state.  A pair is
void when its post got an earlier reply in a later generation; texts of void pairs are worked out again from all their pairs,
all other texts are a minimum of old and new.  Of the thread table rows without news are copied.

The manifest of a generation is written last.  A run that fails leaves folders nobody reads, which the next run replaces.
"""

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from deskflow import fixed
from deskflow.functions.columns import compute_once
from deskflow.functions.text import clean_text, text_key
from deskflow.operators.threads import brand_posts, customer_posts
from deskflow.plans.datasets import label_intents
from deskflow.sources.stage import exists, folders, remove, scratch, stage

LEVELS = (fixed.MIN_CHARS, fixed.GOLDEN_MIN_CHARS)


def listed_parts(spark: SparkSession, path: str) -> DataFrame:
    """(file, path, length, modified) of the Parquet files of a folder; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(F.col("_metadata.file_path").alias("file"), "path", "length",
                        F.col("modificationTime").alias("modified"))


def part_hashes(posts: DataFrame) -> DataFrame:
    """(file, rows, total) of every file with rows: their number and the sum of their hashes."""
    return posts.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.sum(F.xxhash64(*posts.columns).cast("decimal(38,0)")).alias("total"))


def manifest_of(spark: SparkSession, folder: str) -> tuple[int, DataFrame | None]:
    """Number and manifest of the last complete generation; 0 and None without one."""
    done = [int(n) for n in folders(spark, folder, "manifest-") if exists(spark, f"{folder}/manifest-{n}")]
    return (max(done), spark.read.parquet(f"{folder}/manifest-{max(done)}")) if done else (0, None)


def _lowest(replies: DataFrame) -> DataFrame:
    return replies.groupBy("tweet_id").agg(F.min("r").alias("r"), F.max("generation").alias("generation"))


def _only(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return rows.join(keys.select(key).distinct(), key, "left_semi")


class _State:
    """Tables of the generations from ``base`` to ``last``."""

    def __init__(self, spark: SparkSession, folder: str, base: int, last: int):
        self.spark, self.folder, self.base, self.last = spark, folder, base, last

    def path(self, name: str, generation: int) -> str:
        return f"{self.folder}/{name}-{generation}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(*[self.path(name, g) for g in range(self.base, self.last + 1)])

    def threads(self) -> DataFrame:
        return self.spark.read.parquet(self.path("threads", self.last))

    def write(self, name: str, generation: int, rows: DataFrame) -> DataFrame:
        rows.write.mode("overwrite").parquet(self.path(name, generation))
        return self.spark.read.parquet(self.path(name, generation))


def _first_replies(posts: DataFrame, brand: str) -> DataFrame:
    replies = brand_posts(posts, brand).filter("in_response_to_tweet_id IS NOT NULL")
    return replies.groupBy(F.col("in_response_to_tweet_id").alias("tweet_id")).agg(
        F.min(F.struct("created_at", F.col("tweet_id").alias("reply_id"), "text")).alias("r"))


def _cleaned_pairs(asked: DataFrame, replies: DataFrame, chars: int) -> DataFrame:
    """(key, tweet, tweet_id, created_at, gold_reply) of answered questions that are long enough."""
    answers = replies.select("tweet_id", F.col("r.text").alias("answer")).filter(F.length("answer") >= chars)
    cleaned = compute_once(asked.join(answers, "tweet_id"), tweet=clean_text(F.col("text")),
                           gold_reply=clean_text(F.col("answer")))
    least = max(chars, 5)
    kept = cleaned.filter((F.length("tweet") >= least) & (F.length("gold_reply") >= least))
    return kept.select(text_key(F.col("tweet")).alias("key"), "tweet", "tweet_id", "created_at", "gold_reply")


def _levels(pairs: DataFrame, levels: Sequence[int]) -> DataFrame:
    post = F.struct("created_at", "tweet_id", "gold_reply")
    return pairs.select("key", "tweet", *[F.when(F.length("gold_reply") >= n, post).alias(f"first_{n}") for n in levels])


def _merge(state: _State | None, out: _State, posts: DataFrame, brand: str, rules, levels) -> None:
    """Write the generation ``out`` that adds ``posts`` to the state."""
    chars, generation = min(levels), out.last
    asked = out.write("asked", generation, customer_posts(posts).filter(F.length("text") >= chars).select(
        "tweet_id", "created_at", "text"))
    found = _first_replies(posts, brand).withColumn("generation", F.lit(generation))
    if state is None:
        replies = out.write("replies", generation, found)
        pairs = out.write("pairs", generation, _cleaned_pairs(asked, replies, chars).withColumn(
            "generation", F.lit(generation)))
        fresh = _levels(pairs, levels).groupBy("key", "tweet").agg(*[F.min(f"first_{n}").alias(f"first_{n}") for n in levels])
        out.write("threads", generation, label_intents(fresh, rules))
        return
    found = stage(found, "found")
    before = _lowest(_only(state.read("replies"), found, "tweet_id")).select("tweet_id", F.col("r").alias("_old"))
    compared = stage(found.join(before, "tweet_id", "left").filter(F.col("_old").isNull() | (F.col("r") < F.col("_old"))),
                     "compared")
    replies = out.write("replies", generation, compared.drop("_old"))
    touched = stage(_only(state.read("asked"), replies, "tweet_id").unionByName(asked), "touched")
    every_reply = state.read("replies").unionByName(replies)
    pairs = out.write("pairs", generation, _cleaned_pairs(
        touched, _lowest(_only(every_reply, touched, "tweet_id")), chars).withColumn("generation", F.lit(generation)))
    # Texts of which a pair is void now, and all their pairs that still hold.
    old_pairs = state.read("pairs")
    replaced = compared.filter("_old IS NOT NULL")
    again = stage(_only(old_pairs, replaced, "tweet_id").select("key").distinct(), "again")
    candidates = stage(_only(old_pairs, again, "key"), "candidates")
    since = _lowest(_only(every_reply, candidates, "tweet_id")).select("tweet_id", F.col("generation").alias("_since"))
    holding = candidates.join(since, "tweet_id").filter("generation >= _since")
    # Texts with a new pair and no void one start from what they had.
    news = pairs.select("key").distinct()
    old = state.threads()
    had = _only(old, news.join(again, "key", "left_anti"), "key").drop("intent")
    rows = _levels(pairs, levels).unionByName(_levels(holding, levels)).unionByName(had)
    fresh = rows.groupBy("key", "tweet").agg(*[F.min(f"first_{n}").alias(f"first_{n}") for n in levels])
    kept = old.join(news.union(again).distinct(), "key", "left_anti")
    out.write("threads", generation, kept.unionByName(label_intents(fresh, rules)))


def _fold(state: _State, out: _State) -> None:
    """Write the whole state as one generation: first replies and holding pairs only."""
    generation = out.last
    since = _lowest(state.read("replies"))
    pairs = state.read("pairs").join(since.select("tweet_id", F.col("generation").alias("_since")), "tweet_id").filter(
        "generation >= _since").drop("_since")
    out.write("asked", generation, state.read("asked").distinct())
    out.write("replies", generation, since.withColumn("generation", F.lit(generation)))
    out.write("pairs", generation, pairs.withColumn("generation", F.lit(generation)).distinct())
    out.write("threads", generation, state.threads())


def refresh_threads(
    spark: SparkSession, path: str, folder: str, brand: str = fixed.BRAND,
    rules: Sequence[tuple[str, str]] = fixed.INTENT_RULES, levels: Sequence[int] = LEVELS, fold: int = 16,
) -> DataFrame:
    """Thread table of the Parquet posts under ``path``, as ``thread_table`` gives it, with its state under ``folder``.

    New parts are merged.  A known part that was moved or touched is recognised by its rows.  A part that is gone or has
    changed, or other settings, mean a new start from all parts.  Parts may come in any order and hold any posts.  After
    ``fold`` generations the state is folded into one, and the folders it replaces are removed.  The driver holds the paths
    of new parts.  One run at a time may work on a folder, and what it returns may be read until the next.
    """
    settings = hashlib.sha256(repr((brand, tuple(map(tuple, rules)), tuple(levels))).encode()).hexdigest()
    with scratch(spark):
        last, known = manifest_of(spark, folder)
        listed = stage(listed_parts(spark, path), "listed")
        name = ["file", "length", "modified"]
        if known is not None:
            head = known.select("base", "settings").first()
            base, seen = head["base"], known.drop("base", "settings")
        else:
            base, seen = 0, listed.limit(0).select(*name, F.lit(0).cast("long").alias("rows"),
                                                   F.lit(0).cast("decimal(38,0)").alias("total"))
        anew = known is None or head["settings"] != settings
        unknown = stage(listed.join(seen, name, "left_anti"), "unknown")
        gone = seen.join(listed, name, "left_anti")
        places = _paths(unknown)
        if not anew and not places and gone.isEmpty():
            return _result(_State(spark, folder, base, last))
        hashes = part_hashes(spark.read.parquet(*places)) if places else seen.select("file", "rows", "total").limit(0)
        marked = stage(unknown.join(hashes, "file", "left").select(
            *name, "path", F.coalesce("rows", F.lit(0)).alias("rows"),
            F.coalesce("total", F.lit(0).cast("decimal(38,0)")).alias("total")), "marked")
        # Each known part must still be there: under its name and time, or with the same rows under another.
        same = ["rows", "total"]
        missed = gone.groupBy(*same).agg(F.count("*").alias("_missed"))
        came = marked.groupBy(*same).agg(F.count("*").alias("_came"))
        anew = anew or not missed.join(came, same, "left").filter("coalesce(_came, 0) < _missed").isEmpty()
        if anew:
            new = _paths(listed)
        else:
            numbered = marked.withColumn("_at", F.row_number().over(W.partitionBy(*same).orderBy("file")))
            new = _paths(numbered.join(missed, same, "left").filter("_missed IS NULL OR _at > _missed"))
        if anew and not new:
            raise ValueError(f"no Parquet file under {path}")
        generation = last + 1
        old, out = _State(spark, folder, base, last), _State(spark, folder, generation, generation)
        # Parts that only moved bring no rows, but a manifest and so a generation of their own.
        rows = spark.read.parquet(*(new or places or _paths(listed)))
        _merge(None if anew else old, out, rows if new else rows.limit(0), brand, rules, levels)
        base = generation if anew else base
        if generation - base >= fold:
            generation += 1
            _fold(_State(spark, folder, base, generation - 1), _State(spark, folder, generation, generation))
            base = generation
        manifest = marked.drop("path").unionByName(seen.join(listed, name, "left_semi")).withColumns(
            {"base": F.lit(base), "settings": F.lit(settings)})
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest-{generation}")
        _clear(spark, folder, base, generation)
        return _result(_State(spark, folder, base, generation))


def _paths(parts: DataFrame) -> list[str]:
    return [r["path"] for r in parts.select("path").collect()]


def _clear(spark: SparkSession, folder: str, base: int, last: int) -> None:
    """Remove what no later run reads: generations before ``base``, thread tables and manifests before ``last``."""
    for name, first in (("asked", base), ("replies", base), ("pairs", base), ("threads", last), ("manifest", last)):
        for n in folders(spark, folder, f"{name}-"):
            if int(n) < first:
                remove(spark, f"{folder}/{name}-{n}")


def _result(state: _State) -> DataFrame:
    return state.threads().drop("key")
