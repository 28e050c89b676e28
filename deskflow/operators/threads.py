"""Question / reply pairs from a flat table of posts."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from deskflow import fixed
from deskflow.functions.columns import compute_once
from deskflow.functions.text import clean_text, parse_flag, text_key


def keep_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First row per key.

    A minimum over (order columns, rest) is combined on the map side, so the shuffle carries at most one
    row per key and task, however many copies a hot key has.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    first = df.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(key, "_first.*").select(*df.columns)


def dedupe_text(df: DataFrame, text: str, order: Sequence[str], keep_text: bool = True) -> DataFrame:
    """First row per text, grouped by a digest; without ``keep_text`` the text is not shuffled at all."""
    keyed = df.withColumn("_key", text_key(F.col(text)))
    return keep_first(keyed if keep_text else keyed.drop(text), "_key", order).drop("_key")


def customer_posts(posts: DataFrame) -> DataFrame:
    return posts.filter(parse_flag(F.col("inbound")))


def brand_posts(posts: DataFrame, brand: str = fixed.BRAND) -> DataFrame:
    return posts.filter(F.col("author_id") == brand)


def first_replies(posts: DataFrame, brand: str = fixed.BRAND) -> DataFrame:
    """Earliest reply of the brand to each post it answered."""
    replies = (
        brand_posts(posts, brand)
        .filter(F.col("in_response_to_tweet_id").isNotNull())
        .select("in_response_to_tweet_id", "created_at", "tweet_id", "text")
    )
    first = keep_first(replies, "in_response_to_tweet_id", ["created_at", "tweet_id"])
    return first.select("in_response_to_tweet_id", F.col("text").alias("gold_reply"))


def thread_pairs(posts: DataFrame, brand: str = fixed.BRAND) -> DataFrame:
    """Each customer post with the first reply of the brand; unanswered posts drop out.

    The reply side has one row per key and is already partitioned by it after ``first_replies``.
    """
    asked = customer_posts(posts).select("tweet_id", "created_at", "text")
    replies = first_replies(posts, brand).withColumnRenamed("in_response_to_tweet_id", "tweet_id")
    return asked.join(replies.filter(F.col("gold_reply").isNotNull()), "tweet_id")


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that have a value in each of the columns."""
    return df.dropna(how="any", subset=list(columns))


def long_enough(df: DataFrame, columns: Sequence[str], chars: int = fixed.MIN_CHARS) -> DataFrame:
    for c in columns:
        df = df.filter(F.length(c) >= chars)
    return df


def thread_levels(posts: DataFrame, brand: str = fixed.BRAND, levels: Sequence[int] = (fixed.MIN_CHARS,)) -> DataFrame:
    """Cleaned pairs, one row per question text, for several minimum lengths in one pass.

    Columns: tweet, and for each level n the struct first_n (created_at, tweet_id, gold_reply) of the first post
    with that text whose reply has n characters (null when there is none).
    """
    chars = min(levels)
    # Cleaning never lengthens a text, so posts too short as written can go before the join.
    candidates = posts.filter(F.length("text") >= chars) if chars else posts
    asked = customer_posts(candidates).select("tweet_id", "created_at", "text")
    replies = first_replies(posts, brand).withColumnRenamed("in_response_to_tweet_id", "tweet_id")
    pairs = asked.join(replies.filter(F.length("gold_reply") >= chars), "tweet_id")
    cleaned = compute_once(
        pairs.select("tweet_id", "created_at", "text", F.col("gold_reply").alias("answer")),
        tweet=clean_text(F.col("text")), gold_reply=clean_text(F.col("answer")),
    ).drop("text", "answer")
    # Cleaned text is pure ASCII: of the mostly-ASCII test only its minimum of 5 characters is left.
    kept = long_enough(cleaned, ["tweet", "gold_reply"], max(chars, 5))
    post = F.struct("created_at", "tweet_id", "gold_reply")
    return kept.groupBy("tweet").agg(*[
        F.min(F.when(F.length("gold_reply") >= n, post)).alias(f"first_{n}") for n in levels
    ])


def threads_at(levels: DataFrame, chars: int) -> DataFrame:
    """The threads of one minimum length: the other columns of the table, tweet_id, created_at, gold_reply."""
    others = [c for c in levels.columns if not c.startswith("first_")]
    first = F.col(f"first_{chars}")
    long = levels.filter((F.length("tweet") >= chars) & first.isNotNull())
    return long.select(*others, *[first[c].alias(c) for c in ("tweet_id", "created_at", "gold_reply")])


def build_threads(posts: DataFrame, brand: str = fixed.BRAND, min_chars: int = fixed.MIN_CHARS) -> DataFrame:
    """Cleaned, filtered pairs, one per question text: tweet, tweet_id, created_at, gold_reply."""
    return threads_at(thread_levels(posts, brand, (min_chars,)), min_chars)


def turn_pairs(conversations: DataFrame, span: int = 4096) -> DataFrame:
    """Each user turn with the assistant turn that follows it, also across a gap in the numbers.

    Rows that repeat a turn follow each other by role, then text (null first).

    Turns are ordered within ranges of ``span`` numbers, so a very long conversation spreads over all tasks.  The last
    turn of a range is followed by the first of the next range that has any; only these first turns, one per range,
    are ordered by conversation.
    """
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("_range", F.floor(F.col("turn") / span))
    one = W.partitionBy("conv_id", "_range").orderBy("turn", "role", "text")
    first = rows.groupBy("conv_id", "_range").agg(F.min(F.struct("turn", "role", "text")).alias("_head"))
    after = first.select("conv_id", "_range", F.lead("_head").over(
        W.partitionBy("conv_id").orderBy("_range")).alias("_head"))
    paired = rows.withColumn("_next", F.lead(F.struct("turn", "role", "text")).over(one))
    inside = paired.filter("_next IS NOT NULL")
    # Only the last turn of a range needs the next range.
    edge = paired.filter("_next IS NULL").drop("_next").join(after, ["conv_id", "_range"]).withColumnRenamed("_head", "_next")
    both = inside.unionByName(edge).filter("role = 'user' AND _next.role = 'assistant'")
    return both.select("conv_id", "turn", F.col("text").alias("tweet"), F.col("_next.text").alias("gold_reply"))
