"""Question / reply pairs and running counts from arriving posts, with state."""

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from deskflow import fixed
from deskflow.functions.text import parse_flag
from deskflow.sources import stage
from deskflow.streaming.routing import route_messages

ASKED = "struct<at: bigint, new: int, created_at: timestamp, text: string>"
REPLY = "struct<created_at: timestamp, id: string, new: int, text: string>"
STATE = f"post string, asked {ASKED}, reply {REPLY}, done boolean, settled boolean, kept boolean"


def slice_of(time: Column, slice_seconds: int) -> Column:
    """Start of the slice of a time, in milliseconds."""
    return F.floor(F.unix_seconds(time) / slice_seconds) * (slice_seconds * 1000)


def arrived(posts: DataFrame, brand: str, slice_seconds: int) -> DataFrame:
    """What each post with a time is: a question under its own id, a reply under the id it answers, both, or neither.

    The fields of a question and a reply are in the order in which the first of several is found; what is in the state
    goes before what is new, where that is equal.
    """
    time, target = F.col("created_at"), F.col("in_response_to_tweet_id")
    new, nobody = F.lit(1).alias("new"), F.lit(None)
    asked = F.struct(slice_of(time, slice_seconds).alias("at"), new, time.alias("created_at"), F.col("text").alias("text"))
    reply = F.struct(time.alias("created_at"), F.coalesce(F.col("tweet_id").cast("string"), F.lit("")).alias("id"), new,
                     F.col("text").alias("text"))

    def part(post, question, answer):
        return F.struct(post.cast("string").alias("post"), question.cast(ASKED).alias("asked"), answer.cast(REPLY).alias("reply"))

    kinds = F.array(
        F.when(parse_flag(F.col("inbound")) & F.col("tweet_id").isNotNull(), part(F.col("tweet_id"), asked, nobody)),
        F.when((F.col("author_id") == brand) & target.isNotNull(), part(target, nobody, reply)),
    )
    return posts.select(F.inline(F.filter(kinds, lambda k: k.isNotNull()))).withColumn("done", F.lit(False))


def settle(posts: DataFrame, now: int, keep_ms: int, slice_seconds: int) -> DataFrame:
    """The state of each post once the watermark is ``now``, from what is known and what is new of it.

    ``settled`` are the posts whose first reply the watermark has reached just now, ``kept`` those the next batch needs.
    First ones are minima, combined on the map side, so a post with very many replies does not fill a task.
    """
    rows = posts.groupBy("post").agg(F.min("asked").alias("asked"), F.min("reply").alias("reply"), F.max("done").alias("done"))
    both = F.col("asked").isNotNull() & F.col("reply").isNotNull()
    reply_at = slice_of(F.col("reply.created_at"), slice_seconds)
    settled = both & ~F.col("done") & (reply_at <= now)
    waits = both & ~F.col("done") & (reply_at > now)
    fresh = F.coalesce(F.col("asked.at"), reply_at) + keep_ms >= now
    return rows.select("*", settled.alias("settled"), (waits | fresh).alias("kept")).filter("settled OR kept")


def known(spark: SparkSession, folder: str) -> DataFrame:
    """What the batch before has kept; of a post that is done only the mark."""
    rows = spark.read.schema(STATE).parquet(f"{folder}/posts").filter("kept")
    done = F.col("done") | F.col("settled")

    def field(name: str) -> Column:
        c = F.col(name)
        marked = c.withField("new", F.lit(0)).withField("text", F.when(~done, c["text"]))
        return F.when(c.isNotNull(), marked).alias(name)

    return rows.select("post", field("asked"), field("reply"), done.alias("done"))


def thread_pairs_stream(
    posts: DataFrame, path: str, checkpoint: str, brand: str = fixed.BRAND, delay: str = "1 hour", keep: str = "30 days",
    slice_seconds: int = 60,
) -> StreamingQuery:
    """Write the pairs of ``thread_pairs`` settled by the posts that have arrived so far, each exactly once.

    Time is that of the posts, of any author, in slices of ``slice_seconds``.  A reply is settled when the watermark (the latest
    slice less ``delay``) has reached its slice; posts that arrive at or behind the watermark of the batch before are late and
    left out.  So the order of arrival within ``delay`` does not matter, and the last pairs come when later posts have arrived.
    A question waits ``keep`` for a reply, and a reply for its question; the mark of a post that is done stays as long.
    Both bound the state.

    Posts without a time or an id are left out; of several questions with one id the earliest counts; a first reply
    without text gives no pair.

    The state is a table under the checkpoint, one row a post, joined with what is new by one grouping a batch.  A batch that is
    repeated starts from the state of the batch before it and replaces its own pairs.
    """
    delay_ms, keep_ms = (int(pd.Timedelta(t).total_seconds() * 1000) for t in (delay, keep))
    states = f"{checkpoint}/threads"

    def merge(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        before, folder = f"{states}/batch={batch - 1}", f"{states}/batch={batch}"
        if batch and not stage.exists(spark, f"{before}/clock"):
            raise RuntimeError(f"{checkpoint} has no state of batch {batch - 1}.")
        now = spark.read.parquet(f"{before}/clock").first()["now"] if batch else 0
        timed = rows.withColumn("created_at", F.col("created_at").cast("timestamp"))
        at = slice_of(F.col("created_at"), slice_seconds)
        latest = timed.agg(F.max(at)).first()[0]
        after = now if latest is None else max(now, latest - delay_ms)

        found = arrived(timed.filter(at > now), brand, slice_seconds)
        if batch:
            found = known(spark, before).unionByName(found)
        settle(found, after, keep_ms, slice_seconds).write.mode("overwrite").parquet(f"{folder}/posts")
        spark.range(1).select(F.lit(after).cast("long").alias("now")).write.mode("overwrite").parquet(f"{folder}/clock")
        pairs = spark.read.schema(STATE).parquet(f"{folder}/posts").filter("settled AND reply.text IS NOT NULL").select(
            F.col("post").alias("tweet_id"), "asked.text", F.col("reply.text").alias("gold_reply"))
        pairs.write.mode("overwrite").parquet(f"{path}/_next")
        stage.publish(spark, f"{path}/_next", path, f"pairs-{batch}")
        for old in stage.folders(spark, states, "batch="):
            if int(old) < batch - 1:
                stage.remove(spark, f"{states}/batch={old}")

    return (
        posts.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def count_stream(messages: DataFrame, path: str, checkpoint: str, text: str = "text", confidence: str | None = None) -> StreamingQuery:
    """Running counts by intent and decision of all messages so far; a message without intent counts as ``none``.

    The state is one number per intent and decision.  Each batch writes all counts to a folder of its own, so a
    batch that is repeated replaces its own numbers.
    """
    routed = route_messages(messages, text, confidence)
    counts = routed.groupBy(F.coalesce("intent", F.lit("none")).alias("intent"), "decision").agg(F.count("*").alias("n"))

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return (
        counts.writeStream.foreachBatch(write).outputMode("complete")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts of the last batch that was written to its end."""
    batches = [p for p in stage.folders(spark, path, "batch=") if stage.exists(spark, f"{path}/batch={p}")]
    return spark.read.parquet(f"{path}/batch={max(map(int, batches))}")
