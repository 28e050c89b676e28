"""Rule-based routing of messages, on a batch or a stream."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from deskflow import fixed
from deskflow.functions.columns import compute_once
from deskflow.functions.routing import route, weak_intent
from deskflow.functions.text import clean_text


def route_messages(messages: DataFrame, text: str = "text", confidence: str | None = None) -> DataFrame:
    """Adds cleaned text, rule intent, decision and reason.  Row by row, so it runs on a stream as it is."""
    sure = F.col(confidence) if confidence else F.lit(fixed.LABEL_CONFIDENCE)
    cleaned = compute_once(messages, tweet=clean_text(F.col(text)))
    labelled = compute_once(cleaned, intent=weak_intent(F.col("tweet")))
    routed = compute_once(labelled, _r=route(F.col("tweet"), F.col("intent"), sure))
    return routed.withColumn("decision", F.col("_r.decision")).withColumn("reason", F.col("_r.reason")).drop("_r")


def route_stream(
    messages: DataFrame, path: str, checkpoint: str, text: str = "text", confidence: str | None = None
) -> StreamingQuery:
    """Route all messages that have arrived so far into Parquet files, each exactly once."""
    return (
        route_messages(messages, text, confidence).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )
