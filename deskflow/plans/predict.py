"""Prediction for tables of messages."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from deskflow import fixed, schemas
from deskflow.functions.columns import compute_once
from deskflow.functions.replies import draft_reply
from deskflow.functions.routing import route
from deskflow.functions.text import clean_text, round_binary, strip
from deskflow.operators.models import IntentClassifier, TextEncoder
from deskflow.operators.retrieval import retrieve_context
from deskflow.sources.sinks import sink_predictions, sink_vector_table
from deskflow.sources.stage import exists
from deskflow.sources.tables import default_column, read_messages, scan_messages


def vector_table(encoder: TextEncoder | None, pairs: DataFrame, vector: str | None = None) -> DataFrame:
    """Index rows: id (of any type that has an order), vector and texts of question-reply pairs.

    The vectors come from the encoder, or, when they are there already, from the column ``vector``.
    """
    kept = [F.col(vector).alias("embedding")] if vector else []
    rows = default_column(pairs, "intent", "general_inquiry").select(
        F.col("tweet_id").alias("id"), "tweet", F.col("gold_reply").alias("apple_reply"), "intent", *kept)
    return (rows if vector else encoder.encode(rows)).select(*schemas.VECTOR_TABLE.names)


@dataclass
class SupportAgent:
    """Fitted encoder, classifier and index."""

    encoder: TextEncoder | None
    classifier: IntentClassifier
    index: DataFrame

    @classmethod
    def fit(cls, train: DataFrame, past: DataFrame | None = None, encoder: TextEncoder | None = None,
            vector: str | None = None) -> "SupportAgent":
        """Fit on training pairs (tweet_id, tweet, gold_reply, intent).

        ``past`` are the pairs to search for similar cases, as many as there are; without it, the training pairs.
        ``encoder`` replaces the built-in one.  ``vector`` names a column of precomputed vectors in both tables; then no
        text is encoded, and messages bring their vectors as well.
        """
        past = train if past is None else past
        if vector:
            return cls(None, IntentClassifier.fit(train, vector=vector), vector_table(None, past, vector))
        encoder = encoder or TextEncoder.fit(train)
        classifier = IntentClassifier.fit(encoder.encode(train.select("tweet", "intent")))
        return cls(encoder, classifier, vector_table(encoder, past))

    def save(self, path: str) -> None:
        """Classifier, index and the built-in encoder; an encoder of the caller's own is given again to ``load``."""
        if self.encoder is not None and self.encoder.model is not None:
            self.encoder.model.write().overwrite().save(f"{path}/encoder")
        self.classifier.save(path)
        sink_vector_table(self.index, f"{path}/index")

    @classmethod
    def load(cls, spark: SparkSession, path: str, encoder: TextEncoder | None = None) -> "SupportAgent":
        classifier = IntentClassifier.load(spark, path)
        if encoder is None and exists(spark, f"{path}/encoder/metadata"):
            encoder = TextEncoder(PipelineModel.load(f"{path}/encoder"))
        return cls(encoder, classifier, spark.read.parquet(f"{path}/index").select(*schemas.VECTOR_TABLE.names))

    def predict(
        self, messages: DataFrame, k: int = fixed.TOP_K, message_id: str = "message_id", text: str = "text",
        clean: bool = False, vector: str | None = None,
    ) -> DataFrame:
        """Message id and the seven contract columns.

        ``vector`` names a column of precomputed vectors; an agent without an encoder needs it.  With an index of checked size there is no shuffle: each message is encoded once, classified, compared
        with the index, routed and answered in one stage.  Routing sees the unrounded confidence.
        """
        prepared = clean_text(F.col(text)) if clean else strip(F.col(text))
        given = [F.col(vector).alias("embedding")] if vector else []
        rows = messages.select(message_id, prepared.alias("tweet"), *given)
        encoded = rows if vector else self.encoder.encode(rows)
        scored = self.classifier.predict(encoded).drop("class_probabilities")
        found = retrieve_context(scored, self.index, k)
        routed = compute_once(found, _r=route(F.col("tweet"), F.col("intent"), F.col("confidence")))
        return routed.select(
            message_id, "tweet", "intent", round_binary(F.col("confidence"), 4).alias("confidence"),
            draft_reply(F.col("retrieved_context")).alias("generated_reply"),
            F.col("_r.decision").alias("decision"), F.col("_r.reason").alias("reason"), "retrieved_context",
        )

    def predict_texts(self, texts: Sequence[str | None], k: int = fixed.TOP_K) -> DataFrame:
        """Predict for a few texts at hand; ``message_id`` is the place in the list."""
        rows = self.index.sparkSession.createDataFrame(list(enumerate(texts)), "message_id long, text string")
        return self.predict(rows, k)


def predict_table(
    agent: SupportAgent, messages: DataFrame, path: str, k: int = fixed.TOP_K, fmt: str = "parquet"
) -> DataFrame:
    """Predict for any message table and write the message ids and the six contract columns."""
    rows = scan_messages(messages)
    if "message_id" not in rows.columns:
        raise ValueError("The messages have no column message_id; predict_file names them by file and row.")
    predictions = agent.predict(rows, k)
    sink_predictions(predictions, path, fmt, "message_id")
    return predictions


def predict_file(agent: SupportAgent, source: str, path: str, k: int = fixed.TOP_K, fmt: str = "parquet") -> DataFrame:
    """``predict_table`` for a table at a path, Parquet or (ending in .csv) CSV, with whatever columns it has."""
    return predict_table(agent, read_messages(agent.index.sparkSession, source), path, k, fmt)


def preview(df: DataFrame, order: str, rows: int = 3) -> DataFrame:
    return df.orderBy(order).limit(rows)


