"""Evaluating predictions and comparing models."""

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from deskflow.functions.routing import baseline_route
from deskflow.operators.metrics import (
    class_report, compare_models, escalation_scores, intent_scores, majority_predictions, metrics_document,
)
from deskflow.operators.models import SvmBaseline
from deskflow.operators.rubric import human_agreement, judge_summary, rounded_agreement, score_replies
from deskflow.plans.predict import SupportAgent
from deskflow.sources.stage import stage
from deskflow.sources.tables import default_column


COMPARED = ("truth", "predicted", "truth_route", "route")


def training_report(agent: SupportAgent, validation: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accuracy and macro scores on the validation split in one row, and the report by class."""
    rows = validation.withColumnRenamed("intent", "truth")
    encoded = agent.encoder.encode(rows) if agent.encoder else rows
    scored = stage(agent.classifier.predict(encoded).groupBy("truth", "intent").agg(
        F.count("*").alias("n")), "validation-counts")
    return intent_scores(scored, "truth", "intent", "n"), class_report(scored, "truth", "intent", "n")


def attach_truth(predictions: DataFrame, truth: DataFrame, key: str = "tweet_id") -> DataFrame:
    """Predictions with the true intent and routing, joined by id."""
    truth = default_column(default_column(truth, "escalate", "AUTO"), "gold_reply", "")
    return predictions.join(
        truth.select(key, F.col("intent").alias("ground_truth_intent"),
                     F.col("escalate").alias("ground_truth_escalate"), "gold_reply"), key)


def predict_with_truth(agent: SupportAgent, evaluation: DataFrame, key: str = "tweet_id") -> DataFrame:
    predictions = agent.predict(evaluation, message_id=key, text="tweet").drop("retrieved_context")
    return attach_truth(predictions, evaluation, key)


def evaluate_predictions(
    predictions: DataFrame, dataset: str, judge: bool = False, review: DataFrame | None = None
) -> DataFrame:
    """Metrics document of predictions with truth.

    Predictions are reduced once to counts by (truth, prediction, both routings); all scores come from those.
    """
    counts = stage(
        predictions.groupBy("ground_truth_intent", "intent", "ground_truth_escalate", "decision").agg(
            F.count("*").alias("n")), "score-counts")
    summary = agreement = None
    if judge:
        summary = judge_summary(score_replies(predictions.select("generated_reply")))
        if review is not None:
            scored = score_replies(review.select("gold_reply", "human_average_score"), "gold_reply")
            agreement = rounded_agreement(human_agreement(scored, "human_average_score", "average_score"))
    return metrics_document(
        dataset,
        intent_scores(counts, "ground_truth_intent", "intent", "n"),
        escalation_scores(counts, "ground_truth_escalate", "decision", "n"),
        summary, agreement,
    )


def evaluate_agent(
    agent: SupportAgent, evaluation: DataFrame, dataset: str, judge: bool = False, review: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(predictions with truth, metrics document); the predictions are computed and written once."""
    predictions = stage(predict_with_truth(agent, evaluation), "predictions")
    return predictions, evaluate_predictions(predictions, dataset, judge, review)


def agent_predictions(agent: SupportAgent, evaluation: DataFrame) -> DataFrame:
    rows = predict_with_truth(agent, evaluation)
    return rows.select(
        F.col("ground_truth_intent").alias("truth"), F.col("intent").alias("predicted"),
        F.col("ground_truth_escalate").alias("truth_route"), F.col("decision").alias("route"))


def svm_predictions(train: DataFrame, evaluation: DataFrame) -> DataFrame:
    model = SvmBaseline.fit(train)
    rows = model.predict(evaluation.select("tweet", F.col("intent").alias("truth"), "escalate"), output="predicted")
    return rows.select(
        "truth", "predicted", F.col("escalate").alias("truth_route"),
        baseline_route(F.col("tweet"), F.col("predicted")).alias("route"))


def compare_baselines(train: DataFrame, evaluation: DataFrame, agent: SupportAgent) -> DataFrame:
    """Majority class, TF-IDF with linear SVM, and the agent: one row each, all scored in one pass."""
    models: dict[str, Callable[[], DataFrame]] = {
        "majority": lambda: majority_predictions(train, evaluation),
        "tfidf_svm": lambda: svm_predictions(train, evaluation),
        "agent": lambda: agent_predictions(agent, evaluation),
    }
    frames = [rows().select(F.lit(name).alias("model"), *COMPARED) for name, rows in models.items()]
    return compare_models(frames[0].unionByName(frames[1]).unionByName(frames[2]))
